"""The pipeline stage by stage against brute force, on the given documents and on awkward ones."""
from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from pricelens.llm import mixing, sharding
from pricelens.llm.common import table

from .test_mixing_sharding import brute_targets, words
from .test_search import shingles
from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "sharding"]
    clean = cp.drop_toxic(spark, docs, SF).cache()
    assert clean.columns == docs.columns and set(rows_of(clean)) <= set(rows_of(docs)) and clean.count() > 0.8 * docs.count()
    harmless = {r["doc_id"] for r in table(spark, SF, "labels").filter("toxic = 0").collect()}
    assert harmless <= {d for d, _, _ in rows_of(clean)}

    before = rows_of(clean)
    comps = brute_components([d for d, _, _ in before], [brute_fingerprint(t) for _, t, _ in before])
    unique = cp.drop_near_duplicates(spark, clean, SF).cache()
    assert unique.columns == docs.columns and sorted(d for d, _, _ in rows_of(unique)) == sorted(set(comps))

    items = [shingles(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    want = [r for r in rows_of(unique) if not any(i and len(i & shingles(r[1])) / len(i) >= 0.8 for i in items)]
    kept = cp.drop_benchmark(spark, unique, SF).cache()
    assert kept.columns == docs.columns and sorted(rows_of(kept)) == sorted(want)

    sizes = collections.Counter()
    for _, t, s in want:
        sizes[s] += words(t)
    mixed = cp.mix_sources(spark, kept, SF).cache()
    got, targets = collections.Counter(rows_of(mixed)), brute_targets(sizes)
    assert mixed.columns == docs.columns and set(got) <= set(want) and max(got.values()) <= 3
    for s, t in targets.items():
        took = sum(n * words(x) for (_, x, src), n in got.items() if src == s)
        assert abs(took - t) <= max(words(x) for _, x, src in want if src == s)

    out = cp.shard(spark, mixed, SF)
    assert out.columns == [*docs.columns, "shard"] and collections.Counter(rows_of(out)) == got
    assert {r["shard"] for r in out.select("shard").collect()} <= set(range(sharding.SHARDS))


ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " ", "en", None, 0), (4, "a b c d e f g h", "en", "s", 8), (4, "a b c d e f g h", "en", "s", 8),
       (None, "null id text here to keep", "en", "t", 1), (5, "word " * 30_000, "en", "u", 9), (6, "a b c d e f g h", "en", "s", 8)]


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_stages_take_awkward_rows(spark, name, stage):
    docs = (spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
            .withColumn("shard", F.lit("clash")).withColumn("size", F.lit("x")).withColumn("fp", F.lit(0)))
    if name == "sharding":
        docs = docs.drop("shard")
    out = stage(spark, docs, SF)
    assert out.columns[:len(docs.columns)] == docs.columns
    n = out.count()
    if name in ("toxicity", "sharding"):
        assert n == len(ODD)
    elif name == "simhash_near_dedup":      # texts without words are one group, the repeated text another
        assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted([1, 4, 5, None], key=repr)
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_run_and_registration(spark):
    import __spark_entry__ as e
    assert e.queries()["pipeline"] is cp.run and cp.ORACLE_SQL is None
    assert {int(n[2:].split("_")[0]) for n in e.queries() if n.startswith("op")} == set(range(1, 14))
    out = cp.run(spark, SF)
    assert out.count() > 50 and "shard" in out.columns
    sources = {r["source"] for r in mixing.mix(table(spark, SF, "documents")).select("source").distinct().collect()}
    assert {r["source"] for r in out.select("source").distinct().collect()} <= sources


WORKING = ["rejected", "p_term", "p_repeated", "p_toxic", "fp", "__fp", "keep_id", "keep_fp", "b_id", "b_dk", "__dk", "m_id", "m_dk", "m_source", "__n",
           "__c", "n", "copies", "key", "__key", "size", "score", "x", "extra_0"]


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_extra_columns_named_like_working_columns_pass_through(spark, name, stage):
    docs = table(spark, SF, "documents")
    wide = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in WORKING])
    out = stage(spark, wide, SF)
    assert out.columns[:len(wide.columns)] == wide.columns
    got = out.select("doc_id", *WORKING).collect()
    assert got and all(r[c] == f"{c}-{r['doc_id']}" for r in got for c in WORKING)
    assert sorted(rows_of(out), key=repr) == sorted(rows_of(stage(spark, docs, SF)), key=repr)
