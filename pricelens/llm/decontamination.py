"""Benchmark decontamination by size-partitioned MinHash containment search.

A document is contaminated by a test item if it holds at least ``threshold`` of
the item's distinct ``shingle``-word shingles (lower-cased words joined by one
space). An item of fewer words is one shingle of as many words as it has, and
documents are probed with shingles of that length too (only for the lengths that
occur among the items); an item without words has none and never matches.

Search: items are partitioned by size (distinct shingles, in powers of two, u
being the partition's upper bound). An item's sketch holds its
``floor((1 - threshold) * u) + 1`` smallest shingle hashes. A document that
lacks all of them lacks more than ``1 - threshold`` of the item, so probing
documents for sketch values finds every contaminated pair, however long the
document; short items never drown in a long document's own signature.
Verification: the shingles of candidate documents are compared with the
candidates' items as text and counted exactly.

Sketches are broadcast in blocks of at most ``BLOCK`` rows (16 bytes each);
a larger benchmark takes several passes over the documents. Documents are
never shuffled for the search; only candidates are for the verification, by
(document, shingle), so a passage that a third of all documents share is
spread over all tasks.

Defined cases: null and blank texts match nothing; repeated rows and repeated
ids count once, with the largest containment; a null id is reported as null;
either table may be empty; extra columns are ignored or passed through.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import aside, let, text_key, word_array, written

SHINGLE = 5
THRESHOLD = 0.8
BLOCK = 1_000_000


def shingle_hashes(words: Column, lengths: list[int]) -> Column:
    """64-bit hashes of the word sequences of each of the ``lengths``, from the hashes of their words."""
    def of(h):
        def each(k):
            runs = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
            return F.when(F.size(h) >= k, runs).otherwise(F.array().cast("array<long>"))
        return each(lengths[0]) if len(lengths) == 1 else F.concat(*[each(k) for k in lengths])

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def shingle_texts(words: Column, lengths: list[int]) -> Column:
    """Distinct word sequences of each of the ``lengths`` as text."""
    def of(w):
        def each(k):
            runs = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)]))
            return F.when(F.size(w) >= k, runs).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(each(lengths[0]) if len(lengths) == 1 else F.concat(*[each(k) for k in lengths]))

    return let(words, of)


def item_shingles(items: DataFrame, k: int = SHINGLE) -> DataFrame:
    """One row per item and distinct shingle: ik (item key), item_id, s, h, n (distinct shingles of the item), len (words
    of a shingle)."""
    one = items.select("item_id", text_key(F.col("text")).alias("ik"), word_array(F.col("text")).alias("w")).distinct()
    long = F.size("w") >= k
    one = one.withColumn("ss", F.when(long, shingle_texts(F.col("w"), [k])).when(F.size("w") > 0, F.array(F.concat_ws(" ", "w")))
                         .otherwise(F.array().cast("array<string>"))).withColumn("len", F.least(F.size("w"), F.lit(k)))
    rows = one.select("item_id", "ik", F.size("ss").cast("long").alias("n"), "len", F.explode("ss").alias("s"))
    words = F.split("s", " ")
    h = F.coalesce(*[F.when(F.col("len") == n, shingle_hashes(words, [n])[0]) for n in range(1, k + 1)])
    return rows.withColumn("h", h)


def sketches(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The smallest hashes of each item, as many as its size partition asks for."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n"))))
    size = F.floor((1 - threshold) * upper + 1e-9) + 1
    rank = F.row_number().over(W.partitionBy("item_id", "ik").orderBy("h", "s"))
    return shingles.withColumn("r", rank).filter(F.col("r") <= size).select("item_id", "ik", "h").distinct()


def contaminated_pairs(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE,
                       block: int = BLOCK) -> DataFrame:
    """One row per contaminated (document text, item): doc_id, dk (text key), item_id, n_item, n_shared, containment."""
    wanted = written(item_shingles(items, k), "decontam-items")
    sketch = written(sketches(wanted, threshold), "decontam-sketch")
    lengths = sorted(r["len"] for r in wanted.select("len").distinct().collect()) or [k]    # at most k values
    blocks = max(1, math.ceil(sketch.count() / block))
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("dk"), "text")
    probes = keyed.select("doc_id", "dk", F.explode(shingle_hashes(word_array(F.col("text")), lengths)).alias("h"))
    found = None
    for i in range(blocks):
        part = sketch.filter(F.pmod(F.col("h"), F.lit(blocks)) == i)
        hit = probes.join(F.broadcast(part), "h").select("doc_id", "dk", "item_id", "ik")
        found = hit if found is None else found.union(hit)
    pairs = written(found.distinct(), "decontam-candidates")
    cand = pairs.select(F.col("doc_id").alias("c_id"), F.col("dk").alias("c_dk")).distinct()
    texts = keyed.join(cand, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("dk") == F.col("c_dk")), "left_semi")
    have = texts.dropDuplicates(["doc_id", "dk"]).select("doc_id", "dk", F.explode(shingle_texts(word_array(F.col("text")), lengths)).alias("s"))
    need = pairs.join(wanted.withColumnRenamed("item_id", "i_id").withColumnRenamed("ik", "i_k"),
                      F.col("item_id").eqNullSafe(F.col("i_id")) & (F.col("ik") == F.col("i_k"))).select("doc_id", "dk", "item_id", "ik", "n", "s")
    have = have.select(F.col("doc_id").alias("h_id"), F.col("dk").alias("h_dk"), F.col("s").alias("h_s"))
    both = need.join(have, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("dk") == F.col("h_dk")) & (F.col("s") == F.col("h_s")), "left_semi")
    counted = both.groupBy("doc_id", "dk", "item_id", "ik", "n").agg(F.count(F.lit(1)).alias("n_shared"))
    share = F.col("n_shared") / F.col("n")
    return (counted.withColumn("containment", share).filter(F.col("containment") >= threshold)
            .select("doc_id", "dk", "item_id", F.col("n").alias("n_item"), "n_shared", "containment"))


def contaminations(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """One row per (doc_id, item_id): n_item, n_shared, containment of the best match under those ids."""
    best = F.max(F.struct("containment", "n_shared", "n_item")).alias("b")
    return (contaminated_pairs(docs, items, threshold, k).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.n_item", "b.n_shared", "b.containment"))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    bad = (contaminated_pairs(docs, items, threshold, k)
           .select(F.col("doc_id").alias("b_id"), F.col("dk").alias("b_dk")).distinct())
    plain = aside(docs)
    keyed = plain.withColumn("__dk", text_key(F.col("text")))
    return (keyed.join(bad, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("__dk") == F.col("b_dk")), "left_anti")
            .select(*plain.columns).toDF(*docs.columns))
