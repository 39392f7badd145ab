"""The dealt operators as queries over the given tables, with their DuckDB SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, language, language_model, mixing, packing, prefix_trie, quality, secrets, sharding, simhash, topk, toxicity,
               whitening)
from .common import id_crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


@query("op2_source_mix", f"""
WITH d AS (SELECT doc_id, source, coalesce(len({_WORDS}), 0)::BIGINT AS size,
                  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
p AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS w_all,
             3 * coalesce(sum(source_size) OVER r, 0) AS c_size, coalesce(sum(w) OVER r, 0) AS c_w FROM w
      WINDOW r AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (total - c_size) * w > 3 * source_size * (w_all - c_w) AS capped FROM p),
t AS (SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE
             (total - coalesce(sum(3 * source_size) FILTER (capped) OVER (), 0))::DOUBLE * w / (sum(w) FILTER (NOT capped) OVER ())::DOUBLE END AS target FROM c),
b AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, budget // greatest(source_size, 1) AS epochs, budget % greatest(source_size, 1) AS rest FROM b),
u AS (SELECT *, greatest(0, least(size, rest - before)) AS part FROM q)
SELECT doc_id, size, source_size, target, (epochs * size + part)::BIGINT AS taken,
       (epochs + CASE WHEN 2 * part >= greatest(size, 1) THEN 1 ELSE 0 END)::BIGINT AS copies FROM u
""")
def op2(spark, sf_dir):
    """Words each document gives to a mix by source weights 5, 2, 1."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op3_histogram_sharding")
def op3(spark, sf_dir):
    """40 shards of near-equal bytes."""
    out = sharding.sharded(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op5_simhash_near_dedup")
def op5(spark, sf_dir):
    """Fingerprint and component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_SHINGLES = """list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))"""


@query("op6_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 5) AS k FROM
      (SELECT item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark) WHERE len(w) > 0),
dk AS (SELECT doc_id, w, k FROM d JOIN (SELECT DISTINCT k FROM b) ON len(w) >= k),
ds AS (SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS s FROM dk),
bs AS (SELECT DISTINCT item_id, unnest({_SHINGLES}) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
x AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM x JOIN n USING (item_id) WHERE n_shared / n_item >= 0.8
""")
def op6(spark, sf_dir):
    """Documents that hold at least 0.8 of a benchmark item's five-word shingles (all of a shorter item)."""
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_toxicity_chain")
def op10(spark, sf_dir):
    """Category probabilities of every document and whether it is rejected."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain, ["doc_id"])


@query("op4_language_id")
def op4(spark, sf_dir):
    """Language of every document, learned from those whose id hash modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_crc_mod(F.col("doc_id"), 4) == 2)
    model = language.train(docs.filter("NOT held_out"), F.col("lang"))
    return language.predict(docs, model, ["doc_id", "held_out"])


@query("op9_quality_gam")
def op9(spark, sf_dir):
    """Quality of every document, learned from labels whose id hash modulo 5 is not 0."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_crc_mod(F.col("doc_id"), 5) == 0)
    labels = table(spark, sf_dir, "labels").filter(id_crc_mod(F.col("doc_id"), 5) != 0)
    return quality.rate(docs, labels, ["doc_id", "held_out"], cut=0.3)


@query("op8_pivot_top_k", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op8(spark, sf_dir):
    """The five best inner products of every fiftieth vector against all vectors."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op1_secret_scan")
def op1(spark, sf_dir):
    """Every secret candidate of the documents, its place and the forest's verdict."""
    out = secrets.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("i").cast("long").alias("word_no"), F.length("value").alias("n_chars"), "score", "secret",
                      F.sha2("value", 256).alias("value_sha256"), "coverage", "pair_logp", "named")


@query("op7_pitman_yor_lm")
def op7(spark, sf_dir):
    """Log10 probability of every text under a model of those whose id hash modulo 7 is not 2."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_crc_mod(F.col("doc_id"), 7) == 2)
    model, rare = language_model.train(docs.filter("NOT held_out"))
    return language_model.score(docs, model, rare, ["doc_id", "held_out"])


_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"


@query("op11_conversation_prefix_trie", f"""
WITH tab AS (SELECT {_CRC_TABLE} AS t),
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
               md5(md5(coalesce(role, '')) || coalesce(text, '')) AS h, coalesce(len({_WORDS}), 0)::BIGINT AS words
        FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 20 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''),
               lambda x: ascii(x)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 4 AS h FROM (SELECT DISTINCT c FROM own), tab),
turns AS (SELECT i.c, o.pos, 0 AS part, o.h, o.words FROM ids i JOIN own o ON o.c = i.base AND o.pos < i.h
          UNION ALL SELECT i.c, o.pos, 1, o.h, o.words FROM ids i JOIN own o ON o.c = i.c AND o.pos >= i.h),
path AS (SELECT c, row_number() OVER w AS d, string_agg(h, '') OVER w AS key, words FROM turns
         WINDOW w AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
         UNION ALL SELECT c, 0, '', 0 FROM ids),
node AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM path GROUP BY key, d),
up AS (SELECT n.*, p.key AS pkey, p.conv_id AS parent_conv_id FROM node n LEFT JOIN node p ON p.key = left(n.key, length(n.key) - 32) AND n.d > 0),
kids AS (SELECT pkey AS key, count(*) AS n_children FROM up WHERE d > 0 GROUP BY pkey),
full_ AS (SELECT u.*, coalesce(k.n_children, 0) AS n_children FROM up u LEFT JOIN kids k USING (key)),
sub AS (SELECT a.key, sum((f.n_convs - 1) * f.words)::BIGINT AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
        FROM full_ f JOIN path a ON a.c = f.conv_id AND a.d <= f.d GROUP BY a.key),
last AS (SELECT c, arg_max(key, d) AS key FROM path GROUP BY c),
ends AS (SELECT key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256 FROM last GROUP BY key)
SELECT conv_id, d::BIGINT AS depth, CASE WHEN d > 0 THEN parent_conv_id END AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_ JOIN sub USING (key) LEFT JOIN ends USING (key)
""")
def op11(spark, sf_dir):
    """Nodes of the trie of conversations that open as the first of their twenty does."""
    own = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    rows, conversations = prefix_trie.with_shared_openings(own, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, 3)
    return prefix_trie.trie(rows, conversations)


@query("op12_embedding_whitening")
def op12(spark, sf_dir):
    """Every vector on the four leading components of the distinct ones, with unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_sequence_packing")
def op13(spark, sf_dir):
    """Pieces of all documents in sequences of at most 1024 ids."""
    import public_tokenizers
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing.tokenizer_json(public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
