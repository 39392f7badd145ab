"""Secret scan: candidates by shape, false positives removed by a random forest.

Whitespace tokens are split at quotes, brackets, separators and ``= : & ; , ? |``, so
that a key in compact JSON, a query string or a list stands alone. A candidate is a
piece of eight characters or more that holds a digit or stands in an assignment
(``name = value``, ``name: value``, ``name=value``), without its end punctuation; ``key`` is
the piece before it in its token. The forest judges each one by

* length, shares of digits, capitals, hex digits and symbols;
* character transitions: changes between letters, digits and cases, and the mean
  log-probability of its character pairs under pairs of the corpus's words;
* dictionary coverage: the share of its letters in runs that are corpus words
  (words found at least ``MIN_WORD`` times);
* path: slashes, an @, dots, a file ending, and the document's source kind;
* neighbouring words: credential names, assignment signs and quotes before and
  in it, dictionary words on both sides.

The forest is trained from labelled findings (columns of ``candidates`` plus
``label``), at most ``SAMPLE`` of them (a documented parameter). The given tables
hold no labelled findings, so the query labels candidates by strict formats
(``known_format``): key ids and tokens with a vendor's prefix, JSON web tokens, the
lines of private-key blocks, hex, base64 and mixed values under a credential name are
secrets; mail addresses, telephone and card numbers, network addresses, dates, versions,
paths, numbers and names made of words are not. A candidate in neither has no
label and isn't trained on; the forest alone judges it. The features don't include
the rule's outcome.

Everything is DataFrame and SQL work. The dictionary is one count over the words
of all documents; the pair table has at most 29 x 29 entries and travels as a
literal array; coverage is looked up once per distinct candidate.

Defined cases: null and blank texts have no candidates; repeated rows report
their findings each; a null source counts as plain text; without both classes
among the labels every candidate scores its class (0 if there is none); empty
tables give an empty result; texts may be of any length.
"""
from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, let, text_key, written

MIN_LENGTH = 8
MIN_WORD = 5
SAMPLE = 20_000
TREES = 24
DEPTH = 6
CUT = 0.5
NAMES = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth)"
ASSIGNED = NAMES + r"[\"']?\s*(=|:)"
_EDGE = "\"'`()[]{}<>,;.!?*#$%&|"
PIECE = r"[\"'`=:&;,?|{}\[\]()<>]+"
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0*#"
FEATURES = ["length", "digits", "uppers", "hexes", "symbols", "kind_changes", "case_changes", "pair_logp", "coverage",
            "slashes", "ats", "dots", "file_end", "pathlike_source", "named", "assigned", "quoted", "words_before", "words_after"]


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.greatest(F.length(value), F.lit(1))


def candidates(docs: DataFrame, carry: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``carry`` plus dk (text key), i (word number), value, prev2, prev, next, raw (the whole token), piece and key (its place in the token, and the piece before)."""
    text = F.btrim("text", F.lit(SPACE_CHARS))
    wanted = docs.filter(F.col("text").rlike(r"[0-9]|" + ASSIGNED))
    words = F.split(text, SPACE)

    def pick(w):
        def row(i):
            raw, prev = F.get(w, i), F.coalesce(F.get(w, i - 1), F.lit(""))
            prev2 = F.coalesce(F.get(w, i - 2), F.lit(""))
            outer = (prev.rlike(r"^(=|:)$") & prev2.rlike(NAMES)) | prev.rlike(ASSIGNED + "$")

            def pieces(parts):
                def piece(k):
                    value, key = F.btrim(F.get(parts, k), F.lit(_EDGE)), F.coalesce(F.get(parts, k - 1), F.lit(""))
                    named = F.when(key == "", outer).otherwise(key.rlike(NAMES) & raw.rlike("[=:]"))
                    return F.when((F.length(value) >= MIN_LENGTH) & (value.rlike("[0-9]") | named),
                                  F.struct(i.alias("i"), k.alias("piece"), raw.alias("raw"), prev2.alias("prev2"), prev.alias("prev"),
                                           F.coalesce(F.get(w, i + 1), F.lit("")).alias("next"), key.alias("key"), value.alias("value")))
                return F.filter(F.transform(F.sequence(F.lit(0), F.size(parts) - 1), piece), lambda s: s.isNotNull())

            return let(F.split(raw, PIECE), pieces)
        return F.flatten(F.transform(F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (F.length(F.get(w, i)) >= MIN_LENGTH)), row))

    return (wanted.select(*carry, text_key(F.col("text")).alias("dk"), F.explode(let(words, pick)).alias("c")).select(*carry, "dk", "c.*"))


def dictionary(docs: DataFrame, min_count: int = MIN_WORD) -> DataFrame:
    """Corpus words (lower-cased, letters only) and their counts over all documents."""
    w = F.explode(F.split(F.lower(F.btrim("text", F.lit(SPACE_CHARS))), SPACE)).alias("w")
    words = docs.select(w).select(F.rtrim(F.col("w"), F.lit(".,;:!?")).alias("w"))
    return words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= min_count) & F.col("w").rlike(r"^\p{L}{2,}$"))


def _symbols(value: Column) -> Column:
    """One of 29 signs per character: a-z, 0 for digits, * for other letters, # for the rest."""
    s = F.regexp_replace(F.lower(value), "[0-9]", "0")
    return F.regexp_replace(F.regexp_replace(s, r"[^\p{ASCII}]", "*"), "[^a-z0*]", "#")


def pair_table(words: DataFrame) -> list[float]:
    """Log-probability of each sign after each sign in the dictionary, add-half smoothed: 29 x 29 numbers."""
    s = _symbols(F.col("w"))
    each = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))
    pairs = words.select("n", s.alias("s")).filter(F.length("s") > 1).select("n", F.explode(each).alias("p"))
    k, counts = len(_ALPHABET), [[0.5] * len(_ALPHABET) for _ in _ALPHABET]
    for r in pairs.groupBy("p").agg(F.sum("n").alias("n")).collect():
        counts[_ALPHABET.index(r["p"][0])][_ALPHABET.index(r["p"][1])] += r["n"]
    from math import log
    return [log(counts[a][b] / sum(counts[a])) for a in range(k) for b in range(k)]


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` plus FEATURES."""
    table = F.array(*[F.lit(x) for x in pair_table(words)])
    spot = lambda s, i: F.instr(F.lit(_ALPHABET), F.substring(s, i, F.lit(1))) - 1
    distinct = found.select("value").distinct()
    runs = distinct.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit(r"(\p{L}{2,})"))).alias("run"))
    covered = (runs.join(words.select(F.col("w").alias("run"), F.lit(1).alias("known")), "run", "left").groupBy("value")
               .agg(F.sum(F.when(F.col("known") == 1, F.length("run")).otherwise(0)).alias("in_words")))

    def logp(s):
        steps = F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.get(table, spot(s, i) * len(_ALPHABET) + spot(s, i + 1)))
        return F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / (F.length(s) - 1)

    scored = distinct.withColumn("pair_logp", F.when(F.length("value") > 1, let(_symbols(F.col("value")), logp)).otherwise(0.0))
    scored = written(scored.join(covered, "value", "left")
                     .select(F.col("value").alias("v"), "pair_logp", (F.coalesce("in_words", F.lit(0)) / F.length("value")).alias("coverage")), "secrets-values")
    v, raw, prev, prev2, key = (F.col(c) for c in ("value", "raw", "prev", "prev2", "key"))
    num = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    plain = r"^\p{L}{2,}[.,;:!?]?$"
    return (found.join(scored, F.col("value") == F.col("v")).drop("v")
            .withColumn("length", F.length(v).cast("double")).withColumn("digits", _share(v, "[0-9]")).withColumn("uppers", _share(v, "[A-Z]"))
            .withColumn("hexes", _share(v, "[0-9a-fA-F]")).withColumn("symbols", _share(v, r"[^\p{L}0-9]"))
            .withColumn("kind_changes", _share(v, r"(?<=\p{L})(?=[0-9])|(?<=[0-9])(?=\p{L})"))
            .withColumn("case_changes", _share(v, r"(?<=\p{Lu})(?=\p{Ll})|(?<=\p{Ll})(?=\p{Lu})"))
            .withColumn("slashes", num(F.regexp_count(v, F.lit(r"[/\\]")))).withColumn("ats", num(F.regexp_count(v, F.lit("@"))))
            .withColumn("dots", num(F.regexp_count(v, F.lit("[.]")))).withColumn("file_end", num(v.rlike(r"[.][A-Za-z]{2,4}$")))
            .withColumn("pathlike_source", num(F.coalesce(F.col("source").cast("string"), F.lit("")).rlike(r"[/.]")))
            .withColumn("named", num(F.when(key == "", prev.rlike(NAMES) | prev2.rlike(NAMES)).otherwise(key.rlike(NAMES))))
            .withColumn("assigned", num(F.when(key == "", prev.rlike("(=|:)$")).otherwise(raw.rlike("[=:].{6}")))).withColumn("quoted", num(raw.rlike("[\"'`]")))
            .withColumn("words_before", num(prev.rlike(plain)) + num(prev2.rlike(plain))).withColumn("words_after", num(F.col("next").rlike(plain))))


VENDOR = (r"^(((?i)(AKIA|ASIA)[A-Z0-9]{16})|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{16,}|xox[abeoprs]-[A-Za-z0-9-]{10,}"
          r"|[srp]k_(live|test)_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{30,}|eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]*)$")
HARMLESS = (r"^([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+|[vV]?[0-9]+([.][0-9]+)+([-+][a-z]+[.]?[0-9]*)?|[+]?[0-9][0-9 ./_+-]*"
            r"|[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9.Z+-]*|([.~]|[A-Za-z])?[/\\\\].*[.][A-Za-z]{1,4}|//[^/@]+(/[A-Za-z0-9._~-]{0,24})*|([A-Za-z0-9._-]+/)+[A-Za-z0-9_-]+[.][A-Za-z]{1,4})$")


def known_format(found: DataFrame) -> Column:
    """1 for candidates in a strict secret format, 0 in a harmless one, null in neither (labels where no findings were labelled by hand)."""
    v = F.col("value")
    held = (F.col("named") == 1) & (F.col("assigned") == 1)
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    block = F.col("prev").rlike("KEY-----$") & v.rlike("^[A-Za-z0-9+/]{40,}$")
    secret = v.rlike(VENDOR) | block | (held & (v.rlike(r"^(?i)[0-9a-f]{16,128}$") | (mixed & ~v.rlike(HARMLESS) & (F.col("coverage") < 0.7))))
    harmless = v.rlike(HARMLESS) | (~held & (F.col("coverage") > 0.8))
    return F.when(secret, 1.0).when(harmless, 0.0)


def train(labelled: DataFrame, sample: int = SAMPLE):
    """Forest from labelled findings (FEATURES and label; rows without a label are left out), or the single class there is (0.0 without rows)."""
    key = F.xxhash64("doc_id", "i", "value")
    rows = written(labelled.filter(F.col("label").isNotNull()).select(*FEATURES, "label", key.alias("k")).orderBy("k", *FEATURES).limit(sample), "secrets-sample")
    classes = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(classes) < 2:
        return classes[0] if classes else 0.0
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=32, seed=17, featuresCol="features", labelCol="label",
                                    subsamplingRate=0.8, featureSubsetStrategy="sqrt")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.coalesce(4)))


def judge(found: DataFrame, model) -> DataFrame:
    """``found`` plus score (the forest's probability) and secret."""
    if isinstance(model, float):
        return found.withColumn("score", F.lit(model)).withColumn("secret", F.lit(model >= CUT))
    out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    return (out.withColumn("score", vector_to_array("probability")[1]).withColumn("secret", F.col("score") >= CUT)
            .drop("features", "rawPrediction", "probability", "prediction"))


def scan(docs: DataFrame, findings: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """Every candidate of ``docs`` with its score; ``findings``: labelled findings, by default ``known_format``."""
    found = written(candidates(docs), "secrets-candidates")
    words = written(dictionary(docs), "secrets-words")
    made = written(with_features(found, words), "secrets-features")
    labelled = made.withColumn("label", known_format(made)) if findings is None else findings
    return judge(made, train(labelled, sample))
