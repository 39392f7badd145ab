"""Learned column encodings (EN1-EN8, EN11, EN12, EN17) as DataFrame operators.

Each encoder is fitted on training rows only and returns small fitted tables
(vocabularies, per-column statistics) that are applied by joins or column
expressions. Fitting is a few aggregations over the training rows; nothing
row-level passes through the driver. Multi-column statistics are computed on
a long (column, value) view so one aggregation serves every column.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.portable import hash_int
from ..functions.ranks import distinct_ranks
from .profile import LIMIT, Profile

# Labels and the level limit must equal those of the encodings reproduced here.
MISSING = "__missing__"
LEVEL_SUFFIX = "__lvl"
MAX_LEVELS = 60
INDICATOR_PREFIX = "missingindicator_"
CHUNK_ROWS = 50_000


def long_values(df: DataFrame, cols: list[str], key: str | None = None) -> DataFrame:
    """(key?, column, value) with values cast to string: one row per (row, column)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value")) for c in cols]))
    sel = ([F.col(key)] if key else []) + [pairs.alias("_p")]
    return df.select(*sel).select(*([key] if key else []), "_p.col_name", "_p.value")


# ----------------------------------------------------------------------------
# EN1 / EN7: sorted vocabulary -> index
# ----------------------------------------------------------------------------
def vocabulary(train: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, idx): distinct non-null values per column, idx = place in sorted order (0-based).

    Distinct values are dealt over tasks by range, so a vocabulary of any size is ranked without one task for it.
    """
    counts = long_values(train, cols).filter(F.col("value").isNotNull()).groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("c"))
    return distinct_ranks(counts).select("col_name", "value", F.col("place").cast("int").alias("idx"))


def apply_ordinal(df: DataFrame, vocab: DataFrame, cols: list[str], unknown: int = -1, suffix: str = "") -> DataFrame:
    """EN7 (unseen -> -1) / EN1 (unseen or missing -> NULL when unknown=None)."""
    out = df
    for c in cols:
        v = vocab.filter(F.col("col_name") == c).select(F.col("value").alias(f"_v_{c}"), F.col("idx").alias(f"_i_{c}"))
        out = out.join(v, out[c].cast("string") == v[f"_v_{c}"], "left")
        idx = F.col(f"_i_{c}") if unknown is None else F.coalesce(F.col(f"_i_{c}"), F.lit(unknown))
        out = out.withColumn(c + suffix, idx).drop(f"_v_{c}", f"_i_{c}")
    return out


# ----------------------------------------------------------------------------
# EN2 / EN3
# ----------------------------------------------------------------------------
def missing_sentinel(df: DataFrame, cols: list[str]) -> DataFrame:
    """EN2: missing category -> '__missing__'."""
    return df.select(*[F.coalesce(F.col(c), F.lit(MISSING)).alias(c) if c in cols else F.col(c) for c in df.columns])


def most_frequent(train: DataFrame, cols: list[str]) -> DataFrame:
    """EN3: (column, value, n): most frequent non-null value per column; ties -> smallest label."""
    # pure aggregations: max count per column, then the smallest label holding it (no window)
    counts = long_values(train, cols).filter(F.col("value").isNotNull()).groupBy("col_name", "value").count()
    top = counts.groupBy("col_name").agg(F.max("count").alias("n"))
    return (counts.join(top, "col_name").filter(F.col("count") == F.col("n"))
            .groupBy("col_name").agg(F.min("value").alias("value"), F.first("n").alias("n")))


def impute_text(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(modes[c])).alias(c) if c in modes else F.col(c) for c in df.columns])


# ----------------------------------------------------------------------------
# EN4 / EN5 / EN8: numeric statistics in one aggregation
# ----------------------------------------------------------------------------
def numeric_stats(train: DataFrame, cols: list[str]) -> DataFrame:
    """(column, median, n_missing, mean, sd_pop) per numeric column, one aggregation.

    Median is exact (middle pair averaged, T2); mean and population sd are of
    the *imputed* column: with m missing values replaced by the median M,
    mean' = (sum + m M)/n and var' = (sumsq + m M^2)/n - mean'^2.
    """
    from ..functions.selection import grouped_quantiles
    # exact medians of every column from shared bounded selection passes (no per-column
    # buffer of distinct values in one task), then one aggregation for the moments
    meds = grouped_quantiles(train, cols, [0.5])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count_if(x.isNull()).alias(f"{c}__miss"),
                 F.sum(x).alias(f"{c}__s"), F.sum(x * x).alias(f"{c}__q"), F.count(F.lit(1)).alias(f"{c}__n")]
    wide = train.agg(*aggs)
    rows = []
    for c in cols:
        med = F.lit(meds[c][0]).cast("double")
        miss, s, q, n = (F.col(f"{c}__{p}") for p in ("miss", "s", "q", "n"))
        fill = F.coalesce(s, F.lit(0.0)) + miss * F.coalesce(med, F.lit(0.0))
        fillq = F.coalesce(q, F.lit(0.0)) + miss * F.coalesce(med, F.lit(0.0)) * F.coalesce(med, F.lit(0.0))
        mean = fill / n
        var = F.greatest(fillq / n - mean * mean, F.lit(0.0))
        rows.append(F.struct(F.lit(c).alias("col_name"), med.alias("median"), miss.alias("n_missing"),
                             mean.alias("mean"), F.sqrt(var).alias("sd_pop")))
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def profiled_stats(train: DataFrame, cols: list[str], found: Profile) -> dict[str, dict]:
    """``numeric_stats`` as {column: its row} from the rows' profile."""
    from ..functions.selection import grouped_quantiles
    wide = [c for c in cols if found.numbers[c].values is None]
    meds = {c: v[0] for c, v in grouped_quantiles(train, wide, [0.5]).items()} if wide else {}
    out = {}
    for c in cols:
        x, n = found.numbers[c], found.n
        miss = int(x.missing.sum())
        med = meds[c] if c in meds else x.median()
        fill = med or 0.0
        mean = (x.total + miss * fill) / n if n else None
        var = max((x.square + miss * fill * fill) / n - mean * mean, 0.0) if n else None
        if n and math.isnan(x.total):
            var = math.nan
        out[c] = {"median": med, "n_missing": miss, "mean": mean, "sd_pop": None if var is None else math.sqrt(var)}
    return out


@dataclass
class NumericPrep:
    """Fitted EN4 + EN5 (+ EN8 when ``scale``): driver-side per-column constants (bounded by column count)."""

    medians: dict[str, float | None]
    indicator_cols: list[str]
    means: dict[str, float]
    sds: dict[str, float]
    ind_means: dict[str, float]
    ind_sds: dict[str, float]
    scale: bool

    @staticmethod
    def fit(train: DataFrame, cols: list[str], scale: bool = True, found: Profile | None = None) -> "NumericPrep":
        """``found``: the rows' profile, if it is known already; only wide columns' medians are then taken from the rows."""
        st = {r["col_name"]: r for r in numeric_stats(train, cols).collect()} if found is None else profiled_stats(train, cols, found)  # one row per column
        meds = {c: st[c]["median"] for c in cols}
        inds = [c for c in cols if st[c]["n_missing"] > 0]
        n = (train.count() if found is None else found.n) if scale and inds else 0   # only indicator scaling needs the row count
        means = {c: st[c]["mean"] or 0.0 for c in cols}
        sds = {c: (st[c]["sd_pop"] or 0.0) for c in cols}
        im, isd = {}, {}
        for c in inds:
            p = st[c]["n_missing"] / n if n else 0.0
            im[c] = p
            isd[c] = (p * (1 - p)) ** 0.5
        return NumericPrep(meds, inds, means, sds, im, isd, scale)

    def columns(self) -> list[tuple[str, Column]]:
        out = []
        for c, med in self.medians.items():
            x = F.coalesce(F.col(c).cast("double"), F.lit(med))
            if self.scale:
                sd = self.sds[c] if self.sds[c] > 0 else 1.0
                x = (x - F.lit(self.means[c])) / F.lit(sd)
            out.append((c, x))
        for c in self.indicator_cols:
            x = F.col(c).isNull().cast("double")
            if self.scale:
                sd = self.ind_sds[c] if self.ind_sds[c] > 0 else 1.0
                x = (x - F.lit(self.ind_means[c])) / F.lit(sd)
            out.append((INDICATOR_PREFIX + c, x))
        return out

    def transform(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return df.select(*[F.col(k) for k in keep], *[e.alias(n) for n, e in self.columns()])


# ----------------------------------------------------------------------------
# EN11 / EN12: level routing and level labels
# ----------------------------------------------------------------------------
def route_levels(train: DataFrame, text_cols: list[str], numeric_cols: list[str], max_levels: int = MAX_LEVELS, found: Profile | None = None):
    """EN11: (level_cols, wide_cols). Text always expands; numeric iff exact distinct non-null <= max_levels.

    Exact distinct counts come from one grouped count on the long view of the
    numeric columns (values cast to double first, T6), not from approximations;
    or from the rows' profile ``found``.
    """
    if not numeric_cols:
        return list(text_cols), []
    if found is not None and max_levels <= LIMIT:
        distinct = {c: found.numbers[c].distinct() for c in numeric_cols}
        expanded = [c for c in numeric_cols if distinct[c] is not None and distinct[c] <= max_levels]
        return list(text_cols) + expanded, [c for c in numeric_cols if c not in expanded]
    lv = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("value")) for c in numeric_cols])).alias("_p"))
    counts = (lv.select("_p.*").filter(F.col("value").isNotNull()).distinct()
              .groupBy("col_name").count().collect())  # one row per column
    nd = {r["col_name"]: r["count"] for r in counts}
    expanded = [c for c in numeric_cols if nd.get(c, 0) <= max_levels]
    return list(text_cols) + expanded, [c for c in numeric_cols if c not in expanded]


def level_label(c: str, numeric: bool) -> Column:
    """EN12: value -> string (numerics via double, T6), missing -> '__missing__'."""
    x = F.col(c).cast("double").cast("string") if numeric else F.col(c).cast("string")
    return F.coalesce(x, F.lit(MISSING))


def add_level_columns(df: DataFrame, level_cols: list[str], numeric: set[str]) -> DataFrame:
    return df.select("*", *[level_label(c, c in numeric).alias(c + LEVEL_SUFFIX) for c in level_cols])


# ----------------------------------------------------------------------------
# EN6: one-hot in long form
# ----------------------------------------------------------------------------
def one_hot_long(df: DataFrame, vocab: DataFrame, cols: list[str], key: str = "ID") -> DataFrame:
    """(key, feature, value=1.0) for every seen level; unseen or missing -> no row (all zeros)."""
    lv = long_values(df, cols, key).filter(F.col("value").isNotNull())
    hit = lv.join(vocab.select("col_name", "value"), ["col_name", "value"])
    return hit.select(key, F.concat(F.col("col_name"), F.lit("_"), F.col("value")).alias("feature"), F.lit(1.0).alias("value"))


# ----------------------------------------------------------------------------
# EN17: ordered target statistics, salted for hot levels
# ----------------------------------------------------------------------------
def ordered_target_stats(train: DataFrame, level: str, target: str, key: str = "ID", a: float = 1.0,
                         seed: int = 42, chunk_bits: int | None = None, out: str = "ots") -> DataFrame:
    """EN17: each row encoded from *earlier* rows of its level: (sum y + a prior) / (n + a).

    Row order = (hash(seed, key), key). A hot level is split into 2^chunk_bits
    contiguous hash chunks: per-chunk totals (one aggregation), an exclusive
    prefix over the (level, chunk) table (bounded by levels x chunks), and the
    running sum inside each chunk (window partitioned by level *and* chunk),
    so no task sees more than one chunk of one level.
    """
    prior = train.agg(F.avg(target)).scalar()
    if chunk_bits is None:      # a chunk of the whole table holds about CHUNK_ROWS rows, whatever its size
        chunk_bits = min(32, max(0, math.ceil(math.log2(max(1, train.count()) / CHUNK_ROWS))))
    h = hash_int(seed, F.col(key))
    d = train.select(key, level, target, h.alias("_h")).withColumn("_c", F.shiftright("_h", 32 - chunk_bits) if chunk_bits else F.lit(0).cast("long"))
    chunks = d.groupBy(level, "_c").agg(F.sum(target).alias("_cs"), F.count(F.lit(1)).alias("_cn"))
    wc = Window.partitionBy(level).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(level, "_c", F.coalesce(F.sum("_cs").over(wc), F.lit(0.0)).alias("_ps"),
                           F.coalesce(F.sum("_cn").over(wc), F.lit(0)).alias("_pn"))
    wr = Window.partitionBy(level, "_c").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, -1)
    inner = d.select("*", F.coalesce(F.sum(target).over(wr), F.lit(0.0)).alias("_rs"),
                     F.count(F.lit(1)).over(wr).alias("_rn"))
    j = inner.join(chunks, [level, "_c"])
    s, n = F.col("_rs") + F.col("_ps"), F.col("_rn") + F.col("_pn")
    return j.select(key, level, target, ((s + F.lit(a) * prior) / (n + F.lit(a))).alias(out))


def add_ordered_target_stats(train: DataFrame, levels: list[str], target: str, key: str = "ID", a: float = 1.0,
                             seed: int = 42, suffix: str = "__ts") -> DataFrame:
    """EN17 for many columns: ``train`` plus ``<level><suffix>`` of each, the values of ``ordered_target_stats``, without a join by row."""
    n, prior = train.agg(F.count(F.lit(1)), F.avg(target)).first()
    bits = min(32, max(0, math.ceil(math.log2(max(1, n) / CHUNK_ROWS))))
    d = train.withColumn("_h", hash_int(seed, F.col(key))).withColumn("_c", F.shiftright("_h", 32 - bits) if bits else F.lit(0).cast("long"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    for c in levels:
        wc, wr = before(Window.partitionBy(c).orderBy("_c")), before(Window.partitionBy(c, "_c").orderBy("_h", key))
        chunks = train.select(c, target, hash_int(seed, F.col(key)).alias("_h"))
        chunks = chunks.withColumn("_c", F.shiftright("_h", 32 - bits) if bits else F.lit(0).cast("long")).groupBy(c, "_c").agg(
            F.sum(target).alias("_cs"), F.count(F.lit(1)).alias("_cn"))
        chunks = chunks.select(c, "_c", F.coalesce(F.sum("_cs").over(wc), F.lit(0.0)).alias("_ps"), F.coalesce(F.sum("_cn").over(wc), F.lit(0)).alias("_pn"))
        inner = d.withColumn("_rs", F.coalesce(F.sum(target).over(wr), F.lit(0.0))).withColumn("_rn", F.count(F.lit(1)).over(wr))
        value = (F.col("_rs") + F.col("_ps") + F.lit(a * (prior or 0.0))) / (F.col("_rn") + F.col("_pn") + F.lit(a))
        d = inner.join(chunks, [c, "_c"]).withColumn(c + suffix, value).drop("_rs", "_rn", "_ps", "_pn")
    return d.drop("_h", "_c")


def add_target_stats(df: DataFrame, train: DataFrame, levels: list[str], target: str, a: float = 1.0, suffix: str = "__ts") -> DataFrame:
    """EN17 at scoring time for many columns: ``df`` plus ``<level><suffix>`` from the tables of ``train``; the prior for unseen levels."""
    prior = train.agg(F.avg(target)).first()[0]
    for c in levels:
        df = df.join(target_stats_table(train, c, target, a).withColumnRenamed("te", c + suffix), c, "left")
        df = df.withColumn(c + suffix, F.coalesce(c + suffix, F.lit(prior)))
    return df


def target_stats_table(train: DataFrame, level: str, target: str, a: float = 1.0) -> DataFrame:
    """EN17 scoring-time statistic: (n mean + a prior)/(n + a) per level, prior for unseen."""
    prior = train.agg(F.avg(target)).scalar()
    g = train.groupBy(level).agg(F.sum(target).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return g.select(level, ((F.col("_s") + F.lit(a) * prior) / (F.col("_n") + F.lit(a))).alias("te"))
