"""Feature, encoder, split, model closed-form, blend, bootstrap and attribution properties."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators import blend as bl
from pricelens.operators import bootstrap as bs
from pricelens.operators import encode as en
from pricelens.operators import explain as sh
from pricelens.operators.features import engineer, FeatureConfig, add_interactions
from pricelens.operators.group_models import fit_backfit, fit_one_factor_ridge
from pricelens.operators.split import assign_folds, exact_split, make_dev_holdout, sample_rows


# ---------------------------------------------------------------------------- FE
def test_text_fixtures(spark):
    df = spark.createDataFrame([("Acer Creator HGG", "Intel i5-12462"), ("One", "Intel i5-12")], "model string, cpu_model string")
    out = engineer(df, FeatureConfig(cpu_generation=True), drop=()).collect()
    assert out[0]["model_line"] == "Creator" and out[1]["model_line"] is None          # T7: NULL per row
    assert out[0]["cpu_family"] == "Intel i5" and out[1]["cpu_family"] == "Intel i5-12"
    assert out[0]["cpu_generation"] == 12.0 and out[1]["cpu_generation"] is None


def test_structural_zeros_and_resolution(spark):
    df = spark.createDataFrame([(0.0, 65.0, 0.0, "1920x1080", 15.6), (50.0, 0.0, 300.0, "bad", 0.0)],
                               "battery_wh double, charger_watts double, psu_watts double, resolution string, display_size_in double")
    r = engineer(df).collect()
    assert (r[0]["has_battery"], r[0]["has_psu"], r[0]["power_watts"], r[0]["battery_wh"]) == (0, 0, 65.0, None)
    assert r[1]["psu_watts"] == 300.0 and r[1]["charger_watts"] is None
    assert r[0]["res_pixels"] == 1920 * 1080 and r[0]["res_ppi"] == pytest.approx((1920 ** 2 + 1080 ** 2) ** 0.5 / 15.6)
    assert r[1]["res_width"] is None and r[1]["res_ppi"] is None                       # try_cast, nullif (T1)


def test_family_skips_when_inputs_absent(spark):
    df = spark.createDataFrame([(1.0,)], "ram_gb double")
    assert engineer(df, FeatureConfig(capacity=True, premium=True)).columns == ["ram_gb", "ram_log2", "is_high_ram"]


def test_interactions(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    out = add_interactions(df, [("x", "y"), ("x", "missing")])
    assert out.columns == ["x", "y", "x_X_y"] and out.first()["x_X_y"] == "a|NA"


# ---------------------------------------------------------------------------- EN
def test_encoder_fixture(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",)], "c string")
    vocab = en.vocabulary(fit, ["c"])
    assert [(r["value"], r["idx"]) for r in vocab.orderBy("idx").collect()] == [("a", 0), ("b", 1), ("c", 2)]
    new = spark.createDataFrame([("k1", "a"), ("k2", "zz"), ("k3", None)], "ID string, c string")
    hot = en.one_hot_long(new, vocab, ["c"]).collect()
    assert [(r["ID"], r["feature"]) for r in hot] == [("k1", "c_a")]                  # unseen / missing: all zeros
    codes = {r["ID"]: r["c"] for r in en.apply_ordinal(en.impute_text(new, {"c": "b"}), vocab, ["c"]).collect()}
    assert codes == {"k1": 0, "k2": -1, "k3": 1}


def test_numeric_prep_population_scaling(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    prep = en.NumericPrep.fit(df, ["x"], scale=True)
    vals = np.array([1, 2, 3, 10, 2.5])
    assert prep.medians["x"] == 2.5 and prep.indicator_cols == ["x"]
    assert prep.sds["x"] == pytest.approx(vals.std()) and prep.means["x"] == pytest.approx(vals.mean())


def test_ordered_target_stats_matches_pandas(spark):
    import pandas as pd
    from pricelens.functions.portable import hash_int
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"ID": [f"k{i}" for i in range(400)], "lvl": rng.choice(["a", "b", "c"], 400, p=[.7, .2, .1]),
                        "y": rng.normal(100, 10, 400)})
    df = spark.createDataFrame(pdf)
    got = en.ordered_target_stats(df, "lvl", "y", a=2.0, chunk_bits=3).toPandas().set_index("ID")["ots"]
    h = df.select("ID", hash_int(42, F.col("ID")).alias("h")).toPandas().set_index("ID")["h"]
    pdf["h"] = pdf["ID"].map(h)
    pdf = pdf.sort_values(["h", "ID"])
    prior = pdf["y"].mean()
    cs = pdf.groupby("lvl")["y"].cumsum() - pdf["y"]
    cn = pdf.groupby("lvl").cumcount()
    exp = ((cs + 2.0 * prior) / (cn + 2.0)).set_axis(pdf["ID"])
    np.testing.assert_allclose(got.loc[exp.index].to_numpy(), exp.to_numpy(), rtol=1e-12)


# ---------------------------------------------------------------------------- SP
def test_split_disjoint_complete_and_partition_independent(spark, device_small):
    a = make_dev_holdout(device_small).select("ID", "split")
    b = make_dev_holdout(device_small.repartition(13)).select("ID", F.col("split").alias("s2"))
    j = a.join(b, "ID")
    assert j.count() == device_small.count() and j.filter("split <> s2").count() == 0
    frac = a.filter("split = 'holdout'").count() / a.count()
    assert 0.17 < frac < 0.23


def test_exact_split_size(spark, device_small):
    n = device_small.count()
    s = exact_split(device_small.select("ID"), "ID", 5, n_test=777)
    assert s.filter("split = 'holdout'").count() == 777
    assert sample_rows(device_small, 50).count() == 50


def test_folds_repeat_seeds(spark, device_small):
    f = assign_folds(device_small.select("ID"), "ID", 5, 42, repeats=2)
    counts = f.groupBy("repeat", "fold").count().collect()
    assert len(counts) == 10 and sum(r["count"] for r in counts) == 2 * device_small.count()


# ---------------------------------------------------------------------------- MD
def test_one_factor_ridge_matches_matrix_solution(spark):
    rng = np.random.default_rng(3)
    lv = rng.choice(list("abcd"), 300)
    y = rng.normal(0, 1, 300) + (lv == "a") * 3
    df = spark.createDataFrame([(f"k{i}", str(l), float(v), 0) for i, (l, v) in enumerate(zip(lv, y))], "ID string, g string, y double, m int")
    model = fit_one_factor_ridge(df, ["m"], "y", "g", 7.0)
    pred = model.predict(df, "p").orderBy("ID").toPandas()
    X = np.column_stack([np.ones(300)] + [(lv == c).astype(float) for c in "abcd"])
    P = np.diag([0.0, 7.0, 7.0, 7.0, 7.0])
    w = np.linalg.solve(X.T @ X + P, X.T @ y)
    exp = dict(zip([f"k{i}" for i in range(300)], X @ w))
    np.testing.assert_allclose(pred["p"], [exp[k] for k in pred["ID"]], rtol=1e-10)


def test_backfit_converges_to_joint_ridge(spark):
    rng = np.random.default_rng(4)
    a, b = rng.choice(list("xyz"), 500), rng.choice(list("pq"), 500)
    y = rng.normal(0, 1, 500) + (a == "x") * 2 + (b == "p") * 1.5
    df = spark.createDataFrame([(f"k{i}", str(u), str(v), float(t), 0) for i, (u, v, t) in enumerate(zip(a, b, y))],
                               "ID string, a string, b string, y double, m int")
    pred = fit_backfit(df, ["m"], "y", ["a", "b"], 3.0, sweeps=12).predict(df, "p").orderBy("ID").toPandas()
    X = np.column_stack([(a == c).astype(float) for c in "xyz"] + [(b == c).astype(float) for c in "pq"])
    yc = y - y.mean()
    w = np.linalg.solve(X.T @ X + 3.0 * np.eye(5), X.T @ yc)
    exp = dict(zip([f"k{i}" for i in range(500)], y.mean() + X @ w))
    np.testing.assert_allclose(pred["p"], [exp[k] for k in pred["ID"]], atol=1e-4)


# ---------------------------------------------------------------------------- BL
def test_nnls_matches_brute_force():
    rng = np.random.default_rng(5)
    X = rng.normal(size=(200, 4)) + 5
    y = X @ np.array([0.5, 0.0, 1.2, -0.3]) + rng.normal(size=200)
    import itertools
    w = bl.nnls_gram(X.T @ X, X.T @ y)
    assert (w >= 0).all()
    best = np.sum(y ** 2)
    for size in range(1, 5):
        for s in itertools.combinations(range(4), size):
            v = np.linalg.lstsq(X[:, list(s)], y, rcond=None)[0]
            if (v >= 0).all():
                best = min(best, float(np.sum((y - X[:, list(s)] @ v) ** 2)))
    assert np.sum((y - X @ w) ** 2) == pytest.approx(best, rel=1e-10)


def test_stacking_loo_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(10, 2, 60)
    bb = a + rng.normal(0, 1, 60)
    y = 0.6 * a + 0.3 * bb + 2 + rng.normal(0, 0.5, 60)
    wide = spark.createDataFrame([(float(u), float(v), float(t)) for u, v, t in zip(a, bb, y)], "a double, b double, y double")
    out = bl.stacking(wide, ["a", "b"], alphas=(0.1, 10.0)).collect()
    alpha = out[0]["alpha"]
    X = np.column_stack([a, bb])

    def fit(Xt, yt):
        m, my = Xt.mean(0), yt.mean()
        w = np.linalg.solve((Xt - m).T @ (Xt - m) + alpha * np.eye(2), (Xt - m).T @ (yt - my))
        return w, my - m @ w
    errs = []
    for i in range(60):
        keep = np.arange(60) != i
        w, b0 = fit(X[keep], y[keep])
        errs.append(y[i] - b0 - X[i] @ w)
    assert out[0]["loo_rmse"] == pytest.approx(float(np.sqrt(np.mean(np.square(errs)))), rel=1e-8)


def _every_set(G, b):
    """NNLS by trying every set of members."""
    import itertools
    best, value = np.zeros(len(b)), 0.0
    for size in range(1, len(b) + 1):
        for idx in map(list, itertools.combinations(range(len(b)), size)):
            ws = np.linalg.solve(G[np.ix_(idx, idx)], b[idx])
            w = np.zeros(len(b))
            w[idx] = ws
            if ws.min() >= 0 and w @ G @ w - 2 * w @ b < value - 1e-12:
                best, value = w, w @ G @ w - 2 * w @ b
    return best


@pytest.mark.parametrize("seed", range(12))
def test_nnls_equals_every_set_and_starts_anywhere(seed):
    rng = np.random.default_rng(seed)
    k = 2 + seed % 7
    truth = rng.normal(size=300) * 10
    X = truth[:, None] + rng.normal(size=(300, k)) * rng.uniform(0.1, 6, k)      # members close to each other
    G, b = X.T @ X, X.T @ (truth + rng.normal(size=300) * (1 if seed % 3 else -40))
    want = _every_set(G, b)
    for start in ([], [0], list(range(k))):
        np.testing.assert_allclose(bl.nnls_gram(G, b, start), want, atol=1e-9)


def test_nnls_of_forty_members_is_optimal():
    rng = np.random.default_rng(1)
    X = rng.normal(size=(500, 40))
    X[:, 7] = X[:, 3]
    y = X[:, :6].sum(axis=1) - X[:, 10:14].sum(axis=1) + rng.normal(size=500)
    G, b = X.T @ X, X.T @ y
    w = bl.nnls_gram(G, b)
    slope = b - G @ w
    assert w.min() >= 0 and slope.max() < 1e-8 * np.abs(b).max() and np.abs(slope[w > 0]).max() < 1e-8 * np.abs(b).max()
    assert bl.nnls_gram(np.zeros((0, 0)), np.zeros(0)).size == 0 and bl.nnls_gram(np.eye(2), np.array([-1.0, -2.0])).tolist() == [0.0, 0.0]


def test_weighted_blend_is_linear(spark):
    wide = spark.createDataFrame([(float(i), float(i) * 2, float(i) + 1) for i in range(10)], "a double, b double, y double")
    r = bl.blended(wide, ["a", "b"], [0.25, 0.75]).select("pred").collect()
    assert [x["pred"] for x in r] == [0.25 * i + 1.5 * i for i in range(10)]


def test_cat_style_uses_every_engineered_column(spark):
    import json

    from pricelens.operators.cat_stage import OrderedTargetEncoder
    from pricelens.operators.explain import _column_names
    from pricelens.plans import q_ml
    d = engineer(q_ml.dev_holdout(spark, "/root/testdata/sf0.001"))
    cols = [c for c in d.columns if c not in ("ID", "price", "split")]
    dev = d.filter("split = 'dev'")
    encoder = OrderedTargetEncoder(colsJson=json.dumps(cols), labelCol="price")
    model, train = encoder.fit_rows(dev)
    names = _column_names(train)
    want = {c if kind != "string" else f"{c}__ts" for c, kind in d.dtypes if c in cols}
    assert set(names) == want and {"form_factor__ts", "resolution__ts", "ram_gb"} <= want
    score = model.transform(d)
    assert train.count() == dev.count() and score.count() == d.count()
    full = en.missing_sentinel(dev, ["brand", "resolution"])
    got = sorted((r["price"], *(round(r["features"][names.index(f"{c}__ts")], 6) for c in ("brand", "resolution"))) for r in train.collect())
    own = [en.ordered_target_stats(full, c, "price").select("ID", "price", F.round("ots", 6).alias(c)) for c in ("brand", "resolution")]
    assert got == sorted((r["price"], r["brand"], r["resolution"]) for r in own[0].join(own[1].drop("price"), "ID").collect())
    assert not any(np.isnan(r["features"].toArray()).any() for r in score.select("features").collect())


# ---------------------------------------------------------------------------- BS
def _errors(spark, sd, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.normal(1000, 200, n)
    return spark.createDataFrame([(f"k{i}", float(a), float(a + e)) for i, (a, e) in enumerate(zip(y, rng.normal(0, sd, n)))],
                                 "ID string, y double, pred double")


def test_bootstrap_brackets_point_and_ignores_partitioning(spark):
    df = _errors(spark, 50)
    a = bs.bootstrap_ci_bucketed(df, n_boot=300).first()
    b = bs.bootstrap_ci_bucketed(df.repartition(13), n_boot=300).first()
    assert a["ci_low"] < a["rmse"] < a["ci_high"]
    assert (a["ci_low"], a["ci_high"]) == (pytest.approx(b["ci_low"], rel=1e-12), pytest.approx(b["ci_high"], rel=1e-12))
    p = bs.bootstrap_ci_portable(df, n_boot=30).first()
    assert p["ci_low"] < p["rmse"] < p["ci_high"] and p["n_obs"] == 3000


def test_every_replicate_draws_n_rows_by_the_multinomial(spark):
    n, reps = 3 * bs.LEAF + 77, 4000
    w = np.hstack([bs.leaf_weights(j, n, reps, 5) for j in range(4)])
    assert w.shape == (reps, n) and (w.sum(axis=1) == n).all()
    p = 1 / n
    assert abs(w.var() - n * p * (1 - p)) < 0.01 and abs(w.mean(axis=0) - 1).max() < 5 / np.sqrt(reps)
    part = w[:, :bs.LEAF].sum(axis=1)                       # draws of a leaf: binomial(n, size / n)
    q = bs.LEAF / n
    assert abs(part.mean() - n * q) < 4 * np.sqrt(n * q * (1 - q) / reps) and abs(part.var() / (n * q * (1 - q)) - 1) < 0.1
    corr = np.corrcoef(part, w[:, -77:].sum(axis=1))[0, 1]  # parts of a multinomial: -sqrt(q r / ((1 - q)(1 - r)))
    r = 77 / n
    assert abs(corr + np.sqrt(q * r / ((1 - q) * (1 - r)))) < 0.06


def test_exact_bootstrap_against_numpy(spark):
    df = _errors(spark, 120, 2000, 9)
    e = np.array([(r["y"] - r["pred"]) ** 2 for r in df.collect()])
    draws = np.sqrt(e[np.random.default_rng(1).integers(0, 2000, (4000, 2000))].mean(axis=1))
    got = bs.bootstrap_ci_bucketed(df, n_boot=4000).first()
    want = np.quantile(draws, [0.025, 0.975])
    slack = 4 * np.sqrt(2) * np.sqrt(0.025 * 0.975 / 4000) / 0.0584 * draws.std()     # four standard errors of two such quantiles
    assert abs(got["ci_low"] - want[0]) < slack and abs(got["ci_high"] - want[1]) < slack
    w = np.hstack([bs.leaf_weights(j, 2000, 4000, 12345) for j in range(4)])
    assert abs(np.sqrt(w @ e / 2000).std() / draws.std() - 1) < 0.05


def test_ranks_of_rows_and_awkward_groups(spark):
    rows = [(g, f"k{i // 3}", 1.0, float(i % 7)) for g, n in (("a", 900), (None, 500), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, ID string, y double, pred double").repartition(7)
    base = df.select("g", F.xxhash64("ID").alias("_k"), F.col("pred").alias("_e"))
    out = bs.ranked(base, ["g"], cell=64).toPandas()
    for g, n in (("a", 900), (None, 500), ("c", 1)):
        own = out[out["g"].isna() if g is None else out["g"] == g]
        assert sorted(own["_rank"]) == list(range(n)) and set(own["_n"]) == {n}
    assert bs.bootstrap_ci_bucketed(df.filter("g = 'c'"), n_boot=50).first()["ci_low"] == 1.0
    assert bs.bootstrap_ci_bucketed(df.limit(0), n_boot=50, by=["g"]).count() == 0


def test_grouped_bootstrap_is_the_bootstrap_of_each_group(spark):
    a, b = _errors(spark, 50, 900, 3), _errors(spark, 90, 700, 4)
    both = a.withColumn("model", F.lit("a")).unionByName(b.withColumn("model", F.lit("b"))).withColumn("iseed", F.lit(7)).repartition(5)
    got = {r["model"]: r for r in bs.bootstrap_ci_bucketed(both, n_boot=200, by=["model", "iseed"]).collect()}
    for name, df in (("a", a), ("b", b)):
        one = bs.bootstrap_ci_bucketed(df, n_boot=200).first()
        assert all(got[name][c] == pytest.approx(one[c], rel=1e-12) for c in ("rmse", "ci_low", "ci_high", "n_obs")) and got[name]["iseed"] == 7


def test_rule_per_inner_seed_draws_2000_replicates(spark):
    from pricelens.plans import q_blend
    r = q_blend.q_bs2b(spark, "/root/testdata/sf0.001").collect()
    assert len(r) == 9 and all(x["n_boot"] == 2000 for x in r)


def test_overfitting_rule(spark):
    tr, va = _errors(spark, 5, 4000, 1), _errors(spark, 200, 2000, 2)
    r = bs.overfitting_rule(bs.bootstrap_ci_portable(tr, n_boot=30), bs.bootstrap_ci_portable(va, n_boot=30, seed=12346)).first()
    assert (r["intervals_overlap"], r["points"]) == (False, 0) and r["verdict"] == bs.VERDICT_OVERFIT
    t2, v2 = _errors(spark, 100, 2000, 3), _errors(spark, 100, 2000, 4)
    r2 = bs.overfitting_rule(bs.bootstrap_ci_portable(t2, n_boot=30), bs.bootstrap_ci_portable(v2, n_boot=30, seed=12346)).first()
    assert r2["points"] == 15 and r2["intervals_overlap"]


# ---------------------------------------------------------------------------- SH
@pytest.mark.parametrize("column,expected", [
    ("os__lvl___missing__", "os"), ("num__weight_kg", "weight_kg"), ("cat__gpu_model", "gpu_model"), ("storage_gb__lvl_512.0", "storage_gb"),
    ("missingindicator_psu_watts", "psu_watts"), ("is_gaming", "is_gaming")])
def test_source_feature_mapping(spark, column, expected):
    assert spark.range(1).select(sh.source_feature_col(F.lit(column))).first()[0] == expected


def test_attribution_additivity_and_sum_preservation(spark, device_small):
    d = device_small.select("ID", "gpu_model", "device_type", "price", F.lit(0).alias("m"))
    model = fit_backfit(d, ["m"], "price", ["gpu_model", "device_type"], 5.0, 2)
    sample = sample_rows(d, 120)
    long, base = sh.additive_attribution(model, sample)
    preds = model.predict(sample, "pred")
    chk = sh.additivity_check(long, base, preds).first()
    assert chk["n"] == 120 and chk["max_abs_diff"] < 1e-6
    r = fit_one_factor_ridge(d, ["m"], "price", "device_type", 10.0)
    enc = sh.encoded_attribution(r, sample, "device_type")
    agg = sh.aggregate_by_feature(enc)
    own, rest = sh.sparse_attribution(r, sample, "device_type")
    assert own.count() <= 120 and rest.count() == r.effects["device_type"].select("device_type").distinct().count()
    sparse = {x["ID"]: x["shap"] for x in sh.aggregate_sparse(own, rest, sample).collect()}
    assert sparse == pytest.approx({x["ID"]: x["shap"] for x in agg.collect()}, abs=1e-9)
    l2, _ = sh.additive_attribution(r, sample)
    j = agg.join(l2.select("ID", "feature", F.col("shap").alias("s2")), ["ID", "feature"])
    assert j.count() == 120 and j.agg(F.max(F.abs(F.col("shap") - F.col("s2")))).first()[0] < 1e-9
