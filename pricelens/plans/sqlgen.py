"""DuckDB text builders that mirror the Spark operators (used only by oracle SQL)."""
from __future__ import annotations

from ..functions.portable import fold_sql, hash_int_sql
from ..sources.tables import device_frame_sql


def folded_sql(cols: list[str], k: int = 5, seed: int = 42, repeats: int = 1, src: str = "device") -> str:
    """SELECT cols + repeat + fold (SP2 twin)."""
    sel = ", ".join(cols)
    if repeats == 1:
        return f"SELECT {sel}, 0 AS repeat, {fold_sql(seed, 'ID', k)} AS fold FROM {src}"
    return (f"SELECT {sel}, CAST(rr.range AS INTEGER) AS repeat, "
            f"{fold_sql(f'({seed} + rr.range)', 'ID', k)} AS fold FROM {src} CROSS JOIN range({repeats}) rr")


def closed_form_preds_ctes(spec: dict, k: int = 5, seed: int = 42, repeats: int = 1, src: str = "device",
                           target: str = "price", prefix: str = "") -> str:
    """CTEs ending in ``{prefix}preds(ID, repeat, fold, role, y, pred)`` for a closed-form model."""
    p = prefix
    kind = spec["kind"]
    levels = [spec["level"]] if kind == "ridge1" else list(spec.get("levels", []))
    lvl_sel = "".join(f", {c}" for c in levels)
    ctes = [
        f"{p}r AS (SELECT ID, {target} AS y{lvl_sel}, repeat, fold FROM ({folded_sql(['ID', target] + levels, k, seed, repeats, src)}) x)",
        f"{p}fs AS (SELECT CAST(range AS INTEGER) AS f FROM range({k}))",
        f"{p}tr AS (SELECT {p}r.*, {p}fs.f FROM {p}r JOIN {p}fs ON {p}r.fold <> {p}fs.f)",
    ]
    eff_terms = []
    if kind == "mean":
        ctes.append(f"{p}b AS (SELECT repeat, f, avg(y) AS b FROM {p}tr GROUP BY repeat, f)")
    elif kind == "median":
        ctes.append(f"{p}b AS (SELECT repeat, f, quantile_cont(y, 0.5) AS b FROM {p}tr GROUP BY repeat, f)")
    elif kind == "ridge1":
        lv, a = spec["level"], float(spec.get("alpha", 1.0))
        ctes += [
            f"{p}cells AS (SELECT repeat, f, {lv}, count(*) AS n, avg(y) AS ybar, count(*) / (count(*) + {a!r}::DOUBLE) AS w "
            f"FROM {p}tr GROUP BY repeat, f, {lv})",
            f"{p}b AS (SELECT repeat, f, sum(w * ybar) / sum(w) AS b FROM {p}cells GROUP BY repeat, f)",
            f"{p}e_{lv} AS (SELECT c.repeat, c.f, c.{lv}, c.w * (c.ybar - b.b) AS e FROM {p}cells c JOIN {p}b b USING (repeat, f))",
        ]
        eff_terms.append(lv)
    elif kind == "backfit":
        lam, sweeps = float(spec.get("lam", 1.0)), int(spec.get("sweeps", 3))
        ctes.append(f"{p}b AS (SELECT repeat, f, avg(y) AS b FROM {p}tr GROUP BY repeat, f)")
        cur = {lv: None for lv in levels}
        step = 0
        for _ in range(sweeps):
            for lv in levels:
                joins, resid = "", "t.y - b.b"
                for o in levels:
                    if o == lv or cur[o] is None:
                        continue
                    joins += f" LEFT JOIN {cur[o]} eo_{o} ON eo_{o}.repeat = t.repeat AND eo_{o}.f = t.f AND eo_{o}.{o} = t.{o}"
                    resid += f" - coalesce(eo_{o}.e, 0.0)"
                name = f"{p}bf{step}_{lv}"
                ctes.append(
                    f"{name} AS (SELECT t.repeat, t.f, t.{lv}, sum({resid}) / (count(*) + {lam!r}::DOUBLE) AS e "
                    f"FROM {p}tr t JOIN {p}b b ON b.repeat = t.repeat AND b.f = t.f{joins} GROUP BY t.repeat, t.f, t.{lv})")
                cur[lv] = name
                step += 1
        for lv in levels:
            ctes.append(f"{p}e_{lv} AS (SELECT * FROM {cur[lv]})")
        eff_terms = levels
    else:
        raise ValueError(kind)
    joins, pred = "", "b.b"
    for lv in eff_terms:
        joins += f" LEFT JOIN {p}e_{lv} e_{lv} ON e_{lv}.repeat = s.repeat AND e_{lv}.f = s.f AND e_{lv}.{lv} = s.{lv}"
        pred += f" + coalesce(e_{lv}.e, 0.0)"
    ctes.append(
        f"{p}sv AS (SELECT {p}r.*, {p}fs.f, CASE WHEN {p}fs.f = {p}r.fold THEN 'val' ELSE 'train' END AS role "
        f"FROM {p}r CROSS JOIN {p}fs)")
    ctes.append(
        f"{p}preds AS (SELECT s.ID, s.repeat, s.f AS fold, s.role, s.y, {pred} AS pred FROM {p}sv s "
        f"JOIN {p}b b ON b.repeat = s.repeat AND b.f = s.f{joins})")
    return ",\n".join(ctes)


def with_ctes(body: str, *ctes: str) -> str:
    """WITH device AS (...), <ctes> <body>."""
    extra = ",\n".join(c for c in ctes if c)
    return f"WITH device AS ({device_frame_sql()})" + (f",\n{extra}" if extra else "") + f"\n{body}"


FOLD_METRICS_SQL = (
    "SELECT repeat, fold, role, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, "
    "avg(abs(y - pred)) AS mae FROM {t} GROUP BY repeat, fold, role"
)


def cv_summary_sql(preds: str, model: str) -> str:
    fm = FOLD_METRICS_SQL.format(t=preds)
    return (f"SELECT '{model}' AS model, CAST(count(CASE WHEN role = 'val' THEN 1 END) AS BIGINT) AS n_folds, "
            "avg(CASE WHEN role = 'train' THEN rmse END) AS train_rmse, "
            "avg(CASE WHEN role = 'val' THEN rmse END) AS val_rmse, "
            "avg(CASE WHEN role = 'train' THEN mae END) AS train_mae, "
            "avg(CASE WHEN role = 'val' THEN mae END) AS val_mae, "
            "coalesce(stddev_samp(CASE WHEN role = 'val' THEN rmse END), 0.0) AS val_rmse_std, "
            "avg(CASE WHEN role = 'val' THEN rmse END) - avg(CASE WHEN role = 'train' THEN rmse END) AS gap "
            f"FROM ({fm}) fm")


__all__ = ["folded_sql", "closed_form_preds_ctes", "with_ctes", "FOLD_METRICS_SQL", "cv_summary_sql", "hash_int_sql"]
