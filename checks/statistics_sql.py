"""SQL of the period statistics, written from moments so that both engines mean the same."""

from __future__ import annotations

from checks.standins import EVENT, POST, PRE

PARTS = {
    "mean": "avg({c})",
    "stdDev": "sqrt(avg(({c} - {c}_m) ** 2))",
    "median": "median({c})",
    "min": "min({c})",
    "max": "max({c})",
    "skew": "CASE WHEN avg(({c} - {c}_m) ** 2) > 0 THEN avg(({c} - {c}_m) ** 3) / avg(({c} - {c}_m) ** 2) ** 1.5 END",
    "kurtosis": "CASE WHEN avg(({c} - {c}_m) ** 2) > 0 THEN avg(({c} - {c}_m) ** 4) / avg(({c} - {c}_m) ** 2) ** 2 - 3 END",
}


def r6(expr: str) -> str:
    return f"round({expr} + 1e-9, 6) + 0.0"


def statistics(table: str, keys: list[str], values: list[str], names: list[str], where: str = "true") -> str:
    """SELECT keys, {value}_{name}, n from a table."""
    by = ", ".join(keys)
    means = ", ".join(f"avg({v}) OVER (PARTITION BY {by}) AS {v}_m" for v in values)
    stats = ", ".join(f"{PARTS[n].format(c=v)} AS {v}_{n}" for v in values for n in names)
    return f"SELECT {by}, count(*) AS n, {stats} FROM (SELECT *, {means} FROM {table} WHERE {where}) GROUP BY {by}"


def features(table: str, keys: list[str], values: list[str], names: list[str], window="1x1", pre=PRE, post=POST, count_as=None) -> str:
    """SELECT keys, bounds, {value}_{pre|post}_{window}_{name} for every pair of periods."""
    periods = list(dict.fromkeys([*pre, *post]))
    vals = ", ".join(f"({i}, DATE '{p.start}', DATE '{p.end}')" for i, p in enumerate(periods))
    pairs = ", ".join(f"({periods.index(a)}, {periods.index(b)})" for a in pre for b in post)
    tagged = f"(SELECT t.*, w.i AS period FROM {table} t JOIN (VALUES {vals}) w(i, s, e) ON t.ts >= w.s AND t.ts < w.e)"
    stats = statistics(tagged, [*keys, "period"], values, names)
    on = " AND ".join(f"x.{k} = b.{k}" for k in keys)
    cols = ", ".join(
        f"round(x{p}.{v}_{n} + 1e-9, 6) + 0.0 AS {v}_{p}_{window}_{n}" for v in values for p in ("pre", "post") for n in names
    )
    counts = "" if not count_as else "".join(f", coalesce(x{p}.n, 0) AS {count_as}_{p}" for p in ("pre", "post"))
    base = ", ".join(f"b.{k}" for k in keys)
    return f"""SELECT {base}, p1.s AS start_pre, p1.e AS end_pre, p2.s AS start_post, p2.e AS end_post{counts}, {cols}
FROM (SELECT DISTINCT {", ".join(keys)} FROM {tagged}) b
CROSS JOIN (VALUES {pairs}) pair(i, j)
JOIN (VALUES {vals}) p1(i, s, e) ON p1.i = pair.i JOIN (VALUES {vals}) p2(i, s, e) ON p2.i = pair.j
LEFT JOIN ({stats}) xpre ON {on.replace("x.", "xpre.")} AND xpre.period = pair.i
LEFT JOIN ({stats}) xpost ON {on.replace("x.", "xpost.")} AND xpost.period = pair.j"""


LABEL_SQL = f"CASE WHEN end_post <= DATE '{EVENT}' THEN 0 ELSE 1 END"


def experiment_sql(preds: str, threshold: float = 0.5) -> str:
    """Counts and metrics of point predictions (aoi, unosat_id, start_post, pred) against ``point_labels``."""
    starts = ", ".join(f"(DATE '{p.start}')" for p in POST)
    every = f"""SELECT l.date, w.start_post, p.pred FROM (SELECT DISTINCT aoi, unosat_id FROM p) k JOIN point_labels l USING (aoi, unosat_id)
      CROSS JOIN (VALUES {starts}) w(start_post) LEFT JOIN p ON p.aoi = k.aoi AND p.unosat_id = k.unosat_id AND p.start_post = w.start_post WHERE l.date IS NOT NULL"""
    sides = f"""SELECT 1 AS y, pred FROM e WHERE start_post >= date AND year(start_post) = {EVENT.year}
      UNION ALL SELECT 0, pred FROM e WHERE start_post < DATE '{EVENT}'"""
    hit = f"coalesce(pred >= {threshold}::DOUBLE * 255, false)"
    counts = f"SELECT count(*) FILTER (y = 1 AND {hit}) AS tp, count(*) FILTER (y = 0 AND {hit}) AS fp, count(*) FILTER (y = 0 AND NOT {hit}) AS tn, count(*) FILTER (y = 1 AND NOT {hit}) AS fn FROM ({sides})"
    share = lambda a, b: f"coalesce(({a})::DOUBLE / nullif({b}, 0), 0)"
    metrics = {
        "precision": share("tp", "tp + fp"), "recall": share("tp", "tp + fn"), "f1": share("2 * tp", "2 * tp + fp + fn"),
        "roc_auc": f"({share('tp', 'tp + fn')} + {share('tn', 'tn + fp')}) / 2", "accuracy": share("tp + tn", "tp + fp + tn + fn"),
    }
    return f"WITH p AS ({preds}), e AS ({every}) SELECT tp, fp, tn, fn, " + ", ".join(f"{r6(v)} AS {k}" for k, v in metrics.items()) + f" FROM ({counts})"
