"""DuckDB oracle SQL for every registered query (tables are pre-registered views).

Each statement restates the query's semantics in plain SQL over the raw test tables. Shared
views of the test-data mapping are written once as CTE text below.
"""

from __future__ import annotations

# Daily observations: lineitem rows as supplier-days.
DAILY = """daily AS (
  SELECT l_suppkey AS district, CAST(l_shipdate AS DATE) AS date,
         l_quantity AS temp_max, l_discount AS temp_min, l_extendedprice AS precipitation,
         l_tax AS humidity, l_quantity * 60.0 AS sunshine
  FROM lineitem)"""


def _r2(expr: str) -> str:
    """NumPy-style rounding to 2 decimals."""
    return f"round_even(({expr}) * 100.0, 0) / 100.0"


def _r6(expr: str) -> str:
    return f"round_even(({expr}) * 1000000.0, 0) / 1000000.0"


def _cents(col: str) -> str:
    return f"CAST(round({col} * 100.0) AS BIGINT)"


def _mean(col: str) -> str:
    return f"CAST(sum({_cents(col)}) AS DOUBLE) / 100.0 / count({col})"


def _total(col: str) -> str:
    return f"coalesce(CAST(sum({_cents(col)}) AS DOUBLE) / 100.0, 0.0)"


MEASURES = ",\n  ".join([
    f"{_r2(_mean('temp_max'))} AS avg_temp_max",
    f"{_r2(_mean('temp_min'))} AS avg_temp_min",
    f"{_r2(_mean('humidity'))} AS avg_humidity",
    f"{_r2(_total('precipitation'))} AS total_precipitation",
    f"{_r2(_total('sunshine') + ' / 3600.0')} AS total_sunshine_hours",
])

# The feature columns, in the order of the published parameters.
FEATURE_LIST = ["avg_temp_max", "avg_temp_min", "avg_humidity", "total_precipitation",
                "total_sunshine_hours"]
FEATURES = ", ".join(FEATURE_LIST)

YM = "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"
KEEP = "WHERE district IS NOT NULL AND date IS NOT NULL"

# Supplier-month panel with the row-count target.
PANEL = f"""panel AS (
  SELECT district, {YM},
  {MEASURES},
  CAST(count(*) AS DOUBLE) AS mal_cases
  FROM daily {KEEP}
  GROUP BY ALL)"""

# National monthly series with the orders-per-month target.
NATIONAL = f"""national AS (
  SELECT w.*, t.ddd_demand FROM (
    SELECT {YM},
    {MEASURES}
    FROM daily WHERE date IS NOT NULL GROUP BY ALL) w
  LEFT JOIN (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
                    CAST(month(o_orderdate) AS INTEGER) AS month,
                    CAST(count(*) AS DOUBLE) AS ddd_demand
             FROM orders GROUP BY ALL) t
  USING (year, month))"""


SERIES_COLS = FEATURE_LIST + ["ddd_demand"]
PANEL_COLS = FEATURE_LIST + ["mal_cases"]


def stats_cte(name: str, src: str, cols: list[str], part: str | None) -> str:
    """First-60 % mean / population std, NULL-propagating, std floor 1e-10."""
    pby = f"PARTITION BY {part}" if part else ""
    keys = f"{part}, " if part else ""
    train = "rn <= floor(CAST(0.6 AS DOUBLE) * n)"
    out = []
    for c in cols:
        v = f"CASE WHEN {train} THEN {c} END"
        full = f"count({v}) = count_if({train})"
        sd = f"stddev_pop({v})"
        out.append(f"CASE WHEN {full} THEN avg({v}) END AS {c}_mean")
        out.append(f"CASE WHEN {full} THEN (CASE WHEN {sd} < 1e-10 THEN 1.0 ELSE {sd} END) END AS {c}_std")
    group = f"GROUP BY {part}" if part else ""
    return f"""{name} AS (
  SELECT {keys}{", ".join(out)}
  FROM (SELECT *, row_number() OVER ({pby} ORDER BY year, month) AS rn, count(*) OVER ({pby}) AS n
        FROM {src})
  {group})"""


def zscores(src: str, stats: str, cols: list[str]) -> str:
    return ", ".join(f"({src}.{c} - {stats}.{c}_mean) / {stats}.{c}_std AS {c}" for c in cols)


# Panel job views: dated panel, panel without the excluded entity, entity statistics, complete
# 6-month windows (latest month taken before the exclusion), z-scores and dense ids.
P_VIEWS = [
    "p AS (SELECT *, make_date(year, month, 1) AS date FROM panel)",
    "px AS (SELECT * FROM p WHERE district IS NOT NULL AND district NOT IN (5))",
    stats_cte("st", "px", PANEL_COLS, "district"),
    """wr AS (SELECT * FROM px WHERE date BETWEEN
       CAST((SELECT max(date) FROM p) - INTERVAL 5 MONTH AS DATE) AND (SELECT max(date) FROM p))""",
    "w AS (SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY district) AS n FROM wr) WHERE n = 6)",
    f"z AS (SELECT w.district, w.year, w.month, w.date, {zscores('w', 'st', FEATURE_LIST)} FROM w JOIN st USING (district))",
    """ids AS (SELECT district, CAST(dense_rank() OVER (ORDER BY district) - 1 AS INTEGER) AS entity_id
         FROM (SELECT DISTINCT district FROM px))""",
    """zt AS (SELECT z.*, ids.entity_id,
           CAST(row_number() OVER (PARTITION BY z.district ORDER BY z.date) - 1 AS INTEGER) AS t
         FROM z JOIN ids USING (district))""",
]


def _dbl(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def weight_ctes(prefix: str, model_weights: dict, months: int, width: int) -> list[str]:
    """VALUES tables (model, horizon, t, f, w) of the non-zero weights and (model, horizon, b)."""
    wrows, brows = [], []
    for name, m in model_weights.items():
        for h, (row, b) in enumerate(zip(m.weights, m.bias), start=1):
            brows.append(f"('{name}', {h}, {_dbl(b)})")
            for j, w in enumerate(row):
                if w != 0.0:
                    wrows.append(f"('{name}', {h}, {j // width}, {j % width}, {_dbl(w)})")
    return [f"{prefix}w AS (SELECT * FROM (VALUES {', '.join(wrows)}) v(model, horizon, t, f, w))",
            f"{prefix}b AS (SELECT * FROM (VALUES {', '.join(brows)}) v(model, horizon, b))"]


def unpivot(src: str, cols: list[str], t: str = "t", key: str = "district") -> str:
    """Rows (key, t, f, value) of a wide window frame."""
    k = f"{key}, " if key else ""
    return "\n    UNION ALL ".join(f"SELECT {k}{t} AS t, {i} AS f, CAST({c} AS DOUBLE) AS value FROM {src}"
                                     for i, c in enumerate(cols))


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["monthly_entity_rollup"] = with_ctes(DAILY) + f"""
SELECT district, {YM},
  {MEASURES}
FROM daily {KEEP}
GROUP BY ALL"""

    q["monthly_national_rollup"] = with_ctes(DAILY) + f"""
SELECT {YM},
  {MEASURES}
FROM daily WHERE date IS NOT NULL
GROUP BY ALL"""

    q["monthly_both_grains"] = with_ctes(DAILY) + f"""
SELECT * FROM (
  SELECT CAST(district AS VARCHAR) AS district, {YM}, CAST(grouping(district) AS INTEGER) AS national,
    {MEASURES}
  FROM daily WHERE date IS NOT NULL
  GROUP BY GROUPING SETS ((district, year(date), month(date)), (year(date), month(date))))
WHERE national = 1 OR district IS NOT NULL"""

    q["round_policy"] = """
SELECT l_orderkey, l_linenumber, x, r2, round_even(x * 10000.0, 0) / 10000.0 AS r4,
       printf('%.2f', r2) AS txt
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount AS x,
             round_even(l_extendedprice * l_discount * 100.0, 0) / 100.0 AS r2
      FROM lineitem)"""

    q["period_filter"] = with_ctes(DAILY) + """
SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date), '2001_08' AS period FROM daily
WHERE date BETWEEN DATE '2001-08-01' AND DATE '2001-08-31'"""

    q["payload_flatten"] = """
WITH e AS (SELECT user_id AS district, event_id // 1024 AS request, ts, event_id, value, event_type
           FROM events),
g AS (SELECT district, request, bool_or(event_type = 'error') AS has_err FROM e GROUP BY ALL)
SELECT e.district, e.request,
       CAST(row_number() OVER (PARTITION BY e.district, e.request ORDER BY ts, event_id) - 1 AS INTEGER) AS pos,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, value,
       CASE WHEN has_err AND event_type = 'error' THEN value END AS error_value
FROM e JOIN g USING (district, request)"""

    q["coverage_missing"] = """
SELECT c_custkey AS district, c_name, c_nationkey FROM customer c
WHERE NOT EXISTS (
  SELECT 1 FROM orders o
  WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus <> 'P')"""

    q["schema_align"] = with_ctes(DAILY, PANEL) + f"""
SELECT year, month, district, CAST(NULL AS DOUBLE) AS mal_cases, {FEATURES} FROM panel"""

    q["duplicate_keys"] = with_ctes(DAILY, PANEL) + """
SELECT b.district, b.year, b.month
FROM panel b JOIN panel h
  ON b.district IS NOT DISTINCT FROM h.district AND b.year IS NOT DISTINCT FROM h.year
 AND b.month IS NOT DISTINCT FROM h.month
WHERE b.year * 100 + b.month >= 200105 AND h.year * 100 + h.month < 200106"""

    hist = with_ctes(DAILY, PANEL, f"""h AS (
  SELECT year, month, district, mal_cases, {FEATURES}, year * 100 + month AS ym FROM panel)""")
    cols = f"year, month, district, mal_cases, {FEATURES}"
    same = ("x.district IS NOT DISTINCT FROM b.district AND x.year IS NOT DISTINCT FROM b.year "
            "AND x.month IS NOT DISTINCT FROM b.month")
    q["append_all_or_nothing"] = hist + f"""
SELECT {cols}, 'disjoint' AS scenario FROM h WHERE ym < 200106
UNION ALL
SELECT {cols}, 'disjoint' FROM h WHERE ym >= 200106 AND NOT EXISTS (
  SELECT 1 FROM h b JOIN h x ON {same} WHERE b.ym >= 200106 AND x.ym < 200106)
UNION ALL
SELECT {cols}, 'overlap' FROM h WHERE ym < 200106
UNION ALL
SELECT {cols}, 'overlap' FROM h WHERE ym >= 200105 AND NOT EXISTS (
  SELECT 1 FROM h b JOIN h x ON {same} WHERE b.ym >= 200105 AND x.ym < 200106)"""

    q["append_new_keys"] = hist + f"""
SELECT {cols}, 'disjoint' AS scenario FROM h WHERE ym < 200106
UNION ALL
SELECT {cols}, 'disjoint' FROM h b WHERE ym >= 200106 AND NOT EXISTS (
  SELECT 1 FROM h x WHERE x.ym < 200106 AND {same})
UNION ALL
SELECT {cols}, 'overlap' FROM h WHERE ym < 200106
UNION ALL
SELECT {cols}, 'overlap' FROM h b WHERE ym >= 200105 AND NOT EXISTS (
  SELECT 1 FROM h x WHERE x.ym < 200106 AND {same})"""

    eq = " AND ".join(f"x.{c} = f.{c}" for c in FEATURE_LIST)
    ncols = f"year, month, {FEATURES}"
    q["append_if_absent"] = with_ctes(DAILY, NATIONAL, f"""b AS (
  SELECT {ncols}, CAST(NULL AS DOUBLE) AS ddd_demand, year * 100 + month AS ym FROM national)""") + f"""
SELECT {ncols}, ddd_demand, 'new' AS scenario FROM national WHERE year * 100 + month < 200106
UNION ALL
SELECT {ncols}, ddd_demand, 'new' FROM b WHERE ym >= 200106 AND NOT EXISTS (
  SELECT 1 FROM national x, b f WHERE f.ym = 200106 AND x.year * 100 + x.month < 200106 AND {eq})
UNION ALL
SELECT {ncols}, ddd_demand, 'present' FROM national WHERE year * 100 + month < 200106
UNION ALL
SELECT {ncols}, ddd_demand, 'present' FROM b WHERE ym >= 200105 AND NOT EXISTS (
  SELECT 1 FROM national x, b f WHERE f.ym = 200105 AND x.year * 100 + x.month < 200106 AND {eq})"""

    q["merge_target"] = with_ctes(DAILY, NATIONAL) + "SELECT * FROM national"

    q["history_sorted"] = with_ctes(DAILY, PANEL) + f"""
SELECT year, month, district, mal_cases, {FEATURES},
       row_number() OVER (ORDER BY district, year, month) - 1 AS pos
FROM panel"""

    q["validation_report"] = with_ctes(DAILY, PANEL, """v AS (
  SELECT CASE WHEN month = 12 THEN NULL ELSE year END AS year, month FROM panel)""") + """
SELECT 'required_columns' AS check_name, CAST(1 AS BIGINT) AS n_bad, false AS passed
UNION ALL SELECT 'non_empty', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT), count(*) > 0 FROM v
UNION ALL SELECT 'not_null:year', count(*) - count(year), count(*) = count(year) FROM v
UNION ALL SELECT 'not_null:month', count(*) - count(month), count(*) = count(month) FROM v"""

    r6cols = lambda cols: ", ".join(f"{_r6(c)} AS {c}" for c in cols)
    stat_names = [f"{c}_{k}" for c in SERIES_COLS for k in ("mean", "std")]
    q["global_norm_fit"] = with_ctes(DAILY, NATIONAL, stats_cte("gs", "national", SERIES_COLS, None)) + f"""
SELECT {r6cols(stat_names)} FROM gs"""

    pstat_names = [f"{c}_{k}" for c in PANEL_COLS for k in ("mean", "std")]
    q["entity_norm_fit"] = with_ctes(DAILY, PANEL, *P_VIEWS) + f"""
SELECT district, {r6cols(pstat_names)} FROM st"""

    latest = """lw AS (SELECT * EXCLUDE (rn), CAST(12 - rn AS INTEGER) AS pos
  FROM (SELECT *, row_number() OVER (ORDER BY year DESC, month DESC) AS rn FROM national)
  WHERE rn <= 12)"""
    q["latest_window"] = with_ctes(DAILY, NATIONAL, latest) + "SELECT * FROM lw"

    q["series_normalize"] = with_ctes(DAILY, NATIONAL, latest,
                                      stats_cte("gs", "national", SERIES_COLS, None)) + f"""
SELECT year, month, pos, {", ".join(_r6(f"(lw.{c} - gs.{c}_mean) / gs.{c}_std") + f" AS {c}" for c in FEATURE_LIST)}
FROM lw, gs"""

    q["panel_window"] = with_ctes(DAILY, PANEL, "p AS (SELECT *, make_date(year, month, 1) AS date FROM panel)") + """
SELECT * EXCLUDE (n) REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM (
  SELECT *, count(*) OVER (PARTITION BY district) AS n FROM p
  WHERE date BETWEEN CAST((SELECT max(date) FROM p) - INTERVAL 5 MONTH AS DATE) AND (SELECT max(date) FROM p))
WHERE n = 6"""

    q["panel_skipped"] = with_ctes(DAILY, PANEL, *P_VIEWS) + """
SELECT e.district, coalesce(c.n, 0) AS n_rows
FROM (SELECT DISTINCT district FROM px) e
LEFT JOIN (SELECT district, count(*) AS n FROM wr GROUP BY district) c USING (district)
WHERE coalesce(c.n, 0) <> 6"""

    q["entity_exclude"] = with_ctes(DAILY, PANEL, *P_VIEWS) + \
        "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM w"

    q["entity_ids"] = with_ctes(DAILY, PANEL, *P_VIEWS) + "SELECT * FROM ids"

    q["panel_normalize"] = with_ctes(DAILY, PANEL, *P_VIEWS) + f"""
SELECT district, year, month, {r6cols(FEATURE_LIST)} FROM z"""

    tensor_rows = "\nUNION ALL\n".join(
        [f"SELECT district, t, {i} AS f, {_r6(c)} AS value FROM zt" for i, c in enumerate(FEATURE_LIST)]
        + [f"SELECT district, t, {len(FEATURE_LIST)} AS f, CAST(entity_id AS DOUBLE) AS value FROM zt"])
    q["window_tensor"] = with_ctes(DAILY, PANEL, *P_VIEWS) + tensor_rows

    flat_rows = "\nUNION ALL\n".join(
        [f"SELECT district, t * 5 + {i} AS pos, {_r6(c)} AS value FROM zt" for i, c in enumerate(FEATURE_LIST)]
        + ["SELECT DISTINCT district, 30 + entity_id AS pos, CAST(1.0 AS DOUBLE) AS value FROM zt"])
    q["flat_features"] = with_ctes(DAILY, PANEL, *P_VIEWS) + flat_rows

    q["clip_cast"] = with_ctes(DAILY, PANEL) + """
SELECT district, year, month, x, CAST(trunc(least(greatest(x, 0), n - 1)) AS INTEGER) AS clipped
FROM (SELECT district, year, month, total_precipitation / 10000.0 - 5.0 AS x FROM panel)
JOIN (SELECT count(DISTINCT district) AS n FROM panel) ON true"""

    from panelcast.plans import models as m

    panel_w = weight_ctes("p", m.panel_models(), m.PANEL_MONTHS, m.N_FEATURES + 1)
    tvr = f"tvr AS ({unpivot('zt', FEATURE_LIST + ['entity_id'])})"
    sc = """sc AS (
  SELECT tvr.district, pw.model, pw.horizon, sum(tvr.value * pw.w) + pb.b AS y
  FROM tvr JOIN pw ON tvr.t = pw.t AND tvr.f = pw.f
  JOIN pb ON pb.model = pw.model AND pb.horizon = pw.horizon
  GROUP BY tvr.district, pw.model, pw.horizon, pb.b)"""
    scored = with_ctes(DAILY, PANEL, *P_VIEWS, tvr, *panel_w, sc)
    q["score_linear"] = scored + f"SELECT district, model, horizon, {_r6('y')} AS y FROM sc"
    q["score_models"] = q["score_linear"]

    denorm = "dn AS (SELECT sc.district, sc.model, sc.horizon, sc.y * st.mal_cases_std + st.mal_cases_mean AS y FROM sc JOIN st USING (district))"
    q["denormalize"] = with_ctes(DAILY, PANEL, *P_VIEWS, tvr, *panel_w, sc, denorm) + \
        f"SELECT district, model, horizon, {_r6('y')} AS y FROM dn"

    clamp = "CASE WHEN isnan(y) OR y IS NULL OR y <= 0 THEN 0.0 ELSE y END"
    q["long_forecast"] = with_ctes(DAILY, PANEL, *P_VIEWS, tvr, *panel_w, sc, denorm) + f"""
SELECT district, model,
       strftime(CAST((SELECT max(date) FROM p) + to_months(horizon) AS DATE), '%B_%Y') AS month,
       {_r2(clamp)} AS predicted_mal_cases
FROM dn"""

    tab_w = m.tabular_model().weights
    trows = ", ".join(f"({h}, {j}, {_dbl(w)})" for h, row in enumerate(tab_w, start=1)
                      for j, w in enumerate(row) if w != 0.0)
    q["score_tabular"] = with_ctes(DAILY, PANEL, *P_VIEWS, tvr, f"tw AS (SELECT * FROM (VALUES {trows}) v(horizon, j, w))") + f"""
SELECT ft.district, 'tabular' AS model, tw.horizon,
       {_r6("sum(ft.value * tw.w) + CAST(0.001 AS DOUBLE) * ft.entity_id * tw.horizon + 0.0")} AS y
FROM (SELECT tvr.district, tvr.t * 5 + tvr.f AS j, tvr.value, ids.entity_id
      FROM tvr JOIN ids USING (district) WHERE tvr.f < 5) ft
JOIN tw ON ft.j = tw.j
GROUP BY ft.district, tw.horizon, ft.entity_id"""

    nodes = ", ".join("(" + ", ".join("NULL" if v is None else str(v) for v in r) + ")" for r in m.tree_nodes())
    q["score_trees"] = with_ctes(DAILY, PANEL, *P_VIEWS, tvr, f"""tn AS (
  SELECT CAST(horizon AS INTEGER) AS horizon, tree, node, feature, CAST(threshold AS DOUBLE) AS threshold, lft, rgt,
         CAST(value AS DOUBLE) AS value, missing_left
  FROM (VALUES {nodes}) v(horizon, tree, node, feature, threshold, lft, rgt, value, missing_left))""", """x AS (
  SELECT tvr.district, tvr.t * 5 + tvr.f AS feature, tvr.value FROM tvr WHERE tvr.f < 5)""", """one AS (
  SELECT tn.horizon, tn.tree, tn.node, d.district, coalesce(x.value, CASE WHEN d.entity_id = tn.feature - 30 THEN 1.0 ELSE 0.0 END) AS v
  FROM tn CROSS JOIN (SELECT DISTINCT district, entity_id FROM zt) d LEFT JOIN x ON x.district = d.district AND x.feature = tn.feature)""",
                                 """step AS (
  SELECT one.district, tn.horizon, tn.tree, tn.node, CASE WHEN tn.lft IS NULL THEN tn.node WHEN one.v <= tn.threshold THEN tn.lft
         ELSE tn.rgt END AS nxt, tn.value
  FROM tn JOIN one USING (horizon, tree, node))""") + f"""
SELECT a.district, 'trees' AS model, a.horizon, {_r6("sum(c.value)")} AS y
FROM step a JOIN step b ON b.district = a.district AND b.horizon = a.horizon AND b.tree = a.tree AND b.node = a.nxt
            JOIN step c ON c.district = a.district AND c.horizon = a.horizon AND c.tree = a.tree AND c.node = b.nxt
WHERE a.node = 0
GROUP BY a.district, a.horizon"""

    q["forecast_months"] = with_ctes(DAILY, PANEL, "p AS (SELECT *, make_date(year, month, 1) AS date FROM panel)") + """
SELECT district, h AS horizon, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%Y-%m-%d') AS date, strftime(d, '%B %Y') AS label_space, strftime(d, '%B%Y') AS label_joined,
       strftime(d, '%B_%Y') AS label_underscore, strftime(d, '%Y-%m-%d') AS label_iso,
       strftime(d, '%Y_%m') AS label_period
FROM (SELECT district, h, CAST(last + to_months(h) AS DATE) AS d
      FROM (SELECT district, max(date) AS last FROM p GROUP BY district)
      CROSS JOIN (SELECT unnest([1, 2, 3]) AS h))"""

    series_w = weight_ctes("s", m.series_models(), m.SERIES_MONTHS, m.N_FEATURES)
    zs = "zs AS (SELECT pos AS t, " + ", ".join(
        f"(lw.{c} - gs.{c}_mean) / gs.{c}_std AS {c}" for c in FEATURE_LIST) + " FROM lw, gs)"
    q["series_forecast"] = with_ctes(DAILY, NATIONAL, latest, stats_cte("gs", "national", SERIES_COLS, None),
                                     zs, f"tvs AS ({unpivot('zs', FEATURE_LIST, key='')})", *series_w, """ssc AS (
  SELECT sw.model, sw.horizon, sum(tvs.value * sw.w) + sb.b AS y
  FROM tvs JOIN sw ON tvs.t = sw.t AND tvs.f = sw.f
  JOIN sb ON sb.model = sw.model AND sb.horizon = sw.horizon
  GROUP BY sw.model, sw.horizon, sb.b)""") + f"""
SELECT ssc.model AS model_name,
       strftime(CAST((SELECT max(make_date(year, month, 1)) FROM national) + to_months(ssc.horizon) AS DATE),
                '%Y-%m-%d') AS date,
       round_even((ssc.y * gs.ddd_demand_std + gs.ddd_demand_mean) * 10000.0, 0) / 10000.0 AS predicted_demand
FROM ssc, gs"""

    q["series_score_models"] = q["series_forecast"]

    q["mae_by_horizon"] = with_ctes(DAILY, PANEL, "p AS (SELECT *, make_date(year, month, 1) AS date FROM panel)",
                                    "o AS (SELECT CAST((SELECT max(date) FROM p) - INTERVAL 3 MONTH AS DATE) AS origin)",
                                    """pred AS (
  SELECT district, 'persistence' AS model, mal_cases AS y FROM p WHERE date = (SELECT origin FROM o)
  UNION ALL
  SELECT district, 'mean3', avg(mal_cases) FROM p
  WHERE date BETWEEN CAST((SELECT origin FROM o) - INTERVAL 2 MONTH AS DATE) AND (SELECT origin FROM o)
  GROUP BY district)""", """e AS (
  SELECT pred.model, hs.h AS horizon, abs(pred.y - p.mal_cases) AS err
  FROM pred CROSS JOIN (SELECT unnest([1, 2, 3]) AS h) hs
  JOIN p ON p.district = pred.district AND p.date = CAST((SELECT origin FROM o) + to_months(hs.h) AS DATE))""",
                                    """agg AS (
  SELECT model, avg(err) FILTER (WHERE horizon = 1) AS t1, avg(err) FILTER (WHERE horizon = 2) AS t2,
         avg(err) FILTER (WHERE horizon = 3) AS t3
  FROM e GROUP BY model)""") + f"""
SELECT model AS model_name, {_r6('t1')} AS t1_mae, {_r6('t2')} AS t2_mae, {_r6('t3')} AS t3_mae,
       {_r6('t1 + t2 + t3')} AS mae_sum, {_r6('(t1 + t2 + t3) / 3.0')} AS mae
FROM agg"""

    q["nation_monthly_rollup"] = with_ctes(DAILY) + f"""
SELECT n.n_name, {YM},
  {MEASURES}
FROM daily d
JOIN supplier s ON s.s_suppkey = d.district
JOIN nation n ON n.n_nationkey = s.s_nationkey
WHERE d.district IS NOT NULL AND d.date IS NOT NULL AND n.n_name IS NOT NULL
GROUP BY n.n_name, year(date), month(date)"""

    q["latest_window_entity"] = with_ctes(DAILY, PANEL, "p AS (SELECT *, make_date(year, month, 1) AS date FROM panel)") + """
SELECT * EXCLUDE (rn, n) REPLACE (strftime(date, '%Y-%m-%d') AS date), n - rn AS pos FROM (
  SELECT *, count(*) OVER (PARTITION BY district) AS n FROM (
    SELECT *, row_number() OVER (PARTITION BY district ORDER BY year DESC, month DESC) AS rn FROM p)
  WHERE rn <= 12)"""

    seeded = "sp AS (SELECT * REPLACE (CASE WHEN month = 3 THEN NULL ELSE mal_cases END AS mal_cases) FROM panel)"
    q["norm_fit_nulls_propagate"] = with_ctes(DAILY, PANEL, seeded, stats_cte("ns", "sp", ["mal_cases"], "district")) + f"""
SELECT district, {_r6('mal_cases_mean')} AS mal_cases_mean, {_r6('mal_cases_std')} AS mal_cases_std FROM ns"""
    skip = """sk AS (
  SELECT district, avg(CASE WHEN rn <= floor(CAST(0.6 AS DOUBLE) * n) THEN mal_cases END) AS m,
         stddev_pop(CASE WHEN rn <= floor(CAST(0.6 AS DOUBLE) * n) THEN mal_cases END) AS s
  FROM (SELECT *, row_number() OVER (PARTITION BY district ORDER BY year, month) AS rn,
               count(*) OVER (PARTITION BY district) AS n FROM sp)
  GROUP BY district)"""
    q["norm_fit_nulls_skip"] = with_ctes(DAILY, PANEL, seeded, skip) + f"""
SELECT district, {_r6('m')} AS mal_cases_mean, {_r6('CASE WHEN s < 1e-10 THEN 1.0 ELSE s END')} AS mal_cases_std
FROM sk"""

    q["panel_window_distinct"] = with_ctes(DAILY, PANEL, "p AS (SELECT *, make_date(year, month, 1) AS date FROM panel)",
                                           """d2 AS (SELECT * FROM p UNION ALL SELECT * FROM p WHERE date = (SELECT max(date) FROM p))""",
                                           """wr AS (SELECT * FROM d2 WHERE date BETWEEN
       CAST((SELECT max(date) FROM p) - INTERVAL 5 MONTH AS DATE) AND (SELECT max(date) FROM p))""") + """
SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM wr WHERE district IN (
  SELECT district FROM wr GROUP BY district HAVING count(DISTINCT date) = 6)"""

    q["month_partials"] = q["monthly_entity_rollup"]
    q["score_registry"] = q["score_models"]
    q["params_file"] = q["global_norm_fit"]

    q["score_errors"] = with_ctes(DAILY, PANEL, *P_VIEWS) + """
SELECT 'broken' AS model, 'predict: no such weights' AS error, count(DISTINCT district) AS n FROM zt HAVING count(*) > 0"""

    q["panel_readiness"] = with_ctes(DAILY, PANEL, "p AS (SELECT *, make_date(year, month, 1) AS date FROM panel)", """c AS (
  SELECT district, count(*) FILTER (WHERE date >= (SELECT max(date) FROM p) - INTERVAL 5 MONTH) AS n FROM p
  WHERE district <> 5 GROUP BY district)""") + """
SELECT count(*) AS entities, count(*) FILTER (WHERE n = 6) AS complete, coalesce(bool_or(n = 6), false) AS ready FROM c"""

    seeded = """k AS (
  SELECT * FROM panel WHERE ((district + month) % 7 <> 0 OR district % 4 = 0)
    AND (district % 10 <> 7 OR year * 12 + month >= 2001 * 12 + 9)),
seeded AS (SELECT * FROM k UNION ALL SELECT * FROM k WHERE district % 10 = 4 AND month = 9)"""
    q["entity_runs"] = with_ctes(DAILY, PANEL, seeded, """m AS (
  SELECT district, CAST(year * 12 + month - 1 AS INTEGER) AS ym, count(*) AS n FROM seeded GROUP BY ALL)""", """l AS (
  SELECT *, ym - row_number() OVER (PARTITION BY district ORDER BY ym) AS island,
         (SELECT coalesce(sum(b.n), 0) FROM m b WHERE b.district = m.district AND b.ym > m.ym) AS later FROM m)""", """e AS (
  SELECT district, sum(n) AS total, bool_or(n > 1 AND later < 6) AS doubled FROM l GROUP BY district)""", """r AS (
  SELECT district, island, min(ym) AS first, max(ym) AS last, count(*) AS n_months, sum(n) AS n_rows FROM l GROUP BY ALL)""") + """
SELECT district, CAST(row_number() OVER w - 1 AS INTEGER) AS run, first, last, n_months, CAST(n_rows AS BIGINT) AS n_rows,
       CAST(lag(first) OVER w - last - 1 AS INTEGER) AS gap,
       CASE WHEN total < 6 THEN 'short' WHEN doubled THEN 'repeated'
            WHEN first_value(n_months) OVER w < 6 THEN 'gap' ELSE 'ready' END AS state
FROM r JOIN e USING (district)
WINDOW w AS (PARTITION BY district ORDER BY last DESC)"""
    q["latest_window_contiguous"] = with_ctes(DAILY, PANEL, seeded, """t AS (
  SELECT *, row_number() OVER (PARTITION BY district ORDER BY year DESC, month DESC) AS rn FROM seeded)""", """g AS (
  SELECT district FROM t WHERE rn <= 6 GROUP BY district
  HAVING count(*) = 6 AND count(DISTINCT year * 12 + month) = 6
     AND max(year * 12 + month) - min(year * 12 + month) = 5)""") + f"""
SELECT district, year, month, {FEATURES}, mal_cases, strftime(make_date(year, month, 1), '%Y-%m-%d') AS date,
       CAST(6 - rn AS BIGINT) AS pos
FROM t JOIN g USING (district) WHERE rn <= 6"""

    cols = FEATURE_LIST + ["mal_cases"]
    q["norm_fit_float32"] = with_ctes(DAILY, PANEL, """o AS (
  SELECT *, row_number() OVER (PARTITION BY district ORDER BY year, month) AS rn, count(*) OVER (PARTITION BY district) AS n
  FROM panel)""") + "\nSELECT district, " + ", ".join(
        f"{_r6(f'CAST(CAST(avg(CAST(CAST({c} AS REAL) AS DOUBLE)) AS REAL) AS DOUBLE)')} AS {c}_mean, "
        + _r6(f"CAST(CAST(CASE WHEN stddev_pop(CAST(CAST({c} AS REAL) AS DOUBLE)) < 1e-10 THEN 1.0 "
              f"ELSE stddev_pop(CAST(CAST({c} AS REAL) AS DOUBLE)) END AS REAL) AS DOUBLE)") + f" AS {c}_std" for c in cols) + """
FROM (SELECT d.district, o.* EXCLUDE (district) FROM (SELECT DISTINCT district FROM panel) d
      LEFT JOIN o ON o.district = d.district AND rn <= floor(CAST(0.6 AS DOUBLE) * n))
GROUP BY district"""

    q["csv_folder_rows"] = with_ctes(DAILY, PANEL) + f"""
SELECT district, year, month, {FEATURES} FROM panel
WHERE year % 3 < 2 AND NOT (year % 3 = 0 AND district % 10 = 1 AND month = 2)"""
    q["csv_folder_quarantine"] = with_ctes(DAILY, PANEL) + """
SELECT CASE WHEN year % 3 = 2 THEN 'no column total_precipitation' ELSE 'line does not fit' END AS reason, count(*) AS n_lines
FROM panel WHERE year % 3 = 2 OR (year % 3 = 0 AND district % 10 = 1 AND month = 2) GROUP BY reason"""

    q["published_panel"] = with_ctes(DAILY, PANEL) + f"\nSELECT district, year, month, {FEATURES}, mal_cases FROM panel"
    q["history_stored_order"] = with_ctes(DAILY, PANEL) + """
SELECT year, month, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order FROM panel GROUP BY year, month"""
    return q
