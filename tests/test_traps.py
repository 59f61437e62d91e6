"""The semantic traps of the survey (T1-T24) and the small in-line fixtures, one test each."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import schemas
from panelcast.functions import clamp_zero, clip_cast, round_half_even
from panelcast.operators import filters, forecast, normalize, rollup, windows

D = dt.date

DAILY = T.StructType([
    T.StructField("district", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("temp_max", T.DoubleType()), T.StructField("temp_min", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()), T.StructField("humidity", T.DoubleType()),
    T.StructField("sunshine", T.DoubleType()),
])


def daily(spark, rows):
    return spark.createDataFrame(rows, DAILY)


def panel(spark, rows, target="mal_cases"):
    """rows: (district, year, month, value) -> panel with five features = value and target."""
    data = [(d, y, m, v, v, v, v, v, v) for d, y, m, v in rows]
    cols = ["district", "year", "month"] + schemas.MONTHLY_FEATURES + [target]
    sch = T.StructType([T.StructField("district", T.StringType()), T.StructField("year", T.IntegerType()),
                        T.StructField("month", T.IntegerType())]
                       + [T.StructField(c, T.DoubleType()) for c in cols[3:]])
    return spark.createDataFrame(data, sch)


# ---- roll-ups (T1, T2, T3, T14, F-1, F-2) -------------------------------------------------

def test_null_keys_are_dropped_and_all_null_sum_is_zero(spark):
    df = daily(spark, [
        ("A", D(2025, 4, 1), 30.0, 20.0, None, 70.0, 3600.0),
        ("A", D(2025, 4, 2), 32.0, 22.0, None, 72.0, 7200.0),
        (None, D(2025, 4, 1), 99.0, 99.0, 99.0, 99.0, 99.0),
        ("B", D(2025, 4, 1), None, None, None, None, None),
    ])
    out = {r.district: r for r in rollup.monthly_rollup(df).collect()}
    assert set(out) == {"A", "B"}                                  # T1
    assert out["A"].avg_temp_max == 31.0
    assert out["A"].total_precipitation == 0.0                     # T2: all-NULL sum is 0
    assert out["A"].total_sunshine_hours == 3.0                    # F-1 seconds -> hours
    assert out["B"].avg_temp_max is None                           # mean of nothing stays NULL
    assert out["B"].total_sunshine_hours == 0.0


def test_rounding_is_numpy_half_even_on_the_scaled_double(spark):
    vals = [0.125, 2.675, 0.135, 1.005, -0.125, 12.345]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.r for r in df.select(round_half_even("x", 2).alias("r")).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]          # T3
    assert got[0] == 0.12                                         # Spark round() gives 0.13
    assert got[1] == 2.68 and round(2.675, 2) == 2.67             # T4: Python's round differs


def test_national_rollup_reads_daily_rows_not_rounded_entity_rows(spark):
    rows = []
    for i, d in enumerate(["A", "B", "C"]):
        for day in range(1, 4):
            rows.append((d, D(2025, 4, day), 1.0, 1.0, 0.333 + i, 1.0, 1234.5 + 17 * day + i))
    df = daily(spark, rows)
    both = rollup.both_grains(df)
    nat = both.filter("national = 1").first()
    expected = round(sum(r[6] for r in rows) / 3600.0, 2)
    assert nat.total_sunshine_hours == pytest.approx(expected, abs=1e-9)          # T14
    direct = rollup.monthly_rollup(df, entity=None).first()
    assert direct.total_sunshine_hours == nat.total_sunshine_hours


def test_exact_scale_matches_plain_means_on_fixed_point_data(spark):
    rng = np.random.default_rng(3)
    rows = [("A", D(2025, 4, 1 + i % 28), *[round(float(v), 2) for v in rng.uniform(0, 100, 5)])
            for i in range(200)]
    df = daily(spark, rows)
    a = rollup.monthly_rollup(df, digits=None, exact_scale=2).first()
    b = rollup.monthly_rollup(df, digits=None).first()
    for c in schemas.MONTHLY_FEATURES:
        assert a[c] == pytest.approx(b[c], rel=1e-12)


# ---- windows and normalisation (T5, T6, T7, T8, T9, T11, T13, F-4) -----------------------

def test_train_prefix_is_int_of_point_six_n(spark):
    # T5: floor(0.6D * n) == int(0.60 * n) for every n a panel can have.
    df = spark.range(1, 2000).select(F.col("id").alias("n"))
    bad = df.filter(F.floor(F.lit(0.6) * F.col("n")) != F.expr("CAST(n * 3 / 5 AS BIGINT)")).count()
    assert bad == 0
    assert all(int(0.60 * n) == (3 * n) // 5 for n in range(1, 2000))


def test_clamp_zero_python_max_semantics(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-1.5,), (0.0,), (2.5,)], "y double")
    got = [r.c for r in df.select(clamp_zero("y").alias("c")).collect()]
    assert got == [0.0, 0.0, 0.0, 0.0, 2.5]                       # T6


def test_stats_population_std_and_floor(spark):
    vals = [3.0, 5.0, 9.0, 11.0, 2.0, 100.0, 100.0, 100.0, 100.0, 100.0]
    p = panel(spark, [("A", 2024, i + 1, v) for i, v in enumerate(vals)]
              + [("K", 2024, i + 1, 7.0) for i in range(10)])
    st = {r.district: r for r in normalize.fit_stats(p, ["avg_temp_max"], ["year", "month"], "district").collect()}
    prefix = np.array(vals[:6])
    assert st["A"].avg_temp_max_mean == pytest.approx(prefix.mean())
    assert st["A"].avg_temp_max_std == pytest.approx(prefix.std())        # T8 ddof=0
    assert st["K"].avg_temp_max_std == 1.0                                  # F-4 constant entity


def test_null_target_in_prefix_propagates(spark):
    rows = [("A", 2024, m, float(m)) for m in range(1, 11)]
    p = panel(spark, rows).withColumn(
        "mal_cases", F.when((F.col("district") == "A") & (F.col("month") == 2), None).otherwise(F.col("mal_cases")))
    late = panel(spark, [("B", 2024, m, float(m)) for m in range(1, 11)]).withColumn(
        "mal_cases", F.when(F.col("month") == 9, None).otherwise(F.col("mal_cases")))
    both = p.unionByName(late)
    st = {r.district: r for r in normalize.fit_stats(both, ["mal_cases"], ["year", "month"], "district").collect()}
    assert st["A"].mal_cases_mean is None and st["A"].mal_cases_std is None   # T7 propagate
    assert st["B"].mal_cases_mean == pytest.approx(3.5)                       # NULL after the prefix
    skip = {r.district: r for r in normalize.fit_stats(both, ["mal_cases"], ["year", "month"], "district",
                                                       nulls="skip").collect()}
    assert skip["A"].mal_cases_mean == pytest.approx(np.mean([1, 3, 4, 5, 6]))


def test_row_order_does_not_change_stats_or_windows(spark):
    rows = [("A", 2024 + (m - 1) // 12, (m - 1) % 12 + 1, float(m * m % 17)) for m in range(1, 31)]
    p1 = panel(spark, rows)
    p2 = panel(spark, list(reversed(rows))).repartition(7)
    s1 = normalize.fit_stats(p1, ["avg_temp_max"], ["year", "month"], "district").collect()
    s2 = normalize.fit_stats(p2, ["avg_temp_max"], ["year", "month"], "district").collect()
    assert s1 == s2                                                            # T9
    w1 = windows.latest_window(p1, ["year", "month"], 12).orderBy("pos").collect()
    w2 = windows.latest_window(p2, ["year", "month"], 12).orderBy("pos").collect()
    assert [r.avg_temp_max for r in w1] == [r.avg_temp_max for r in w2]


def test_completeness_counts_rows_not_distinct_months(spark):
    full = [("F", 2025, m, 1.0) for m in range(1, 7)]
    short = [("S", 2025, m, 1.0) for m in range(2, 7)]
    dup = [("D", 2025, m, 1.0) for m in [1, 2, 3, 4, 6, 6]]       # May missing, June twice
    p = windows.with_month_date(panel(spark, full + short + dup))
    got = {r.district for r in windows.panel_window(p, "district").select("district").distinct().collect()}
    assert got == {"F", "D"}                                        # T11: rows, so D passes
    strict = {r.district for r in windows.panel_window(p, "district", distinct_months=True)
              .select("district").distinct().collect()}
    assert strict == {"F"}
    skipped = {r.district: r.n_rows for r in windows.panel_skipped(p, "district").collect()}
    assert skipped == {"S": 5}


def test_skipped_report_includes_entities_without_window_rows(spark):
    rows = [("F", 2025, m, 1.0) for m in range(1, 7)] + [("Z", 2024, 1, 1.0)]
    p = windows.with_month_date(panel(spark, rows))
    assert {r.district: r.n_rows for r in windows.panel_skipped(p, "district").collect()} == {"Z": 0}


def test_exclusion_after_the_latest_month(spark):
    rows = [("A", 2025, m, 1.0) for m in range(1, 7)] + [("K", 2025, m, 1.0) for m in range(2, 8)]
    p = windows.with_month_date(panel(spark, rows))
    kept = filters.entity_exclude(p, "district", ["K"])
    # The latest month (July) comes from the whole panel, so A's Jan-Jun window is incomplete.
    assert windows.panel_window(kept, "district", max_from=p).count() == 0      # T13
    assert windows.panel_window(kept, "district").count() == 6


def test_no_complete_entity_fails_the_job(spark):
    from panelcast.plans import jobs, models
    rows = [("A", 2025, m, 1.0) for m in range(1, 4)]
    with pytest.raises(Exception, match="complete input window"):
        jobs.panel_forecast(panel(spark, rows), models.panel_models()).collect()   # P15


def test_min_rows_guard(spark):
    p = panel(spark, [("A", 2025, m, 1.0) for m in range(1, 6)])
    with pytest.raises(Exception, match="need at least 12"):
        windows.latest_window(p, ["year", "month"], 12).collect()             # P17


# ---- scalar functions (F-7, F-8, F-11, F-12) -----------------------------------------------

def test_clip_cast_truncates(spark):
    df = spark.createDataFrame([(-3.2,), (0.9,), (5.99,), (250.0,)], "x double")
    assert [r.c for r in df.select(clip_cast("x", 118).alias("c")).collect()] == [0, 0, 5, 117]


def test_forecast_months_carry_the_year(spark):
    df = spark.createDataFrame([("A", D(2025, 11, 1)), ("B", D(2025, 12, 1))], "district string, date date")
    out = forecast.forecast_months(df, "date", 3, "district").orderBy("district", "horizon").collect()
    assert [r.label_underscore for r in out if r.district == "A"] == ["December_2025", "January_2026", "February_2026"]
    b = [r for r in out if r.district == "B"]
    assert [(r.year, r.month) for r in b] == [(2026, 1), (2026, 2), (2026, 3)]
    assert b[0].label_space == "January 2026" and b[0].label_joined == "January2026"
    assert b[0].label_iso == "2026-01-01" and b[0].label_period == "2026_01"


def test_golden_forecast_month_names(spark):
    # Series ending March 2025 -> April, May, June 2025 (published prediction file names).
    df = spark.createDataFrame([(D(2025, 3, 1),)], "date date")
    labels = [r.label_joined for r in forecast.forecast_months(df, "date").orderBy("horizon").collect()]
    assert "_".join(labels) == "April2025_May2025_June2025"


def test_golden_mae_sum_and_mean(spark):
    # Published per-horizon MAEs: mae_sum is their sum and mae is mae_sum / 3.
    pred = spark.createDataFrame([("A", "m", h, 0.0) for h in (1, 2, 3)], "district string, model string, horizon int, y double")
    actual = spark.createDataFrame([("A", h, v) for h, v in ((1, 2.0), (2, 4.0), (3, 9.0))],
                                   "district string, horizon int, actual double")
    r = forecast.mae_by_horizon(pred, actual, ["district", "horizon"]).first()
    assert (r.t1_mae, r.t2_mae, r.t3_mae, r.mae_sum, r.mae) == (2.0, 4.0, 9.0, 15.0, 5.0)


def test_float_cast_is_opt_in(spark):
    df = spark.createDataFrame([(0.1,)], "x double")
    assert df.select(F.col("x").cast("float").alias("f")).first().f == pytest.approx(0.1, rel=1e-7)
    assert df.first().x == 0.1                                                  # F-15: double default


def test_year_month_stored_as_doubles_are_cast(spark):
    df = spark.createDataFrame([(2017.0, 1.0, 1.5)], "year double, month double, ddd_demand double")
    out = schemas.schema_align(df, ["year", "month", "ddd_demand"],
                               types={"year": T.IntegerType(), "month": T.IntegerType()})
    assert out.first() == Row(year=2017, month=1, ddd_demand=1.5)


def test_contiguity_is_optional(spark):
    months = [m for m in range(1, 15) if m != 7]                  # a gap inside the last 12 rows
    p = panel(spark, [("N", 2024 + (m - 1) // 12, (m - 1) % 12 + 1, float(m)) for m in months])
    assert windows.latest_window(p, ["year", "month"], 12).count() == 12      # T10 default
    with pytest.raises(Exception, match="not contiguous"):
        windows.latest_window(p, ["year", "month"], 12, require_contiguous=True).collect()


def test_skewed_entity_rollup_is_exact(spark):
    # One entity holds a third of all rows; partial aggregation keeps the result exact.
    rows = [("HOT", D(2025, 4, 1 + i % 30), 1.0, 1.0, 0.01, 1.0, 60.0) for i in range(3000)]
    rows += [(f"E{i % 60}", D(2025, 4, 1 + i % 30), 2.0, 2.0, 0.02, 2.0, 60.0) for i in range(6000)]
    df = daily(spark, rows).repartition(16)
    out = {r.district: r for r in rollup.monthly_rollup(df, exact_scale=2).collect()}
    assert out["HOT"].total_precipitation == 30.0 and out["HOT"].total_sunshine_hours == 50.0
    assert out["E0"].total_precipitation == 2.0 and len(out) == 61
