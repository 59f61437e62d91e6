"""NULL keys, CSV headers, first rows by time, gaps and failing models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators import history, normalize, rollup, scoring, windows
from panelcast.sources import readers

SERIES = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("value", T.DoubleType())])


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("index,value,year\n0,1.5,2020\n")
    assert [tuple(r) for r in readers.read_table(spark, str(tmp_path / "a.csv"), SERIES).collect()] == [(2020, 1.5)]


def test_csv_without_a_wanted_column_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("index,year\n0,2020\n")
    with pytest.raises(ValueError, match="value"):
        readers.read_table(spark, str(tmp_path / "a.csv"), SERIES)


def test_rows_without_an_entity_count_for_the_nation_only(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1), 5.0), (None, dt.date(2020, 1, 2), 7.0)],
                               "district string, date date, precipitation double")
    rules = {"precipitation": ("total", "sum")}
    rows = rollup.both_grains(df, rules=rules, hours=()).collect()
    assert sorted((r.national, r.district, r.total) for r in rows) == [(0, "a", 5.0), (1, None, 12.0)]


def test_no_statistics_or_window_for_a_null_entity(spark):
    df = spark.createDataFrame([(e, 2020, m, float(m)) for e in ("a", None) for m in (1, 2, 3)],
                               "district string, year int, month int, v double")
    assert [r.district for r in normalize.fit_stats(df, ["v"], ["year", "month"], entity="district").collect()] == ["a"]
    kept = windows.panel_window(windows.with_month_date(df), "district", k=3, latest=dt.date(2020, 3, 1))
    assert {r.district for r in kept.collect()} == {"a"}


def test_the_first_row_is_the_earliest(spark):
    stored = spark.createDataFrame([(2020, 1, 9.0)], "year int, month int, v double")
    batch = spark.createDataFrame([(2020, 2, 1.0), (2020, 1, 9.0)], "year int, month int, v double")
    assert history.rows_if_absent(stored, batch, ["v"], ["year", "month"]).count() == 0


def test_a_repeated_month_does_not_hide_a_gap(spark):
    df = spark.createDataFrame([(2020, m) for m in (1, 2, 2, 4)], "year int, month int")
    with pytest.raises(Exception, match="contiguous"):
        windows.latest_window(df, ["year", "month"], 4, require_contiguous=True).collect()


def test_a_model_that_fails_in_one_batch_never_leaves_part_of_its_rows(spark):
    scores = spark.createDataFrame([("a", "m", 1, 1.0, None), ("b", "m", 1, None, "boom"), ("a", "n", 1, 2.0, None)],
                                   "district string, model string, horizon int, y double, error string")
    assert {r.model for r in scoring.good_rows(scores).collect()} == {"n"}
    with pytest.raises(Exception, match="boom"):
        scoring.good_rows(scores, on_error="raise").collect()
    assert [tuple(r) for r in scoring.failures(scores).collect()] == [("m", "boom", 1)]


def test_dense_ids_never_sort_in_one_task(spark):
    df = spark.range(0, 500).select((F.col("id") % 37).alias("k"))
    from panelcast.operators.ordering import dense_ids
    assert sorted(r.entity_id for r in dense_ids(df, "k").collect()) == list(range(37))
