"""Appends, duplicates, alignment and validation (J1, J2, U1-U3, P1-P5, P16, O1, T12, T15, T19)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import schemas
from panelcast.operators import history, validate
from panelcast.operators.ordering import global_index

KEYS = ["district", "year", "month"]
SCHEMA = "district string, year int, month int, v double"


@pytest.fixture()
def hist(spark):
    return spark.createDataFrame([("A", 2025, 1, 1.0), ("A", 2025, 2, 2.0), ("B", 2025, 1, 3.0),
                                  (None, 2025, 1, 4.0)], SCHEMA)


def test_duplicate_keys_match_null_to_null(spark, hist):
    batch = spark.createDataFrame([("A", 2025, 2, 9.0), (None, 2025, 1, 9.0), ("C", 2025, 3, 9.0)], SCHEMA)
    got = sorted(history.duplicate_keys(batch, hist, KEYS).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([("A", 2025, 2), (None, 2025, 1)], key=str)


def test_all_or_nothing_skips_the_whole_batch(spark, hist):
    overlap = spark.createDataFrame([("A", 2025, 2, 9.0), ("C", 2025, 3, 9.0)], SCHEMA)
    disjoint = spark.createDataFrame([("C", 2025, 3, 9.0), ("D", 2025, 3, 9.0)], SCHEMA)
    assert history.append_all_or_nothing(hist, overlap, KEYS).count() == 4
    assert history.append_all_or_nothing(hist, disjoint, KEYS).count() == 6


def test_new_keys_appends_only_new_rows_and_is_idempotent(spark, hist):
    batch = spark.createDataFrame([("A", 2025, 2, 9.0), ("C", 2025, 3, 9.0), (None, 2025, 1, 9.0)], SCHEMA)
    once = history.append_new_keys(hist, batch, KEYS)
    assert once.count() == 5
    twice = history.append_new_keys(once, batch, KEYS)
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_append_if_absent_compares_first_row_on_features(spark):
    cols = "a double, b double, t double"
    stored = spark.createDataFrame([(1.0, 2.0, 5.0), (3.0, None, 6.0)], cols)
    same = spark.createDataFrame([(1.0, 2.0, None)], cols)
    new = spark.createDataFrame([(1.0, 2.5, None)], cols)
    null_row = spark.createDataFrame([(3.0, None, None)], cols)
    assert history.append_if_absent(stored, same, ["a", "b"], ["a"]).count() == 2       # T15
    assert history.append_if_absent(stored, new, ["a", "b"], ["a"]).count() == 3
    assert history.append_if_absent(stored, null_row, ["a", "b"], ["a"]).count() == 3   # NULL never matches


def test_schema_align_renames_adds_and_drops(spark):
    legacy = spark.createDataFrame([(0, 2025, 4, "A", 1.0, 2.0, 3.0, 4.0, 5.0)],
                                   "index long, year int, month int, district string, avg_temp_max double, "
                                   "avg_temp_min double, avg_humidity double, sum_precipitation double, "
                                   "sum_sunshine_hours double")
    out = schemas.schema_align(legacy, schemas.DISTRICT_HISTORY_COLUMNS, renames=schemas.LEGACY_RENAMES,
                               add_missing={"mal_cases": T.DoubleType()})
    assert out.columns == schemas.DISTRICT_HISTORY_COLUMNS                      # T12, T19
    r = out.first()
    assert r.mal_cases is None and r.total_precipitation == 4.0 and r.total_sunshine_hours == 5.0
    with pytest.raises(ValueError, match="missing required"):
        schemas.schema_align(legacy.drop("district"), schemas.DISTRICT_HISTORY_COLUMNS)


def test_validation_report_and_assert(spark):
    df = spark.createDataFrame([(2025, 1), (None, 2), (2025, None)], "year int, month int")
    rep = {r.check_name: (r.n_bad, r.passed) for r in
           validate.validation_report(df, ["year", "month", "ddd_demand"], ["year", "month"]).collect()}
    assert rep == {"required_columns": (1, False), "non_empty": (0, True),
                   "not_null:year": (1, False), "not_null:month": (1, False)}
    with pytest.raises(ValueError, match="validation failed"):
        validate.assert_valid(df, ["year"], ["year"])
    empty = spark.createDataFrame([], "year int, month int")
    rep = {r.check_name: r.n_bad for r in validate.validation_report(empty, ["year"], ["year"]).collect()}
    assert rep["non_empty"] == 1


def test_history_sorted_nulls_last_with_global_index(spark, hist):
    out = global_index(hist.repartition(3), [F.col(k).asc_nulls_last() for k in KEYS]).orderBy("pos").collect()
    assert [(r.district, r.month, r.pos) for r in out] == [("A", 1, 0), ("A", 2, 1), ("B", 1, 2), (None, 1, 3)]


def test_global_index_matches_row_number_on_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(13)
    from pyspark.sql import Window
    ref = {r.k: r.rn for r in df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("rn")).collect()}
    got = {r.k: r.pos for r in global_index(df, [F.col("k")]).collect()}
    assert got == ref


def test_dense_ids_are_dense_and_sorted(spark):
    from panelcast.operators.ordering import dense_ids
    df = spark.range(0, 3000).select((F.col("id") * 37 % 1009).alias("k")).repartition(9)
    got = {r.k: r.entity_id for r in dense_ids(df, "k").collect()}
    assert got == {k: k for k in range(1009)}
