"""Jobs end to end on small fixtures: monthly ETL, stream arrival, readers and sinks, forecasts."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast import schemas
from panelcast.plans import jobs, models
from panelcast.sources import readers, sinks
from panelcast.streaming import monthly_arrival


def payload(d, month, days, base):
    time = [f"2025-{month:02d}-{i + 1:02d}" for i in range(days)]
    return {"district": d, "daily": {
        "time": time,
        "temperature_2m_max": [base + i for i in range(days)],
        "temperature_2m_min": [base - 10.0] * days,
        "precipitation_sum": [0.5] * days,
        "relative_humidity_2m_mean": [70.0] * days,
        "sunshine_duration": [3600.0] * days}}


def land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def test_monthly_etl_writes_rollups_and_guarded_history(spark, tmp_dir):
    land(f"{tmp_dir}/land", "2025_04", [payload("A", 4, 30, 30.0), payload("B", 4, 30, 20.0),
                                         {"district": "C"}])
    dim = spark.createDataFrame([("A",), ("B",), ("C",)], "district string")
    paths = jobs.run_monthly_etl(spark, f"{tmp_dir}/land", dim, "2025-05-10", f"{tmp_dir}/wh")
    dm = spark.read.parquet(paths["district_month"])
    assert dm.count() == 2
    a = dm.filter("district = 'A'").first()
    assert a.avg_temp_max == 44.5 and a.total_precipitation == 15.0 and a.total_sunshine_hours == 30.0
    nat = spark.read.parquet(paths["national_month"]).first()
    assert nat.total_precipitation == 30.0 and nat.avg_temp_max == pytest.approx(39.5)
    assert [r.district for r in spark.read.parquet(paths["coverage_missing"]).collect()] == ["C"]
    assert spark.read.parquet(paths["district_history"]).count() == 2
    files = spark.read.parquet(paths["district_history"]).groupBy(F.input_file_name()).agg(
        F.collect_list("district").alias("order")).collect()
    assert all(r.order == sorted(r.order) for r in files)                                # O1
    # Second run of the same month: both guards find the month stored, nothing is appended.
    again = jobs.run_monthly_etl(spark, f"{tmp_dir}/land", dim, "2025-05-10", f"{tmp_dir}/wh")
    assert spark.read.parquet(paths["district_history"]).count() == 2
    assert "duplicates" not in paths
    assert {r.district for r in spark.read.parquet(again["duplicates"]).collect()} == {"A", "B"}     # J1
    assert spark.read.parquet(paths["national_history"]).count() == 1
    # Next month appends.
    land(f"{tmp_dir}/land5", "2025_05", [payload("A", 5, 31, 30.0)])
    jobs.run_monthly_etl(spark, f"{tmp_dir}/land5", dim, "2025-06-02", f"{tmp_dir}/wh")
    assert spark.read.parquet(paths["district_history"]).count() == 3
    assert spark.read.parquet(paths["national_history"]).count() == 2


def test_stream_arrival_appends_each_month_once(spark, tmp_dir):
    landing, hist, ck = f"{tmp_dir}/land", f"{tmp_dir}/hist", f"{tmp_dir}/ck"
    land(landing, "2025_04", [payload("A", 4, 30, 30.0), payload("B", 4, 30, 20.0)])
    q = monthly_arrival.start_monthly_arrival(spark, landing, hist, ck)
    q.awaitTermination(120)
    land(landing, "2025_05", [payload("A", 5, 31, 31.0)])
    land(landing, "2025_04_again", [payload("A", 4, 30, 99.0)])          # replayed month: ignored
    q = monthly_arrival.start_monthly_arrival(spark, landing, hist, ck)
    q.awaitTermination(120)
    h = spark.read.parquet(hist)
    assert h.count() == 3
    assert h.filter("district = 'A' AND month = 4").first().avg_temp_max == 44.5
    months = {(r.year, r.month): r.entities for r in monthly_arrival.history_months(spark, hist).collect()}
    assert months == {(2025, 4): 2, (2025, 5): 1}


def test_csv_reader_keeps_truncated_row(spark, tmp_dir):
    p = f"{tmp_dir}/preds.csv"
    with open(p, "w") as f:
        f.write("district,month,model,predicted_mal_cases\nA,May,Dense,12.5\nB,May,GRU,3.25\nK\n")
    sch = T.StructType([T.StructField("district", T.StringType()), T.StructField("month", T.StringType()),
                        T.StructField("model", T.StringType()), T.StructField("predicted_mal_cases", T.DoubleType())])
    df = readers.read_table(spark, p, sch, keep_corrupt=True).cache()
    assert df.count() == 3
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 1     # T23


def test_params_file_length_check_and_floor(spark, tmp_dir):
    feats = schemas.MONTHLY_FEATURES + ["ddd_demand"]
    p = f"{tmp_dir}/params.json"
    with open(p, "w") as f:
        json.dump({"mean": [1, 2, 3, 4, 5, 6], "std": [1, 0, 1, 1, 1e-12, 2]}, f, indent=2)
    r = readers.read_params(spark, p, feats).first()
    assert r.avg_temp_min_std == 1.0 and r.total_sunshine_hours_std == 1.0 and r.ddd_demand_mean == 6.0
    with open(p, "w") as f:
        json.dump({"mean": [1, 2], "std": [1, 2]}, f)
    with pytest.raises(ValueError, match="must have 6"):
        readers.read_params(spark, p, feats)


def test_fixed_decimal_csv_sink(spark, tmp_dir):
    df = spark.createDataFrame([("A", 0.125), ("B", 2.5)], "district string, v double")
    sinks.write_csv(df, f"{tmp_dir}/out", float_digits=2)
    got = {r.district: r.v for r in spark.read.option("header", True).csv(f"{tmp_dir}/out").collect()}
    assert got == {"A": "0.12", "B": "2.50"}


def history_frame(spark, n_entities=4, months=12):
    rng = np.random.default_rng(5)
    rows = []
    for e in range(n_entities):
        for m in range(months):
            y, mo = 2024 + m // 12, m % 12 + 1
            rows.append((f"D{e}", y, mo, *[float(v) for v in rng.uniform(1, 50, 5)], float(rng.integers(0, 100))))
    cols = "district string, year int, month int, " + ", ".join(f"{c} double" for c in schemas.MONTHLY_FEATURES) + \
        ", mal_cases double"
    return spark.createDataFrame(rows, cols)


def test_panel_forecast_job_writes_named_long_csv(spark, tmp_dir):
    hist = history_frame(spark)
    sinks.write_table(hist, f"{tmp_dir}/hist")
    path = jobs.run_panel_forecast(spark, f"{tmp_dir}/hist", models.panel_models(), f"{tmp_dir}/res",
                                   exclude=["D3"])
    assert path.endswith("predictions_January_2025_February_2025_March_2025")
    out = spark.read.option("header", True).csv(path)
    assert out.count() == 3 * 2 * 3                                  # entities x models x months
    assert out.filter(F.col("predicted_mal_cases").cast("double") < 0).count() == 0


def test_panel_job_reports_skips_and_keeps_the_last_output_on_failure(spark, tmp_dir):
    hist = history_frame(spark).where("NOT (district = 'D1' AND year = 2024 AND month = 11)")
    sinks.write_table(hist, f"{tmp_dir}/hist")
    path = jobs.run_panel_forecast(spark, f"{tmp_dir}/hist", models.panel_models(), f"{tmp_dir}/res", exclude=["D3"])
    skipped = spark.read.option("header", True).csv(path.replace("/predictions_", "/skipped_")).collect()
    assert [(r.district, r.n_rows) for r in skipped] == [("D1", "5")]                   # P14
    before = sorted(map(tuple, spark.read.option("header", True).csv(path).collect()))

    class Broken:
        def predict(self, x):
            raise RuntimeError("boom")

    with pytest.raises(Exception, match="boom"):
        jobs.run_panel_forecast(spark, f"{tmp_dir}/hist", {"broken": Broken()}, f"{tmp_dir}/res", exclude=["D3"])
    assert sorted(map(tuple, spark.read.option("header", True).csv(path).collect())) == before      # M5


def test_series_forecast_with_model_set(spark):
    hist = history_frame(spark, 1, 30).drop("district").withColumnRenamed("mal_cases", "ddd_demand")
    lin = models.series_models()
    out = jobs.series_forecast(hist, lin).collect()
    assert len(out) == 6 and {r.model_name for r in out} == {"recency", "last_month"}
    class DenseStandIn:                       # local class: pickled by value to the workers
        def predict(self, x):
            return np.tanh(x.reshape(len(x), -1)[:, :3])

    via_workers = jobs.series_forecast(hist, {**lin, "dense": DenseStandIn()}).collect()
    assert len(via_workers) == 9
    assert sorted((r.model_name, r.date, r.predicted_demand) for r in via_workers if r.model_name != "dense") == \
        sorted((r.model_name, r.date, r.predicted_demand) for r in out)


def test_dated_csv_reader(spark, tmp_dir):
    p = f"{tmp_dir}/daily.csv"
    with open(p, "w") as f:
        f.write("district,date,temp_max,temp_min,precipitation,humidity,sunshine,month\n"
                "A,2025-04-01,30.5,20.1,0.0,70.0,3600.0,2025_04\n")
    df = readers.read_csv_dated(spark, p, schemas.DAILY_SCHEMA)
    r = df.first()
    assert str(r.date) == "2025-04-01" and r.temp_max == 30.5 and r.month == "2025_04"


def test_a_failing_model_fails_the_panel_job(spark, tmp_dir):
    class Broken:
        def predict(self, x):
            raise RuntimeError("boom")

    sinks.write_table(history_frame(spark), f"{tmp_dir}/hist")
    with pytest.raises(Exception, match="boom"):
        jobs.run_panel_forecast(spark, f"{tmp_dir}/hist", {"broken": Broken()}, f"{tmp_dir}/res")  # M4


def test_panel_job_equals_registered_long_forecast(spark):
    from panelcast.plans import queries as Q
    sf = "/root/testdata/sf0.01"
    job = jobs.panel_forecast_frame(spark, sf)
    composed = Q.long_forecast(spark, sf)
    a = sorted(tuple(r) for r in job.collect())
    b = sorted(tuple(r) for r in composed.collect())
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert x[:3] == y[:3] and x[3] == pytest.approx(y[3], abs=0.011)


def test_run_series_forecast_reads_csv_and_params(spark, tmp_dir):
    rng = np.random.default_rng(9)
    lines = ["year,month,ddd_demand," + ",".join(schemas.MONTHLY_FEATURES)]
    for i in range(27):                                   # 2023-01 .. 2025-03, last 3 targets empty
        y, m = 2023 + i // 12, i % 12 + 1
        target = "" if i >= 24 else f"{rng.uniform(1, 2):.4f}"
        lines.append(f"{float(y)},{float(m)},{target}," + ",".join(f"{v:.2f}" for v in rng.uniform(0, 50, 5)))
    with open(f"{tmp_dir}/merged.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(f"{tmp_dir}/params.json", "w") as f:
        json.dump({"mean": [25, 25, 25, 25, 25, 1.5], "std": [10, 10, 10, 10, 10, 0.3]}, f)
    path = jobs.run_series_forecast(spark, f"{tmp_dir}/merged.csv", models.series_models(),
                                    f"{tmp_dir}/res", params_path=f"{tmp_dir}/params.json")
    assert path.endswith("ddd_predictions_April2025_May2025_June2025")
    out = spark.read.option("header", True).csv(path).collect()
    assert len(out) == 6 and {r.date for r in out} == {"2025-04-01", "2025-05-01", "2025-06-01"}


def test_series_job_validates_before_running(spark):
    empty = spark.createDataFrame([], "year int, month int, ddd_demand double, " +
                                  ", ".join(f"{c} double" for c in schemas.MONTHLY_FEATURES))
    with pytest.raises(ValueError, match="non_empty"):
        jobs.series_forecast(empty, models.series_models())
    missing = empty.drop("ddd_demand")
    with pytest.raises(ValueError, match="required_columns"):
        jobs.series_forecast(missing, models.series_models())
