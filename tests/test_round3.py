"""Tree ensembles, one scoring pass, partial sums, gaps, CSV folders, publication, registry, float32 fit."""

import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import normalize, partials, registry, rollup, scoring, trees, windows
from panelcast.plans import jobs, models
from panelcast.sources import csv_folder, publish
from panelcast.streaming import monthly_arrival


# ---- M2 --------------------------------------------------------------------------------------

def walk(nodes, flat, entity, width):
    """Plain recursion over the node table."""
    total = {}
    for r in [n for n in nodes if n[2] == 0]:
        own = {n[2]: n for n in nodes if n[:2] == r[:2]}
        at = 0
        while own[at][5] is not None:
            _, _, _, feature, threshold, left, right, _, lost = own[at]
            x = flat[feature] if feature < width else float(entity == feature - width)
            at = left if (bool(lost) if x is None or math.isnan(x) else x <= threshold) else right
        total[r[0]] = total.get(r[0], 0.0) + own[at][7]
    return total


def test_trees_equal_plain_recursion_with_missing_features(spark):
    rng = np.random.default_rng(3)
    rows = []
    for e in range(60):
        flat = [None if rng.random() < 0.05 else float("nan") if rng.random() < 0.05 else float(v) for v in rng.normal(size=30)]
        rows.append((e, flat, e % 17))
    df = spark.createDataFrame(rows, "district long, flat array<double>, entity_id int")
    nodes = models.tree_nodes(trees=7) + [(4, 0, 0, None, None, None, None, 2.5, False)]      # a horizon with one leaf
    table = spark.createDataFrame(nodes, trees.NODE_SCHEMA)
    got = {(r.district, r.horizon): r.y for r in trees.tree_scores(df, table, 30, ["district"], base={2: 10.0}).collect()}
    for e, flat, i in rows:
        for h, y in walk(nodes, flat, i, 30).items():
            assert got[e, h] == pytest.approx(y + (10.0 if h == 2 else 0.0), abs=1e-12)


def test_saved_spark_ml_models_are_walked_exactly(spark, tmp_dir):
    """Boosted trees, a forest and one tree fitted by Spark ML on [flat | one-hot]: the walk equals their own transform."""
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
    rng = np.random.default_rng(5)
    rows = [(e, [float(v) for v in rng.normal(size=6)], e % 5) for e in range(200)]
    rows = [(e, f, i, f[0] * 2 - (f[3] > 0.2) + i * 0.7) for e, f, i in rows]
    df = spark.createDataFrame(rows, "district long, flat array<double>, entity_id int, label double")
    ids = df.select("entity_id").distinct()
    train = scoring.feature_vector(df, "flat", "entity_id", ids)
    kinds = {1: GBTRegressor(maxIter=5, maxDepth=3, seed=1, stepSize=0.3), 2: RandomForestRegressor(numTrees=4, maxDepth=4, seed=2),
             3: DecisionTreeRegressor(maxDepth=4)}
    fitted = {h: k.fit(train) for h, k in kinds.items()}
    for h, m in fitted.items():
        m.save(f"{tmp_dir}/model{h}")
    path = f"{tmp_dir}/nodes"
    trees.save_ensemble(trees.from_spark_ml(spark, {h: f"{tmp_dir}/model{h}" for h in fitted}), path)
    got = {(r.district, r.horizon): r.y
           for r in trees.tree_scores(df, trees.load_ensemble(spark, path), 6, ["district"]).collect()}
    for r in scoring.score_spark_ml(train, fitted).collect():
        assert got[r.district, r.horizon] == pytest.approx(r.y, abs=1e-9)


@pytest.mark.parametrize("nodes", [
    [(1, 0, 0, 3, 0.5, 1, 2, None, False), (1, 0, 1, None, None, None, None, 1.0, False)],             # a child is missing
    [(1, 0, 0, None, None, None, None, None, False)],                                                   # a leaf without value
    [(1, 0, 0, None, 0.5, 1, 2, None, False)] + [(1, 0, n, None, None, None, None, 1.0, False) for n in (1, 2)],
    [(1, 0, 0, 3, 0.5, 1, 1, None, False), (1, 0, 1, None, None, None, None, 1.0, False)],             # two parents
    [(1, 0, 0, None, None, None, None, 1.0, False)] * 2, []])
def test_a_broken_ensemble_is_refused(spark, nodes):
    df = spark.createDataFrame([(1, [0.0] * 4, 0)], "district long, flat array<double>, entity_id int")
    with pytest.raises(ValueError):
        trees.tree_scores(df, spark.createDataFrame(nodes, trees.NODE_SCHEMA), 4, ["district"])


# ---- M4 / M3 ---------------------------------------------------------------------------------

def test_models_run_once_for_rows_and_errors(spark, tmp_dir):
    class Counting:
        """Leaves a file for each batch that it is asked for, and fails for one entity."""

        def __init__(self, fails):
            self.fails = fails

        def predict(self, x):
            import tempfile
            tempfile.mkstemp(dir=tmp_dir)
            if self.fails and (x[:, 0, 0] == 3.0).any():
                raise ValueError("boom")
            return np.zeros((len(x), 3))

    df = spark.createDataFrame([(e, [[float(e)], [0.0]]) for e in range(4)], "district long, tensor array<array<double>>").repartition(4, "district")
    parts = df.select(F.spark_partition_id()).distinct().count()
    model_set = scoring.ModelSet({"good": Counting(False), "bad": Counting(True)})
    good, errors = scoring.split_scores(scoring.score(df, model_set))
    assert good.count() == 12 and {r.model for r in good.collect()} == {"good"}
    assert [(r.model, r.error) for r in errors.collect()] == [("bad", "predict: boom")]
    assert len(os.listdir(tmp_dir)) == 2 * parts


def test_registry_lists_failures_and_loads_the_latest(spark, tmp_dir):
    good = models.panel_models()
    path = f"{tmp_dir}/registry"
    registry.register(registry.artefacts(spark, good, 1), path)
    registry.register(registry.artefacts(spark, {"recency": good["last_month"]}, 2), path)
    rows = registry.artefacts(spark, {"torn": good["recency"], "strange": good["recency"], "short": good["recency"]})
    rows = rows.withColumn("payload", F.when(F.col("name") == "torn", F.encode(F.lit("{"), "utf-8")).otherwise(F.col("payload")))
    rows = rows.withColumn("kind", F.when(F.col("name") == "strange", "forest").otherwise(F.col("kind")))
    payload = json.dumps({"weights": [[1.0], [2.0]], "bias": [0.0]}).encode()
    rows = rows.withColumn("payload", F.when(F.col("name") == "short", F.lit(payload)).otherwise(F.col("payload")))
    rows = rows.withColumn("digest", F.when(F.col("name") == "short", F.sha2(F.lit(payload), 256)).otherwise(F.col("digest")))
    registry.register(rows, path)
    table = spark.read.schema(registry.SCHEMA).parquet(path)
    report = {r.name: r for r in registry.registry_report(table).collect()}
    assert report["recency"].version == 2 and report["recency"].error is None and report["last_month"].error is None
    assert "digest" in report["torn"].error and "unknown kind" in report["strange"].error and "differ" in report["short"].error
    loaded = registry.model_set(table)
    assert loaded.names == ["recency", "last_month"]
    x = np.random.default_rng(0).normal(size=(2, 6, 6))
    assert np.array_equal(loaded.specs["recency"].build().predict(x), good["last_month"].predict(x))
    with pytest.raises(RuntimeError):
        registry.model_set(rows.where("name = 'torn'"))


# ---- A3 / partial sums -----------------------------------------------------------------------

DAILY = ("district string, date date, temp_max double, temp_min double, humidity double, precipitation double, sunshine double")


def daily(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(d, dt.date(2025, m, day), t, 1.0, None, 2.0, 3600.0) for d, m, day, t in rows], DAILY)


def test_both_grains_tell_null_entities_from_the_total(spark):
    df = daily(spark, [("A", 4, 1, 10.0), ("A", 4, 2, 20.0), (None, 4, 3, 60.0), ("B", 5, 1, 5.0), (None, 6, 1, 7.0)])
    got = {(r.district, r.month, r.national): (r.avg_temp_max, r.total_precipitation) for r in rollup.both_grains(df).collect()}
    assert got == {("A", 4, 0): (15.0, 4.0), ("B", 5, 0): (5.0, 2.0), (None, 4, 1): (30.0, 6.0), (None, 5, 1): (5.0, 2.0),
                   (None, 6, 1): (7.0, 2.0)}


def test_partial_sums_merge_late_parts_and_replay(spark, tmp_dir):
    path = f"{tmp_dir}/partials"
    assert partials.read_partials(spark, path) is None
    parts = {"a": [("A", 4, 1, 10.0), (None, 4, 2, 40.0)], "b": [("A", 4, 3, 20.0), ("A", 5, 1, 1.0)]}
    for batch in ("a", "b", "a"):
        partials.write_partials(partials.month_partials(daily(spark, parts[batch]), batch), path)
    table = partials.read_partials(spark, path)
    whole = rollup.both_grains(daily(spark, parts["a"] + parts["b"]))
    want = whole.where("national = 0").drop("national").orderBy("month").collect()
    assert partials.merged_rollup(table).orderBy("month").collect() == want
    nation = whole.where("national = 1").drop("national", "district").orderBy("month").collect()
    assert partials.merged_rollup(table, national=True).orderBy("month").collect() == nation


def payload(district, month, first, last, value):
    days = range(first, last + 1)
    return {"district": district, "daily": {"time": [f"2025-{month:02d}-{d:02d}" for d in days],
            "temperature_2m_max": [value] * len(days), "temperature_2m_min": [1.0] * len(days),
            "relative_humidity_2m_mean": [50.0] * len(days), "precipitation_sum": [1.0] * len(days),
            "sunshine_duration": [3600.0] * len(days)}}


def land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def test_a_month_in_two_landings_has_its_full_sum(spark, tmp_dir):
    dim = spark.createDataFrame([("A",)], "district string")
    land(f"{tmp_dir}/one", "x", [payload("A", 4, 1, 10, 10.0)])
    land(f"{tmp_dir}/two", "x", [payload("A", 4, 11, 30, 40.0)])
    jobs.run_monthly_etl(spark, f"{tmp_dir}/one", dim, "2025-05-02", f"{tmp_dir}/wh")
    for _ in range(2):
        paths = jobs.run_monthly_etl(spark, f"{tmp_dir}/two", dim, "2025-05-02", f"{tmp_dir}/wh")
    row = spark.read.parquet(paths["district_month"]).first()
    assert row.avg_temp_max == 30.0 and row.total_precipitation == 30.0 and row.total_sunshine_hours == 30.0
    assert spark.read.parquet(paths["national_month"]).first().avg_temp_max == 30.0


def test_the_partial_stream_merges_files_of_one_month(spark, tmp_dir):
    landing, table, ck = f"{tmp_dir}/land", f"{tmp_dir}/table", f"{tmp_dir}/ck"
    for name, rows in (("one", [payload("A", 4, 1, 10, 10.0)]), ("two", [payload("A", 4, 11, 30, 40.0), payload("B", 5, 1, 31, 7.0)])):
        land(landing, name, rows)
        monthly_arrival.start_partial_arrival(spark, landing, table, ck).awaitTermination(120)
    h = {(r.district, r.month): (r.avg_temp_max, r.total_precipitation) for r in monthly_arrival.month_history(spark, table).collect()}
    assert h == {("A", 4): (30.0, 30.0), ("B", 5): (7.0, 31.0)}
    # A batch that is replayed after a failure replaces its own rows.
    monthly_arrival.write_batch_partials(spark.read.schema(monthly_arrival.schemas.PAYLOAD_SCHEMA).json(f"{landing}/one.json"), table, 0)
    assert {(r.district, r.month) for r in monthly_arrival.month_history(spark, table).collect()} == set(h)
    assert monthly_arrival.month_history(spark, table).where("district = 'A'").first().total_precipitation == 30.0


# ---- A5 / F-15 -------------------------------------------------------------------------------

def plan_of(df):
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_the_global_fit_moves_no_rows_to_one_task(spark):
    df = spark.createDataFrame([(2000 + n // 12, n % 12 + 1, float(n), None if n == 95 else 1.0) for n in range(100)],
                               "year int, month int, x double, z double").repartition(5)
    st = normalize.fit_stats(df, ["x", "z"], ["year", "month"])
    row = st.first()
    assert row.x_mean == 29.5 and row.x_std == pytest.approx(np.std(np.arange(60.0))) and row.z_mean == 1.0 and row.z_std == 1.0
    p = plan_of(st)
    # What goes to a single task is aggregated before: row counts of the ranges, and partial statistics.
    lines = p.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert single and all("HashAggregate" in lines[i + 1] for i in single)
    empty = normalize.fit_stats(df.where("x < 0"), ["x"], ["year", "month"]).first()
    assert empty.x_mean is None and empty.x_std is None


def test_float32_fit_is_within_its_bound(spark):
    rng = np.random.default_rng(9)
    values = rng.normal(1000, 300, 400)
    df = spark.createDataFrame([(n % 4, 2000 + n // 48, n // 4 % 12 + 1, float(v)) for n, v in enumerate(values)],
                               "district long, year int, month int, x double")
    exact, single = ({r.district: r for r in normalize.fit_stats(df, ["x"], ["year", "month"], entity="district", numeric=k).collect()}
                     for k in ("double", "float32"))
    for d, r in single.items():
        assert r.x_mean == float(np.float32(r.x_mean)) and r.x_std == float(np.float32(r.x_std))
        assert abs(r.x_mean - exact[d].x_mean) <= 2 ** -23 * np.abs(values).max()
        assert abs(r.x_std - exact[d].x_std) <= 2 ** -23 * exact[d].x_std + 2 ** -24 * np.abs(values).max()
    with pytest.raises(ValueError):
        normalize.fit_stats(df, ["x"], ["year"], numeric="half")


# ---- W1 / P17 --------------------------------------------------------------------------------

def months(spark, rows):
    return spark.createDataFrame([(d, m // 12, m % 12 + 1) for d, m in rows], "district string, year int, month int")


def test_runs_and_windows_by_entity(spark):
    rows = [("ready", m) for m in (100, 101, 110, 111, 112, 113)] + [("gap", m) for m in (100, 101, 102, 104, 105)]
    rows += [("short", 113), ("short", 112)] + [("repeated", m) for m in (109, 110, 111, 112, 112, 113)]
    rows += [("old", m) for m in (100, 100, 101, 110, 111, 112, 113)] + [(None, 100)]
    df = months(spark, rows)
    got = {}
    for r in windows.entity_runs(df, "district", 4).orderBy("district", "run").collect():
        got.setdefault(r.district, []).append((r.first, r.last, r.n_months, r.n_rows, r.gap, r.state))
    assert got == {"ready": [(110, 113, 4, 4, None, "ready"), (100, 101, 2, 2, 8, "ready")],
                   "gap": [(104, 105, 2, 2, None, "gap"), (100, 102, 3, 3, 1, "gap")], "short": [(112, 113, 2, 2, None, "short")],
                   "repeated": [(109, 113, 5, 6, None, "repeated")],
                   "old": [(110, 113, 4, 4, None, "ready"), (100, 101, 2, 3, 8, "ready")]}
    order = ["year", "month"]
    all_of = windows.latest_window(df.where("district IS NOT NULL"), order, 4, entity="district")
    assert {r.district for r in all_of.collect()} == {"ready", "gap", "repeated", "old"}
    strict = windows.latest_window(df.where("district IS NOT NULL"), order, 4, entity="district", require_contiguous=True)
    assert {r.district for r in strict.collect()} == {"ready", "old"} and {r.pos for r in strict.collect()} == {0, 1, 2, 3}
    loose = windows.latest_window(df, order, 4, entity="district", min_rows=False)
    assert {r.district for r in loose.collect()} >= {"short", "gap"}


# ---- S1 / S2 / T23 ---------------------------------------------------------------------------

def test_csv_folder_binds_each_file_by_its_own_header(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("district", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("x", T.DoubleType())])
    files = {"a.csv": "district,year,x\nA,2001,1.5\nB,2002,\nC,20", "b.csv": "x, year ,note,district\n2.5,2003,\"q,r\",D\noops,2004,n,E\n",
             "c.csv": "district,x\nF,1.0\n", "d.csv": "", "e.csv": "district,year,x\n", "f.csv": "district,year,year,x\nG,1,2,3\n"}
    os.makedirs(f"{tmp_dir}/in")
    for name, text in files.items():
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write(text)
    rows, bad = csv_folder.read_csv_folder(spark, f"{tmp_dir}/in", schema)
    assert sorted(tuple(r) for r in rows.collect()) == [("A", 2001, 1.5), ("B", 2002, None), ("D", 2003, 2.5)]
    got = {(r.file.split("/")[-1], r.line, r.reason) for r in bad.collect()}
    assert got == {("a.csv", "C,20", "line does not fit"), ("b.csv", "oops,2004,n,E", "line does not fit"),
                   ("c.csv", "F,1.0", "no column year"), ("f.csv", "G,1,2,3", "column year twice")}
    rows, bad = csv_folder.read_csv_folder(spark, f"{tmp_dir}/in", schema, optional=("year",))
    assert ("F", None, 1.0) in {tuple(r) for r in rows.collect()}


# ---- S7 / S9 / M5 ----------------------------------------------------------------------------

@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_killed_between_the_steps_leaves_the_old_output(spark, tmp_dir, monkeypatch, fmt):
    one = spark.createDataFrame([(1, "a", 0.1), (2, None, None), (3, "", 1e300)], "id long, t string, x double")
    publish.publish(spark, publish.stage(one, tmp_dir, "out", fmt), tmp_dir, "out", "2025_04")

    def read():
        back = publish.read_published(spark, tmp_dir, "out", "2025_04")
        return sorted((int(r.id), r.t, None if r.x is None else float(r.x)) for r in back.collect())

    want = sorted(tuple(r) for r in one.collect())
    assert read() == want
    two = one.where("id = 1")
    # Killed while writing: a task fails.
    with pytest.raises(Exception):
        publish.stage(two.withColumn("t", F.raise_error(F.lit("killed"))), tmp_dir, "out", fmt)
    assert read() == want
    # Killed after the write, before or in the verification.
    with monkeypatch.context() as m:
        m.setattr(publish, "_read", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            publish.stage(two, tmp_dir, "out", fmt)
    assert read() == want
    # Damaged between write and verification.
    with monkeypatch.context() as m:
        real = publish._read
        m.setattr(publish, "_read", lambda *a: real(*a).limit(0))
        with pytest.raises(RuntimeError, match="does not hold"):
            publish.stage(two, tmp_dir, "out", fmt)
    # Staged and verified, killed before the manifest row.
    staged = publish.stage(two, tmp_dir, "out", fmt)
    assert read() == want
    publish.publish(spark, staged, tmp_dir, "out", "2025_04")
    assert read() == [(1, "a", 0.1)]
    with pytest.raises(RuntimeError, match="no rows"):
        publish.stage(one.where("id > 9"), tmp_dir, "out", fmt)
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, tmp_dir, "out", "2025_05")


def test_the_panel_forecast_is_published_whole(spark, tmp_dir):
    rows = [(d, 2025, m, 1.0 * m, 2.0, 3.0, 4.0 * m, 5.0, 10.0 + m) for d in ("A", "B") for m in range(1, 7)]
    cols = "district string, year int, month int, avg_temp_max double, avg_temp_min double, avg_humidity double, "
    cols += "total_precipitation double, total_sunshine_hours double, mal_cases double"
    spark.createDataFrame(rows, cols).write.parquet(f"{tmp_dir}/hist")
    period = jobs.publish_panel_forecast(spark, f"{tmp_dir}/hist", models.panel_models(), tmp_dir)
    assert period == "July_2025_August_2025_September_2025"
    assert publish.read_published(spark, tmp_dir, "panel_forecast", period).count() == 2 * 2 * 3
