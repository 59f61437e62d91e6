"""Property checks (Hypothesis): append idempotence, normalise/denormalise round trip, one-hot."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.functions import one_hot
from panelcast.operators import history, normalize

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]), st.integers(1, 4)), max_size=8)


@SETTINGS
@given(h=keys, b=keys)
def test_append_new_keys_twice_equals_once(spark, h, b):
    sch = "district string, month int"
    hist = spark.createDataFrame(sorted(set(h), key=str), sch)
    batch = spark.createDataFrame(b, sch)
    once = history.append_new_keys(hist, batch, ["district", "month"])
    twice = history.append_new_keys(once, batch, ["district", "month"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


@SETTINGS
@given(vals=st.lists(st.floats(-1e4, 1e4, allow_nan=False), min_size=3, max_size=20))
def test_denormalize_inverts_normalize(spark, vals):
    df = spark.createDataFrame([("A", 2024, i + 1, v) for i, v in enumerate(vals)],
                               "district string, year int, month int, x double")
    stats = normalize.fit_stats(df, ["x"], ["year", "month"], "district")
    z = normalize.normalize(df, stats, ["x"], "district").withColumnRenamed("x", "y")
    back = normalize.denormalize(z.select("district", "month", "y"), stats, "y", "x", "district")
    got = sorted((r.month, r.y) for r in back.collect())
    for (m, y), v in zip(got, vals):
        assert y == pytest.approx(v, rel=1e-9, abs=1e-6)


@SETTINGS
@given(n=st.integers(1, 40), idx=st.data())
def test_one_hot_rows_sum_to_one(spark, n, idx):
    i = idx.draw(st.integers(0, n - 1))
    r = spark.range(1).select(one_hot(F.lit(i), n).alias("h")).first().h
    assert len(r) == n and sum(r) == 1.0 and r[i] == 1.0


@SETTINGS
@given(seed=st.integers(0, 10_000), parts=st.integers(1, 9))
def test_row_order_does_not_change_rollup_or_stats(spark, seed, parts):
    import random
    import datetime as dt
    from panelcast.operators import rollup
    rng = random.Random(7)
    rows = [(f"E{rng.randint(0, 4)}", dt.date(2024, rng.randint(1, 12), rng.randint(1, 28)),
             *[round(rng.uniform(0, 100), 2) for _ in range(5)]) for _ in range(120)]
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    sch = ("district string, date date, temp_max double, temp_min double, precipitation double, "
           "humidity double, sunshine double")
    a = rollup.monthly_rollup(spark.createDataFrame(rows, sch), exact_scale=2)
    b = rollup.monthly_rollup(spark.createDataFrame(shuffled, sch).repartition(parts), exact_scale=2)
    assert sorted(a.collect()) == sorted(b.collect())
    sa = normalize.fit_stats(a, ["avg_temp_max"], ["year", "month"], "district")
    sb = normalize.fit_stats(b, ["avg_temp_max"], ["year", "month"], "district")
    key = lambda r: r.district
    for x, y in zip(sorted(sa.collect(), key=key), sorted(sb.collect(), key=key)):
        assert x.district == y.district
        assert x.avg_temp_max_mean == pytest.approx(y.avg_temp_max_mean, rel=1e-12)
        assert x.avg_temp_max_std == pytest.approx(y.avg_temp_max_std, rel=1e-9)
