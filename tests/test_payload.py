"""Payload flattening and coverage (S3, F-13, F-16, J5, T22): the payload_gaps fixture."""

import json

from panelcast import schemas
from panelcast.sources import payload

TIME = ["2025-04-01", "2025-04-02", "2025-04-03"]


def full(d):
    return {"district": d, "daily": {"time": TIME, "temperature_2m_max": [30.0, 31.0, 32.0],
                                     "temperature_2m_min": [20.0, 21.0, 22.0],
                                     "precipitation_sum": [0.0, 1.5, 2.5],
                                     "relative_humidity_2m_mean": [70.0, 71.0, 72.0],
                                     "sunshine_duration": [3600.0, 7200.0, 0.0]}}


def write_landing(tmp_dir):
    no_member = full("NoHumidity")
    del no_member["daily"]["relative_humidity_2m_mean"]
    short = full("Short")
    short["daily"]["temperature_2m_max"] = [30.0]
    rows = [full("Full"), no_member, short, {"district": "NoDaily"}]
    path = f"{tmp_dir}/landing"
    import os
    os.makedirs(path)
    with open(f"{path}/2025_04.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    return path


def test_flatten_missing_and_short_arrays_give_nulls(spark, tmp_dir):
    pl = payload.read_payloads(spark, write_landing(tmp_dir))
    out = payload.payload_flatten(pl, period="2025_04")
    rows = {(r.district, r.pos): r for r in out.collect()}
    assert len(rows) == 9                                        # NoDaily yields no rows
    assert rows[("Full", 1)].precipitation == 1.5 and str(rows[("Full", 1)].date) == "2025-04-02"
    assert all(rows[("NoHumidity", i)].humidity is None for i in range(3))
    assert rows[("NoHumidity", 2)].temp_max == 32.0
    assert rows[("Short", 0)].temp_max == 30.0 and rows[("Short", 2)].temp_max is None
    assert {r.month for r in out.collect()} == {"2025_04"}
    assert out.schema["date"].dataType.simpleString() == "date"


def test_coverage_reports_absent_and_memberless(spark, tmp_dir):
    pl = payload.read_payloads(spark, write_landing(tmp_dir))
    dim = spark.createDataFrame([(d,) for d in ["Full", "NoHumidity", "Short", "NoDaily", "Absent"]],
                                "district string")
    missing = {r.district for r in payload.coverage_missing(dim, pl).collect()}
    assert missing == {"NoDaily", "Absent"}


def test_parse_payload_text(spark):
    text = spark.createDataFrame([("A", json.dumps({"daily": full("A")["daily"]}))], "district string, body string")
    sch = schemas.PAYLOAD_SCHEMA["daily"].dataType
    from pyspark.sql import types as T
    parsed = payload.parse_payloads(text, "body", T.StructType([T.StructField("daily", sch)]))
    assert payload.payload_flatten(parsed).count() == 3
