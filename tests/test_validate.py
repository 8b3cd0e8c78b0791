from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from ridelake.operators import report
from ridelake.operators.report import (
    failure_messages,
    first_errors,
    kept_report,
    quality_report,
    report_state,
    write_report_state,
)
from ridelake.operators.validate import split_quarantine, validate
from ridelake.sources.schemas import RAW
from ridelake.sources.scratch import written
from test_bronze_silver import NAN, ride


def codes(df, entity):
    return [r["error_codes"] for r in validate(df, entity).collect()]


def test_passenger(rows):
    df = rows(
        RAW["passenger"],
        ("P000001", "John", "Doe", "john@example.com", "+12025551234", None, None, None, "active"),
        ("P000001", None, "", "invalid-email", None, None, None, None, "unknown"),
    )
    good, bad = validate(df, "passenger").collect()
    assert good["valid_record"] and good["errors"] == []
    assert not bad["valid_record"]
    assert bad["errors"] == [
        "first_name is required",
        "last_name is required",
        "email is invalid or missing",
        "phone is invalid or missing",
        "status 'unknown' is invalid",
    ]


def test_driver(rows):
    ratings = [4.5, 0.0, 5.0, 6.5, -0.1, NAN, None]
    df = rows(RAW["driver"], *[("D", "J", "D", None, r, None, None, "banned") for r in ratings])
    assert codes(df, "driver") == [[], [], [], *[["rating_range"]] * 4]
    text = rows("driver_id string, first_name string, last_name string, rating string, status string",
                ("D", "J", "D", "good", None))
    assert validate(text, "driver").first()["errors"] == [
        "rating 'good' must be between 0 and 5",
        "status 'None' is invalid",
    ]


def test_vehicle(rows):
    df = rows(RAW["vehicle"], ("V", None, "", "", 1, "", ""), ("V", "D", "", "", None, "", "x"))
    assert codes(df, "vehicle") == [["driver_id_required", "license_plate_required"], []]


def test_payment(rows):
    df = rows(
        RAW["payment"],
        ("M", "R", None, "any", 0.0, None, "pending"),
        ("M", "", None, None, -1.5, None, "paid"),
    )
    assert [r["errors"] for r in validate(df, "payment").collect()] == [
        [],
        ["ride_id is required", "amount '-1.5' must be >= 0", "payment_status 'paid' is invalid"],
    ]


def test_ride(spark, rows):
    df = spark.createDataFrame(
        [
            ride(ride_status="completed"),
            ride(ride_status="cancelled", distance_km=-1.0, fare_amount=None, duration_minutes=-1),
        ],
        RAW["ride"],
    )
    assert codes(df, "ride") == [
        [],
        ["distance_range", "fare_range", "duration_range", "ride_status_allowed"],
    ]
    sparse = rows("ride_id string, distance_km double, fare_amount double", ("R1", -1.0, 15.5))
    assert codes(sparse, "ride")[0] == [
        "passenger_id_required",
        "driver_id_required",
        "vehicle_id_required",
        "timestamp_format",
        "distance_range",
        "duration_range",
        "ride_status_allowed",
    ]


def python_verdict(*texts):
    """The rule in plain Python: parse all three, then compare in a chain."""
    import datetime as dt

    try:
        a, b, c = (dt.datetime.fromisoformat(t) for t in texts)
        return [] if a <= b <= c else ["timestamp_order"]
    except (ValueError, TypeError):
        return ["timestamp_format"]


def test_ride_times_match_python(spark):
    texts = [
        "2026-05-01T10:00:00",
        "2026-05-01T09:00:00",
        "2026-05-01T10:00:00+02:00",
        "2026-05-01T09:00:00Z",
        "2026-05-01",
        "soon",
        None,
    ]
    triples = list(product(texts, repeat=3))
    names = ("request_timestamp", "pickup_timestamp", "dropoff_timestamp")
    df = spark.createDataFrame(
        [ride(ride_id=str(i), ride_status="no_show", **dict(zip(names, t))) for i, t in enumerate(triples)],
        RAW["ride"],
    )
    got = {r["ride_id"]: r["error_codes"] for r in validate(df, "ride").collect()}
    assert [got[str(i)] for i in range(len(triples))] == [python_verdict(*t) for t in triples]


def test_quarantine_is_complete(spark):
    df = spark.createDataFrame(
        [ride(ride_id=str(i), ride_status="completed" if i % 3 else "x") for i in range(30)], RAW["ride"]
    )
    good, bad = split_quarantine(df, "ride")
    assert good.columns == df.columns
    assert good.count() == 20 and bad.count() == 10
    assert {tuple(r["error_codes"]) for r in bad.collect()} == {("ride_status_allowed",)}


def test_report(rows):
    df = rows(
        RAW["vehicle"],
        ("V2", "D", "", "", 1, "", "x"),
        ("V1", None, "", "", 1, "", ""),
        ("V4", "D", "", "", 1, "", "x"),
        ("V3", "D", "", "", 1, "", ""),
    )
    row = quality_report(df, "vehicle", dataset="fleet").first().asDict()
    assert row == {
        "dataset": "fleet",
        "records": 4,
        "valid_records": 2,
        "invalid_records": 2,
        "validity_rate": 50.0,
        "checks": {"driver_id_required": 1, "license_plate_required": 2},
        "errors_truncated": False,
        "errors": [
            "Record V1: driver_id is required",
            "Record V1: license_plate is required",
            "Record V3: license_plate is required",
        ],
    }
    assert {tuple(r) for r in failure_messages(df, "vehicle").collect()} == {
        ("driver_id_required", "driver_id is required", 1),
        ("license_plate_required", "license_plate is required", 2),
    }


def test_report_of_nothing(rows):
    row = quality_report(rows(RAW["vehicle"]), "vehicle").first()
    assert (row["records"], row["validity_rate"], row["checks"], row["errors"]) == (0, 0.0, {}, [])


@pytest.mark.parametrize("n, truncated", [(100, False), (101, True)])
def test_report_quotes_a_hundred(spark, n, truncated):
    df = spark.range(n).selectExpr("CAST(id AS STRING) vehicle_id", "'D' driver_id", "'' license_plate")
    row = quality_report(df, "vehicle").first()
    assert len(row["errors"]) == 100 and row["errors_truncated"] is truncated
    assert row["checks"] == {"license_plate_required": n}


def test_first_errors_of_a_hot_key(spark):
    """Many records share a key: the cut is the same however they are spread."""
    df = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS vehicle_id",
        "IF(id % 2 = 0, NULL, 'D') AS driver_id",
        "IF(id % 5 = 0, '', 'x') AS license_plate",
    )
    one = first_errors(df.repartition(1), "vehicle", "vehicle_id").select("record", "error").collect()
    many = first_errors(df.repartition(16), "vehicle", "vehicle_id").select("record", "error").collect()
    assert one == many and len(one) == 100


def test_merged_states_are_the_state_of_all(spark, tmp_path):
    rows = [dict(ride_id=f"R{k % 90:02}", fare_amount=-1.0 if k % 3 else 2.0, currency=None if k % 5 else "USD") for k in range(120)]
    df = spark.createDataFrame([ride(**r) for r in rows], RAW["ride"])
    whole = quality_report(df, "ride", shown=25).first()
    assert whole["errors_truncated"] and len(whole["errors"]) == 25
    for parts in (1, 2, 5):
        days = [df.filter(F.pmod(F.crc32("ride_id"), F.lit(parts)) == k) for k in range(parts)]
        days.append(df.limit(0))
        path = str(tmp_path / f"states{parts}")
        for k, day in enumerate(days):
            for _ in range(2 if k == 0 else 1):  # a day that comes again replaces itself
                write_report_state(report_state(day, "ride", shown=25), path, f"2026-05-0{k + 1}")
        assert kept_report(spark, path).first() == whole
    none = quality_report(df.limit(0), "ride").first()
    assert (none["records"], none["validity_rate"], none["checks"], none["errors"]) == (0, 0.0, {}, [])


def test_a_report_writes_failing_rows_only(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(report, "written", lambda df: seen.append(df) or written(df))
    rows = [ride(ride_id=f"R{k}", ride_status="completed", fare_amount=-1.0 if k == 7 else 1.0) for k in range(50)]
    df = spark.createDataFrame(rows, RAW["ride"])
    bad = validate(df, "ride").filter("NOT valid_record").count()
    assert report.quality_report(df, "ride").first()["invalid_records"] == bad
    assert seen[0].count() == bad
