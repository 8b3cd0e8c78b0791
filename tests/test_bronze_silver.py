from __future__ import annotations

import datetime as dt

from ridelake.operators.bronze import bronze_driver, bronze_passenger, bronze_ride, bronze_vehicle
from ridelake.operators.dedup import dedup
from ridelake.operators.normalise import (
    normalise_driver,
    normalise_passenger,
    normalise_payment,
    normalise_ride,
    normalise_vehicle,
)
from ridelake.operators.refine import (
    WIDE_RIDE_STATUSES,
    refine_driver,
    refine_passenger,
    refine_payment,
    refine_ride,
    refine_vehicle,
)
from ridelake.sources.schemas import RAW, raw_text

NAN = float("nan")


def ride(**over):
    out = dict(
        ride_id="R1",
        passenger_id="P1",
        driver_id="D1",
        vehicle_id="V1",
        request_timestamp="2026-05-01T10:00:00",
        pickup_timestamp="2026-05-01T10:05:00",
        dropoff_timestamp="2026-05-01T10:30:00",
        pickup_latitude=1.0,
        pickup_longitude=2.0,
        dropoff_latitude=3.0,
        dropoff_longitude=4.0,
        pickup_city=" Dallas ",
        dropoff_city=None,
        distance_km=5.5,
        duration_minutes=25,
        fare_amount=15.5,
        currency="usd",
        ride_status="Completed",
    )
    return {**out, **over}


def test_bronze_numbers(rows):
    df = rows(raw_text("driver"), *[("D", "a", "b", "t", r, "c", "u", "s") for r in ("4.5", None, "x")])
    assert [r["rating"] for r in bronze_driver(df).collect()] == [4.5, 0.0, None]
    v = rows(raw_text("vehicle"), *[("V", "D", "m", "m", y, "t", "p") for y in ("2020", None, "3.5")])
    assert [r["year"] for r in bronze_vehicle(v).collect()] == [2020, 0, None]


def test_bronze_fills_absent_columns(rows):
    out = bronze_ride(rows("ride_id string", ("R1",)))
    row = out.first()
    assert len(out.columns) == 18
    assert row["fare_amount"] == 0.0 and row["duration_minutes"] == 0 and row["currency"] is None
    assert len(bronze_passenger(rows("city string", ("x",))).columns) == 9


def test_normalise_passenger(rows):
    df = rows(
        RAW["passenger"],
        (None, " Al\t", None, " A@B.Com ", " 1 ", "2026-05-01T23:59:59", " NY", "US ", " ACTIVE"),
        ("P2", "x", "y", None, None, "bad", None, None, None),
    )
    a, b = normalise_passenger(df).collect()
    assert tuple(a) == ("", "Al", "", "a@b.com", "1", dt.date(2026, 5, 1), "NY", "US", "active")
    assert tuple(b) == ("P2", "x", "y", "", "", None, "", "", "")


def test_normalise_driver_rating(rows):
    given = [-1.0, 6.5, 4.25, NAN, None]
    df = rows(RAW["driver"], *[("D", "a", "b", None, r, "c", "u", "s") for r in given])
    assert [r["rating"] for r in normalise_driver(df).collect()] == [0.0, 5.0, 4.25, 0.0, None]


def test_normalise_vehicle(rows):
    df = rows(
        raw_text("vehicle"),
        *[("V", None, "m", "m", y, " XL ", " abc1 ") for y in ("1800", "2060", None, "new")],
    )
    out = normalise_vehicle(df).collect()
    assert [r["year"] for r in out] == [1900, 2050, 2000, None]
    assert (out[0]["driver_id"], out[0]["vehicle_type"], out[0]["license_plate"]) == ("", "xl", "ABC1")


def test_normalise_ride(spark):
    df = spark.createDataFrame(
        [
            ride(),
            ride(
                request_timestamp=None,
                distance_km=-1.0,
                fare_amount=NAN,
                duration_minutes=-3,
                currency="",
                ride_status=" No_Show ",
            ),
            ride(fare_amount=None, currency=None, ride_status=None),
        ],
        RAW["ride"],
    )
    a, b, c = normalise_ride(df).collect()
    assert a["request_date"] == dt.date(2026, 5, 1)
    assert a["request_time"] == "2026-05-01T10:00:00"
    assert tuple(a["pickup_location"]) == (1.0, 2.0, "Dallas")
    assert tuple(a["dropoff_location"]) == (3.0, 4.0, "")
    assert (a["currency"], a["ride_status"]) == ("USD", "completed")
    assert (b["request_date"], b["request_time"]) == (None, "")
    assert (b["distance_km"], b["fare_amount"], b["duration_minutes"]) == (0.0, 0.0, 0)
    assert (b["currency"], b["ride_status"]) == ("USD", " no_show ")  # not stripped
    assert (c["fare_amount"], c["currency"], c["ride_status"]) == (None, "USD", "")


def test_normalise_ride_checks(spark):
    df = spark.createDataFrame([ride(ride_status="completed"), ride(fare_amount=-1.0)], RAW["ride"])
    a, b = normalise_ride(df, checks=True).collect()
    assert a["valid_record"] and all(a["data_quality_checks"].values())
    assert not b["valid_record"]
    failed = {k for k, ok in b["data_quality_checks"].items() if not ok}
    assert failed == {"fare_range", "ride_status_allowed"}


def test_normalise_payment(rows):
    df = rows(
        RAW["payment"],
        ("M1", None, "2026-05-01", " Cash", -2.0, "eur ", " FAILED "),
        ("M2", "R1", "", "x", 3.0, None, None),
    )
    a, b = normalise_payment(df).collect()
    assert tuple(a) == ("M1", "", dt.date(2026, 5, 1), "2026-05-01", "cash", 0.0, "EUR ", "failed")
    assert tuple(b) == ("M2", "R1", None, "", "x", 3.0, "USD", "")


def test_refine_filters(rows, spark):
    drivers = rows(
        RAW["driver"],
        ("D1", "a", "b", "2026-05-01", 4.567, "c", "u", "active"),
        ("D2", "a", "b", "bad", 4.0, "c", "u", "inactive"),
        ("D3", "a", "b", None, 4.0, "c", "u", "banned"),
    )
    got = {r["driver_id"]: (r["signup_timestamp"], r["rating"]) for r in refine_driver(drivers).collect()}
    assert got == {"D1": (dt.datetime(2026, 5, 1), 4.57), "D2": (None, 4.0)}
    people = rows(RAW["passenger"], *[("P", "", "", e, "", "", "", "", "") for e in (None, "x")])
    assert refine_passenger(people).count() == 1
    cars = rows(RAW["vehicle"], *[(f"V{d}", d, "", "", 1, "", "") for d in (None, "D1")])
    assert [r["driver_id"] for r in refine_vehicle(cars).collect()] == ["D1"]
    paid = rows(
        RAW["payment"],
        *[(f"M{i}", "", "", "", a, "", s) for i, (a, s) in enumerate(
            [(1.0, "completed"), (0.0, "completed"), (NAN, "completed"), (None, "completed"), (1.0, "failed")]
        )],
    )
    assert [r["payment_id"] for r in refine_payment(paid).collect()] == ["M0"]
    rides = spark.createDataFrame(
        [
            ride(ride_id="a", ride_status="completed"),
            ride(ride_id="b", ride_status="cancelled"),
            ride(ride_id="c", ride_status="completed", distance_km=0.0),
            ride(ride_id="d", ride_status="completed", fare_amount=-1.0),
        ],
        RAW["ride"],
    )
    assert [r["ride_id"] for r in refine_ride(rides).collect()] == ["a"]
    wide = refine_ride(rides, WIDE_RIDE_STATUSES).collect()
    assert sorted(r["ride_id"] for r in wide) == ["a", "b"]


def test_dedup_is_deterministic(spark, rows):
    data = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, None), (None, 5, "x"), (None, 4, "y"), ("j", 9, "q")]
    want = {("k", 1, None), (None, 4, "y"), ("j", 9, "q")}
    for order in (data, data[::-1]):
        for parts in (1, 5):
            df = rows("id string, n int, t string", *order).repartition(parts)
            assert {tuple(r) for r in dedup(df, ["id"]).collect()} == want
    by_t = dedup(rows("id string, n int, t string", *data), ["id"], order=["t"])
    assert ("k", 1, None) in {tuple(r) for r in by_t.collect()}
    assert dedup(rows("id string", ("a",), ("a",)), ["id"]).count() == 1


def test_dedup_of_a_hot_key(spark):
    """A third of all rows share one key; nothing is lost and one row is kept."""
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    out = dedup(df, ["k"])
    assert out.count() == 20_001 and out.filter("k = 0").first()["v"] == 0
