from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.functions import exact_total, rounded_mean
from ridelake.functions.numbers import PARTS, merged_sums, partial_sums, rounded_mean_of, total_of
from ridelake.operators import gold, increments
from ridelake.operators.integrity import fk_violations, null_profile, orphan_rows, range_profile
from ridelake.operators.dedup import duplicate_keys
from ridelake.sources.schemas import RAW
from test_bronze_silver import NAN, ride

DAY = dt.date(2026, 5, 1)


def rides(spark, *over):
    return spark.createDataFrame([ride(**{"ride_status": "completed", **o}) for o in over], RAW["ride"])


def test_daily_metrics_by_hand(spark):
    df = rides(
        spark,
        dict(fare_amount=10.0, distance_km=1.0, duration_minutes=10),
        dict(fare_amount=10.01, distance_km=2.5, duration_minutes=11),
        dict(ride_status="no_show", fare_amount=99.0),
        dict(ride_status=None),
        dict(ride_status="Completed"),  # case matters
        dict(pickup_city=None, ride_status="cancelled_by_driver"),
        dict(pickup_city="", fare_amount=5.0),
        dict(pickup_city="  "),  # blank is not missing
        dict(request_timestamp="soon"),
        dict(request_timestamp=None),
    )
    got = {r["city"]: tuple(r)[2:] for r in gold.ride_daily_metrics(df).collect()}
    assert got == {
        "Dallas": (5, 2, 3, 3.5, 20.01, 10.01, 1.75, 10.5),
        "Unknown": (2, 1, 1, 5.5, 5.0, 5.0, 5.5, 25.0),
        "": (1, 1, 0, 5.5, 15.5, 15.5, 5.5, 25.0),
    }


def test_daily_metrics_unreadable_measures(spark):
    df = rides(
        spark,
        dict(fare_amount=None),  # adds to no measure
        dict(distance_km=None, fare_amount=4.0),  # fare only
        dict(duration_minutes=None, fare_amount=6.0, distance_km=2.0),
        dict(fare_amount=NAN, distance_km=4.0, duration_minutes=9),
    )
    row = gold.ride_daily_metrics(df).first()
    assert (row["total_rides"], row["completed_rides"]) == (4, 4)
    assert (row["total_revenue"], row["avg_fare"]) == (10.0, 3.33)
    assert (row["total_distance_km"], row["avg_distance_km"]) == (6.0, 3.0)
    assert row["avg_duration_minutes"] == 9.0


def test_daily_metrics_without_completed(spark):
    row = gold.ride_daily_metrics(rides(spark, dict(ride_status="no_show"))).first()
    assert tuple(row)[2:] == (1, 0, 1, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_negative_fares_round_away_from_zero(spark):
    row = gold.ride_daily_metrics(rides(spark, *[dict(fare_amount=f) for f in (-0.01, -0.02)])).first()
    assert (row["total_revenue"], row["avg_fare"]) == (-0.03, -0.02)


def test_daily_totals_add_up(spark):
    df = spark.range(10_000).selectExpr(
        "CONCAT('R', id) AS ride_id",
        "IF(id % 17 = 0, 'bad', CONCAT('2026-05-0', id % 9 + 1, 'T00:00:00')) AS request_timestamp",
        "IF(id % 3 = 0, 'Hot', CONCAT('C', id % 50)) AS pickup_city",
        "IF(id % 2 = 0, 'completed', 'no_show') AS ride_status",
        "id / 100 AS fare_amount",
        "id % 30 / 4 AS distance_km",
        "CAST(id % 60 AS INT) AS duration_minutes",
    )
    out = gold.ride_daily_metrics(df).collect()
    assert all(r["total_rides"] == r["completed_rides"] + r["cancelled_rides"] for r in out)
    assert sum(r["total_rides"] for r in out) == df.filter("request_timestamp <> 'bad'").count()
    again = gold.ride_daily_metrics(df.repartition(13, "ride_id")).collect()
    assert sorted(out) == sorted(again)


def test_driver_daily_metrics(spark, rows):
    df = rides(
        spark,
        dict(fare_amount=10.0, distance_km=1.0),
        dict(fare_amount=None, distance_km=2.0),
        dict(fare_amount=7.0, distance_km=None),  # counts, adds to no total
        dict(driver_id="D2", fare_amount=3.0),
        dict(driver_id="D3", ride_status="no_show"),
        dict(driver_id=None, fare_amount=1.0, distance_km=1.0),
        dict(request_timestamp="bad"),
    )
    drivers = rows(
        RAW["driver"],
        ("D1", "", "", "2026-01-01", 4.9, "", "", ""),
        ("D1", "", "", "2026-02-01", 4.1, "", "", ""),
    )
    got = {r["driver_id"]: tuple(r) for r in
           gold.driver_daily_metrics(df, drivers, order=["signup_timestamp"]).collect()}
    assert got == {
        "D1": (DAY, "D1", 3, 3.0, 10.0, 4.1),
        "D2": (DAY, "D2", 1, 5.5, 3.0, 0.0),
        None: (DAY, None, 1, 1.0, 1.0, 0.0),
    }


def test_job_and_notebook_aggregates(spark, rows):
    df = rides(
        spark,
        dict(fare_amount=10.0),
        dict(ride_id="R2", fare_amount=5.5, ride_status="no_show"),
        dict(ride_id=None, fare_amount=None, passenger_id="P2"),
    )
    assert tuple(gold.daily_rides(df).first()) == (DAY, 2, 7.75)
    assert tuple(gold.daily_city_rides(df).first()) == (DAY, " Dallas ", 2, 2, 7.75, 16.5)
    drivers = rows("driver_id string, rating double", ("D1", 4.5))
    assert tuple(gold.driver_performance(df).first()) == ("D1", 1, 10.0, 10.0)
    assert tuple(gold.driver_performance(df, drivers).first()) == ("D1", 1, 10.0, 10.0, 4.5)
    people = rows("passenger_id string, city string, status string", ("P1", "NY", "active"))
    got = {tuple(r) for r in gold.passenger_activity(df, people).collect()}
    assert got == {("P1", 2, 15.5, 7.75, "NY", "active"), ("P2", 0, None, None, None, None)}


def test_city_counts(rows):
    daily = rows("city string, total_rides long", ("a", 3), ("a", 4), ("b", 1))
    assert {tuple(r) for r in gold.rides_by_city(daily).collect()} == {("a", 7), ("b", 1)}
    assert {tuple(r) for r in gold.rows_by_city(daily).collect()} == {("a", 2), ("b", 1)}


def test_entity_row_counts_skip_empty(spark):
    out = gold.entity_row_counts({"b": spark.range(3), "a": spark.range(2), "c": spark.range(0)})
    assert [tuple(r) for r in out.collect()] == [("a", 2), ("b", 3)]


def test_fk_violations(rows):
    child = rows("id int, p string", (1, "a"), (2, "x"), (3, "x"), (4, None), (5, "b"))
    parent = rows("p string", ("a",), ("a",), ("b",), (None,))
    assert {tuple(r) for r in fk_violations(child, "p", parent).collect()} == {("x", 2), (None, 1)}
    assert sorted(r["id"] for r in orphan_rows(child, "p", parent).collect()) == [2, 3, 4]


def test_profiles(rows):
    df = rows("a int, b double", (1, 5.0), (None, NAN), (9, None), (None, -1.0))
    assert {tuple(r) for r in null_profile(df).collect()} == {("a", 2, 4), ("b", 1, 4)}
    got = {tuple(r) for r in range_profile(df, {"a": (2, 9), "b": (0, 10)}).collect()}
    assert got == {("a", 1, 0, 2), ("b", 1, 1, 1)}
    assert {tuple(r) for r in duplicate_keys(df, ["a"]).collect()} == {(None, 2)}


@pytest.mark.parametrize("partitions", [1, 8])
def test_same_result_for_any_number_of_partitions(spark, partitions):
    df = spark.range(5000).selectExpr(
        "id AS ride_id", "IF(id % 3 = 0, 'P0', CONCAT('P', id)) AS passenger_id",
        "id * 0.01D AS fare_amount",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        hot = gold.passenger_activity(df).filter("passenger_id = 'P0'").first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (hot["total_rides"], hot["total_spent"]) == (1667, 41658.33)


def months_of(*numbers):
    return [
        dict(
            ride_id=f"R{n}",
            request_timestamp=f"2026-0{1 + n % 4}-0{1 + n % 3}T10:00:00",
            fare_amount=[1.25, 1e7 + 0.125, 0.1, None, 1e27][n % 5],
            distance_km=n / 7,
            pickup_city=["LA", "NY"][n % 2],
        )
        for n in numbers
    ]


def test_landing_days_add_up(spark, tmp_path):
    folder, running = str(tmp_path), increments.RIDE_DAYS
    days = {"2026-05-01": range(40), "2026-05-02": range(40, 60, 4), "2026-05-03": []}

    def whole():
        every = rides(spark, *months_of(*(n for own in days.values() for n in own)))
        return sorted(map(tuple, gold.ride_daily_metrics(every).collect()))

    def landed():
        made = gold.with_cancelled(increments.landed_result(spark, running, folder))
        return sorted(map(tuple, made.collect()))

    for day, numbers in days.items():
        if numbers:
            increments.land(rides(spark, *months_of(*numbers)), running, folder, day)
    assert landed() == whole()
    # Every fourth ride is of one month; the others stay as they were.
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "result").rglob("*.parquet")}
    days["2026-05-03"] = range(61, 90, 4)
    changed = increments.land(rides(spark, *months_of(*days["2026-05-03"])), running, folder, "2026-05-03")
    assert changed == {(2026, 2)} and landed() == whole()
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "result").rglob("*.parquet")}
    assert {p for p in files if "date_month=2" not in str(p)} <= {p for p in kept if kept[p] == files.get(p)}
    # A day that comes again, with other rides: nothing counts twice, an empty month goes.
    days = {"2026-05-01": range(0, 40, 4), "2026-05-02": range(40, 60, 4), "2026-05-03": range(61, 90, 4)}
    increments.land(rides(spark, *months_of(*days["2026-05-01"])), running, folder, "2026-05-01")
    assert landed() == whole()
    plan = increments.changed_states(
        spark, spark.read.parquet(f"{folder}/states").schema, f"{folder}/states", {(2026, 2)}
    )._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_merged_sums_are_the_sums_of_all(spark):
    values = [1.25, 0.1, 1e7 + 0.125, 9e25, 9e25, -0.3, None, 2.0**-30, 123456.78, float("nan")]
    df = spark.createDataFrame([(k % 3, v) for k, v in enumerate(values * 3)], "part int, x double")
    x = F.col("x")
    for rows in (df, df.filter("x < 1e20"), df.filter("x IS NULL")):
        whole = rows.agg(exact_total(x).alias("t"), rounded_mean(x, 2).alias("m")).first()
        parts = rows.groupBy("part").agg(*(c.alias(k) for k, c in partial_sums(x).items()))
        once = parts.agg(*(c.alias(k) for k, c in merged_sums({k: F.col(k) for k in PARTS}).items()))
        twice = once.agg(*(c.alias(k) for k, c in merged_sums({k: F.col(k) for k in PARTS}).items()))
        own = {k: F.col(k) for k in PARTS}
        got = twice.select(total_of(own).alias("t"), rounded_mean_of(own, 2).alias("m")).first()
        # Beyond the decimals the sum is that of doubles, in any order.
        assert got == whole or rows is df and tuple(got) == pytest.approx(tuple(whole))
