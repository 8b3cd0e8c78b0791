"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ridelake.functions import between_dates

from ridelake.operators import gold, report
from ridelake.operators.dedup import dedup
from ridelake.operators.integrity import RELATIONS, all_fk_violations, fk_violations
from ridelake.operators.refine import refine_payment, refine_ride
from ridelake.operators.validate import validate
from ridelake.plans.queries import DECLARED, QUERIES
from ridelake.session import HUGE_METHOD, SPARKS_LIMIT
from ridelake.sources.scratch import written
from ridelake.sources.star_schema import JOINED, VIEWS, load, sources_of
from ridelake.sources.tables import read_table, write_table

SF = "/root/testdata/sf0.001"

# Written to disk on the way: their plans only show the last step.
WRITES = {
    "bronze_from_landing", "silver_ride_table", "quarantine_from_files", "silver_listing",
    "payments_as_lines", "landed_lines", "report_file", "routed_lines",
} | {
    f"layer_{what}_{s}" for s in ("jobs", "notebooks", "records") for what in ("counts", "contents")
} | {f"declared_{t}" for t in DECLARED}
# One row for the whole input, or a union of such rows.
GLOBAL = {"ride_count", "distinct_passengers", "quarantine_counts"}


@pytest.fixture(autouse=True)
def whole_plans(spark):
    """Plan text without abbreviations."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_no_cross_join(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("EvalPython", "MapInPandas", "InPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert banned not in text, banned
    single = "SinglePartition" in text
    if name.startswith(("quality_report_", "null_profile_", "range_profile_")) or name in GLOBAL:
        return
    # The vehicle view counts the drivers in a one-row subquery.
    if "vehicle" in name or name == "fk_all":
        assert text.count("SinglePartition") <= text.count("Subquery")
    else:
        assert not single


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", plan(df)))


def test_line_items_are_not_shuffled_by_customer(spark, no_broadcast):
    """Orders find their customers first, then the line items find the orders."""
    lines = plan(load(spark, SF, "ride")).splitlines()
    behind = [b for a, b in zip(lines, lines[1:]) if "hashpartitioning(o_custkey" in a]
    assert behind and not any("l_orderkey" in b for b in behind)
    assert JOINED["ride"] != VIEWS["ride"]


def test_both_forms_of_the_ride_view_hold_the_same_rows(spark):
    made = load(spark, SF, "ride")
    text = spark.sql(VIEWS["ride"], **{s: load(spark, SF, s) for s in sources_of("ride")})
    assert made.columns == text.columns
    assert made.exceptAll(text).isEmpty() and text.exceptAll(made).isEmpty()


def test_large_methods_are_not_generated(spark):
    """Also in a session that `tuned` has not made; a limit of its own stays."""
    before = spark.conf.get(HUGE_METHOD)
    try:
        for given, held in ((SPARKS_LIMIT, "8000"), ("20000", "20000")):
            spark.conf.set(HUGE_METHOD, given)
            load(spark, SF, "raw_ride")
            assert spark.conf.get(HUGE_METHOD) == held
    finally:
        spark.conf.set(HUGE_METHOD, before)


@pytest.fixture
def big(spark):
    """Rides as a plain scan: no joins of the view in the way."""
    return spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "l_orderkey AS ride_id", "l_partkey AS passenger_id", "l_suppkey AS driver_id",
        "l_shipdate AS request_timestamp", "l_returnflag AS pickup_city",
        "l_linestatus AS ride_status", "l_extendedprice AS fare_amount",
        "l_quantity AS distance_km", "CAST(l_quantity AS INT) AS duration_minutes",
    )


def test_gold_shuffles_once(spark, big, no_broadcast):
    for operator in (
        gold.ride_daily_metrics,
        gold.city_metrics,
        gold.daily_rides,
        gold.daily_city_rides,
        gold.driver_performance,
        gold.passenger_activity,
    ):
        text = plan(operator(big))
        assert exchanges(operator(big)) == 1
        assert "partial_" in text and "HashAggregate" in text and "SortAggregate" not in text


def test_daily_driver_metrics_sum_by_hash(spark, big, no_broadcast):
    """The rides are summed in one hash aggregation; only the rating lookup sorts."""
    text = plan(gold.driver_daily_metrics(big, spark.range(5).selectExpr("id AS driver_id", "1.0D AS rating")))
    sums = [line for line in text.splitlines() if "try_sum" in line]
    assert sums and all("HashAggregate" in line for line in sums)


def test_report_reads_its_input_once(spark):
    report = QUERIES["quality_report_payment"](spark, SF)
    assert "events" not in plan(report) and "ridelake-" in plan(report)


def test_months_reach_the_partition_filters(spark):
    days = spark.range(800).selectExpr("date_add(DATE'2024-11-20', CAST(id AS INT)) AS date", "id")
    write_table(days, "by_month", [("years", "date"), ("months", "date")])
    table = read_table(spark, "by_month")
    for low, high in (("2025-02-03", "2025-02-07"), ("2024-12-30", "2025-01-02"), ("2024-12-01", "2026-02-01")):
        part = between_dates(table, "date", low, high)
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(part)).group(1)
        assert "date_month" in filters and "date_year" in filters
        assert part.count() == (dt.date.fromisoformat(high) - dt.date.fromisoformat(low)).days
    spark.sql("DROP TABLE by_month")


def test_joined_gold_reuses_the_partitioning(spark, big, no_broadcast):
    drivers = spark.range(10).selectExpr("id AS driver_id", "1.0D AS rating")
    # One for the aggregate, one for the dimension, none for the join itself.
    assert exchanges(gold.driver_performance(big, drivers)) == 2


def test_dedup_combines_before_the_shuffle(spark, big):
    text = plan(dedup(big, ["ride_id"]))
    assert "partial_min" in text and exchanges(dedup(big, ["ride_id"])) == 1


def test_fk_check_counts_before_the_join(spark, big, no_broadcast):
    df = fk_violations(big, "driver_id", spark.range(5).withColumnRenamed("id", "driver_id"))
    text = plan(df)
    assert "LeftAnti" in text
    assert text.index("LeftAnti") < text.index("partial_count")


def test_all_foreign_keys_in_one_shuffle(spark, big, no_broadcast):
    frames = {
        "ride": big.withColumn("vehicle_id", F.col("driver_id")),
        "passenger": spark.range(50).withColumnRenamed("id", "passenger_id"),
        "driver": spark.range(5).withColumnRenamed("id", "driver_id"),
        "vehicle": spark.range(9).selectExpr("id AS vehicle_id", "IF(id = 3, NULL, id) AS driver_id"),
        "payment": spark.range(7).selectExpr("id AS ride_id"),
    }
    df = all_fk_violations(frames)
    text = plan(df)
    assert exchanges(df) == 1 and "Join" not in text and text.count("FileScan") == 1
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")
    got = {}
    for r in df.collect():
        got.setdefault((r["child"], r["column_name"]), {})[r["key_value"]] = r["row_count"]
    for relation in RELATIONS:
        one = fk_violations(frames[relation.child], relation.column, frames[relation.parent], relation.key)
        want = {None if r[0] is None else str(r[0]): r["row_count"] for r in one.collect()}
        assert got.get((relation.child, relation.column), {}) == want
    assert got["vehicle", "driver_id"][None] == 1


def test_validation_does_not_shuffle(spark):
    assert "Exchange" not in plan(validate(load(spark, SF, "payment"), "payment"))


def test_unused_columns_are_not_read(spark, big):
    text = plan(gold.passenger_activity(big))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
    }


def test_silver_filters_reach_the_scan(spark, tmp_path):
    rides = load(spark, SF, "ride")
    rides.write.parquet(str(tmp_path / "ride"))
    text = plan(refine_ride(spark.read.parquet(str(tmp_path / "ride"))))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    for part in ("EqualTo(ride_status,completed)", "GreaterThan(fare_amount,0.0)", "GreaterThan(distance_km,0.0)"):
        assert part in pushed
    payments = load(spark, SF, "payment")
    payments.write.parquet(str(tmp_path / "payment"))
    text = plan(refine_payment(spark.read.parquet(str(tmp_path / "payment"))))
    assert "GreaterThan(amount,0.0)" in text


def test_partitioned_write_splits_a_hot_partition(spark):
    """One city holds a third of all rows: it is written by several tasks."""
    rides = spark.range(300_000).selectExpr(
        "IF(id % 3 = 0, 'Hot', CONCAT('C', id % 20)) AS pickup_city", "uuid() AS ride_id"
    ).repartition(32)
    keys = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        write_table(rides, "hot_city", "pickup_city")
    finally:
        for k in keys:
            spark.conf.unset(k)
    files = (
        read_table(spark, "hot_city")
        .select("pickup_city", F.input_file_name().alias("file"))
        .groupBy("pickup_city")
        .agg(F.countDistinct("file").alias("files"), F.count("*").alias("n"))
    )
    got = {r["pickup_city"]: (r["files"], r["n"]) for r in files.collect()}
    assert got["Hot"][0] > 2 and got["Hot"][1] == 100_000
    assert sum(n for _, n in got.values()) == 300_000
    spark.sql("DROP TABLE hot_city")


def analysed(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def test_rows_that_pass_build_no_errors_and_plain_times_no_instants(rows):
    rides = rows("ride_id STRING, request_timestamp STRING, fare_amount DOUBLE", ("R1", "2026-05-01T10:00:00", 5.0))
    plan = analysed(report.error_rows(rides, "ride"))
    assert "ELSE array_compact(" in plan
    assert re.search(r"THEN try_cast\(request_timestamp#\d+ as timestamp\)", plan)
    assert not re.search(r"(?<!THEN )try_cast\(request_timestamp#\d+ as timestamp\)", plan)


def test_report_counts_rules_and_not_arrays(rows, monkeypatch):
    plans = []

    def kept(df):
        plans.append(analysed(df))
        return written(df)

    monkeypatch.setattr(report, "written", kept)
    payments = rows(
        "payment_id STRING, ride_id STRING, amount DOUBLE, payment_status STRING",
        ("A", "R1", 1.0, "completed"),
        (None, None, -1.0, "completed"),
        ("A", "", None, "odd"),
    )
    row = report.quality_report(payments, "payment").first()
    assert (row["records"], row["valid_records"], row["invalid_records"]) == (3, 1, 2)
    assert row["checks"] == {
        "payment_id_required": 1, "ride_id_required": 2, "amount_range": 2, "payment_status_allowed": 1,
    }
    assert len(row["errors"]) == 6 and len(plans) == 1 and "array_contains" not in plans[0]
