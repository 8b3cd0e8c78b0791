"""Registered queries: every operator over the whole supplied tables.

Each entry takes (spark, sf_dir). Results are given portable types: times and
lists as text, decimals as doubles, places and maps as plain columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import haversine_km, is_email, is_phone, iso_timestamp, ride_fare
from ridelake.operators import gold, increments
from ridelake.operators.bronze import BRONZE
from ridelake.operators.integrity import all_fk_violations, fk_violations, null_profile, orphan_rows, range_profile
from ridelake.operators.dedup import duplicate_keys
from ridelake.operators.normalise import NORMALISE, normalise_payment, normalise_ride
from ridelake.operators.refine import REFINE, WIDE_RIDE_STATUSES, refine_ride
from ridelake.operators.report import (
    error_rows,
    failure_messages,
    kept_report,
    quality_report,
    report_state,
    write_report_state,
)
from ridelake.operators.validate import split_quarantine, validate
from ridelake.plans.layers import LayerConfig, run_layers
from ridelake.sources.declared import REFUSED, load_declared, read_declared, refused_rows
from ridelake.sources.files import (
    INVALID,
    MALFORMED,
    VALID,
    ingest_bronze,
    land_all,
    land_raw,
    malformed_lines,
    read_bronze,
    read_quarantine,
    read_raw,
    read_routed,
    write_jsonl,
    write_quarantine,
    write_report,
    write_routed,
)
from ridelake.sources.schemas import ENTITIES, raw_text
from ridelake.sources.scratch import remove_folder, shared_folder, written
from ridelake.sources.star_schema import load
from ridelake.sources.tables import list_layer, read_table, reset_tables, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Declared ranges that the range profile of rides reports on.
RIDE_BOUNDS = {
    "distance_km": (0, 40),
    "fare_amount": (1000, 100000),
    "duration_minutes": (5, 45),
    "pickup_latitude": (-45, 60),
    "pickup_longitude": (-180, 150),
}
PAYMENT_BOUNDS = {"amount": (0, 1000)}
DRIVER_BOUNDS = {"rating": (3.5, 5.0)}


def portable(df: DataFrame) -> DataFrame:
    """`df` with column types that compare equal across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StructType):
            out += [
                (c[s.name].cast("double") if isinstance(s.dataType, T.DecimalType) else c[s.name]).alias(f"{f.name}_{s.name}")
                for s in f.dataType.fields
            ]
        elif isinstance(f.dataType, T.TimestampNTZType):
            out.append(c.cast("string").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            out.append(c.cast("double").alias(f.name))
        elif isinstance(f.dataType, T.MapType):
            pairs = F.array_sort(F.map_entries(c))
            texts = F.transform(
                pairs, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
            )
            out.append(F.concat_ws(",", texts).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            out.append(F.concat_ws("|", c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return BRONZE[entity](load(spark, sf_dir, f"raw_{entity}"))


def _bronze(entity: str) -> Query:
    return lambda spark, sf_dir: portable(bronze(spark, sf_dir, entity))


def _normalised(entity: str) -> Query:
    return lambda spark, sf_dir: portable(NORMALISE[entity](bronze(spark, sf_dir, entity)))


def _normalised_from_raw(entity: str) -> Query:
    return lambda spark, sf_dir: portable(
        NORMALISE[entity](load(spark, sf_dir, f"raw_{entity}"))
    )


def _refined(entity: str) -> Query:
    return lambda spark, sf_dir: portable(REFINE[entity](bronze(spark, sf_dir, entity)))


def _checked(entity: str) -> Query:
    key = f"{entity}_id"

    def run(spark, sf_dir):
        checked = validate(bronze(spark, sf_dir, entity), entity)
        return portable(checked.select(key, "error_codes", "valid_record"))

    return run


def _report(entity: str) -> Query:
    return lambda spark, sf_dir: portable(quality_report(bronze(spark, sf_dir, entity), entity))


def _messages(entity: str) -> Query:
    return lambda spark, sf_dir: failure_messages(bronze(spark, sf_dir, entity), entity)


def _error_rows(entity: str) -> Query:
    return lambda spark, sf_dir: error_rows(bronze(spark, sf_dir, entity), entity)


def _on_rides(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(load(spark, sf_dir, "ride"))


def silver_ride_wide(spark, sf_dir):
    return portable(refine_ride(bronze(spark, sf_dir, "ride"), WIDE_RIDE_STATUSES))


def norm_ride_checked(spark, sf_dir):
    return portable(
        normalise_ride(bronze(spark, sf_dir, "ride"), checks=True).select(
            "ride_id", "ride_status", "valid_record", "data_quality_checks"
        )
    )


def norm_payment_checked(spark, sf_dir):
    return portable(
        normalise_payment(bronze(spark, sf_dir, "payment"), checks=True).select(
            "payment_id", "payment_status", "valid_record"
        )
    )


def daily_metrics_from_records(spark, sf_dir):
    return gold.ride_daily_metrics(bronze(spark, sf_dir, "ride"))


def driver_daily_metrics(spark, sf_dir):
    return gold.driver_daily_metrics(load(spark, sf_dir, "ride"), load(spark, sf_dir, "driver"))


def driver_metrics_from_records(spark, sf_dir):
    return gold.driver_daily_metrics(
        bronze(spark, sf_dir, "ride"), bronze(spark, sf_dir, "driver"), order=["signup_timestamp"]
    )


LANDING_DAYS = ("2026-05-01", "2026-05-02", "2026-05-03")


def _by_landing_days(running: increments.Running, finish: Callable[[SparkSession, str, DataFrame], DataFrame]) -> Query:
    """Rides land on three days, one after the other; the result over all of them."""

    def run(spark, sf_dir):
        base = shared_folder(spark)
        rides = bronze(spark, sf_dir, "ride")
        day = F.pmod(F.crc32(F.coalesce("ride_id", F.lit(""))), F.lit(len(LANDING_DAYS)))
        for number, date in enumerate(LANDING_DAYS):
            increments.land(rides.filter(day == number), running, base, date)
        return finish(spark, sf_dir, increments.landed_result(spark, running, base))

    return run


def _with_rating(spark, sf_dir, sums):
    return gold.with_rating(sums, bronze(spark, sf_dir, "driver"), ["signup_timestamp"])


def driver_performance_with_rating(spark, sf_dir):
    drivers = REFINE["driver"](load(spark, sf_dir, "driver"))
    return gold.driver_performance(load(spark, sf_dir, "ride"), drivers)


def passenger_activity_with_profile(spark, sf_dir):
    passengers = REFINE["passenger"](load(spark, sf_dir, "passenger"))
    return gold.passenger_activity(load(spark, sf_dir, "ride"), passengers)


def daily_city_from_silver(spark, sf_dir):
    rides = refine_ride(bronze(spark, sf_dir, "ride"), WIDE_RIDE_STATUSES)
    return gold.daily_city_rides(rides)


def rides_by_city(spark, sf_dir):
    return gold.rides_by_city(gold.ride_daily_metrics(load(spark, sf_dir, "ride")))


def rows_by_city(spark, sf_dir):
    return gold.rows_by_city(gold.ride_daily_metrics(load(spark, sf_dir, "ride")))


def entity_row_counts(spark, sf_dir):
    return gold.entity_row_counts({e: load(spark, sf_dir, e) for e in ENTITIES})


def ride_count(spark, sf_dir):
    return load(spark, sf_dir, "ride").agg(F.count(F.lit(1)).alias("rides"))


def first_drivers(spark, sf_dir):
    """The ten-row inspection of silver drivers, in key order to be repeatable."""
    drivers = REFINE["driver"](load(spark, sf_dir, "driver"))
    return portable(drivers.orderBy("driver_id").limit(10))


def contact_formats(spark, sf_dir):
    return load(spark, sf_dir, "raw_passenger").select(
        "passenger_id",
        is_email(F.col("email")).alias("email_ok"),
        is_phone(F.col("phone")).alias("phone_ok"),
    )


def parsed_times(spark, sf_dir):
    rides = load(spark, sf_dir, "raw_ride")
    return rides.select(
        "ride_id",
        *(
            iso_timestamp(F.col(f"{n}_timestamp")).cast("string").alias(n)
            for n in ("request", "pickup", "dropoff")
        ),
    )


def _fk_ride(parent: str) -> Query:
    return lambda spark, sf_dir: fk_violations(
        load(spark, sf_dir, "ride"), f"{parent}_id", load(spark, sf_dir, parent)
    )


def fk_payment_ride(spark, sf_dir):
    return fk_violations(load(spark, sf_dir, "payment"), "ride_id", load(spark, sf_dir, "ride"))


def fk_vehicle_driver(spark, sf_dir):
    return fk_violations(load(spark, sf_dir, "vehicle"), "driver_id", load(spark, sf_dir, "driver"))


def fk_all(spark, sf_dir):
    """The violations of all five relations, each frame read once, in one shuffle."""
    return all_fk_violations({e: load(spark, sf_dir, e) for e in ENTITIES})


def _report_by_days(entity: str) -> Query:
    """Records land on three days; each day's state is kept, and the report is made of the states."""

    def run(spark, sf_dir):
        base = shared_folder(spark)
        records = bronze(spark, sf_dir, entity)
        day = F.pmod(F.crc32(F.coalesce(f"{entity}_id", F.lit(""))), F.lit(3))
        for number, date in enumerate(LANDING_DAYS):
            state = report_state(records.filter(day == number), entity)
            write_report_state(state, f"{base}/states", date)
        return portable(kept_report(spark, f"{base}/states"))

    return run


def orphan_payments(spark, sf_dir):
    orphans = orphan_rows(load(spark, sf_dir, "payment"), "ride_id", load(spark, sf_dir, "ride"))
    return orphans.select("payment_id", "ride_id", "amount", "payment_status")


def duplicate_ride_ids(spark, sf_dir):
    return duplicate_keys(load(spark, sf_dir, "ride"), ["ride_id"])


def duplicate_license_plates(spark, sf_dir):
    vehicles = NORMALISE["vehicle"](bronze(spark, sf_dir, "vehicle"))
    return duplicate_keys(vehicles, ["license_plate"])


def _nulls(entity: str) -> Query:
    return lambda spark, sf_dir: null_profile(bronze(spark, sf_dir, entity))


def _ranges(entity: str, bounds: dict) -> Query:
    return lambda spark, sf_dir: range_profile(bronze(spark, sf_dir, entity), bounds)


def haversine_fare(spark, sf_dir):
    km = haversine_km(
        *(F.col(f"{end}_{d}") for end in ("pickup", "dropoff") for d in ("latitude", "longitude"))
    )
    return (
        load(spark, sf_dir, "ride")
        .withColumn("km", km)
        .select(
            "ride_id",
            F.round("km", 3).alias("great_circle_km"),
            ride_fare(F.col("km"), F.col("duration_minutes")).alias("fare"),
        )
    )


def quarantined_rides(spark, sf_dir):
    _, bad = split_quarantine(bronze(spark, sf_dir, "ride"), "ride")
    return portable(bad.select("ride_id", "request_timestamp", "errors"))


def quarantine_from_files(spark, sf_dir):
    """Write payments with their errors, read the bad side back."""
    path = f"{shared_folder(spark)}/payment"
    write_quarantine(bronze(spark, sf_dir, "payment"), "payment", path)
    _, bad = read_quarantine(spark, path)
    return portable(bad.select("payment_id", "amount", "errors"))


def quarantine_counts(spark, sf_dir):
    """Good and bad rows of every entity, each table read once."""
    parts = []
    for entity in ENTITIES:
        valid = validate(bronze(spark, sf_dir, entity), entity).select("valid_record")
        sides = [
            F.struct(F.lit(side).alias("side"), n.alias("records"))
            for side, n in (
                ("good", F.count_if("valid_record")),
                ("bad", F.count_if(~F.col("valid_record"))),
            )
        ]
        parts.append(
            valid.agg(F.array(*sides).alias("sides")).select(
                F.lit(entity).alias("entity"), F.inline("sides")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def bronze_from_landing(spark, sf_dir):
    """Land raw rides as JSON Lines, ingest bronze, read it back."""
    base = shared_folder(spark)
    land_raw(load(spark, sf_dir, "raw_ride"), f"{base}/raw", "ride", "2026-05-01", "gzip")
    ingest_bronze(spark, f"{base}/raw", f"{base}/bronze", ["ride"])
    return portable(read_bronze(spark, f"{base}/bronze", "ride"))


def silver_ride_table(spark, sf_dir):
    """Write silver rides as a table by pickup city, read it by name, count per city."""
    base = shared_folder(spark)
    name = "silver_ride_" + base[-8:]
    rides = refine_ride(bronze(spark, sf_dir, "ride"))
    write_table(rides, name, "pickup_city", location=f"{base}/silver/ride")
    counts = read_table(spark, name).groupBy("pickup_city").agg(
        F.count(F.lit(1)).alias("rides"), F.countDistinct("passenger_id").alias("passengers")
    )
    out = written(counts)
    reset_tables(spark, [name])
    return out


def silver_listing(spark, sf_dir):
    """Write the refined dimensions as tables, list the layer, count the rows, drop all."""
    base = shared_folder(spark)
    prefix = f"l{base[-8:]}_"
    for entity in ("passenger", "driver", "vehicle"):
        frame = REFINE[entity](bronze(spark, sf_dir, entity))
        write_table(frame, f"{prefix}silver_{entity}", location=f"{base}/{entity}")
    names = [r["tableName"] for r in list_layer(spark, "silver", prefix).collect()]
    rows = [
        read_table(spark, n).select(F.lit(n.removeprefix(prefix)).alias("table_name")) for n in names
    ]
    counts = reduce(DataFrame.unionByName, rows).groupBy("table_name")
    out = written(counts.agg(F.count(F.lit(1)).alias("records")))
    reset_tables(spark, names)
    return out


def payments_as_lines(spark, sf_dir):
    """Raw payments written as JSON Lines and read back."""
    path = f"{shared_folder(spark)}/payment"
    write_jsonl(load(spark, sf_dir, "raw_payment"), path)
    return spark.read.schema(raw_text("payment")).json(path)


def landed_lines(spark, sf_dir):
    """Payments landed with some lines cut short: how many are records, how many are not."""
    raw = f"{shared_folder(spark)}/raw"
    whole = F.to_json(F.struct(*(F.col(n.split()[0]) for n in raw_text("payment").split(", "))))
    cut = F.when(F.col("payment_id").endswith("7"), F.substring(whole, 1, 20)).otherwise(whole)
    lines = load(spark, sf_dir, "raw_payment").select(cut.alias("value"))
    lines.write.text(f"{raw}/payment/ingestion_date=2026-05-01")
    records = read_raw(spark, raw, "payment").select(F.lit("record").alias("kind"), "payment_id")
    bad = malformed_lines(spark, raw, "payment")
    rest = bad.select(F.lit("malformed").alias("kind"), F.col("line").alias("payment_id"))
    return records.unionByName(rest).groupBy("kind").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.length("payment_id")).alias("characters"),
    )


def report_file(spark, sf_dir):
    """The report on rides, written as a file and read back."""
    path = f"{shared_folder(spark)}/report"
    write_report(quality_report(bronze(spark, sf_dir, "ride"), "ride"), path)
    kinds = "dataset STRING, records BIGINT, valid_records BIGINT, invalid_records BIGINT, validity_rate DOUBLE"
    return spark.read.schema(kinds).json(path)


def _run_layers(style: str, *columns: str) -> Query:
    """Run all layers from landed raw records; `columns` of what every table holds."""

    def run(spark, sf_dir):
        base = shared_folder(spark)
        frames = {e: load(spark, sf_dir, f"raw_{e}") for e in ENTITIES}
        land_all(frames, f"{base}/raw", "2026-05-01", "gzip")
        prefix = f"t{base[-8:]}_"
        cfg = LayerConfig(f"{base}/raw", f"{base}/bronze", prefix, f"{base}/tables", style)
        try:
            held = run_layers(spark, cfg)
        finally:
            for layer in ("silver", "gold"):
                names = [r["tableName"] for r in list_layer(spark, layer, prefix).collect()]
                reset_tables(spark, names)
            remove_folder(spark, base)
        return reduce(
            DataFrame.unionByName,
            (c.select(F.lit(layer).alias("layer"), *columns) for layer, c in held.items()),
        )

    return run


def _declared_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows that go into a declared table."""
    if table == "gold_driver_metrics":
        return driver_metrics_from_records(spark, sf_dir)
    if table.startswith("gold_"):
        metrics = gold.city_metrics if table == "gold_city_metrics" else gold.ride_daily_metrics
        return metrics(bronze(spark, sf_dir, "ride"))
    entity = table.removeprefix("silver_")
    checks = {"checks": True} if entity in ("ride", "payment") else {}
    return NORMALISE[entity](bronze(spark, sf_dir, entity), **checks)


DECLARED = (
    "silver_ride", "silver_payment", "silver_passenger",
    "gold_ride_daily_metrics", "gold_driver_metrics", "gold_city_metrics",
)


def _declared(table: str) -> Query:
    """Load a table made by its DDL, by dynamic overwrite, and read it back."""

    def run(spark, sf_dir):
        base = shared_folder(spark)
        name = f"d{base[-8:]}_{table}"
        try:
            load_declared(_declared_source(spark, sf_dir, table), table, name, f"{base}/refused")
            return written(portable(read_declared(spark, table, name)))
        finally:
            reset_tables(spark, [name])
            remove_folder(spark, base)

    return run


def refused_by_declared_tables(spark, sf_dir):
    """Rows that each declared table refuses, by code."""
    parts = []
    for table in DECLARED:
        bad = refused_rows(_declared_source(spark, sf_dir, table), table)
        codes = bad.select(F.explode(REFUSED).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("records"))
        parts.append(codes.select(F.lit(table).alias("table_name"), "code", "records"))
    return reduce(DataFrame.unionByName, parts)


def routed_lines(spark, sf_dir):
    """Payments landed with faults in the lines: every line where one pass has put it.

    Of ids that end in 7 the line is cut short, of those that end in 3 a second record
    follows on the line, and behind those that end in 5 there is a word.
    """
    base = shared_folder(spark)
    whole = F.to_json(F.struct(*(F.col(n.split()[0]) for n in raw_text("payment").split(", "))))
    only_id = F.concat(F.lit('{"payment_id":"'), "payment_id", F.lit('"}'))
    faulty = (
        F.when(F.col("payment_id").endswith("7"), F.substring(only_id, 1, 16))
        .when(F.col("payment_id").endswith("3"), F.concat(only_id, F.lit(" "), only_id))
        .when(F.col("payment_id").endswith("5"), F.concat(only_id, F.lit(" trailing")))
        .otherwise(whole)
    )
    lines = load(spark, sf_dir, "raw_payment").select(faulty.alias("value"))
    lines.write.text(f"{base}/raw/payment/ingestion_date=2026-05-01")
    write_routed(spark, f"{base}/raw", f"{base}/bronze", "payment", verify=True)
    every = read_routed(spark, f"{base}/bronze", "payment", VALID, INVALID, MALFORMED)
    return portable(every.select("destination", "payment_id", "amount", "error_codes", "line")).withColumn(
        "error_codes", F.when(F.col("destination") == INVALID, F.col("error_codes"))
    )


QUERIES: dict[str, Query] = {
    "ride_daily_metrics": _on_rides(gold.ride_daily_metrics),
    "daily_metrics_from_records": daily_metrics_from_records,
    "city_metrics": _on_rides(gold.city_metrics),
    "driver_daily_metrics": driver_daily_metrics,
    "driver_metrics_from_records": driver_metrics_from_records,
    "daily_metrics_by_landing_days": _by_landing_days(
        increments.RIDE_DAYS, lambda spark, sf_dir, sums: gold.with_cancelled(sums)
    ),
    "driver_metrics_by_landing_days": _by_landing_days(increments.DRIVER_DAYS, _with_rating),
    "daily_rides_by_date": _on_rides(gold.daily_rides),
    "daily_rides_by_city": _on_rides(gold.daily_city_rides),
    "daily_city_from_silver": daily_city_from_silver,
    "driver_performance": _on_rides(gold.driver_performance),
    "driver_performance_with_rating": driver_performance_with_rating,
    "passenger_activity": _on_rides(gold.passenger_activity),
    "passenger_activity_with_profile": passenger_activity_with_profile,
    "rides_by_city": rides_by_city,
    "rows_by_city": rows_by_city,
    "entity_row_counts": entity_row_counts,
    "ride_count": ride_count,
    "distinct_passengers": _on_rides(lambda r: gold.distinct_count(r, "passenger_id")),
    "first_drivers": first_drivers,
    **{f"bronze_{e}": _bronze(e) for e in ENTITIES},
    **{f"norm_{e}": _normalised(e) for e in ENTITIES},
    **{f"norm_raw_{e}": _normalised_from_raw(e) for e in ENTITIES},
    "norm_ride_checked": norm_ride_checked,
    "norm_payment_checked": norm_payment_checked,
    **{f"silver_{e}": _refined(e) for e in ENTITIES},
    "silver_ride_wide": silver_ride_wide,
    **{f"check_{e}": _checked(e) for e in ENTITIES},
    "contact_formats": contact_formats,
    "parsed_times": parsed_times,
    **{f"quality_report_{e}": _report(e) for e in ENTITIES},
    **{f"quality_report_by_days_{e}": _report_by_days(e) for e in ENTITIES},
    **{f"failure_messages_{e}": _messages(e) for e in ENTITIES},
    **{f"error_rows_{e}": _error_rows(e) for e in ENTITIES},
    "quarantined_rides": quarantined_rides,
    "quarantine_from_files": quarantine_from_files,
    "quarantine_counts": quarantine_counts,
    **{f"fk_ride_{p}": _fk_ride(p) for p in ("passenger", "driver", "vehicle")},
    "fk_payment_ride": fk_payment_ride,
    "fk_vehicle_driver": fk_vehicle_driver,
    "fk_all": fk_all,
    "orphan_payments": orphan_payments,
    "duplicate_ride_ids": duplicate_ride_ids,
    "duplicate_license_plates": duplicate_license_plates,
    **{f"null_profile_{e}": _nulls(e) for e in ENTITIES},
    "range_profile_ride": _ranges("ride", RIDE_BOUNDS),
    "range_profile_payment": _ranges("payment", PAYMENT_BOUNDS),
    "range_profile_driver": _ranges("driver", DRIVER_BOUNDS),
    "haversine_fare": haversine_fare,
    "bronze_from_landing": bronze_from_landing,
    "silver_ride_table": silver_ride_table,
    "silver_listing": silver_listing,
    "payments_as_lines": payments_as_lines,
    "landed_lines": landed_lines,
    "report_file": report_file,
    "routed_lines": routed_lines,
    **{f"declared_{t}": _declared(t) for t in DECLARED},
    "refused_by_declared_tables": refused_by_declared_tables,
    **{
        f"layer_{what}_{s}": _run_layers(s, "entity", "record_count", *more)
        for s in ("jobs", "notebooks", "records")
        for what, more in (("counts", ()), ("contents", ("digest_high", "digest_low")))
    },
}
