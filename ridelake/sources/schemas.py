"""Schemas of every layer, and their tables as DDL.

Fixed values: entity and table columns, types, nullability and partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import as_timestamp

ENTITIES = ("passenger", "driver", "vehicle", "ride", "payment")

# Raw records, JSON Lines.
RAW = {
    "passenger": (
        "passenger_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING, "
        "signup_timestamp STRING, city STRING, country STRING, status STRING"
    ),
    "driver": (
        "driver_id STRING, first_name STRING, last_name STRING, signup_timestamp STRING, "
        "rating DOUBLE, city STRING, country STRING, status STRING"
    ),
    "vehicle": (
        "vehicle_id STRING, driver_id STRING, make STRING, model STRING, year INT, "
        "vehicle_type STRING, license_plate STRING"
    ),
    "ride": (
        "ride_id STRING, passenger_id STRING, driver_id STRING, vehicle_id STRING, "
        "request_timestamp STRING, pickup_timestamp STRING, dropoff_timestamp STRING, "
        "pickup_latitude DOUBLE, pickup_longitude DOUBLE, "
        "dropoff_latitude DOUBLE, dropoff_longitude DOUBLE, "
        "pickup_city STRING, dropoff_city STRING, distance_km DOUBLE, duration_minutes INT, "
        "fare_amount DOUBLE, currency STRING, ride_status STRING"
    ),
    "payment": (
        "payment_id STRING, ride_id STRING, payment_timestamp STRING, payment_method STRING, "
        "amount DOUBLE, currency STRING, payment_status STRING"
    ),
}

PLACE = "STRUCT<latitude: DECIMAL(9,6), longitude: DECIMAL(9,6), city: STRING>"

# Layer tables.
TABLES = {
    "bronze_passenger": (
        "passenger_id STRING NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
        "email STRING, phone STRING, signup_timestamp TIMESTAMP_NTZ, city STRING, "
        "country STRING, status STRING"
    ),
    "bronze_driver": (
        "driver_id STRING NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
        "signup_timestamp TIMESTAMP_NTZ, rating DECIMAL(2,1), city STRING, country STRING, "
        "status STRING"
    ),
    "bronze_vehicle": (
        "vehicle_id STRING NOT NULL, driver_id STRING NOT NULL, make STRING, model STRING, "
        "year INT, vehicle_type STRING, license_plate STRING"
    ),
    "bronze_ride": (
        "ride_id STRING NOT NULL, passenger_id STRING NOT NULL, driver_id STRING NOT NULL, "
        "vehicle_id STRING NOT NULL, request_timestamp TIMESTAMP_NTZ, "
        "pickup_timestamp TIMESTAMP_NTZ, dropoff_timestamp TIMESTAMP_NTZ, "
        "pickup_latitude DECIMAL(9,6), pickup_longitude DECIMAL(9,6), "
        "dropoff_latitude DECIMAL(9,6), dropoff_longitude DECIMAL(9,6), "
        "pickup_city STRING, dropoff_city STRING, distance_km DECIMAL(6,2), "
        "duration_minutes INT, fare_amount DECIMAL(8,2), currency STRING, ride_status STRING"
    ),
    "bronze_payment": (
        "payment_id STRING NOT NULL, ride_id STRING NOT NULL, payment_timestamp TIMESTAMP_NTZ, "
        "payment_method STRING, amount DECIMAL(8,2), currency STRING, payment_status STRING"
    ),
    "silver_passenger": (
        "passenger_id STRING NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
        "email STRING NOT NULL, phone STRING NOT NULL, signup_date DATE, "
        "city STRING NOT NULL, country STRING NOT NULL, status STRING NOT NULL"
    ),
    "silver_driver": (
        "driver_id STRING NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
        "signup_date DATE, rating DECIMAL(2,1), city STRING NOT NULL, country STRING NOT NULL, "
        "status STRING NOT NULL"
    ),
    "silver_vehicle": (
        "vehicle_id STRING NOT NULL, driver_id STRING NOT NULL, make STRING NOT NULL, "
        "model STRING NOT NULL, year INT NOT NULL, vehicle_type STRING NOT NULL, "
        "license_plate STRING NOT NULL"
    ),
    "silver_ride": (
        "ride_id STRING NOT NULL, passenger_id STRING NOT NULL, driver_id STRING NOT NULL, "
        "vehicle_id STRING NOT NULL, request_date DATE, request_time TIMESTAMP_NTZ NOT NULL, "
        "pickup_time TIMESTAMP_NTZ NOT NULL, dropoff_time TIMESTAMP_NTZ NOT NULL, "
        f"pickup_location {PLACE}, dropoff_location {PLACE}, "
        "distance_km DECIMAL(6,2) NOT NULL, duration_minutes INT NOT NULL, "
        "fare_amount DECIMAL(8,2) NOT NULL, currency STRING NOT NULL, "
        "ride_status STRING NOT NULL, valid_record BOOLEAN DEFAULT TRUE, "
        "data_quality_checks MAP<STRING, BOOLEAN>"
    ),
    "silver_payment": (
        "payment_id STRING NOT NULL, ride_id STRING NOT NULL, payment_date DATE, "
        "payment_time TIMESTAMP_NTZ NOT NULL, payment_method STRING NOT NULL, "
        "amount DECIMAL(8,2) NOT NULL, currency STRING NOT NULL, "
        "payment_status STRING NOT NULL, valid_record BOOLEAN DEFAULT TRUE"
    ),
    "gold_ride_daily_metrics": (
        "date DATE NOT NULL, city STRING NOT NULL, total_rides INT NOT NULL, "
        "completed_rides INT NOT NULL, cancelled_rides INT NOT NULL, "
        "total_distance_km DECIMAL(10,2) NOT NULL, total_revenue DECIMAL(10,2) NOT NULL, "
        "avg_fare DECIMAL(8,2) NOT NULL, avg_distance_km DECIMAL(6,2) NOT NULL, "
        "avg_duration_minutes DECIMAL(6,2) NOT NULL"
    ),
    "gold_driver_metrics": (
        "date DATE NOT NULL, driver_id STRING NOT NULL, completed_rides INT NOT NULL, "
        "total_distance_km DECIMAL(10,2) NOT NULL, total_revenue DECIMAL(10,2) NOT NULL, "
        "avg_rating DECIMAL(2,1)"
    ),
    "gold_city_metrics": (
        "date DATE NOT NULL, city STRING NOT NULL, total_rides INT NOT NULL, "
        "completed_rides INT NOT NULL, total_revenue DECIMAL(10,2) NOT NULL, "
        "avg_fare DECIMAL(8,2) NOT NULL, avg_distance_km DECIMAL(6,2) NOT NULL"
    ),
}

# Partitioning as (transform, column).
PARTITIONS = {
    "bronze_passenger": [("years", "signup_timestamp")],
    "bronze_driver": [("years", "signup_timestamp")],
    "bronze_ride": [("days", "request_timestamp")],
    "bronze_payment": [("days", "payment_timestamp")],
    "silver_passenger": [("identity", "country"), ("identity", "city")],
    "silver_driver": [("identity", "country"), ("identity", "city")],
    "silver_ride": [("days", "request_time")],
    "silver_payment": [("days", "payment_time")],
    "gold_ride_daily_metrics": [("years", "date"), ("months", "date")],
    "gold_driver_metrics": [("years", "date"), ("months", "date")],
    "gold_city_metrics": [("years", "date"), ("months", "date")],
}

# Keys that must be unique.
UNIQUE = {"silver_vehicle": ["license_plate"]}

# Partition columns of formats without partition transforms. Directory names
# cannot tell '' from NULL, so text is partitioned by a copy and keeps its value.
DERIVED = {
    "years": ("year", F.year, "INT"),
    "months": ("month", F.month, "INT"),
    "days": ("day", F.to_date, "DATE"),
    "identity": ("part", lambda c: c, "STRING"),
}


def raw_text(entity: str) -> str:
    """The raw schema with every column as text, so that bad numbers stay visible."""
    names = [part.split()[0] for part in RAW[entity].split(", ")]
    return ", ".join(f"{n} STRING" for n in names)


def derived_columns(partitions) -> dict[str, Column]:
    """Partition columns by name, for formats without partition transforms."""
    return {f"{c}_{DERIVED[k][0]}": DERIVED[k][1](F.col(c)) for k, c in partitions}


def conform(df: DataFrame, table: str) -> DataFrame:
    """`df` in the declared columns, order and types of `table`.

    Text times are parsed as ISO. A number too large for its declared decimal is
    an error under ANSI mode, never a silent NULL.
    """
    schema = T.StructType.fromDDL(TABLES[table].replace(" DEFAULT TRUE", ""))
    out = []
    for f in schema.fields:
        if f.name not in df.columns and f.nullable:
            # Also `valid_record`: a row that no rule has seen is not valid for that.
            c = F.lit(None)
        elif f.dataType.typeName() == "timestamp_ntz":
            c = as_timestamp(df, f.name)
        else:
            c = F.col(f.name)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def iceberg_partitions(partitions) -> list[tuple[str, str]]:
    """`partitions` without years of a column that also has months: a month lies
    in one year, and Iceberg refuses the pair as redundant."""
    return [(k, c) for k, c in partitions if not (k == "years" and ("months", c) in partitions)]


def create_statement(table: str, name: str | None = None, fmt: str = "parquet") -> str:
    """CREATE TABLE IF NOT EXISTS for a layer table.

    Iceberg takes the partition transforms; other formats get one plain column
    per transform, which `write_table` fills. UNIQUE has no counterpart in
    either: `duplicate_keys` checks it.
    """
    columns, partitions = TABLES[table], PARTITIONS.get(table, [])
    if fmt == "iceberg":
        # Column defaults need a newer table version than v2.
        columns = columns.replace(" DEFAULT TRUE", "")
        finest = iceberg_partitions(partitions)
        spec = [c if k == "identity" else f"{k}({c})" for k, c in finest]
    else:
        spec = [f"{c}_{DERIVED[k][0]}" for k, c in partitions]
        columns += "".join(f", {c}_{DERIVED[k][0]} {DERIVED[k][2]}" for k, c in partitions)
    text = f"CREATE TABLE IF NOT EXISTS {name or table} ({columns}) USING {fmt}"
    return text + (f" PARTITIONED BY ({', '.join(spec)})" if spec else "")


def create_tables(
    spark: SparkSession, layer: str, prefix: str = "", fmt: str = "parquet"
) -> list[str]:
    """Create the tables of `layer` ('bronze', 'silver' or 'gold'); returns their names."""
    names = [t for t in TABLES if t.startswith(f"{layer}_")]
    for t in names:
        spark.sql(create_statement(t, f"{prefix}{t}", fmt))
    return [f"{prefix}{t}" for t in names]
