"""Domain views over star-schema tables (lineitem, orders, customer, ...).

The tables hold no rides. A line item plays a ride, a supplier a driver, a
customer a passenger, a part a vehicle and an event a payment. The text is the
same for Spark and for any ANSI engine: a name in braces is a table or another
view. Typed views feed the gold operators; `raw_*` views are text records as
they would arrive, with faults mixed in by key so that every rule has work.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from ridelake.session import compiled

VIEWS = {
    "ride": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS ride_id,
       CASE WHEN l.l_orderkey % 211 = 5 THEN -o.o_custkey ELSE o.o_custkey END AS passenger_id,
       CASE WHEN l.l_orderkey % 223 = 5 THEN -l.l_suppkey ELSE l.l_suppkey END AS driver_id,
       CASE WHEN l.l_partkey % 227 = 5 THEN -l.l_partkey ELSE l.l_partkey END AS vehicle_id,
       l.l_shipdate AS request_timestamp,
       l.l_shipdate + INTERVAL '5' MINUTE AS pickup_timestamp,
       l.l_shipdate + INTERVAL '5' MINUTE
         + INTERVAL '1' MINUTE * CAST(l.l_quantity AS INT) AS dropoff_timestamp,
       CAST(5 * c.c_nationkey - 60 AS DOUBLE)
         + CAST(l.l_orderkey % 100 AS DOUBLE) / 1000 AS pickup_latitude,
       CAST(13 * c.c_nationkey - 150 AS DOUBLE)
         + CAST(l.l_orderkey % 90 AS DOUBLE) / 1000 AS pickup_longitude,
       CAST(5 * s.s_nationkey - 60 AS DOUBLE)
         + CAST(l.l_partkey % 100 AS DOUBLE) / 1000 AS dropoff_latitude,
       CAST(13 * s.s_nationkey - 150 AS DOUBLE)
         + CAST(l.l_partkey % 90 AS DOUBLE) / 1000 AS dropoff_longitude,
       pn.n_name AS pickup_city,
       dn.n_name AS dropoff_city,
       l.l_quantity + CAST(l.l_partkey % 4096 AS DOUBLE) / 4096 AS distance_km,
       CAST(l.l_quantity AS INT) AS duration_minutes,
       l.l_extendedprice AS fare_amount,
       'USD' AS currency,
       CASE WHEN l.l_returnflag = 'A' THEN 'completed'
            WHEN l.l_returnflag = 'N' THEN 'cancelled_by_driver'
            WHEN l.l_linestatus = 'F' THEN 'no_show'
            ELSE 'cancelled_by_passenger' END AS ride_status
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} pn ON c.c_nationkey = pn.n_nationkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {nation} dn ON s.s_nationkey = dn.n_nationkey
""",
    "driver": """
SELECT s.s_suppkey AS driver_id,
       s.s_name AS first_name,
       'Driver' AS last_name,
       CASE WHEN s.s_suppkey % 19 = 4 THEN 'soon'
            ELSE '2025-03-' || CAST(10 + s.s_suppkey % 20 AS STRING) || 'T08:30:00'
            END AS signup_timestamp,
       CAST(CAST(s.s_acctbal / 1600 AS DECIMAL(12,8)) AS DOUBLE) AS rating,
       n.n_name AS city,
       'USA' AS country,
       CASE s.s_suppkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'banned' END AS status
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
""",
    "passenger": """
SELECT c.c_custkey AS passenger_id,
       '  ' || c.c_name || ' ' AS first_name,
       'Rider' AS last_name,
       CASE WHEN c.c_acctbal < 0 THEN 'not-an-email'
            WHEN c.c_custkey % 17 = 0 THEN NULL
            ELSE 'Passenger' || CAST(c.c_custkey AS STRING) || '@Example.com' END AS email,
       CASE WHEN c.c_acctbal < 0 THEN '2025551234'
            ELSE '+1' || CAST(2000000000 + c.c_custkey AS STRING) END AS phone,
       CASE WHEN c.c_custkey % 23 = 5 THEN '2025-02-30T00:00:00'
            WHEN c.c_custkey % 23 = 6 THEN NULL
            ELSE '2025-04-' || CAST(10 + c.c_custkey % 20 AS STRING) || ' 12:00:00.250'
            END AS signup_timestamp,
       n.n_name AS city,
       r.r_name AS country,
       CASE c.c_mktsegment WHEN 'BUILDING' THEN 'ACTIVE ' WHEN 'MACHINERY' THEN 'suspended'
            WHEN 'FURNITURE' THEN 'unknown' ELSE 'inactive' END AS status
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
""",
    "vehicle": """
SELECT p.p_partkey AS vehicle_id,
       CASE WHEN p.p_partkey % 13 = 0 THEN NULL
            ELSE p.p_partkey % (SELECT COUNT(*) FROM {supplier}) END AS driver_id,
       p.p_brand AS make,
       p.p_name AS model,
       1880 + p.p_size * 4 AS year,
       p.p_type AS vehicle_type,
       ' abc' || CAST(p.p_partkey % 1500 AS STRING) AS license_plate
FROM {part} p
""",
    "payment": """
SELECT e.event_id AS payment_id,
       e.event_id AS ride_id,
       CAST(e.ts AS STRING) AS payment_timestamp,
       CASE e.user_id % 3 WHEN 0 THEN 'Cash' WHEN 1 THEN 'credit_card'
            ELSE ' digital_wallet' END AS payment_method,
       CASE WHEN e.event_id % 29 = 0 THEN -e.value ELSE e.value END AS amount,
       CASE WHEN e.event_id % 7 = 3 THEN '' WHEN e.event_id % 7 = 4 THEN NULL
            WHEN e.event_id % 7 = 5 THEN 'eur ' ELSE 'USD' END AS currency,
       CASE e.event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed'
            WHEN 'view' THEN 'pending' ELSE 'other' END AS payment_status
FROM {events} e
""",
    "raw_ride": """
SELECT CASE WHEN ride_id % 127 = 7 THEN NULL
            ELSE 'R' || CAST(ride_id AS STRING) END AS ride_id,
       CASE WHEN ride_id % 131 = 7 THEN ''
            ELSE 'P' || CAST(passenger_id AS STRING) END AS passenger_id,
       'D' || CAST(driver_id AS STRING) AS driver_id,
       'V' || CAST(vehicle_id AS STRING) AS vehicle_id,
       CASE WHEN ride_id % 101 = 3 THEN 'yesterday'
            WHEN ride_id % 103 = 5 THEN NULL
            WHEN ride_id % 109 = 11 THEN
              REPLACE(CAST(request_timestamp AS STRING), ' ', 'T') || '+02:00'
            ELSE REPLACE(CAST(request_timestamp AS STRING), ' ', 'T') END AS request_timestamp,
       CASE WHEN ride_id % 107 = 9 THEN '1996-13-01T00:00:00'
            WHEN ride_id % 218 = 11 THEN
              CAST(pickup_timestamp AS STRING) || '+02:00'
            ELSE CAST(pickup_timestamp AS STRING) END AS pickup_timestamp,
       CASE WHEN ride_id % 113 = 13 THEN
              REPLACE(CAST(request_timestamp - INTERVAL '1' DAY AS STRING), ' ', 'T')
            WHEN ride_id % 436 = 11 THEN
              CAST(dropoff_timestamp AS STRING) || '+03:00'
            WHEN ride_id % 218 = 11 THEN
              CAST(dropoff_timestamp AS STRING) || '+02:00'
            ELSE CAST(dropoff_timestamp AS STRING) END AS dropoff_timestamp,
       CAST(pickup_latitude AS STRING) AS pickup_latitude,
       CAST(pickup_longitude AS STRING) AS pickup_longitude,
       CASE WHEN ride_id % 137 = 1 THEN NULL
            ELSE CAST(dropoff_latitude AS STRING) END AS dropoff_latitude,
       CAST(dropoff_longitude AS STRING) AS dropoff_longitude,
       CASE WHEN ride_id % 53 = 1 THEN '  ' || pickup_city || ' '
            WHEN ride_id % 59 = 1 THEN NULL
            WHEN ride_id % 59 = 2 THEN '' ELSE pickup_city END AS pickup_city,
       dropoff_city,
       CASE WHEN ride_id % 71 = 1 THEN 'far'
            WHEN ride_id % 73 = 2 THEN NULL
            WHEN ride_id % 79 = 3 THEN '-' || CAST(distance_km AS STRING)
            ELSE CAST(distance_km AS STRING) END AS distance_km,
       CASE WHEN ride_id % 83 = 1 THEN '5.5'
            WHEN ride_id % 89 = 2 THEN '-' || CAST(duration_minutes AS STRING)
            ELSE CAST(duration_minutes AS STRING) END AS duration_minutes,
       CASE WHEN ride_id % 37 = 1 THEN 'n/a'
            WHEN ride_id % 41 = 2 THEN NULL
            WHEN ride_id % 43 = 3 THEN '-' || CAST(fare_amount AS STRING)
            WHEN ride_id % 499 = 7 THEN 'Infinity'
            WHEN ride_id % 503 = 9 THEN '1e17'
            WHEN ride_id % 509 = 11 THEN '1e308'
            ELSE CAST(fare_amount AS STRING) END AS fare_amount,
       CASE WHEN ride_id % 61 = 1 THEN NULL WHEN ride_id % 61 = 2 THEN ''
            WHEN ride_id % 61 = 3 THEN 'eur' ELSE currency END AS currency,
       CASE WHEN ride_id % 47 = 1 THEN 'Completed'
            WHEN ride_id % 47 = 2 THEN NULL
            WHEN ride_id % 47 = 3 THEN 'cancelled' ELSE ride_status END AS ride_status
FROM {ride} r
""",
    "raw_driver": """
SELECT CASE WHEN driver_id % 31 = 7 THEN ''
            ELSE 'D' || CAST(driver_id AS STRING) END AS driver_id,
       '\t' || first_name || ' ' AS first_name,
       CASE WHEN driver_id % 29 = 7 THEN NULL ELSE last_name END AS last_name,
       signup_timestamp,
       CASE WHEN driver_id % 17 = 3 THEN 'good'
            WHEN driver_id % 17 = 5 THEN NULL
            ELSE CAST(CAST(rating AS DECIMAL(6,3)) AS STRING) END AS rating,
       city,
       country,
       CASE WHEN driver_id % 11 = 1 THEN ' Active' ELSE status END AS status
FROM {driver} d
""",
    "raw_passenger": """
SELECT CASE WHEN passenger_id % 97 = 7 THEN NULL
            ELSE 'P' || CAST(passenger_id AS STRING) END AS passenger_id,
       first_name,
       CASE WHEN passenger_id % 43 = 7 THEN '' ELSE last_name END AS last_name,
       email,
       phone,
       signup_timestamp,
       city,
       country,
       status
FROM {passenger} p
""",
    "raw_vehicle": """
SELECT 'V' || CAST(vehicle_id AS STRING) AS vehicle_id,
       'D' || CAST(driver_id AS STRING) AS driver_id,
       make,
       model,
       CASE WHEN vehicle_id % 41 = 1 THEN 'new'
            WHEN vehicle_id % 41 = 2 THEN NULL ELSE CAST(year AS STRING) END AS year,
       vehicle_type,
       CASE WHEN vehicle_id % 37 = 1 THEN '' ELSE license_plate END AS license_plate
FROM {vehicle} v
""",
    "raw_payment": """
SELECT 'PM' || CAST(payment_id AS STRING) AS payment_id,
       CASE WHEN payment_id % 67 = 1 THEN NULL
            ELSE 'R' || CAST(ride_id AS STRING) END AS ride_id,
       CASE WHEN payment_id % 71 = 1 THEN '' ELSE payment_timestamp END AS payment_timestamp,
       payment_method,
       CASE WHEN payment_id % 73 = 1 THEN 'free'
            WHEN payment_id % 73 = 2 THEN NULL
            ELSE CAST(amount AS STRING) END AS amount,
       currency,
       payment_status
FROM {payment} p
""",
}


_ROWS_FIRST = """FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} pn ON c.c_nationkey = pn.n_nationkey
"""
_ORDERS_FIRST = """FROM {lineitem} l
JOIN ({orders} o
      JOIN {customer} c ON o.o_custkey = c.c_custkey
      JOIN {nation} pn ON c.c_nationkey = pn.n_nationkey) ON l.l_orderkey = o.o_orderkey
"""

#: The same views as Spark reads them. Spark joins as written: orders, a quarter of the line
#: items and two keys wide, find their customers first, so that line items are shuffled once.
JOINED = {"ride": VIEWS["ride"].replace(_ROWS_FIRST, _ORDERS_FIRST)}


def sources_of(name: str) -> list[str]:
    """Tables and views that the text of view `name` reads."""
    return list(dict.fromkeys(f for _, f, _, _ in Formatter().parse(VIEWS[name]) if f))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table or domain view `name` over the Parquet files in `sf_dir`."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    compiled(spark)
    return spark.sql(JOINED.get(name, VIEWS[name]), **{s: load(spark, sf_dir, s) for s in sources_of(name)})


def with_views(sql: str, *names: str) -> str:
    """`sql` preceded by the domain views it names, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for s in sources_of(name):
                add(s)
            ordered.append(name)

    for n in names:
        add(n)
    parts = []
    for n in ordered:
        text = VIEWS[n].format(**{s: s for s in sources_of(n)})
        parts.append(f"{n} AS ({text})")
    head = "WITH " + ",\n".join(parts)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
