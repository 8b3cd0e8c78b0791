"""SQL counterparts of the registered queries.

Written from the definitions, not from the operators: the only shared text is
the domain views, which give both sides the same input.
"""

from __future__ import annotations

import re

from ridelake.sources.star_schema import with_views

ISO = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?"
    r"(Z|[+-]\d{2}:\d{2})?)?$"
)


# Characters that count as blank, by code point.
BLANKS = "".join(
    chr(c)
    for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


# --- scalar snippets -------------------------------------------------------


def _ts(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{ISO}') THEN TRY_CAST({x} AS TIMESTAMP) END"


def _num(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 0 ELSE TRY_CAST({x} AS DOUBLE) END AS {x}"


def _int(x: str, default: int = 0) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN {default} "
        f"WHEN regexp_matches({x}, '^[+-]?[0-9]+$') THEN CAST({x} AS INTEGER) END AS {x}"
    )


def _tidy(x: str) -> str:
    return f"trim(COALESCE({x}, ''), '{BLANKS}')"


def _units(x: str) -> str:
    """Whole 10^-12 units of a number by its decimal text; NULL if it has none in range."""
    text = f"CAST(TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12)) AS VARCHAR)"
    return f"CAST(REPLACE({text}, '.', '') AS HUGEINT)"


def _plain(x: str) -> str:
    """Whether every value has units."""
    return f"COUNT({x}) = COUNT({_units(x)})"


def _total(x: str) -> str:
    return (
        f"CASE WHEN {_plain(x)} THEN CAST(CAST(SUM({_units(x)}) AS VARCHAR) || 'e-12' AS DOUBLE) "
        f"ELSE SUM(CAST({x} AS DOUBLE)) END"
    )


def _mean(x: str) -> str:
    return f"({_total(x)}) / NULLIF(COUNT({x}), 0)"


def _rounded(x: str, n: str) -> str:
    """SUM({x}) / n in whole hundredths, halves away from zero, by integers."""
    total, step = f"SUM({_units(x)})", f"(CAST({n} AS HUGEINT) * 10000000000)"
    size = f"((abs({total}) * 2 + {step}) // ({step} * 2))"
    cents = f"CASE WHEN {total} < 0 THEN -{size} ELSE {size} END"
    return (
        f"COALESCE(CASE WHEN {n} = 0 THEN 0.0 "
        f"WHEN {_plain(x)} THEN CAST(CAST({cents} AS VARCHAR) || 'e-2' AS DOUBLE) "
        f"ELSE ROUND(SUM(CAST({x} AS DOUBLE)) / {n}, 2) END, 0.0)"
    )


# --- bronze, normalised and refined layers ---------------------------------

BRONZE = {
    "passenger": "SELECT * FROM raw_passenger",
    "driver": f"""
SELECT driver_id, first_name, last_name, signup_timestamp, {_num("rating")},
       city, country, status FROM raw_driver""",
    "vehicle": f"""
SELECT vehicle_id, driver_id, make, model, {_int('"year"')}, vehicle_type, license_plate
FROM raw_vehicle""",
    "ride": f"""
SELECT ride_id, passenger_id, driver_id, vehicle_id,
       request_timestamp, pickup_timestamp, dropoff_timestamp,
       {_num("pickup_latitude")}, {_num("pickup_longitude")},
       {_num("dropoff_latitude")}, {_num("dropoff_longitude")},
       pickup_city, dropoff_city, {_num("distance_km")}, {_int("duration_minutes")},
       {_num("fare_amount")}, currency, ride_status FROM raw_ride""",
    "payment": f"""
SELECT payment_id, ride_id, payment_timestamp, payment_method, {_num("amount")},
       currency, payment_status FROM raw_payment""",
}

# Records as they are read: no defaults.
TYPED = {
    e: re.sub(r"CASE WHEN (\S+) IS NULL THEN 0 (WHEN|ELSE)", r"CASE WHEN \1 IS NULL THEN NULL \2", q)
    for e, q in BRONZE.items()
}

NORMALISED = {
    "passenger": f"""
SELECT COALESCE(passenger_id, '') AS passenger_id, {_tidy("first_name")} AS first_name,
       {_tidy("last_name")} AS last_name, lower({_tidy("email")}) AS email,
       {_tidy("phone")} AS phone, CAST({_ts("signup_timestamp")} AS DATE) AS signup_date,
       {_tidy("city")} AS city, {_tidy("country")} AS country,
       lower({_tidy("status")}) AS status
FROM bronze_passenger""",
    "driver": f"""
SELECT COALESCE(driver_id, '') AS driver_id, {_tidy("first_name")} AS first_name,
       {_tidy("last_name")} AS last_name,
       CAST({_ts("signup_timestamp")} AS DATE) AS signup_date,
       CASE WHEN rating < 0 THEN 0 WHEN rating > 5 THEN 5 ELSE rating END AS rating,
       {_tidy("city")} AS city, {_tidy("country")} AS country,
       lower({_tidy("status")}) AS status
FROM bronze_driver""",
    "vehicle": f"""
SELECT COALESCE(vehicle_id, '') AS vehicle_id, COALESCE(driver_id, '') AS driver_id,
       {_tidy("make")} AS make, {_tidy("model")} AS model,
       CASE WHEN "year" < 1900 THEN 1900 WHEN "year" > 2050 THEN 2050 ELSE "year" END AS "year",
       lower({_tidy("vehicle_type")}) AS vehicle_type,
       upper({_tidy("license_plate")}) AS license_plate
FROM bronze_vehicle""",
    "ride": f"""
SELECT COALESCE(ride_id, '') AS ride_id, COALESCE(passenger_id, '') AS passenger_id,
       COALESCE(driver_id, '') AS driver_id, COALESCE(vehicle_id, '') AS vehicle_id,
       CAST({_ts("request_timestamp")} AS DATE) AS request_date,
       COALESCE(request_timestamp, '') AS request_time,
       COALESCE(pickup_timestamp, '') AS pickup_time,
       COALESCE(dropoff_timestamp, '') AS dropoff_time,
       pickup_latitude AS pickup_location_latitude,
       pickup_longitude AS pickup_location_longitude,
       {_tidy("pickup_city")} AS pickup_location_city,
       dropoff_latitude AS dropoff_location_latitude,
       dropoff_longitude AS dropoff_location_longitude,
       {_tidy("dropoff_city")} AS dropoff_location_city,
       CASE WHEN distance_km < 0 THEN 0 ELSE distance_km END AS distance_km,
       CASE WHEN duration_minutes < 0 THEN 0 ELSE duration_minutes END AS duration_minutes,
       CASE WHEN fare_amount < 0 THEN 0 ELSE fare_amount END AS fare_amount,
       upper(CASE WHEN currency IS NULL OR currency = '' THEN 'USD' ELSE currency END) AS currency,
       lower(COALESCE(ride_status, '')) AS ride_status
FROM bronze_ride""",
    "payment": f"""
SELECT COALESCE(payment_id, '') AS payment_id, COALESCE(ride_id, '') AS ride_id,
       CAST({_ts("payment_timestamp")} AS DATE) AS payment_date,
       COALESCE(payment_timestamp, '') AS payment_time,
       lower({_tidy("payment_method")}) AS payment_method,
       CASE WHEN amount < 0 THEN 0 ELSE amount END AS amount,
       upper(CASE WHEN currency IS NULL OR currency = '' THEN 'USD' ELSE currency END) AS currency,
       lower({_tidy("payment_status")}) AS payment_status
FROM bronze_payment""",
}


def _first(columns: list[str], key: str, source: str) -> str:
    """One row per key, the smallest by every other column, NULLs first."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns if c != key)
    return f"""
SELECT {", ".join(columns)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS place FROM ({source}) s
) t WHERE place = 1"""


PASSENGER = (
    "passenger_id first_name last_name email phone signup_timestamp city country status".split()
)
DRIVER = "driver_id first_name last_name signup_timestamp rating city country status".split()
VEHICLE = 'vehicle_id driver_id make model "year" vehicle_type license_plate'.split()
RIDE = (
    "ride_id passenger_id driver_id vehicle_id request_timestamp pickup_timestamp "
    "dropoff_timestamp pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude "
    "pickup_city dropoff_city distance_km duration_minutes fare_amount currency ride_status"
).split()
PAYMENT = (
    "payment_id ride_id payment_timestamp payment_method amount currency payment_status".split()
)


def _refined_driver(source: str) -> str:
    # Halves away from zero on the decimal digits of the value, not on its binary.
    rounded = "CAST(ROUND(CAST(rating AS DECIMAL(18, 8)), 2) AS DOUBLE)"
    return _first(
        DRIVER,
        "driver_id",
        f"""
SELECT * REPLACE ({_ts("signup_timestamp")} AS signup_timestamp, {rounded} AS rating)
FROM {source} WHERE status IN ('active', 'inactive')""",
    )


def _refined_passenger(source: str) -> str:
    return _first(
        PASSENGER,
        "passenger_id",
        f"""
SELECT * REPLACE ({_ts("signup_timestamp")} AS signup_timestamp)
FROM {source} WHERE email IS NOT NULL""",
    )


def _refined_vehicle(source: str) -> str:
    return _first(VEHICLE, "vehicle_id", f"SELECT * FROM {source} WHERE driver_id IS NOT NULL")


def _refined_ride(statuses: str) -> str:
    return _first(
        RIDE,
        "ride_id",
        f"""
SELECT * REPLACE ({_ts("request_timestamp")} AS request_timestamp,
                  {_ts("pickup_timestamp")} AS pickup_timestamp,
                  {_ts("dropoff_timestamp")} AS dropoff_timestamp)
FROM bronze_ride
WHERE ride_status IN ({statuses}) AND fare_amount > 0 AND distance_km > 0""",
    )


REFINED = {
    "driver": _refined_driver("bronze_driver"),
    "passenger": _refined_passenger("bronze_passenger"),
    "vehicle": _refined_vehicle("bronze_vehicle"),
    "payment": _first(
        PAYMENT,
        "payment_id",
        f"""
SELECT * REPLACE ({_ts("payment_timestamp")} AS payment_timestamp)
FROM bronze_payment WHERE payment_status = 'completed' AND amount > 0""",
    ),
    "ride": _refined_ride("'completed'"),
}
WIDE_RIDE = _refined_ride("'completed', 'cancelled'")


def _times_as_text(sql: str, columns: list[str]) -> str:
    shown = [
        f"CAST({c} AS VARCHAR) AS {c}" if c.endswith("_timestamp") else c for c in columns
    ]
    return f"SELECT {', '.join(shown)} FROM ({sql}) u"


# --- validation ------------------------------------------------------------


def _missing(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


def _outside(x: str, words: str) -> str:
    return f"({x} IS NULL OR {x} NOT IN ({words}))"


def _quote(x: str, ending: str) -> str:
    return f"'{x} ''' || COALESCE(CAST({x} AS VARCHAR), 'None') || ''' {ending}'"


ZONED = r"'^.{10}.+(Z|[+-]\d{2}:\d{2})$'"


def _zoned(x: str) -> str:
    return f"regexp_matches({x}, {ZONED})"


def _readable(x: str) -> str:
    return f"(({_ts(x)}) IS NOT NULL)"


def _later(a: str, b: str) -> str:
    return (
        f"(CASE WHEN {_zoned(a)} THEN TRY_CAST({a} AS TIMESTAMPTZ) > TRY_CAST({b} AS TIMESTAMPTZ) "
        f"ELSE ({_ts(a)}) > ({_ts(b)}) END)"
    )


_REQ, _PICK, _DROP = "request_timestamp", "pickup_timestamp", "dropoff_timestamp"
_TIME_STATE = f"""
CASE WHEN NOT ({" AND ".join(f"COALESCE({_readable(x)}, FALSE)" for x in (_REQ, _PICK, _DROP))})
       THEN 'format'
     WHEN {_zoned(_REQ)} <> {_zoned(_PICK)} THEN 'format'
     WHEN {_later(_REQ, _PICK)} THEN 'order'
     WHEN {_zoned(_PICK)} <> {_zoned(_DROP)} THEN 'format'
     WHEN {_later(_PICK, _DROP)} THEN 'order'
     ELSE 'fine' END"""

# entity -> [(code, condition that fails, message)]
FAILS = {
    "passenger": [
        *(
            (f"{c}_required", _missing(c), f"'{c} is required'")
            for c in ("passenger_id", "first_name", "last_name")
        ),
        (
            "email_format",
            r"NOT COALESCE(regexp_matches(email, "
            r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'), FALSE)",
            "'email is invalid or missing'",
        ),
        (
            "phone_format",
            r"NOT COALESCE(regexp_matches(phone, '^\+1[0-9]{10}$'), FALSE)",
            "'phone is invalid or missing'",
        ),
        (
            "status_allowed",
            _outside("status", "'active', 'inactive', 'suspended'"),
            _quote("status", "is invalid"),
        ),
    ],
    "driver": [
        *(
            (f"{c}_required", _missing(c), f"'{c} is required'")
            for c in ("driver_id", "first_name", "last_name")
        ),
        (
            "rating_range",
            "(rating IS NULL OR rating < 0 OR rating > 5)",
            _quote("rating", "must be between 0 and 5"),
        ),
        (
            "status_allowed",
            _outside("status", "'active', 'inactive', 'banned'"),
            _quote("status", "is invalid"),
        ),
    ],
    "vehicle": [
        (f"{c}_required", _missing(c), f"'{c} is required'")
        for c in ("vehicle_id", "driver_id", "license_plate")
    ],
    "ride": [
        *(
            (f"{c}_required", _missing(c), f"'{c} is required'")
            for c in ("ride_id", "passenger_id", "driver_id", "vehicle_id")
        ),
        (
            "timestamp_order",
            f"({_TIME_STATE}) = 'order'",
            "'timestamps out of order: request <= pickup <= dropoff'",
        ),
        ("timestamp_format", f"({_TIME_STATE}) = 'format'", "'invalid timestamp format'"),
        (
            "distance_range",
            "(distance_km IS NULL OR distance_km < 0)",
            _quote("distance_km", "must be >= 0"),
        ),
        (
            "fare_range",
            "(fare_amount IS NULL OR fare_amount < 0)",
            _quote("fare_amount", "must be >= 0"),
        ),
        (
            "duration_range",
            "(duration_minutes IS NULL OR duration_minutes < 0)",
            _quote("duration_minutes", "must be >= 0"),
        ),
        (
            "ride_status_allowed",
            _outside(
                "ride_status",
                "'completed', 'cancelled_by_driver', 'cancelled_by_passenger', 'no_show'",
            ),
            _quote("ride_status", "is invalid"),
        ),
    ],
    "payment": [
        *((f"{c}_required", _missing(c), f"'{c} is required'") for c in ("payment_id", "ride_id")),
        ("amount_range", "(amount IS NULL OR amount < 0)", _quote("amount", "must be >= 0")),
        (
            "payment_status_allowed",
            _outside("payment_status", "'completed', 'failed', 'pending'"),
            _quote("payment_status", "is invalid"),
        ),
    ],
}


def _bad(entity: str) -> str:
    return "(" + " OR ".join(f"({fails})" for _, fails, _ in FAILS[entity]) + ")"


def _codes(entity: str, separator: str = "|", part: int = 0) -> str:
    """Codes (part 0) or messages (part 2) of the failed rules, joined."""
    items = ", ".join(
        f"CASE WHEN {rule[1]} THEN {rule[2] if part else repr(rule[0])} END"
        for rule in FAILS[entity]
    )
    return f"concat_ws('{separator}', {items})"


def _errors(entity: str) -> str:
    """One row per failed rule: record, rule_no, error_code, error."""
    return " UNION ALL ".join(
        f"SELECT {entity}_id AS record, {i} AS rule_no, '{code}' AS error_code, "
        f"{message} AS error FROM bronze_{entity} WHERE {fails}"
        for i, (code, fails, message) in enumerate(FAILS[entity])
    )


def _report(entity: str) -> str:
    codes = sorted(code for code, _, _ in FAILS[entity])
    shown = ", ".join(
        f"(SELECT '{c}=' || COUNT(*) FROM errors WHERE error_code = '{c}' HAVING COUNT(*) > 0)"
        for c in codes
    )
    listed = ", ".join(
        f"CASE WHEN {fails} THEN {{'rule_no': {i}, 'error': {message}}} END"
        for i, (_, fails, message) in enumerate(FAILS[entity])
    )
    return f"""
WITH errors AS ({_errors(entity)}),
top AS (
  SELECT record, listed FROM (
    SELECT {entity}_id AS record, [x FOR x IN [{listed}] IF x IS NOT NULL] AS listed
    FROM bronze_{entity}) j
  WHERE len(listed) > 0 ORDER BY record NULLS FIRST, listed LIMIT 100),
quoted AS (SELECT record, listed, unnest(listed) AS one FROM top),
shown AS (SELECT * FROM quoted ORDER BY record NULLS FIRST, listed, one.rule_no LIMIT 100)
SELECT '{entity}' AS dataset, COUNT(*) AS records,
       COUNT(*) FILTER (WHERE NOT {_bad(entity)}) AS valid_records,
       COUNT(*) FILTER (WHERE {_bad(entity)}) AS invalid_records,
       CAST((COUNT(*) FILTER (WHERE NOT {_bad(entity)}) * 20000 + COUNT(*)) // (COUNT(*) * 2)
            AS DOUBLE) / 100 AS validity_rate,
       concat_ws(',', {shown}) AS checks,
       (SELECT COUNT(*) > 100 FROM errors) AS errors_truncated,
       (SELECT COALESCE(string_agg('Record ' || COALESCE(record, 'None') || ': ' || one.error, '|'
                                   ORDER BY record NULLS FIRST, listed, one.rule_no), '')
        FROM shown) AS errors
FROM bronze_{entity}"""


# --- gold ------------------------------------------------------------------


def _daily(source: str, date: str) -> str:
    done = "ride_status = 'completed'"
    return f"""
SELECT date, city, total_rides, completed_rides, total_rides - completed_rides AS cancelled_rides,
       total_distance_km, total_revenue, avg_fare, avg_distance_km, avg_duration_minutes
FROM (
  SELECT date, city, COUNT(*) AS total_rides,
         COUNT(*) FILTER (WHERE {done}) AS completed_rides,
         {_rounded("k", "1")} AS total_distance_km,
         {_rounded("f", "1")} AS total_revenue,
         {_rounded("f", "COUNT(f)")} AS avg_fare,
         {_rounded("k", "COUNT(k)")} AS avg_distance_km,
         {_rounded("m", "COUNT(m)")} AS avg_duration_minutes
  FROM (
    SELECT {date} AS date,
           trim(CASE WHEN pickup_city IS NULL OR pickup_city = '' THEN 'Unknown'
                     ELSE pickup_city END, '{BLANKS}') AS city,
           ride_status,
           CASE WHEN {done} THEN fare_amount END AS f,
           CASE WHEN {done} AND fare_amount IS NOT NULL THEN distance_km END AS k,
           CASE WHEN {done} AND fare_amount IS NOT NULL AND distance_km IS NOT NULL
                THEN duration_minutes END AS m
    FROM {source}
  ) r WHERE date IS NOT NULL GROUP BY date, city
) g"""


_DAY = "CAST(request_timestamp AS DATE)"
DAILY = _daily("ride", _DAY)


def _driver_daily(rides: str, date: str, ratings: str) -> str:
    return f"""
SELECT g.date, g.driver_id, completed_rides, total_distance_km, total_revenue,
       COALESCE(CAST(d.rating AS DOUBLE), 0.0) AS avg_rating
FROM (
  SELECT date, driver_id, COUNT(*) AS completed_rides,
         {_rounded("distance_km", "1")} AS total_distance_km,
         {_rounded("fare", "1")} AS total_revenue
  FROM (SELECT {date} AS date, driver_id, distance_km,
               CASE WHEN distance_km IS NOT NULL THEN fare_amount END AS fare
        FROM {rides} WHERE ride_status = 'completed') r
  WHERE date IS NOT NULL GROUP BY date, driver_id
) g LEFT JOIN ({ratings}) d ON g.driver_id = d.driver_id"""


def _performance(source: str) -> str:
    return f"""
SELECT driver_id, COUNT(ride_id) AS completed_rides, {_total("fare_amount")} AS total_revenue,
       {_mean("fare_amount")} AS avg_fare
FROM {source} WHERE ride_status = 'completed' GROUP BY driver_id"""


def _activity(source: str) -> str:
    return f"""
SELECT passenger_id, COUNT(ride_id) AS total_rides, {_total("fare_amount")} AS total_spent,
       {_mean("fare_amount")} AS avg_fare
FROM {source} GROUP BY passenger_id"""


_PERFORMANCE, _ACTIVITY = _performance("ride"), _activity("ride")


def _daily_rides(source: str) -> str:
    return f"""
SELECT {_DAY} AS request_date, COUNT(ride_id) AS total_rides, {_mean("fare_amount")} AS avg_fare
FROM {source} GROUP BY 1"""


def _daily_city(source: str) -> str:
    return f"""
SELECT {_DAY} AS request_date, pickup_city, COUNT(ride_id) AS total_rides,
       CAST(SUM(CASE WHEN ride_status = 'completed' THEN 1 ELSE 0 END) AS BIGINT)
         AS completed_rides,
       {_mean("fare_amount")} AS avg_fare, {_total("distance_km")} AS total_distance_km
FROM {source} GROUP BY 1, 2"""


def _violations(column: str, child: str, parent: str) -> str:
    return f"""
SELECT c.{column}, COUNT(*) AS row_count FROM {child} c
WHERE NOT EXISTS (SELECT 1 FROM ({parent}) p WHERE p.{column} = c.{column})
GROUP BY c.{column}"""


def _nulls(entity: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c.strip(chr(34))}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"COUNT(*) AS row_count FROM bronze_{entity}"
        for c in columns
    )


def _ranges(entity: str, bounds: dict[str, tuple[float, float]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} < {lo}) AS below, "
        f"COUNT(*) FILTER (WHERE {c} > {hi}) AS above, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS missing FROM bronze_{entity}"
        for c, (lo, hi) in bounds.items()
    )


_LAT1, _LON1 = "radians(pickup_latitude)", "radians(pickup_longitude)"
_LAT2, _LON2 = "radians(dropoff_latitude)", "radians(dropoff_longitude)"
# Spherical distance by the angle between unit vectors, not by the half-chord.
_CROSS = (
    f"sqrt(pow(cos({_LAT2}) * sin({_LON2} - {_LON1}), 2) + "
    f"pow(cos({_LAT1}) * sin({_LAT2}) - "
    f"sin({_LAT1}) * cos({_LAT2}) * cos({_LON2} - {_LON1}), 2))"
)
_DOT = f"(sin({_LAT1}) * sin({_LAT2}) + cos({_LAT1}) * cos({_LAT2}) * cos({_LON2} - {_LON1}))"
_KM = f"(6371.0 * atan2({_CROSS}, {_DOT}))"


def _layer_counts(style: str) -> str:
    parts = [("bronze", e, f"SELECT COUNT(*) FROM raw_{e}") for e in FAILS]
    if style == "records":
        parts += [("silver", e, f"SELECT COUNT(*) FROM raw_{e}") for e in FAILS]
        daily = _daily("bronze_ride", f"CAST({_ts('request_timestamp')} AS DATE)")
        drivers = f"""SELECT CAST({_ts("request_timestamp")} AS DATE) AS date, driver_id
                      FROM bronze_ride WHERE ride_status = 'completed' GROUP BY 1, 2
                      HAVING date IS NOT NULL"""
        parts += [
            ("gold", "ride_daily_metrics", f"SELECT COUNT(*) FROM ({daily}) x"),
            ("gold", "city_metrics", f"SELECT COUNT(*) FROM ({daily}) x"),
            ("gold", "driver_metrics", f"SELECT COUNT(*) FROM ({drivers}) x"),
        ]
    else:
        # Without the projection a missing number stays NULL; the strict filters
        # drop it and the default 0 alike.
        wide = style == "notebooks"
        ride = WIDE_RIDE if wide else REFINED["ride"]
        silver = {**REFINED, "ride": ride}
        parts += [("silver", e, f"SELECT COUNT(*) FROM ({q}) x") for e, q in silver.items()]
        grain = "1, pickup_city" if wide else "1"
        parts += [
            (
                "gold",
                "daily_ride_metrics",
                f"SELECT COUNT(*) FROM (SELECT {_DAY} AS day FROM ({ride}) y GROUP BY {grain}) x",
            ),
            (
                "gold",
                "driver_performance",
                f"SELECT COUNT(*) FROM (SELECT driver_id FROM ({ride}) y "
                f"WHERE ride_status = 'completed' GROUP BY 1) x",
            ),
            (
                "gold",
                "passenger_activity",
                f"SELECT COUNT(*) FROM (SELECT passenger_id FROM ({ride}) y GROUP BY 1) x",
            ),
        ]
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS entity, ({q}) AS record_count"
        for layer, name, q in parts
    )


# --- contents of tables ----------------------------------------------------

DOUBLES = (
    "rating pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude distance_km "
    "fare_amount amount avg_fare total_distance_km total_revenue avg_distance_km "
    "avg_duration_minutes avg_rating total_spent latitude longitude"
).split()


def _two(power: int) -> str:
    return f"CAST('{2.0**power!r}' AS DOUBLE)"


def _number_text(x: str) -> str:
    """Whole part and 60 binary places, small and large numbers scaled before."""

    def cut(band: str, y: str) -> str:
        places = f"trunc(({y} - trunc({y})) * {_two(60)})"
        return f"'{band}' || CAST(CAST(trunc({y}) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST({places} AS BIGINT) AS VARCHAR)"

    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'nan' "
        f"WHEN abs({x}) < {_two(-8)} THEN {cut('s', f'({x} * {_two(52)})')} "
        f"WHEN abs({x}) < {_two(62)} THEN {cut('', x)} "
        f"WHEN abs({x}) < {_two(122)} THEN {cut('l', f'({x} * {_two(-60)})')} "
        f"WHEN {x} > 0 THEN 'far' ELSE '-far' END"
    )


def _mark(text: str) -> str:
    return f"COALESCE('v' || length({text}) || ':' || {text}, 'n')"


def _marked(column: str) -> str:
    name, _, place = column.partition("=")
    if place:
        return _mark("(" + " || ".join(_marked(f"{name}_{part}") for part in place.split("+")) + ")")
    number = name in DOUBLES or name.endswith(("_latitude", "_longitude"))
    return _mark(f"({_number_text(name)})" if number else f"CAST({name} AS VARCHAR)")


def _contents(layer: str, entity: str, columns: list[str], source: str) -> str:
    row = " || ".join(_marked(c) for c in columns)

    def limb(first: int) -> str:
        return f"CAST(SUM(CAST('0x' || substr(h, {first}, 6) AS BIGINT)) AS BIGINT)"

    return (
        f"SELECT '{layer}' AS layer, '{entity}' AS entity, COUNT(*) AS record_count, "
        f"{limb(1)} AS digest_high, {limb(7)} AS digest_low "
        f"FROM (SELECT md5({row}) AS h FROM ({source}) x) y"
    )


_PLACE = "latitude+longitude+city"
_SILVER_RECORDS = {
    "passenger": "passenger_id first_name last_name email phone signup_date city country status",
    "driver": "driver_id first_name last_name signup_date rating city country status",
    "vehicle": 'vehicle_id driver_id make model "year" vehicle_type license_plate',
    "ride": (
        "ride_id passenger_id driver_id vehicle_id request_date request_time pickup_time dropoff_time "
        f"pickup_location={_PLACE} dropoff_location={_PLACE} distance_km duration_minutes fare_amount "
        "currency ride_status"
    ),
    "payment": "payment_id ride_id payment_date payment_time payment_method amount currency payment_status",
}
_RECORDS_DAY = f"CAST({_ts('request_timestamp')} AS DATE)"
_LAST_RATING = """SELECT driver_id, rating FROM (
    SELECT driver_id, rating, row_number() OVER (
      PARTITION BY driver_id
      ORDER BY signup_timestamp DESC NULLS LAST, rating DESC NULLS LAST) AS place
    FROM bronze_driver) q WHERE place = 1"""


def _layer_contents(style: str) -> str:
    """Rows and digests of the 13 tables of a run."""
    columns = {"passenger": PASSENGER, "driver": DRIVER, "vehicle": VEHICLE, "ride": RIDE, "payment": PAYMENT}
    parts = [("bronze", e, names, f"SELECT * FROM bronze_{e}") for e, names in columns.items()]
    if style == "records":
        parts += [("silver", e, names.split(), NORMALISED[e]) for e, names in _SILVER_RECORDS.items()]
        daily = _daily("bronze_ride", _RECORDS_DAY)
        gold = {
            "ride_daily_metrics": (
                "date city total_rides completed_rides cancelled_rides total_distance_km total_revenue "
                "avg_fare avg_distance_km avg_duration_minutes",
                daily,
            ),
            "city_metrics": (
                "date city total_rides completed_rides total_revenue avg_fare avg_distance_km",
                daily,
            ),
            "driver_metrics": (
                "date driver_id completed_rides total_distance_km total_revenue avg_rating",
                _driver_daily("bronze_ride", _RECORDS_DAY, _LAST_RATING),
            ),
        }
    else:
        wide = style == "notebooks"
        ride = WIDE_RIDE if wide else REFINED["ride"]
        silver = {**REFINED, "ride": ride}
        parts += [("silver", e, columns[e], q) for e, q in silver.items()]
        performance, activity = _performance(f"({ride}) r"), _activity(f"({ride}) r")
        gold = {
            "daily_ride_metrics": ("request_date total_rides avg_fare", _daily_rides(f"({ride}) r")),
            "driver_performance": ("driver_id completed_rides total_revenue avg_fare", performance),
            "passenger_activity": ("passenger_id total_rides total_spent avg_fare", activity),
        }
        if wide:
            gold = {
                "daily_ride_metrics": (
                    "request_date pickup_city total_rides completed_rides avg_fare total_distance_km",
                    _daily_city(f"({ride}) r"),
                ),
                "driver_performance": (
                    "driver_id completed_rides total_revenue avg_fare rating",
                    f"SELECT g.*, d.rating FROM ({performance}) g LEFT JOIN ({REFINED['driver']}) d USING (driver_id)",
                ),
                "passenger_activity": (
                    "passenger_id total_rides total_spent avg_fare city status",
                    f"""SELECT g.*, p.city, p.status FROM ({activity}) g
                        LEFT JOIN ({REFINED["passenger"]}) p USING (passenger_id)""",
                ),
            }
    parts += [("gold", name, names.split(), q) for name, (names, q) in gold.items()]
    return " UNION ALL ".join(_contents(*p) for p in parts)


# --- declared tables -------------------------------------------------------

# Columns as name, type and whether a value is required (`!`).
_PLACE_TYPES = " ".join(
    f"{end}_location_{part}" for end in ("pickup", "dropoff") for part in ("latitude:9.6", "longitude:9.6", "city")
)
DECLARED = {
    "silver_ride": (
        "ride_id! passenger_id! driver_id! vehicle_id! request_date request_time:ts! pickup_time:ts! "
        f"dropoff_time:ts! {_PLACE_TYPES} distance_km:6.2! duration_minutes! fare_amount:8.2! currency! "
        "ride_status! valid_record data_quality_checks"
    ),
    "silver_payment": (
        "payment_id! ride_id! payment_date payment_time:ts! payment_method! amount:8.2! currency! "
        "payment_status! valid_record"
    ),
    "silver_passenger": "passenger_id! first_name! last_name! email! phone! signup_date city! country! status!",
    "gold_ride_daily_metrics": (
        "date! city! total_rides! completed_rides! cancelled_rides! total_distance_km:10.2! "
        "total_revenue:10.2! avg_fare:8.2! avg_distance_km:6.2! avg_duration_minutes:6.2!"
    ),
    "gold_driver_metrics": "date! driver_id! completed_rides! total_distance_km:10.2! total_revenue:10.2! avg_rating:2.1",
    "gold_city_metrics": (
        "date! city! total_rides! completed_rides! total_revenue:10.2! avg_fare:8.2! avg_distance_km:6.2!"
    ),
}


def _declared_columns(table: str) -> list[tuple[str, str, str, bool]]:
    """(name, value in its type, value as it is compared, required)."""
    out = []
    for text in DECLARED[table].split():
        name, _, kind = text.rstrip("!").partition(":")
        typed = shown = name
        if kind == "ts":
            typed = f"({_ts(name)})"
            shown = f"CAST({typed} AS VARCHAR)"
        elif kind:
            # By the decimal text of the number, as rounding its binary may go the other way.
            typed = f"TRY_CAST(CAST({name} AS VARCHAR) AS DECIMAL({kind.replace('.', ', ')}))"
            shown = f"CAST({typed} AS DOUBLE)"
        out.append((name, typed, shown, text.endswith("!")))
    return out


def _declared_sources() -> dict[str, tuple[str, tuple[str, ...]]]:
    """(rows before the gate, bronze entities they need)."""
    checks = ", ".join(
        f"'{code}=' || CASE WHEN {fails} THEN 'false' ELSE 'true' END" for code, fails, _ in sorted(FAILS["ride"])
    )
    ride = NORMALISED["ride"].replace(
        "FROM bronze_ride",
        f", NOT {_bad('ride')} AS valid_record, concat_ws(',', {checks}) AS data_quality_checks FROM bronze_ride",
    )
    payment = NORMALISED["payment"].replace("FROM bronze_payment", f", NOT {_bad('payment')} AS valid_record FROM bronze_payment")
    daily = _daily("bronze_ride", _RECORDS_DAY)
    return {
        "silver_ride": (ride, ("ride",)),
        "silver_payment": (payment, ("payment",)),
        "silver_passenger": (NORMALISED["passenger"], ("passenger",)),
        "gold_ride_daily_metrics": (daily, ("ride",)),
        "gold_city_metrics": (daily, ("ride",)),
        "gold_driver_metrics": (_driver_daily("bronze_ride", _RECORDS_DAY, _LAST_RATING), ("ride", "driver")),
    }


def _declared(table: str) -> str:
    source, entities = _declared_sources()[table]
    columns = _declared_columns(table)
    keep = " AND ".join(
        f"{typed} IS NOT NULL" if required else f"({name} IS NULL OR {typed} IS NOT NULL)"
        for name, typed, _, required in columns
        if required or typed != name
    )
    shown = ", ".join(f"{value} AS {name}" for name, _, value, _ in columns)
    return _over_bronze(f"SELECT {shown} FROM ({source}) s WHERE {keep}", *entities)


def _refusals() -> str:
    parts, every = [], set()
    for table, (source, entities) in _declared_sources().items():
        every |= set(entities)
        for name, typed, _, required in _declared_columns(table):
            tests = [("missing", f"{name} IS NULL")] if required else []
            if typed != name:
                tests.append(("unfit", f"{name} IS NOT NULL AND {typed} IS NULL"))
            parts += [
                f"SELECT '{table}' AS table_name, '{name}_{code}' AS code, COUNT(*) AS records "
                f"FROM ({source}) s WHERE {test} HAVING COUNT(*) > 0"
                for code, test in tests
            ]
    return _over_bronze(" UNION ALL ".join(parts), *sorted(every))


# --- assembly --------------------------------------------------------------


def _over_bronze(sql: str, *entities: str, bronze: dict[str, str] = BRONZE) -> str:
    """`sql` over bronze views of the given entities."""
    ctes = ", ".join(f"bronze_{e} AS ({bronze[e]})" for e in entities)
    body = sql.strip()
    rest = f", {body[5:]}" if body.startswith("WITH ") else f" {body}"
    return with_views(f"WITH {ctes}{rest}", *(f"raw_{e}" for e in entities))


def oracle_sql(bounds: dict[str, dict[str, tuple[float, float]]]) -> dict[str, str]:
    from_views = {
        "ride_daily_metrics": (DAILY, "ride"),
        "city_metrics": (
            f"""SELECT date, city, total_rides, completed_rides, total_revenue, avg_fare,
                       avg_distance_km FROM ({DAILY}) d""",
            "ride",
        ),
        "driver_daily_metrics": (
            _driver_daily(
                "ride",
                _DAY,
                "SELECT driver_id, MAX(rating) AS rating FROM driver GROUP BY driver_id",
            ),
            "ride",
            "driver",
        ),
        "daily_rides_by_date": (_daily_rides("ride"), "ride"),
        "daily_rides_by_city": (_daily_city("ride"), "ride"),
        "driver_performance": (_PERFORMANCE, "ride"),
        "driver_performance_with_rating": (
            f"""SELECT g.*, d.rating FROM ({_PERFORMANCE}) g
                LEFT JOIN ({_refined_driver("driver")}) d ON g.driver_id = d.driver_id""",
            "ride",
            "driver",
        ),
        "passenger_activity": (_ACTIVITY, "ride"),
        "passenger_activity_with_profile": (
            f"""SELECT g.*, p.city, p.status FROM ({_ACTIVITY}) g
                LEFT JOIN ({_refined_passenger("passenger")}) p
                  ON g.passenger_id = p.passenger_id""",
            "ride",
            "passenger",
        ),
        "rides_by_city": (
            f"""SELECT city, CAST(SUM(total_rides) AS BIGINT) AS rides
                FROM ({DAILY}) d GROUP BY city""",
            "ride",
        ),
        "rows_by_city": (
            f"SELECT city, COUNT(*) AS rides FROM ({DAILY}) d GROUP BY city",
            "ride",
        ),
        "entity_row_counts": (
            "SELECT entity, COUNT(*) AS record_count FROM ("
            + " UNION ALL ".join(f"SELECT '{e}' AS entity FROM {e}" for e in FAILS)
            + ") u GROUP BY entity ORDER BY entity",
            *FAILS,
        ),
        "ride_count": ("SELECT COUNT(*) AS rides FROM ride", "ride"),
        "distinct_passengers": (
            "SELECT COUNT(DISTINCT passenger_id) AS distinct_passenger_id FROM ride",
            "ride",
        ),
        "first_drivers": (
            _times_as_text(_refined_driver("driver"), DRIVER) + " ORDER BY driver_id LIMIT 10",
            "driver",
        ),
        "contact_formats": (
            f"""SELECT passenger_id, NOT ({FAILS["passenger"][3][1]}) AS email_ok,
                       NOT ({FAILS["passenger"][4][1]}) AS phone_ok FROM raw_passenger""",
            "raw_passenger",
        ),
        "parsed_times": (
            "SELECT ride_id, "
            + ", ".join(
                f"CAST({_ts(f'{n}_timestamp')} AS VARCHAR) AS {n}"
                for n in ("request", "pickup", "dropoff")
            )
            + " FROM raw_ride",
            "raw_ride",
        ),
        "fk_ride_passenger": (
            _violations("passenger_id", "ride", "SELECT passenger_id FROM passenger"),
            "ride",
            "passenger",
        ),
        "fk_ride_driver": (
            _violations("driver_id", "ride", "SELECT driver_id FROM driver"),
            "ride",
            "driver",
        ),
        "fk_ride_vehicle": (
            _violations("vehicle_id", "ride", "SELECT vehicle_id FROM vehicle"),
            "ride",
            "vehicle",
        ),
        "fk_payment_ride": (
            _violations("ride_id", "payment", "SELECT ride_id FROM ride"),
            "payment",
            "ride",
        ),
        "fk_vehicle_driver": (
            _violations("driver_id", "vehicle", "SELECT driver_id FROM driver"),
            "vehicle",
            "driver",
        ),
        "fk_all": (
            " UNION ALL ".join(
                f"""SELECT '{child}' AS child, '{column}' AS column_name, '{parent}' AS parent,
                           CAST({column} AS VARCHAR) AS key_value, row_count
                    FROM ({_violations(column, child, f"SELECT {column} FROM {parent}")}) v"""
                for child, column, parent in (
                    ("ride", "passenger_id", "passenger"),
                    ("ride", "driver_id", "driver"),
                    ("ride", "vehicle_id", "vehicle"),
                    ("payment", "ride_id", "ride"),
                    ("vehicle", "driver_id", "driver"),
                )
            ),
            *FAILS,
        ),
        "orphan_payments": (
            """SELECT payment_id, ride_id, amount, payment_status FROM payment
               WHERE ride_id IS NULL OR ride_id NOT IN (SELECT ride_id FROM ride)""",
            "payment",
            "ride",
        ),
        "duplicate_ride_ids": (
            "SELECT ride_id, COUNT(*) AS row_count FROM ride GROUP BY 1 HAVING COUNT(*) > 1",
            "ride",
        ),
        "haversine_fare": (
            f"""SELECT ride_id, ROUND({_KM}, 3) AS great_circle_km,
                       ROUND(2.5 + 1.25 * {_KM} + 0.25 * duration_minutes, 2) AS fare
                FROM ride""",
            "ride",
        ),
        **{f"layer_counts_{s}": None for s in ("jobs", "notebooks", "records")},
    }
    out = {k: with_views(v[0], *v[1:]) for k, v in from_views.items() if v}
    for s in ("jobs", "notebooks", "records"):
        out[f"layer_counts_{s}"] = _over_bronze(_layer_counts(s), *FAILS)
        own = BRONZE if s == "records" else TYPED
        out[f"layer_contents_{s}"] = _over_bronze(_layer_contents(s), *FAILS, bronze=own)
    out["daily_metrics_from_records"] = _over_bronze(_daily("bronze_ride", _RECORDS_DAY), "ride")
    out["driver_metrics_from_records"] = _over_bronze(
        _driver_daily("bronze_ride", _RECORDS_DAY, _LAST_RATING),
        "ride",
        "driver",
    )
    out["daily_metrics_by_landing_days"] = out["daily_metrics_from_records"]
    out["driver_metrics_by_landing_days"] = out["driver_metrics_from_records"]
    out["daily_city_from_silver"] = _over_bronze(_daily_city(f"({WIDE_RIDE}) s"), "ride")
    columns = {
        "passenger": PASSENGER,
        "driver": DRIVER,
        "vehicle": VEHICLE,
        "ride": RIDE,
        "payment": PAYMENT,
    }
    for e, names in columns.items():
        out[f"bronze_{e}"] = _over_bronze(f"SELECT * FROM bronze_{e}", e)
        out[f"norm_{e}"] = _over_bronze(NORMALISED[e], e)
        out[f"silver_{e}"] = _over_bronze(_times_as_text(REFINED[e], names), e)
        out[f"check_{e}"] = _over_bronze(
            f"""SELECT {e}_id, {_codes(e)} AS error_codes, NOT {_bad(e)} AS valid_record
                FROM bronze_{e}""",
            e,
        )
        out[f"quality_report_{e}"] = _over_bronze(_report(e), e)
        out[f"quality_report_by_days_{e}"] = out[f"quality_report_{e}"]
    out["bronze_from_landing"] = out["bronze_ride"]
    out["norm_raw_driver"] = out["norm_driver"]
    out["norm_raw_ride"] = out["norm_ride"]
    # Straight from raw text a missing year becomes 2000, not bronze's 0.
    out["norm_raw_vehicle"] = with_views(
        f"""WITH bronze_vehicle AS (
              SELECT vehicle_id, driver_id, make, model, {_int('"year"', 2000)}, vehicle_type,
                     license_plate FROM raw_vehicle) {NORMALISED["vehicle"]}""",
        "raw_vehicle",
    )
    out["silver_ride_wide"] = _over_bronze(_times_as_text(WIDE_RIDE, RIDE), "ride")
    out["silver_ride_table"] = _over_bronze(
        f"""SELECT pickup_city, COUNT(*) AS rides, COUNT(DISTINCT passenger_id) AS passengers
            FROM ({REFINED["ride"]}) s GROUP BY 1""",
        "ride",
    )
    ride_checks = ", ".join(
        f"'{code}=' || CASE WHEN {fails} THEN 'false' ELSE 'true' END"
        for code, fails, _ in sorted(FAILS["ride"])
    )
    out["norm_ride_checked"] = _over_bronze(
        f"""SELECT COALESCE(ride_id, '') AS ride_id, lower(COALESCE(ride_status, '')) AS ride_status,
                   NOT {_bad("ride")} AS valid_record,
                   concat_ws(',', {ride_checks}) AS data_quality_checks
            FROM bronze_ride""",
        "ride",
    )
    out["norm_payment_checked"] = _over_bronze(
        f"""SELECT payment_id, lower({_tidy("payment_status")}) AS payment_status,
                   NOT {_bad("payment")} AS valid_record FROM bronze_payment""",
        "payment",
    )
    for e in FAILS:
        out[f"failure_messages_{e}"] = _over_bronze(
            f"SELECT error_code, error, COUNT(*) AS records FROM ({_errors(e)}) x GROUP BY 1, 2", e
        )
    out["quarantined_rides"] = _over_bronze(
        f"""SELECT ride_id, request_timestamp, {_codes("ride", "|", 2)} AS errors
            FROM bronze_ride WHERE {_bad("ride")}""",
        "ride",
    )
    out["quarantine_from_files"] = _over_bronze(
        f"""SELECT payment_id, amount, {_codes("payment", "|", 2)} AS errors
            FROM bronze_payment WHERE {_bad("payment")}""",
        "payment",
    )
    out["quarantine_counts"] = _over_bronze(
        " UNION ALL ".join(
            f"SELECT '{e}' AS entity, '{side}' AS side, COUNT(*) AS records "
            f"FROM bronze_{e} WHERE {test}"
            for e in FAILS
            for side, test in (("good", f"NOT {_bad(e)}"), ("bad", _bad(e)))
        ),
        *FAILS,
    )
    out["duplicate_license_plates"] = _over_bronze(
        f"""SELECT license_plate, COUNT(*) AS row_count FROM ({NORMALISED["vehicle"]}) v
            GROUP BY 1 HAVING COUNT(*) > 1""",
        "vehicle",
    )
    for e, names in columns.items():
        out[f"null_profile_{e}"] = _over_bronze(_nulls(e, names), e)
        out[f"error_rows_{e}"] = _over_bronze(
            f"SELECT CAST(record AS VARCHAR) AS record, error_code, error FROM ({_errors(e)}) x", e
        )
    for e, own in bounds.items():
        out[f"range_profile_{e}"] = _over_bronze(_ranges(e, own), e)
    out["norm_raw_passenger"] = out["norm_passenger"]
    out["norm_raw_payment"] = out["norm_payment"]
    out["silver_listing"] = _over_bronze(
        " UNION ALL ".join(
            f"SELECT 'silver_{e}' AS table_name, COUNT(*) AS records FROM ({REFINED[e]}) {e[0]}"
            for e in ("passenger", "driver", "vehicle")
        ),
        "passenger",
        "driver",
        "vehicle",
    )
    out["payments_as_lines"] = with_views("SELECT * FROM raw_payment", "raw_payment")
    out["landed_lines"] = with_views(
        """SELECT CASE WHEN payment_id LIKE '%7' THEN 'malformed' ELSE 'record' END AS kind,
                  COUNT(*) AS lines,
                  CAST(SUM(CASE WHEN payment_id LIKE '%7' THEN 20 ELSE LENGTH(payment_id) END)
                       AS BIGINT) AS characters
           FROM raw_payment GROUP BY 1""",
        "raw_payment",
    )
    is_record = "NOT (payment_id LIKE '%7' OR payment_id LIKE '%3' OR payment_id LIKE '%5')"
    only_id = """'{"payment_id":"' || payment_id || '"}'"""
    out |= {f"declared_{t}": _declared(t) for t in DECLARED}
    out["refused_by_declared_tables"] = _refusals()
    out["routed_lines"] = _over_bronze(
        f"""SELECT CASE WHEN {_bad("payment")} THEN 'invalid' ELSE 'valid' END AS destination,
                   payment_id, amount,
                   CASE WHEN {_bad("payment")} THEN {_codes("payment")} END AS error_codes,
                   NULL AS line
            FROM bronze_payment WHERE {is_record}
            UNION ALL
            SELECT 'malformed', NULL, NULL, NULL,
                   CASE WHEN payment_id LIKE '%7' THEN substr({only_id}, 1, 16)
                        WHEN payment_id LIKE '%3' THEN {only_id} || ' ' || {only_id}
                        ELSE {only_id} || ' trailing' END
            FROM bronze_payment WHERE NOT ({is_record})""",
        "payment",
    )
    out["report_file"] = _over_bronze(
        f"""SELECT dataset, records, valid_records, invalid_records, validity_rate
            FROM ({_report("ride")}) r""",
        "ride",
    )
    return out
