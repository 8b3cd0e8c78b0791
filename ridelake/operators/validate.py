"""Validation rules as column expressions: no UDF, no shuffle.

Each rule has a stable code, a boolean column and a message, which may quote the
offending value. Messages are fixed wording.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import as_timestamp, is_email, is_phone, is_present, parse_double, parse_int
from ridelake.functions.timestamps import has_zone
from ridelake.operators.bronze import field

# Allowed status words per entity.
STATUSES = {
    "passenger": ["active", "inactive", "suspended"],
    "driver": ["active", "inactive", "banned"],
    "ride": ["completed", "cancelled_by_driver", "cancelled_by_passenger", "no_show"],
    "payment": ["completed", "failed", "pending"],
}


RIDE_TIMES = ("request_timestamp", "pickup_timestamp", "dropoff_timestamp")


@dataclass(frozen=True)
class Rule:
    code: str
    passed: Column
    message: Column


def _rule(code: str, passed: Column, message: Column | str) -> Rule:
    text = F.lit(message) if isinstance(message, str) else message
    return Rule(code, F.coalesce(passed, F.lit(False)), text)


def _quoted(df: DataFrame, name: str, ending: str) -> Column:
    shown = F.coalesce(field(df, name).cast("string"), F.lit("None"))
    return F.concat(F.lit(f"{name} '"), shown, F.lit(f"' {ending}"))


def required(df: DataFrame, *names: str) -> list[Rule]:
    return [
        _rule(f"{n}_required", is_present(field(df, n)), f"{n} is required") for n in names
    ]


def in_range(df: DataFrame, name: str, code: str, ending: str, low, high=None, kind="double") -> Rule:
    """`name` is a number in [low, high]; unreadable text counts as out of range."""
    c = field(df, name)
    if kind == "int":
        value = parse_int(c)
    elif name in df.columns and isinstance(df.schema[name].dataType, T.NumericType):
        value = c
    else:
        value = parse_double(c)
    ok = value >= low if high is None else value.between(low, high)
    return _rule(code, ok, _quoted(df, name, ending))


def allowed(df: DataFrame, name: str, words: list[str]) -> Rule:
    return _rule(f"{name}_allowed", field(df, name).isin(words), _quoted(df, name, "is invalid"))


# Verdicts on a triple of timestamps.
TIMES_FINE, TIMES_DISORDERED, TIMES_MALFORMED = 0, 1, 2


def time_verdict(df: DataFrame, first: str, second: str, third: str) -> DataFrame:
    """Append `_times`: whether three timestamps are well formed and in order.

    Zoned and naive times cannot be compared: a mixture is malformed, unless the
    first two alone already show the wrong order. The readings are columns of
    their own, so that each text is parsed once.
    """
    names = (first, second, third)
    wall, zoned, point = {}, {}, {}
    for n in names:
        known = n in df.columns
        text = known and isinstance(df.schema[n].dataType, T.StringType)
        wall[f"_{n}_wall"] = as_timestamp(df, n) if known else F.lit(None).cast("timestamp_ntz")
        zoned[f"_{n}_zoned"] = has_zone(F.col(n)) if text else F.lit(False)
        # Only looked at for zoned values, and only read for them: few texts have a zone.
        moment = F.when(has_zone(F.col(n)), F.col(n).try_cast("timestamp")) if text else F.lit(None)
        point[f"_{n}_point"] = moment.cast("timestamp")

    def part(n: str, what: str) -> Column:
        return F.col(f"_{n}_{what}")

    def later(a: str, b: str) -> Column:
        return F.when(part(a, "zoned"), part(a, "point") > part(b, "point")).otherwise(
            part(a, "wall") > part(b, "wall")
        )

    unreadable = F.lit(False)
    for n in names:
        unreadable = unreadable | part(n, "wall").isNull()
    verdict = F.when(unreadable, TIMES_MALFORMED)
    for a, b in ((first, second), (second, third)):
        verdict = verdict.when(part(a, "zoned") != part(b, "zoned"), TIMES_MALFORMED)
        verdict = verdict.when(later(a, b), TIMES_DISORDERED)
    parsed = df.withColumns({**wall, **zoned, **point})
    return parsed.withColumn("_times", verdict.otherwise(TIMES_FINE))


def in_time_order() -> list[Rule]:
    """The two rules on `time_verdict`."""
    return [
        _rule(
            "timestamp_order",
            F.col("_times") != TIMES_DISORDERED,
            "timestamps out of order: request <= pickup <= dropoff",
        ),
        _rule("timestamp_format", F.col("_times") != TIMES_MALFORMED, "invalid timestamp format"),
    ]


def passenger_rules(df: DataFrame) -> list[Rule]:
    return [
        *required(df, "passenger_id", "first_name", "last_name"),
        _rule("email_format", is_email(field(df, "email")), "email is invalid or missing"),
        _rule("phone_format", is_phone(field(df, "phone")), "phone is invalid or missing"),
        allowed(df, "status", STATUSES["passenger"]),
    ]


def driver_rules(df: DataFrame) -> list[Rule]:
    return [
        *required(df, "driver_id", "first_name", "last_name"),
        in_range(df, "rating", "rating_range", "must be between 0 and 5", 0, 5),
        allowed(df, "status", STATUSES["driver"]),
    ]


def vehicle_rules(df: DataFrame) -> list[Rule]:
    return required(df, "vehicle_id", "driver_id", "license_plate")


def ride_rules(df: DataFrame) -> list[Rule]:
    return [
        *required(df, "ride_id", "passenger_id", "driver_id", "vehicle_id"),
        *in_time_order(),
        in_range(df, "distance_km", "distance_range", "must be >= 0", 0),
        in_range(df, "fare_amount", "fare_range", "must be >= 0", 0),
        in_range(df, "duration_minutes", "duration_range", "must be >= 0", 0, kind="int"),
        allowed(df, "ride_status", STATUSES["ride"]),
    ]


def payment_rules(df: DataFrame) -> list[Rule]:
    return [
        *required(df, "payment_id", "ride_id"),
        in_range(df, "amount", "amount_range", "must be >= 0", 0),
        allowed(df, "payment_status", STATUSES["payment"]),
    ]


RULES = {
    "passenger": passenger_rules,
    "driver": driver_rules,
    "vehicle": vehicle_rules,
    "ride": ride_rules,
    "payment": payment_rules,
}


def judge(df: DataFrame, entity: str) -> tuple[DataFrame, list[Rule]]:
    """`df` with one boolean column per rule, and the rules that refer to them.

    Codes, messages, the valid flag and the counts all look at the same rules;
    as columns each rule is evaluated once per row.
    """
    timed = time_verdict(df, *RIDE_TIMES) if entity == "ride" else df
    rules = RULES[entity](timed)
    judged = timed.withColumns({f"_{r.code}": r.passed for r in rules})
    return judged, [Rule(r.code, F.col(f"_{r.code}"), r.message) for r in rules]


def all_pass(rules: list[Rule]) -> Column:
    out = F.lit(True)
    for r in rules:
        out = out & r.passed
    return out


def check_map(rules: list[Rule]) -> Column:
    """map<rule code, passed>."""
    return F.create_map(*(part for r in rules for part in (F.lit(r.code), r.passed)))


FAILURES = "array<struct<rule_no: int, code: string, message: string>>"


def failures(rules: list[Rule]) -> Column:
    """array<struct<rule_no, code, message>> of the failed rules, in rule order.

    Most rows fail none: their array is a constant, and no messages are looked at.
    """
    failed = F.array_compact(
        F.array(
            *(
                F.when(
                    ~r.passed,
                    F.struct(
                        F.lit(i).alias("rule_no"),
                        F.lit(r.code).alias("code"),
                        r.message.alias("message"),
                    ),
                )
                for i, r in enumerate(rules)
            )
        )
    )
    return F.when(all_pass(rules), F.array().cast(FAILURES)).otherwise(failed)


def validate(df: DataFrame, entity: str) -> DataFrame:
    """Append `errors`, `error_codes` and `valid_record` to each row."""
    judged, rules = judge(df, entity)
    failed = F.col("_failures")
    return (
        judged.withColumn("_failures", failures(rules))
        .select(
            *df.columns,
            failed["message"].alias("errors"),
            failed["code"].alias("error_codes"),
            all_pass(rules).alias("valid_record"),
        )
    )


def split_quarantine(df: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows as they came, invalid rows with their errors)."""
    judged, rules = judge(df, entity)
    good = judged.filter(all_pass(rules)).select(*df.columns)
    bad = validate(df, entity).filter(~F.col("valid_record")).drop("valid_record")
    return good, bad
