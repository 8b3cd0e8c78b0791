"""Data-quality reports over validated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.validate import Rule, all_pass, failures, judge
from ridelake.session import setting
from ridelake.sources.scratch import written

# Fixed value: a report quotes this many errors unless asked for another number.
SHOWN_ERRORS = 100


def verdicts(df: DataFrame, entity: str, key: str | None = None) -> DataFrame:
    """(record, valid, failures) of each row: its key, and its failed rules in order."""
    return _verdicts(*judge(df, entity), key or f"{entity}_id")


def _verdicts(judged: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    return judged.select(
        F.col(key).cast("string").alias("record"),
        all_pass(rules).alias("valid"),
        failures(rules).alias("failures"),
    )


#: What a report is made of, and can be made of again: counts, and the first errors with their places.
STATE = (
    "dataset STRING, shown INT, records BIGINT, valid_records BIGINT, failures BIGINT, checks MAP<STRING, BIGINT>, "
    "errors ARRAY<STRUCT<place: STRUCT<record: STRING, "
    "failures: ARRAY<STRUCT<rule_no: INT, code: STRING, message: STRING>>, rule_no: INT>, record: STRING, error: STRING>>"
)


def report_state(
    df: DataFrame, entity: str, key: str | None = None, dataset: str | None = None, shown: int = SHOWN_ERRORS
) -> DataFrame:
    """One row of `STATE` over the records of `df`, such as those of one day.

    The records are read and judged once: they are counted as they go by, and only the
    failing ones are written, for the first `shown` errors.
    """
    judged, rules = judge(df, entity)
    watch = Observation()
    # The rules themselves are counted: their columns are there, as booleans.
    counted = judged.observe(
        watch,
        F.count(F.lit(1)).alias("_records"),
        F.count_if(all_pass(rules)).alias("_valid_records"),
        *(F.count_if(~r.passed).alias(r.code) for r in rules),
    )
    bad = written(_verdicts(counted.filter(~all_pass(rules)), rules, key or f"{entity}_id"))
    seen = watch.get
    quoted = F.array_sort(F.collect_list(F.struct("place", "record", "error")))
    checks = {r.code: seen[r.code] for r in rules if seen[r.code]}
    pairs = F.create_map(*(F.lit(x) for pair in checks.items() for x in pair)) if checks else F.lit(None)
    state = _first(bad, shown).agg(quoted.alias("errors"))
    return state.select(
        F.lit(dataset or entity).alias("dataset"),
        F.lit(shown).alias("shown"),
        F.lit(seen["_records"]).cast("bigint").alias("records"),
        F.lit(seen["_valid_records"]).cast("bigint").alias("valid_records"),
        F.lit(sum(checks.values())).cast("bigint").alias("failures"),
        F.coalesce(pairs.cast("map<string,bigint>"), F.map_from_arrays(F.array(), F.array()).cast("map<string,bigint>")).alias("checks"),
        "errors",
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One row of `STATE` for each dataset, out of those of its parts, in any order.

    Counts are added; the first errors of all are among the first of each part. A state
    holds at most `shown` errors, so a dataset's row here takes as many times its parts.
    """
    every = F.flatten(F.collect_list("errors"))
    pairs = F.flatten(F.collect_list(F.map_entries("checks")))
    sums = states.groupBy("dataset").agg(
        F.min("shown").alias("shown"),
        *(F.sum(c).cast("bigint").alias(c) for c in ("records", "valid_records", "failures")),
        pairs.alias("pairs"),
        F.array_sort(every).alias("errors"),
    )
    codes = F.array_sort(F.array_distinct(F.col("pairs.key")))
    total = F.transform(
        codes,
        lambda code: F.aggregate(
            F.filter("pairs", lambda p: p["key"] == code), F.lit(0).cast("bigint"), lambda n, p: n + p["value"]
        ),
    )
    return sums.select(
        "dataset",
        "shown",
        "records",
        "valid_records",
        "failures",
        F.map_from_arrays(codes, total).alias("checks"),
        F.slice("errors", F.lit(1), F.col("shown")).alias("errors"),
    )


def report_of(states: DataFrame) -> DataFrame:
    """The report that each row of `STATE` makes."""
    total, good = F.col("records"), F.col("valid_records")
    # Hundredths of a percent as an integer: exact, halves up.
    rate = F.call_function("div", good * 20000 + total, F.greatest(total, F.lit(1)) * 2)
    return states.select(
        "dataset",
        "records",
        "valid_records",
        (total - good).alias("invalid_records"),
        F.when(total == 0, F.lit(0.0)).otherwise(rate / 100).alias("validity_rate"),
        "checks",
        (F.col("failures") > F.col("shown")).alias("errors_truncated"),
        F.transform(
            "errors",
            lambda e: F.concat(F.lit("Record "), F.coalesce(e["record"], F.lit("None")), F.lit(": "), e["error"]),
        ).alias("errors"),
    )


def quality_report(
    df: DataFrame,
    entity: str,
    key: str | None = None,
    dataset: str | None = None,
    shown: int = SHOWN_ERRORS,
) -> DataFrame:
    """One row: record counts, validity rate, failures per rule, first errors.

    `checks` is counted per rule code, so that the row is bounded by the number of
    rules; `failure_messages` gives the counts per full message, and `error_rows`
    every error, as rows. `shown` errors are quoted in key order, each named by the key of
    its record. Reports of days can be kept as states and merged (`report_state`).
    """
    return report_of(report_state(df, entity, key, dataset, shown))


def write_report_state(state: DataFrame, path: str, day: str) -> None:
    """Keep the state of one day, replacing an older one of that day."""
    dated = state.withColumn("ingestion_date", F.lit(day).cast("date"))
    with setting(state.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        dated.write.mode("overwrite").partitionBy("dataset", "ingestion_date").parquet(path)


def kept_report(spark: SparkSession, path: str) -> DataFrame:
    """The report over all days kept in `path`, one row for each dataset: no record is read."""
    states = spark.read.schema(f"{STATE}, ingestion_date DATE").parquet(path)
    return report_of(merged_states(states.drop("ingestion_date")))


def first_errors(
    df: DataFrame, entity: str, key: str | None = None, n: int = SHOWN_ERRORS
) -> DataFrame:
    """The first n errors, by record key and within a record in rule order."""
    return _first(verdicts(df, entity, key), n)


def _first(judged: DataFrame, n: int) -> DataFrame:
    """The first n errors of verdicts.

    n records hold at least n errors, so the top n records are enough; records
    with the same key come in the order of their errors. Valid rows sort last
    and are dropped after the cut: a filter before it would make the optimizer
    evaluate every rule twice.
    """
    order = [F.col("record"), F.col("failures")]
    records = judged.orderBy("valid", *order).limit(n).filter(~F.col("valid"))
    return (
        records.select("record", "failures", F.explode("failures").alias("failure"))
        .select(
            F.struct(*order, F.col("failure.rule_no")).alias("place"),
            "record",
            F.col("failure.message").alias("error"),
        )
        .orderBy("place")
        .limit(n)
    )


def error_rows(df: DataFrame, entity: str, key: str | None = None) -> DataFrame:
    """Rows (record, error_code, error): every failed rule of every record."""
    return (
        verdicts(df, entity, key)
        .select("record", F.explode_outer("failures").alias("failure"))
        .select(
            "record",
            F.col("failure.code").alias("error_code"),
            F.col("failure.message").alias("error"),
        )
        .filter(F.col("error_code").isNotNull())
    )


def failure_messages(df: DataFrame, entity: str) -> DataFrame:
    """Rows (error_code, error, records): how often each full message occurs.

    The outer explode gives valid rows one NULL, dropped after the count; a plain
    explode would make the optimizer test every rule once more beforehand.
    """
    judged, rules = judge(df, entity)
    return (
        judged.select(F.explode_outer(failures(rules)).alias("failure"))
        .groupBy(
            F.col("failure.code").alias("error_code"), F.col("failure.message").alias("error")
        )
        .agg(F.count(F.lit(1)).alias("records"))
        .filter(F.col("error_code").isNotNull())
    )
