"""Raw landing area, bronze directories, JSON Lines and report files."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions import parse_double, parse_int
from ridelake.operators.bronze import BRONZE
from ridelake.operators.digest import NAMES, Digest, digest_aggregates, found, observed, row_hash
from ridelake.operators.validate import validate
from ridelake.sources.schemas import ENTITIES, RAW, raw_text

log = logging.getLogger(__name__)


#: Records in a landed file: about 100 MB of rides, 10 MB compressed.
LANDED = 200_000


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def land_raw(
    df: DataFrame, raw_dir: str, entity: str, ingestion_date: str, compression: str = "none"
) -> None:
    """Land records as JSON Lines in raw_dir/<entity>/ingestion_date=YYYY-MM-DD/.

    Landing a date again replaces that date and leaves the others alone. `compression`
    "gzip" makes the files about a tenth as large; as such files are read whole by one
    task, no file holds more than `LANDED` records.
    """
    (
        df.withColumn("ingestion_date", F.lit(ingestion_date).cast("date"))
        .write.mode("overwrite")
        .option("compression", compression)
        .option("maxRecordsPerFile", LANDED)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingestion_date")
        .json(f"{raw_dir}/{entity}")
    )


def land_all(
    frames: dict[str, DataFrame], raw_dir: str, ingestion_date: str, compression: str = "none"
) -> list[str]:
    """Land every entity present in `frames`; a missing one is skipped with a warning."""
    landed = []
    for entity in ENTITIES:
        if entity not in frames:
            log.warning("no records for %s, skipped", entity)
            continue
        land_raw(frames[entity], raw_dir, entity, ingestion_date, compression)
        landed.append(entity)
    return landed


# The name of the mark behind a record; no record can hold its own line's hash in it.
END = "_end"

#: Where `routed` rows go.
VALID, INVALID, MALFORMED = "valid", "invalid", "malformed"


def _landed(spark: SparkSession, raw_dir: str, entity: str) -> DataFrame:
    """(line, record, ingestion_date) of every landed line that is not blank.

    `record` is NULL unless the line is one JSON object and nothing else. A parser
    stops behind the first value and would lose what follows; so the line is read as
    the first of two elements of an array, and the second, a mark made of the
    line's hash, is only found if the record ends where the line does.
    """
    lines = spark.read.text(f"{raw_dir}/{entity}").filter(F.trim("value") != "")
    mark = F.xxhash64("value").cast("string")
    kind = f"array<struct<{raw_text(entity).replace(' STRING', ': STRING')}, {END}: STRING>>"
    both = F.concat(F.lit("["), "value", F.lit(f',{{"{END}":"'), mark, F.lit('"}]'))
    parsed = lines.withColumn("parsed", F.from_json(both, kind))
    whole = (F.size("parsed") == 2) & (F.get("parsed", F.lit(1))[END] == mark)
    record = F.when(whole, F.get("parsed", F.lit(0)))
    others = [c for c in lines.columns if c != "value"]
    return parsed.select(F.col("value").alias("line"), record.alias("record"), *others)


def _typed(entity: str, c: Column | None = None) -> dict[str, Column]:
    """The raw columns as read: unreadable numbers NULL, missing ones too."""
    parsers = {"DOUBLE": parse_double, "INT": parse_int}
    kinds = dict(part.split() for part in RAW[entity].split(", "))
    columns = {n: F.col(n) if c is None else c[n] for n in kinds}
    return {n: parsers[kind](columns[n]) if kind in parsers else columns[n] for n, kind in kinds.items()}


def read_raw(spark: SparkSession, raw_dir: str, entity: str, as_text: bool = False) -> DataFrame:
    """All landed records of an entity, with a fixed schema (no inference pass).

    Reading the directory, not a file pattern, finds the dated subdirectories
    and adds their `ingestion_date`. Numbers may be quoted in the records;
    unreadable ones are NULL. `as_text` keeps numbers as written. Lines that are
    no records, or more than one, are left out here: `malformed_lines` has them.
    """
    found = _landed(spark, raw_dir, entity).filter(F.col("record").isNotNull())
    others = [c for c in found.columns if c not in ("line", "record")]
    records = found.select("record.*", *others).drop(END)
    return records if as_text else records.withColumns(_typed(entity))


def malformed_lines(spark: SparkSession, raw_dir: str, entity: str) -> DataFrame:
    """(ingestion_date, entity, line): landed lines that are not one JSON record, as they came."""
    found = _landed(spark, raw_dir, entity).filter(F.col("record").isNull())
    return found.select("ingestion_date", F.lit(entity).alias("entity"), "line")


def ingest_bronze(
    spark: SparkSession,
    raw_dir: str,
    bronze_dir: str,
    entities: Iterable[str] = ENTITIES,
    project: bool = True,
) -> None:
    """Raw JSON Lines to one bronze Parquet directory per entity.

    `project` applies the bronze projection, with its defaults and its NULL for
    unreadable numbers; without it the records are stored as they were read.
    `write_routed` also keeps the lines that are no records, and judges the others.
    """
    for entity in entities:
        if project:
            df = BRONZE[entity](read_raw(spark, raw_dir, entity, as_text=True))
        else:
            df = read_raw(spark, raw_dir, entity).drop("ingestion_date")
        df.write.mode("overwrite").parquet(f"{bronze_dir}/{entity}")


def routed(spark: SparkSession, raw_dir: str, entity: str, project: bool = True) -> DataFrame:
    """Every landed line with its `destination`: valid, invalid or malformed.

    Columns: the bronze columns (`project` as in `ingest_bronze`; the rules look at the
    projection in either case), `errors` and `error_codes` of invalid records, `line` of
    malformed ones. Each line is read, parsed and judged once.
    """
    landed = _landed(spark, raw_dir, entity)
    # The record travels along: its columns and the projection have the same names.
    flat = landed.select("record.*", "line", "record").drop(END)
    checked = validate(BRONZE[entity](flat, keep=("line", "record")), entity)
    is_record = F.col("record").isNotNull()
    names = [part.split()[0] for part in RAW[entity].split(", ")]
    stored = {n: F.col(n) for n in names} if project else _typed(entity, F.col("record"))
    where = F.when(~is_record, MALFORMED).when(F.col("valid_record"), VALID).otherwise(INVALID)
    bad = is_record & ~F.col("valid_record")
    return checked.select(
        *(F.when(is_record, c).alias(n) for n, c in stored.items()),
        *(F.when(bad, F.col(n)).alias(n) for n in ("errors", "error_codes")),
        F.when(~is_record, F.col("line")).alias("line"),
        where.alias("destination"),
    )


def write_routed(
    spark: SparkSession, raw_dir: str, out_dir: str, entity: str, project: bool = True, verify: bool = False
) -> Digest | None:
    """Writes `routed` rows to <out_dir>/<entity>/destination=<where>/, all in one pass.

    With `verify` the digest of what was written is compared with that of what went by;
    the digest of the records, `read_bronze`, is returned.
    """
    df, path = routed(spark, raw_dir, entity, project), f"{out_dir}/{entity}"
    watch = None
    if verify:
        df, watch = observed(df)
    df.write.mode("overwrite").partitionBy("destination").parquet(path, compression="zstd")
    if watch is None:
        return None
    back = spark.read.schema(df.schema).parquet(path).select(df.columns)
    records = F.col("destination") != MALFORMED
    kept = back.drop("errors", "error_codes", "line", "destination")
    # Both digests by one reading.
    hashes = back.select(records.alias("record"), row_hash(back).alias("every"), row_hash(kept).alias("own"))
    every, own = digest_aggregates(F.col("every")), digest_aggregates(F.col("own"))
    row = hashes.groupBy("record").agg(*every, F.struct(*own).alias("own")).collect()
    total = {n: sum(r[n] for r in row) for n in NAMES}
    if found(total) != found(watch.get):
        raise RuntimeError(f"{path} does not hold what was written: {found(total)}, not {found(watch.get)}")
    return next((found(r["own"]) for r in row if r["record"]), Digest(0, 0, 0))


def read_routed(spark: SparkSession, out_dir: str, entity: str, *destinations: str) -> DataFrame:
    """The rows of some destinations; only their directories are read."""
    kinds = f"{RAW[entity]}, errors ARRAY<STRING>, error_codes ARRAY<STRING>, line STRING, destination STRING"
    return spark.read.schema(kinds).parquet(f"{out_dir}/{entity}").filter(F.col("destination").isin(*destinations))


def read_bronze(spark: SparkSession, bronze_dir: str, entity: str) -> DataFrame:
    """The records in <bronze_dir>/<entity>, by `ingest_bronze` or `write_routed`."""
    df = spark.read.schema(RAW[entity]).parquet(f"{bronze_dir}/{entity}")
    if "destination" in df.columns:
        df = df.filter(F.col("destination") != MALFORMED).drop("destination")
    return df


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as a single JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_quarantine(df: DataFrame, entity: str, path: str) -> None:
    """All rows with their errors, valid and invalid ones in separate directories.

    Reading and judging the rows once writes both sides; writing two filtered
    frames would do it twice.
    """
    validate(df, entity).write.mode("overwrite").partitionBy("valid_record").parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows as they came, invalid rows with their errors); each reads its own side."""
    checked = spark.read.parquet(path)
    valid = F.col("valid_record").cast("string") == "true"
    good = checked.filter(valid).drop("errors", "error_codes", "valid_record")
    return good, checked.filter(~valid).drop("valid_record")
