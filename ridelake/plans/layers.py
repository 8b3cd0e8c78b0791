"""The whole run: raw -> bronze -> silver -> gold, stopping at the first failure."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ridelake.operators import gold
from ridelake.operators.digest import Digest, digest, found
from ridelake.operators.normalise import NORMALISE
from ridelake.operators.refine import REFINE, WIDE_RIDE_STATUSES, refine_ride
from ridelake.sources.declared import load_declared
from ridelake.sources.files import read_bronze, write_routed
from ridelake.sources.schemas import ENTITIES
from ridelake.sources.tables import read_table, write_table

log = logging.getLogger(__name__)

STYLES = ("jobs", "notebooks", "records")


@dataclass(frozen=True)
class LayerConfig:
    """Folders, table name prefix (such as a catalog and database) and style.

    `jobs` and `notebooks` refine silver, the latter with the wider ride filter,
    city grouping and joined dimensions in gold. `records` normalises silver and
    computes the daily metrics from unfiltered bronze rides. Bronze holds, beside the
    valid records, the invalid ones with their errors, and the lines that are no
    records (`read_routed`). With `verify` each table is compared, by a digest of its
    content, with the rows that went into it.

    With `declared`, which goes with the style `records`, silver and gold are the tables
    of the DDL, in its types and partitions; rows that they refuse lie, with their codes,
    in <bronze_dir>/refused_<table>.
    """

    raw_dir: str
    bronze_dir: str
    prefix: str = ""
    table_dir: str | None = None
    style: str = "jobs"
    verify: bool = True
    declared: bool = False

    def __post_init__(self):
        if self.declared and self.style != "records":
            raise ValueError("declared tables are those of the style 'records'")
        if self.style not in STYLES:
            raise ValueError(f"style must be one of {STYLES}")

    def table(self, layer: str, name: str) -> str:
        return f"{self.prefix}{layer}_{name}"

    def write(self, df: DataFrame, layer: str, name: str, partition_by=()) -> Digest | None:
        if self.declared:
            kind = f"{layer}_{name}"
            return load_declared(df, kind, self.table(layer, name), f"{self.bronze_dir}/refused_{kind}")[0]
        place = f"{self.table_dir}/{layer}/{name}" if self.table_dir else None
        return write_table(df, self.table(layer, name), partition_by, location=place, verify=self.verify)


Contents = dict[str, Digest | None]


def build_bronze(spark: SparkSession, cfg: LayerConfig) -> Contents:
    """Every landed line, read, parsed and judged once, in bronze or beside it."""
    project = cfg.style == "records"
    return {e: write_routed(spark, cfg.raw_dir, cfg.bronze_dir, e, project, cfg.verify) for e in ENTITIES}


def build_silver(spark: SparkSession, cfg: LayerConfig) -> Contents:
    made: Contents = {}
    for entity in ENTITIES:
        bronze = read_bronze(spark, cfg.bronze_dir, entity)
        if cfg.style == "records":
            checked = {"checks": True} if cfg.declared and entity in ("ride", "payment") else {}
            out, parts = NORMALISE[entity](bronze, **checked), ()
        elif entity == "ride":
            wide = cfg.style == "notebooks"
            out = refine_ride(bronze, WIDE_RIDE_STATUSES) if wide else refine_ride(bronze)
            parts = ("pickup_city",)
        else:
            out, parts = REFINE[entity](bronze), ()
        made[entity] = cfg.write(out, "silver", entity, parts)
    return made


def build_gold(spark: SparkSession, cfg: LayerConfig) -> Contents:
    frames = gold_frames(spark, cfg)
    return {name: cfg.write(df, "gold", name, parts) for name, (df, parts) in frames.items()}


def gold_frames(spark: SparkSession, cfg: LayerConfig) -> dict[str, tuple[DataFrame, tuple]]:
    def by_month(date: str) -> tuple:
        # A day of one city is a single row: months keep the files reasonable.
        return (("years", date), ("months", date))

    if cfg.style == "records":
        rides = read_bronze(spark, cfg.bronze_dir, "ride")
        drivers = read_bronze(spark, cfg.bronze_dir, "driver")
        return {
            "ride_daily_metrics": (gold.ride_daily_metrics(rides), by_month("date")),
            "driver_metrics": (
                gold.driver_daily_metrics(rides, drivers, order=["signup_timestamp"]),
                by_month("date"),
            ),
            "city_metrics": (gold.city_metrics(rides), by_month("date")),
        }
    rides = read_table(spark, cfg.table("silver", "ride"))
    if cfg.style == "notebooks":
        drivers = read_table(spark, cfg.table("silver", "driver"))
        passengers = read_table(spark, cfg.table("silver", "passenger"))
        return {
            "daily_ride_metrics": (gold.daily_city_rides(rides), by_month("request_date")),
            "driver_performance": (gold.driver_performance(rides, drivers), ()),
            "passenger_activity": (gold.passenger_activity(rides, passengers), ()),
        }
    return {
        "daily_ride_metrics": (gold.daily_rides(rides), ()),
        "driver_performance": (gold.driver_performance(rides), ()),
        "passenger_activity": (gold.passenger_activity(rides), ()),
    }


CONTENTS = "entity STRING, record_count BIGINT, digest_high BIGINT, digest_low BIGINT"


def layer_contents(spark: SparkSession, cfg: LayerConfig, layer: str, made: Contents) -> DataFrame:
    """Rows (entity, record_count, digest_high, digest_low) of what a layer holds, by entity.

    The digests are those that the written tables were verified with; where they were
    not, the tables are read for them now. Fails if a part is missing or empty.
    """
    read = {n: d or found(digest(_part(spark, cfg, layer, n)).first()) for n, d in made.items()}
    empty = sorted(n for n, d in read.items() if not d.record_count)
    if empty:
        raise RuntimeError(f"{layer} has no rows in {', '.join(empty)}")
    rows = [(n, d.record_count, d.digest_high, d.digest_low) for n, d in sorted(read.items())]
    return spark.createDataFrame(rows, CONTENTS)


def _part(spark: SparkSession, cfg: LayerConfig, layer: str, name: str) -> DataFrame:
    if layer == "bronze":
        return read_bronze(spark, cfg.bronze_dir, name)
    return read_table(spark, cfg.table(layer, name))


def run_layers(spark: SparkSession, cfg: LayerConfig) -> dict[str, DataFrame]:
    """Run every layer and return what each holds: rows and digest by table.

    Each step reads what the step before has written, so a lost executor costs
    its tasks only. A layer is verified before the next one begins; an exception in a
    step, a table that is empty, or one that does not hold what was written, ends the run.
    """
    contents = {}
    for layer, build in (("bronze", build_bronze), ("silver", build_silver), ("gold", build_gold)):
        contents[layer] = layer_contents(spark, cfg, layer, build(spark, cfg))
        log.info("%s written", layer)
    return contents
