"""Layer tables: write, publish, read, list and drop.

Outside Iceberg a table is a folder per version and a catalog entry that points to one of
them. A rewrite fills a new folder and then moves the entry, in one catalog call: readers
see the old version or the new one, and a write that fails leaves the old one alone.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.operators.digest import Digest, digest, found, observed
from ridelake.session import setting
from ridelake.sources.schemas import derived_columns, iceberg_partitions
from ridelake.sources.scratch import remove_folder, subfolders

Partition = str | tuple[str, str]


def _spec(partition_by: Sequence[Partition]) -> list[tuple[str, str]]:
    return [("identity", p) if isinstance(p, str) else p for p in partition_by]


def is_iceberg(spark: SparkSession, name: str) -> bool:
    """Whether the catalog that `name` starts with is configured as Iceberg."""
    catalog = name.split(".")[0]
    return "iceberg" in spark.conf.get(f"spark.sql.catalog.{catalog}", "").lower()


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Partition | Sequence[Partition] = (),
    location: str | None = None,
    verify: bool = False,
) -> Digest | None:
    """Create or replace table `name` from `df`.

    `partition_by` takes column names and (transform, column) pairs with the
    transforms years, months and days. In an Iceberg catalog the replacement is
    atomic, so readers always see a table. Elsewhere the table is Parquet and
    each transform, and each text column, becomes a partition column of its own
    (see `in_partition` and `between_dates` for reading); its versions lie below
    `location`, or below the table's place in its database's folder, and
    `expire_versions` removes those that nothing reads any more.

    Rows are rebalanced by partition first: one file set per partition instead of
    one per task, while AQE splits a partition that holds a large share.

    With `verify` the digest of the rows is taken as they are written and compared with
    that of what can be read; a difference raises, before the version is published
    where that is possible. The digest is returned.
    """
    if isinstance(partition_by, str):
        partition_by = [partition_by]
    elif isinstance(partition_by, tuple) and partition_by and partition_by[0] in (
        "years",
        "months",
        "days",
    ):
        partition_by = [partition_by]
    spec = _spec(partition_by)
    spark, watch, columns = df.sparkSession, None, df.columns
    if is_iceberg(spark, name):
        if verify:
            df, watch = observed(df)
        writer = df.writeTo(name).using("iceberg").tableProperty("format-version", "2")
        if location:
            writer = writer.tableProperty("location", location)
        if spec:
            writer = writer.partitionedBy(
                *(
                    F.col(c) if k == "identity" else getattr(F.partitioning, k)(c)
                    for k, c in iceberg_partitions(spec)
                )
            )
        writer.createOrReplace()
        return _verified(name, spark.table(name).select(columns), watch)
    derived, names = {}, []
    for kind, column in spec:
        if kind == "identity" and df.schema[column].dataType.typeName() != "string":
            names.append(column)
        else:
            derived |= derived_columns([(kind, column)])
            names = [*names, *(n for n in derived if n not in names)]
    out = df.withColumns(derived) if derived else df
    if names:
        out = out.hint("rebalance", *(F.col(n) for n in names))
    if verify:
        # Behind the rebalancing, in the tasks that write: each row goes by once.
        kept, watch = observed(out.select(columns))
        out = kept.withColumns(derived) if derived else kept
    version = f"{(location or _place(spark, name)).rstrip('/')}/v-{uuid.uuid4().hex}"
    writer = out.write.format("parquet").option("compression", "zstd")
    if names:
        writer = writer.partitionBy(*names)
    writer.save(version)
    made = _verified(name, spark.read.schema(out.schema).parquet(version).select(columns), watch)
    fields = [f for f in out.schema.fields if f.name not in names]
    publish(spark, name, T.StructType([*fields, *(out.schema[n] for n in names)]), names, version)
    return made


def _verified(name: str, back: DataFrame, watch) -> Digest | None:
    if watch is None:
        return None
    wrote, holds = found(watch.get), found(digest(back).first())
    if wrote != holds:
        raise RuntimeError(f"{name} does not hold what was written: {holds}, not {wrote}")
    return holds


def _place(spark: SparkSession, name: str) -> str:
    """Where a table without a location of its own lies."""
    *database, table = name.split(".")
    base = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{table}"


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table; empty where there is none."""
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in ("Type", "Location", "Partition Provider")}


VERSION = re.compile(r"/v-[0-9a-f]{32}/?$")


def publish(spark: SparkSession, name: str, schema: T.StructType, partitions: Sequence[str], version: str) -> None:
    """Let table `name` be what lies in the folder `version`.

    One catalog call where the table has these columns and partitions already. Its
    partitions are found in the folder, not kept in the catalog, so that they
    change with it. Other columns need a new entry: the old one is dropped just before,
    when the data of the new one are complete.
    """
    details = _details(spark, name)
    movable = VERSION.search(details.get("Location", "")) and "Partition Provider" not in details
    if movable:
        columns = spark.catalog.listColumns(name)
        have = [(c.name, c.dataType) for c in columns]
        movable = have == [(f.name, f.dataType.simpleString()) for f in schema.fields]
        movable = movable and [c.name for c in columns if c.isPartition] == list(partitions)
    if movable:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        return
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    split = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    with setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet{split} LOCATION '{version}'")


def expire_versions(spark: SparkSession, name: str) -> list[str]:
    """Remove the versions of a published table that it no longer points to; returns their folders.

    Call it when neither a query over an older version nor a write is under way.
    """
    place = _details(spark, name).get("Location", "").rstrip("/")
    if not VERSION.search(place):
        return []
    base, current = place.rsplit("/", 1)
    old = [f for f in subfolders(spark, base) if VERSION.search(f) and not f.endswith(current)]
    for folder in old:
        remove_folder(spark, folder)
    return old


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The table by catalog name, so that its own metadata decides what it holds."""
    return spark.table(name)


def in_partition(df: DataFrame, column: str, *values: str) -> DataFrame:
    """Rows whose `column` is one of `values`, reading their partitions only."""
    out = df.filter(F.col(column).isin(*values))
    part = f"{column}_part"
    if part in df.columns:
        named = [v for v in values if v != ""]
        keep = F.col(part).isin(*named) if named else F.lit(False)
        if "" in values:
            keep = keep | F.col(part).isNull()
        out = out.filter(keep)
    return out


def list_layer(spark: SparkSession, layer: str, prefix: str = "") -> DataFrame:
    """Tables of a layer: those named <prefix><layer>_*, where the prefix may begin
    with a catalog and a database, as in `LayerConfig`."""
    *place, start = prefix.split(".")
    where = f" IN {'.'.join(place)}" if place else ""
    return (
        spark.sql(f"SHOW TABLES{where} LIKE '{start}{layer}_*'")
        .filter(~F.col("isTemporary"))
        .select("tableName")
        .orderBy("tableName")
    )


def reset_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop tables, ignoring those that do not exist.

    A table in its database's own folder goes with its data; one that was given a
    location leaves them there.
    """
    for name in names:
        place = _details(spark, name).get("Location", "")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if VERSION.search(place) and not is_iceberg(spark, name):
            base = place.rstrip("/").rsplit("/", 1)[0]
            if base.removeprefix("file:").endswith(_place(spark, name).removeprefix("file:").lstrip("/")):
                remove_folder(spark, base)
