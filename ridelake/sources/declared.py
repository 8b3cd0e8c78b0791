"""Layer tables in their declared types and partitions.

A row that a declared table cannot hold (a number beyond its decimal, a time that is none,
nothing where something is required) does not end the load: the gate tells it from the
others, with a code for each column that refuses it. What passes is inserted into
the table made by its DDL, replacing the partitions that it has rows for; the
refused rows go, as they came and with their codes, to a folder beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import as_timestamp
from ridelake.operators.digest import Digest, digest, found
from ridelake.session import setting
from ridelake.sources.schemas import PARTITIONS, TABLES, create_statement, derived_columns
from ridelake.sources.scratch import remove_folder, shared_folder

#: Codes of the rows that a table refuses, in column order.
REFUSED = "refused"


def declared_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table].replace(" DEFAULT TRUE", ""))


def _fitted(c: Column, kind: T.DataType, name: str) -> tuple[Column, list[tuple[str, Column]]]:
    """(`c` in the declared type, [(code, whether it does not fit)])."""
    if isinstance(kind, T.StructType):
        parts = {f.name: _fitted(c[f.name], f.dataType, f"{name}_{f.name}") for f in kind.fields}
        made = F.when(c.isNotNull(), F.struct(*(p.alias(n) for n, (p, _) in parts.items())))
        return made, [code for _, codes in parts.values() for code in codes]
    if isinstance(kind, T.MapType):
        return c.cast(kind), []
    made = c.try_cast(kind)
    return made, [(f"{name}_unfit", c.isNotNull() & made.isNull())]


def _gate(df: DataFrame, table: str) -> tuple[list[Column], Column]:
    """(the declared columns, the codes of what does not fit)."""
    out, refused, any_failed = [], [], F.lit(False)
    for f in declared_schema(table).fields:
        if f.name not in df.columns:
            # Also `valid_record`: a row that no rule has seen is not valid for that.
            made, codes = F.lit(None).cast(f.dataType), []
            if not f.nullable:
                codes = [(f"{f.name}_missing", F.lit(True))]
        else:
            c = F.col(f.name)
            made, codes = _fitted(c, f.dataType, f.name)
            if isinstance(f.dataType, T.TimestampNTZType):
                made = as_timestamp(df, f.name)
                codes = [(f"{f.name}_unfit", c.isNotNull() & made.isNull())]
            if not f.nullable:
                codes = [(f"{f.name}_missing", c.isNull()), *codes]
        out.append(made.alias(f.name))
        refused += [F.when(failed, code) for code, failed in codes]
        for _, failed in codes:
            any_failed = any_failed | failed
    # Most rows fit: their array is a constant, and no lambda looks at it.
    found = F.when(any_failed, F.array_compact(F.array(*refused))).otherwise(F.array().cast("array<string>"))
    return out, found.alias(REFUSED)


def gate(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of `table` in their types, and `refused`: the codes of what does not fit.

    `<column>_missing`: NULL, or no such column, where the table requires a value.
    `<column>_unfit`: a value that the type does not hold. Times may be ISO text; digits
    behind a decimal's last place are rounded, halves up.
    """
    columns, refused = _gate(df, table)
    return df.select(*columns, refused)


def refused_rows(df: DataFrame, table: str) -> DataFrame:
    """The rows of `df` that `table` refuses, as they came, with their codes in `refused`.

    The codes go through an outer explode: a plain filter on them would be moved down to the
    source, with every expression on the way written out again in each of its conditions.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != REFUSED]
    codes = _gate(df, table)[1]
    judged = df.select(*kept, F.array(codes).alias(REFUSED))
    return judged.select(*kept, F.explode_outer(REFUSED).alias(REFUSED)).filter(F.size(REFUSED) > 0)


def load_declared(
    df: DataFrame, table: str, name: str | None = None, refused_dir: str | None = None
) -> tuple[Digest, int]:
    """Insert the rows of `df` that `table` holds into table `name`, made by its DDL if need be.

    Partitions that the rows fall into are replaced, others stay (a table without
    partitions is replaced). The rows are judged once as they are written; only if some
    are refused does a second pass write those to `refused_dir`. Aggregates, the gold
    tables, are small beside their source: they are kept for that pass, not made again.
    Returns the digest of what the table holds now and the number of rows refused.
    """
    if not table.startswith("gold_"):
        return _load(df, table, name or table, refused_dir)
    spark, kept = df.sparkSession, shared_folder(df.sparkSession)
    try:
        df.write.parquet(kept)
        return _load(spark.read.schema(df.schema).parquet(kept), table, name or table, refused_dir)
    finally:
        remove_folder(spark, kept)


def _load(df: DataFrame, table: str, name: str, refused_dir: str | None) -> tuple[Digest, int]:
    spark = df.sparkSession
    spark.sql(create_statement(table, name))
    schema, parts = declared_schema(table), PARTITIONS.get(table, [])
    derived = derived_columns(parts)
    watch = Observation()
    gated = gate(df, table).observe(watch, F.count_if(F.size(REFUSED) > 0).alias(REFUSED))
    fit = gated.filter(F.size(REFUSED) == 0).drop(REFUSED).withColumns(derived)
    if derived:
        fit = fit.hint("rebalance", *(F.col(c) for c in derived))
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        fit.write.insertInto(name, overwrite=True)
    # A retried task may be counted twice, so the number comes from what is written.
    refused = 0
    if watch.get[REFUSED]:
        bad = refused_rows(df, table)
        if refused_dir:
            bad.write.mode("overwrite").parquet(refused_dir)
            bad = spark.read.schema(bad.schema).parquet(refused_dir)
        refused = bad.count()
    held = spark.table(name).select(*(f.name for f in schema.fields))
    return found(digest(held).first()), refused


def read_declared(spark: SparkSession, table: str, name: str | None = None) -> DataFrame:
    """The declared columns of a table, without those of its partitions."""
    return spark.table(name or table).select(*(f.name for f in declared_schema(table).fields))
