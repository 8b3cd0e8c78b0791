"""Digests of tables by content, whatever the order of their rows.

Every row becomes one text, in a form that any engine can build: NULL is `n`, a value is
`v`, its length, `:` and its text. Two limbs of 24 bits of the text's md5 are added over
all rows, so that a table of 2^39 rows still fits a long, and a single changed value
changes the sums but for one case in 2^48. Adding is free of order and combines before
the shuffle; as an observation it costs no pass of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMES = ("record_count", "digest_high", "digest_low")
#: A row's hash as a column of its own: both sums read it, and it is made once.
ROW = "__row_hash"


@dataclass(frozen=True)
class Digest:
    record_count: int
    digest_high: int
    digest_low: int


#: A double is cut into its whole part and 60 binary places, by steps that are exact and
#: alike in every engine; texts of doubles are not. Sizes beyond (below, from, times).
WHOLE = 2.0**62
BANDS = (("s", 2.0**-8, 2.0**52), ("", WHOLE, 1.0), ("l", 2.0**122, 2.0**-60))


def _number(c: Column) -> Column:
    """A double's text; beyond 5e36 it says no more than the sign."""
    size = F.abs(c)
    band = factor = None
    for name, below, times in BANDS:
        band = F.when(size < below, name) if band is None else band.when(size < below, name)
        factor = F.when(size < below, times) if factor is None else factor.when(size < below, times)
    scaled = c * factor
    whole = scaled.cast("bigint")
    places = ((scaled - whole.cast("double")) * F.lit(2.0**60)).cast("bigint")
    far = F.when(F.isnan(c), "nan").when(c > 0, "far").when(c < 0, "-far")
    return F.when(band.isNotNull(), F.concat(band, whole.cast("string"), F.lit(":"), places.cast("string"))).otherwise(far)


def text_of(c: Column, kind: T.DataType) -> Column:
    """The canonical text of a column; NULL for NULL."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _number(c.cast("double"))
    if isinstance(kind, T.StructType):
        parts = F.concat(*(_marked(c[f.name], f.dataType) for f in kind.fields))
        return F.when(c.isNotNull(), parts)
    if isinstance(kind, T.ArrayType):
        return F.concat_ws("", F.transform(c, lambda x: _marked(x, kind.elementType)))
    if isinstance(kind, T.MapType):
        # Keys are distinct, so that the order of the pairs is that of the keys.
        pairs = F.sort_array(F.map_entries(c))
        # In two steps: inside a lambda nothing is kept, and a mark needs its text twice.
        texts = F.transform(
            pairs, lambda e: F.concat(*_mark(text_of(e["key"], kind.keyType)), _marked(e["value"], kind.valueType))
        )
        return F.when(c.isNotNull(), F.concat_ws("", F.transform(texts, lambda t: F.concat(*_mark(t)))))
    return c.cast("string")


def _mark(text: Column) -> list[Column]:
    return [F.lit("v"), F.length(text).cast("string"), F.lit(":"), text]


def _marked(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(c, "v4:true").when(~c, "v5:false").otherwise("n")
    if isinstance(kind, (T.ArrayType, T.MapType)):
        # The text, made by lambdas, would be made twice: as an element it is made once.
        once = F.transform(F.array(text_of(c, kind)), lambda t: F.concat(*_mark(t)))
        marked = F.get(once, F.lit(0))
        return marked if isinstance(kind, T.ArrayType) else F.when(c.isNull(), "n").otherwise(marked)
    return F.coalesce(F.concat(*_mark(text_of(c, kind))), F.lit("n"))


def row_hash(df: DataFrame) -> Column:
    """The md5 of a row's text, over all columns of `df`."""
    return F.md5(F.concat(*(_marked(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields)))


def digest_aggregates(row: Column) -> list[Column]:
    """Aggregates over the hashes of rows: number of rows and the two sums."""

    def limb(first: int) -> Column:
        return F.coalesce(F.sum(F.conv(F.substring(row, first, 6), 16, 10).cast("bigint")), F.lit(0))

    return [
        c.cast("bigint").alias(n) for c, n in zip((F.count(F.lit(1)), limb(1), limb(7)), NAMES, strict=True)
    ]


def digest(df: DataFrame) -> DataFrame:
    """One row: record_count, digest_high, digest_low."""
    return df.select(row_hash(df).alias(ROW)).agg(*digest_aggregates(F.col(ROW)))


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df`, and what its digest was when it went by."""
    watch = Observation()
    return df.withColumn(ROW, row_hash(df)).observe(watch, *digest_aggregates(F.col(ROW))).drop(ROW), watch


def found(row) -> Digest:
    """The digest in a row or in an observation."""
    return Digest(*(int(row[n]) for n in NAMES))
