"""Numbers: parsing, clamping and sums that do not depend on row order.

Adding doubles gives a result that changes with the order of the rows, hence with the
partitioning. Measures are therefore added as decimals with twelve places, and rounded,
if at all, once at the end. A value that no such decimal holds (infinite, or 1e26 and
more) makes its own group's sum the plain sum of doubles, and no other group's.

Decimals of that size are objects. Nearly all measures are cents, or small with a few
places more; these are cut into limbs, longs below a million in size, which are added
by plain additions in generated code and carried once, at the end. Limbs are that small so
that their sums hold 9e12 rows. Only other values are added as decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,12)"


def parse_double(c: Column) -> Column:
    """Text to double, NULL when it is not a number.

    The cast alone would also read '1d', '2f' and '0x1p3', as Java does. No
    decimal number, infinity or NaN holds a d or an x, and an f only as in inf.
    """
    foreign = c.contains("d") | c.contains("D") | c.contains("x") | c.contains("X")
    ends_in_f = (c.contains("f") | c.contains("F")) & ~F.lower(c).contains("inf")
    return F.when(~foreign & ~ends_in_f, c.try_cast("double"))


def parse_int(c: Column) -> Column:
    """Text or number to int: numbers are cut at the point, bad text is NULL."""
    return c.try_cast("int")


def clamp(c: Column, low, high=None) -> Column:
    """`c` limited to [low, high]; NULL stays NULL and NaN becomes `low`."""
    out = F.greatest(F.lit(low), c)
    if high is not None:
        out = F.least(F.lit(high), out)
    return F.when(F.isnan(c), F.lit(low)).when(c.isNotNull(), out)


def measure(c: Column) -> Column:
    """`c` as a double, NaN as 0."""
    x = c.cast("double")
    return F.when(F.isnan(x), F.lit(0.0)).otherwise(x)


#: Units of 10^-12 in 1, and limbs of a million each: whole, millionths, 10^-12 parts.
UNITS, LIMB = 10**12, 10**6


def units(x: Column) -> Column:
    """A double as units of 10^-12, a long; NULL where it is not plainly one.

    Cents below a million, and twelve places below a thousand, have at most fifteen digits:
    if the rounded number gives the double back, its digits are the double's own.
    """
    size, cents, fine = F.abs(x), F.rint(x * 100), F.rint(x * UNITS)
    return (
        F.when((size < LIMB) & (cents / 100.0 == x), cents.cast("bigint") * F.lit(UNITS // 100))
        .when((size < 1000) & (fine / F.lit(float(UNITS)) == x), fine.cast("bigint"))
    )


def limbs(c: Column) -> tuple[Column, Column, Column]:
    """(whole part, millionths, 10^-12 parts) of a number of units."""

    def div(x: Column, by: int) -> Column:
        return F.call_function("div", x, F.lit(by).cast("bigint"))

    return div(c, UNITS), div(c, LIMB) % F.lit(LIMB), c % F.lit(LIMB)


#: What is added of a measure; sums of sums are the sums of all.
PARTS = ("whole", "millionths", "last", "rest", "plain", "held", "odd", "n")


def partial_sums(c: Column) -> dict[str, Column]:
    """Aggregates of a measure by part: its limbs, what has none as a decimal, plain doubles, counts."""
    x = measure(c)
    small = units(x)
    # NULL, and no object, for what has limbs.
    large = F.when(small.isNull(), x.try_cast(EXACT))
    added = [F.coalesce(F.sum(part), F.lit(0)).cast("bigint") for part in limbs(small)]
    return dict(zip(PARTS, (*added, F.try_sum(large), F.sum(x), F.count(small), F.count(large), F.count(x)), strict=True))


def merged_sums(parts: dict[str, Column]) -> dict[str, Column]:
    """Aggregates that add stored parts."""
    out = {k: F.sum(c).cast("bigint") for k, c in parts.items()}
    # A sum that has left its decimal stays lost.
    lost = F.count_if((parts["odd"] > 0) & parts["rest"].isNull())
    out["rest"] = F.when(lost == 0, F.try_sum(parts["rest"])).cast(EXACT)
    return out | {"plain": F.sum(parts["plain"])}


def _carried(parts: dict[str, Column]) -> tuple[Column, Column, Column, Column]:
    """(exact sum, whether it holds, sum of doubles, number of values)."""
    # Types whose sums and products keep all twelve places.
    whole, millionths, last = (parts[k].cast("decimal(20,0)") for k in PARTS[:3])
    carried = whole + millionths * F.lit("0.000001").cast("decimal(6,6)")
    carried = carried + last * F.lit("0.000000000001").cast("decimal(12,12)")
    rest, odd, n = parts["rest"], parts["odd"], parts["n"]
    narrow = "decimal(37,12)"
    both = carried.cast(narrow) + rest.try_cast(narrow)
    # From 1e25 on the last place is far beyond what a double can say.
    total = F.when(odd == 0, carried.cast(EXACT)).otherwise(F.coalesce(both, (rest + carried.cast(EXACT)).try_cast(EXACT)))
    total = F.when(n > 0, total)
    return total, (parts["held"] + odd == n) & total.isNotNull(), parts["plain"], n


def total_of(parts: dict[str, Column], places: int | None = None) -> Column:
    """The sum, NULL for no values; rounded to `places` if given."""
    total, holds, plain, _ = _carried(parts)
    if places is not None:
        total, plain = F.round(total, places), F.round(plain, places)
    return F.when(holds, total.cast("double")).otherwise(plain)


def rounded_mean_of(parts: dict[str, Column], places: int) -> Column:
    """The mean to `places`, halves away from zero; 0 for no values."""
    total, holds, plain, n = _carried(parts)
    # ANSI mode refuses a division by zero.
    some = F.nullif(n, F.lit(0))
    mean = F.when(holds, F.round(total / some, places).cast("double")).otherwise(F.round(plain / some, places))
    return F.coalesce(mean, F.lit(0.0))


def exact_total(c: Column, places: int | None = None) -> Column:
    """Aggregate: sum of `c`, NULL for no values; rounded to `places` if given."""
    return total_of(partial_sums(c), places)


def exact_mean(c: Column) -> Column:
    """Aggregate: unrounded mean of `c`, NULL for no values."""
    return exact_total(c) / F.nullif(F.count(measure(c)), F.lit(0))


def rounded_mean(c: Column, places: int) -> Column:
    """Aggregate: mean of `c` to `places`, halves away from zero; 0 for no values."""
    return rounded_mean_of(partial_sums(c), places)
