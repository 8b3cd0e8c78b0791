from __future__ import annotations

import datetime as dt
import decimal
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridelake import functions as R
from ridelake.functions.numbers import EXACT, units


def column(spark, values, kind, f):
    """f over all values in one job."""
    data = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"i int, x {kind}").select("i", f(F.col("x")).alias("y"))
    return [r["y"] for r in sorted(df.collect())]


def test_email(spark):
    cases = {
        "user@example.com": True,
        "test.user+tag@domain.co.uk": True,
        "invalid.email": False,
        "@example.com": False,
        "user@example.com\n": True,
        "user@example.com\r\n": False,
        "user@example.com x": False,
        None: False,
    }
    assert column(spark, cases, "string", R.is_email) == list(cases.values())


def test_phone(spark):
    cases = {
        "+12025551234": True,
        "+14155551234": True,
        "2025551234": False,
        "+1202555": False,
        "+1٢٠٢٥٥٥١٢٣٤": False,  # ASCII digits only
        None: False,
    }
    assert column(spark, cases, "string", R.is_phone) == list(cases.values())


def test_iso_timestamp(spark):
    good = {
        "2026-05-01": dt.datetime(2026, 5, 1),
        "2026-05-01T10:00": dt.datetime(2026, 5, 1, 10),
        "2026-05-01 10:00:30": dt.datetime(2026, 5, 1, 10, 0, 30),
        "2026-05-01T10:00:30.250": dt.datetime(2026, 5, 1, 10, 0, 30, 250000),
        "2026-05-01T10:00:30.250001": dt.datetime(2026, 5, 1, 10, 0, 30, 250001),
        "2026-05-01T23:00:00+05:00": dt.datetime(2026, 5, 1, 23),  # wall clock kept
        "2026-05-01T23:00:00Z": dt.datetime(2026, 5, 1, 23),
    }
    for text, want in good.items():
        assert dt.datetime.fromisoformat(text).replace(tzinfo=None) == want
    bad = ["2026-05", "2026", "10:00", " 2026-05-01 ", "2026-5-1", "2026-02-30", "yesterday"]
    bad += ["", None, "2026-05-01T10:00:00\n", "2026-13-01T00:00:00"]
    got = column(spark, [*good, *bad], "string", R.iso_timestamp)
    assert got == [*good.values(), *[None] * len(bad)]


def test_has_zone(spark):
    cases = {
        "2026-05-01": False,
        "2026-05-01T10:00": False,
        "2026-05-01T10:00:00.123": False,
        "2026-05-01T10:00Z": True,
        "2026-05-01T10:00:00-07:00": True,
        None: False,
    }
    assert column(spark, cases, "string", R.has_zone) == list(cases.values())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x1c\x85\xa0 　", max_size=8), min_size=1, max_size=20))
def test_strip_matches_python(spark, texts):
    assert column(spark, texts, "string", R.strip) == [t.strip() for t in texts]


def test_tidy_and_default(spark):
    assert column(spark, [None, " a ", ""], "string", R.tidy) == ["", "a", ""]
    got = column(spark, [None, "", " "], "string", lambda c: R.or_default(c, "USD"))
    assert got == ["USD", "USD", " "]


def test_clamp(spark):
    nan = float("nan")
    got = column(spark, [-1.0, 3.0, 9.0, nan, None], "double", lambda c: R.clamp(c, 0.0, 5.0))
    assert got == [0.0, 3.0, 5.0, 0.0, None]
    assert column(spark, [1880, 2060], "int", lambda c: R.clamp(c, 1900, 2050)) == [1900, 2050]


def test_parse_double(spark):
    cases = {"4.5": 4.5, " 7 ": 7.0, "1e3": 1000.0, "-.5": -0.5, "inf": math.inf}
    bad = ["1d", "2f", "0x1p3", "good", "", "1,5", None]
    got = column(spark, [*cases, *bad], "string", R.parse_double)
    assert got == [*cases.values(), *[None] * len(bad)]
    assert math.isnan(column(spark, ["nan"], "string", R.parse_double)[0])


def test_parse_int(spark):
    assert column(spark, ["5", "-2", "3.5", "x", None], "string", R.parse_int) == [
        5,
        -2,
        None,
        None,
        None,
    ]
    assert column(spark, [3.9, -3.9], "double", R.parse_int) == [3, -3]


def sums(spark, values, *aggregates):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return tuple(df.agg(*(f(F.col("x")).alias(str(k)) for k, f in enumerate(aggregates))).first())


def test_sums_keep_every_digit(spark):
    assert sums(spark, [1.2345] * 1000, R.exact_total) == (1234.5,)
    assert sums(spark, [0.004] * 1000, R.exact_total) == (4.0,)
    assert sums(spark, [1.234, 1.234], R.exact_mean) == (1.234,)
    assert sums(spark, [0.1] * 10 + [float("nan")], R.exact_total, R.exact_mean) == (1.0, 1.0 / 11)


@pytest.mark.parametrize(
    "values, want",
    [([0.01, 0.0], 0.01), ([-0.01, 0.0], -0.01), ([0.05, 0.0, 0.0], 0.02), ([1.0, 1.0], 1.0), ([None], 0.0), ([], 0.0)],
)
def test_rounded_mean(spark, values, want):
    assert sums(spark, values, lambda c: R.rounded_mean(c, 2)) == (want,)


def test_extreme_values_do_not_abort(spark):
    inf = float("inf")
    total = [R.exact_total, lambda c: R.exact_total(c, 2), R.exact_mean, lambda c: R.rounded_mean(c, 2)]
    assert sums(spark, [1.0, inf], *total) == (inf,) * 4
    assert sums(spark, [1.0, 1e308], *total) == (1e308, 1e308, 5e307, 5e307)
    assert sums(spark, [1e17, 1e17], *total) == (2e17, 2e17, 1e17, 1e17)
    assert sums(spark, [9e25] * 20, R.exact_total)[0] == pytest.approx(1.8e27)


def test_totals_do_not_depend_on_order(spark):
    values = [0.1 * i for i in range(1000)] + [1e9, -1e9]
    forward = spark.createDataFrame([(v,) for v in values], "x double")
    backward = spark.createDataFrame([(v,) for v in reversed(values)], "x double")
    aggregates = [
        R.exact_total(F.col("x")).alias("total"),
        R.exact_mean(F.col("x")).alias("mean"),
    ]
    first = forward.repartition(1).agg(*aggregates).first()
    assert first == backward.repartition(7).agg(*aggregates).first()
    assert first["total"] == 49950.0
    empty = forward.filter("x > 1e12").agg(*aggregates).first()
    assert empty["total"] is None and empty["mean"] is None


def test_haversine(spark):
    points = spark.createDataFrame(
        [
            (37.7749, -122.4194, 34.0522, -118.2437),
            (0.0, 0.0, 0.0, 180.0),
            (5.0, 5.0, 5.0, 5.0),
        ],
        "a double, b double, c double, d double",
    )
    km = [r[0] for r in points.select(R.haversine_km(*(F.col(c) for c in "abcd"))).collect()]
    assert km[0] == pytest.approx(559.12, abs=0.01)
    assert km[1] == pytest.approx(math.pi * 6371)
    assert km[2] == 0.0


def test_fare(spark):
    df = spark.createDataFrame([(10.0, 20)], "km double, minutes int")
    assert df.select(R.ride_fare(F.col("km"), F.col("minutes"))).first()[0] == 20.0


def test_between_dates_uses_derived_columns(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 5, d), dt.date(2026, 5, d)) for d in range(1, 6)],
        "t timestamp_ntz, t_day date",
    )
    out = R.between_dates(df, "t", "2026-05-02", "2026-05-04")
    assert sorted(r["t"].day for r in out.collect()) == [2, 3]
    assert "t_day" in out._jdf.queryExecution().optimizedPlan().toString().split("Filter")[1]


def test_limbs_add_as_decimals_do(spark):
    rng = random.Random(8)
    kinds = [
        lambda: round(rng.uniform(-1e6, 1e6), 2),
        lambda: rng.uniform(-1e3, 1e3),
        lambda: rng.randrange(4096 * 50) / 4096,
        lambda: round(rng.uniform(-1e7, 1e7), 3),
        lambda: rng.uniform(-1e20, 1e20),
        lambda: round(rng.uniform(0, 1), 12),
        lambda: rng.uniform(-1e-9, 1e-9),
        lambda: rng.choice([999999.99, 1e6, -999999.99, 0.1 + 0.2, -0.0, 1e-12, 5e-13, 999.999999999999]),
    ]
    # Groups of one kind, and mixed ones.
    rows = [(k % 40, kinds[(k % 40 if k % 40 < 24 else k // 40) % 8]()) for k in range(8000)]
    df = spark.createDataFrame(rows, "g long, v double").repartition(5)
    x = F.col("v")
    for r in df.select(units(x).alias("u"), x.try_cast(EXACT).alias("e")).collect():
        assert r.u is None or decimal.Decimal(r.u) / 10**12 == r.e
    # What plain decimals give.
    plain = df.groupBy("g").agg(F.sum(x.cast(EXACT)).alias("s"), F.count("*").alias("n"))
    want = {r.g: (float(r.s), float(r.s) / r.n) for r in plain.collect()}
    made = df.groupBy("g").agg(R.exact_total(x).alias("s"), R.exact_mean(x).alias("m"))
    assert {r.g: (r.s, r.m) for r in made.collect()} == want
