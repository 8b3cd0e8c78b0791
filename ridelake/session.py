"""Session settings that the jobs are tuned for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan from real sizes: merge small partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Wide projections (bronze, validation) generate methods that the JVM refuses
    # to compile above 8000 bytes; past that size plain operators are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
SPARKS_LIMIT = "65535"


def compiled(spark: SparkSession) -> None:
    """Give a session that was not made by `tuned` the limit of method sizes.

    Beyond it the JVM interprets a generated method for every row. A limit that the session
    has been given stays.
    """
    if spark.conf.get(HUGE_METHOD, SPARKS_LIMIT) == SPARKS_LIMIT:
        spark.conf.set(HUGE_METHOD, SETTINGS[HUGE_METHOD])


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside the block alone."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
