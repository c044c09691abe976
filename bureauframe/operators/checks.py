"""Validation queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureauframe.sources.tables import read_source


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def keys_are_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    return duplicate_keys(df, keys).isEmpty()


def rows_per_partition(df: DataFrame, partition: str) -> DataFrame:
    return df.groupBy(partition).agg(F.count(F.lit(1)).alias("n")).orderBy(partition)


def rows_per_date(spark: SparkSession, source: str, partition: str) -> DataFrame:
    """Rows of each partition of a source by name. The counts come from the footers of its files:
    Spark answers a count of a partition column without reading any data."""
    counts = read_source(spark, source).groupBy(partition).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(partition)


def feature_listing(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One (feature, value) row per feature, values as text: the long form of a wide row."""
    names = [c for c in features.columns if c not in keys]
    as_text = features.select(*keys, *(F.col(c).cast("string").alias(c) for c in names))
    return as_text.unpivot(list(keys), names, "feature", "value")
