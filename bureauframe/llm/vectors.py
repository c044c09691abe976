"""What the two vector searches share: usable rows and their passage to numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOP = 20
QUERY_STEP = 20  #: rows whose vec_id it divides are queries


def usable(table: DataFrame, zero: bool) -> DataFrame:
    """vec_id and v (array of doubles) of rows that take part: vec_id and vector present, every
    component a finite number, not all zero unless `zero`. Lengths other than the most frequent one
    (ties: the shorter) cannot be compared and take no part either."""
    values = F.col("embedding").cast("array<double>")
    good = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & good
    )
    if not zero:
        rows = rows.filter(F.exists(values, lambda x: x != 0))
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.select("vec_id", values.alias("v"))
    return rows.filter(F.size("v") == (length["d"] if length else -1))


def is_query() -> Column:
    return F.col("vec_id") % QUERY_STEP == 0


def matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """Rows of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), kind)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def best(found: DataFrame, kind: str) -> DataFrame:
    """query_id, rank, vec_id and score of the TOP best of each query; ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast(kind).alias("score"))
