"""A layout of the account table that retro runs read without shuffling accounts.

Accounts are bucketed by customer key within each delivery, so the join with the references and the
aggregation after it find all rows of a key in one task. A customer with more accounts than a bucket
should hold would make one task slow: such customers, fewer than there are buckets, are kept in a
plain table beside the bucketed one and go through the ordinary plan, whose exchanges split them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureauframe.sources.schemas import CUSTOMER_KEY, SCRUB_DATE

BUCKETS = 1024
BUCKET_ROWS = 100_000  #: accounts of a bucket, about; larger tables have more buckets


def heavy_table(table: str) -> str:
    return f"{table}_heavy"


def write_colocated(
    accounts: DataFrame,
    table: str,
    buckets: int = BUCKETS,
    widen: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Write the account table `table`, partitioned by delivery and bucketed by customer, and the
    table of heavy customers. One file a bucket and delivery. There are at least `buckets`, and as many
    more as keep a bucket at BUCKET_ROWS accounts, for one task reads a bucket.

    Where accounts are computed from narrower rows with the customer key, give these rows and how to
    `widen` them: then only the narrow ones are shuffled."""
    spark = accounts.sparkSession
    rows = accounts.count()
    buckets = max(buckets, -(-rows // BUCKET_ROWS))
    share = rows / buckets
    counts = accounts.groupBy(CUSTOMER_KEY).agg(F.count(F.lit(1)).alias("_n"))
    heavy = F.broadcast(counts.filter(F.col("_n") > max(share, 1)).select(CUSTOMER_KEY))
    light = accounts.join(heavy, CUSTOMER_KEY, "left_anti").repartition(buckets, CUSTOMER_KEY)
    writer = widen(light).write.format("parquet").mode("overwrite").partitionBy(SCRUB_DATE)
    writer.bucketBy(buckets, CUSTOMER_KEY).sortBy(CUSTOMER_KEY).saveAsTable(table)
    rest = accounts.join(heavy, CUSTOMER_KEY, "left_semi")
    widen(rest).write.format("parquet").mode("overwrite").partitionBy(SCRUB_DATE).saveAsTable(heavy_table(table))


def is_colocated(spark: SparkSession, table: str) -> bool:
    """Whether a table was written by `write_colocated`."""
    if "/" in table or not spark.catalog.tableExists(table):
        return False
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return about.get("Bucket Columns") == f"[`{CUSTOMER_KEY}`]" and spark.catalog.tableExists(heavy_table(table))
