"""Session used by the tests, the bench and local runs. Clusters bring their own."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_TUNED = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the plans need. Fused into one generated method the wide projections pass
    the 8000 bytecodes above which the JVM leaves a method uncompiled; with the limit set, Spark
    splits such stages into small methods instead. Single groups run two to four times faster.
    A join whose partitioning serves the aggregation after it is split all the same where a key is
    skewed; only then is there another exchange. Rows of text compress to a tenth and less in a shuffle, so
    partitions are merged up to 4 MB instead of 64 MB, which bounds the memory of a task. A
    task writes up to four partitions of a sink side by side; else its rows, hundreds of columns wide,
    would be sorted by partition and spilled first."""
    for key, value in _TUNED.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """`tune` for the length of a run; the caller's settings come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in _TUNED}
    try:
        yield tune(spark)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see, named by `spark.checkpoint.dir`. Only a local session without
    that setting gets a folder of its own; on a cluster a machine-local one would lose data."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="bureauframe-")


def local_session(cores: str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bureauframe")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
