"""Small helpers the operators share."""

from __future__ import annotations

import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters; `bytes.split()` cuts the
#: same way, so JVM and Python code agree.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Bytes of a batch that goes to a Python worker. Texts may be very long, and the batch exists in
#: the JVM, in the worker and as Python strings at once.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(df: DataFrame) -> DataFrame:
    """Make a session ready for Python stages over texts.

    Workers on this machine can import the package from a checkout; a cluster ships it with
    `--py-files` as usual, and the extra entry does no harm there. Batches are bounded by bytes:
    the setting of the session is lowered, never raised.
    """
    spark = df.sparkSession
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [have, root]))
    limit = re.fullmatch(r"(\d+)b?", spark.conf.get(_BATCH))
    if limit and int(limit[1]) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see, from `spark.checkpoint.dir`. Only a local session without that
    setting gets a folder of its own; a cluster without it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="llm-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that is written and read back."""
    return os.path.join(shared_folder(spark), f"{name}-{os.urandom(8).hex()}")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared folder, so lost executors cost nothing."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> None:
    """Add the rows of `df` to the Parquet files at `path`. The shuffle files behind them go as soon as they are
    written; else they stay until the driver happens to collect the frame."""
    conf = df.sparkSession.conf
    before = conf.get(_RELEASE, None)
    conf.set(_RELEASE, "true")
    try:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        conf.unset(_RELEASE) if before is None else conf.set(_RELEASE, before)


def n_words(text: str) -> Column:
    """Number of words of a text column; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not use, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
