"""Feature sinks on parquet directories or catalog tables."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from bureauframe.operators.checks import duplicate_keys
from bureauframe.operators.frames import distinct_columns
from bureauframe.sources import commits
from bureauframe.sources.commits import is_path
from bureauframe.sources.tables import partition_columns, read_source

_MODE = "spark.sql.sources.partitionOverwriteMode"


def exists(spark: SparkSession, target: str) -> bool:
    """Whether a sink holds data already. An empty directory counts as missing."""
    if not is_path(target) and not commits.pending(spark, target):
        return spark.catalog.tableExists(target)
    try:
        return bool(read_source(spark, target).columns)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _prepare(df: DataFrame, partition: str | None) -> DataFrame:
    out = distinct_columns(df)
    return out.withColumn(partition, F.col(partition).cast("date")) if partition else out


def _save(writer: DataFrameWriter, target: str) -> None:
    writer.parquet(target) if is_path(target) else writer.format("parquet").saveAsTable(target)


def _check_columns(spark: SparkSession, df: DataFrame, target: str, evolve: bool) -> None:
    """A sink keeps its columns: what the frame has and the sink lacks would vanish, what it lacks
    would be NULL. `evolve` adds new columns to a catalog table instead."""
    have = read_source(spark, target).schema
    known = {f.name.lower() for f in have}
    extra = [f for f in df.schema if f.name.lower() not in known]
    missing = sorted(known - {c.lower() for c in df.columns})
    if evolve and extra and not is_path(target):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({columns})")
        extra = []
    if extra or missing:
        raise ValueError(
            f"columns of {target} differ: new {[f.name for f in extra]}, missing {missing}"
        )
    kinds = {f.name.lower(): f.dataType for f in have}
    changed = [f.name for f in df.schema if kinds.get(f.name.lower(), f.dataType) != f.dataType]
    if changed:
        raise ValueError(f"types of {target} differ: {changed}")


def write_append(
    df: DataFrame, target: str, partition: str | None = None, evolve: bool = False
) -> None:
    """Replace exactly the partitions present in `df`; rerunning a date leaves the others alone.
    Without a partition column the rows are appended. A sink that is there must have the columns of
    `df`; with `evolve` a catalog table gets those it lacks."""
    spark = df.sparkSession
    partition = partition if partition in df.columns else None
    out = _prepare(df, partition)
    commits.recover(spark, target)
    present = exists(spark, target)
    if present:
        _check_columns(spark, out, target, evolve)
    if partition is None:
        _save(out.write.mode("append"), target)
    elif is_path(target) or not present:
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        _save(writer.partitionBy(partition), target)
    else:
        # An existing catalog table keeps its definition: insert by position into its own order.
        before = spark.conf.get(_MODE)
        spark.conf.set(_MODE, "dynamic")
        try:
            out.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(_MODE, before)


def drop_partition(spark: SparkSession, target: str, column: str, value: str) -> None:
    """Remove one partition of a sink."""
    if is_path(target):
        commits.delete(spark, f"{target.rstrip('/')}/{column}={value}")
        spark.catalog.refreshByPath(target)
    else:
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({column} = '{value}')")


def _write_whole(df: DataFrame, target: str, partitions: Sequence[str]) -> None:
    """Replace a sink. The new data is written beside it and takes its place in one commit, so a
    run that stops anywhere leaves the old or the new rows."""
    spark = df.sparkSession
    beside = f"{target.rstrip('/')}__{os.urandom(6).hex()}"
    writer = df.write.partitionBy(*partitions) if partitions else df.write
    _save(writer, beside)
    commits.replace(spark, target, beside)


def write_overwrite(df: DataFrame, target: str, partition: str | None = None) -> None:
    partition = partition if partition in df.columns else None
    commits.recover(df.sparkSession, target)
    _write_whole(_prepare(df, partition), target, [partition] if partition else [])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`old` with the rows of `new` updated or added. Columns only `old` has keep their value.

    As with SQL MERGE, keys of `new` should be unique and a NULL key matches nothing.
    """
    only_old = [c for c in old.columns if c not in new.columns]
    if only_old:
        new = new.join(old.select(*keys, *only_old), list(keys), "left")
    untouched = old.join(new.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(new, allowMissingColumns=True)


def touched_files(
    old: DataFrame, new: DataFrame, keys: Sequence[str], partition: str | None = None
) -> list[str]:
    """Files of `old` that hold a key of `new`. Their names reach the driver, as those of all files
    of a scan do; rows do not. The few values of a partition column prune the scan."""
    at = "_file"
    held = old.select(*keys, F.col("_metadata.file_path").alias(at))
    if partition:
        held = held.join(F.broadcast(new.select(partition).distinct()), partition, "left_semi")
    found = held.join(new.select(*keys), list(keys), "left_semi").select(at).distinct()
    return sorted(row[at] for row in found.collect())


def _merge_files(new: DataFrame, target: str, keys: Sequence[str], partition: str | None) -> None:
    """Copy on write by file: the files that hold a matched key are written again, with their other
    rows and all of `new`, and take the place of the old ones in one commit."""
    spark = new.sparkSession
    old = read_source(spark, target)
    touched = touched_files(old, new, keys, partition)
    folder = commits.location(spark, target)
    if touched:
        kept = spark.read.option("basePath", folder).schema(read_source(spark, target).schema).parquet(*touched)
        merged = upsert(kept, new, keys)
    else:
        only_old = [c for c in old.columns if c not in new.columns]
        merged = new.selectExpr("*", *(f"CAST(NULL AS {dict(old.dtypes)[c]}) AS `{c}`" for c in only_old))
    staged = f"{folder}__staged-{os.urandom(6).hex()}"
    parts = partition_columns(spark, target)
    writer = merged.select(*old.columns).write
    (writer.partitionBy(*parts) if parts else writer).parquet(staged)
    commits.replace_files(spark, target, staged, touched)


def write_merge(
    df: DataFrame, target: str, keys: Sequence[str], partition: str | None = None
) -> None:
    """Upsert into a target, created if absent, which keeps its partition folders.

    Keys of `df` must be unique, as in SQL MERGE. Only files that hold a key of `df` are read whole
    and written again. With a partition column only the partitions of `df` are searched, so it must
    be one of the keys: a row cannot move. Columns the target lacks make all of it be written again,
    for its files have one schema.
    """
    if partition and partition not in keys:
        raise ValueError(f"merge by partition needs {partition!r} among the keys {list(keys)}")
    spark = df.sparkSession
    commits.recover(spark, target)
    new = _prepare(df, partition)
    doubled = [r.asDict() for r in duplicate_keys(new, keys).limit(3).collect()]
    if doubled:
        raise ValueError(f"keys that occur more than once, for example {doubled}")
    if not exists(spark, target):
        write_overwrite(new, target, partition)
        return
    old = read_source(spark, target)
    kinds = dict(old.dtypes)
    if all(kinds.get(name) == kind for name, kind in new.dtypes):
        _merge_files(new, target, keys, partition)
    else:
        _write_whole(upsert(old, new, keys), target, partition_columns(spark, target))


def write(
    df: DataFrame,
    target: str,
    mode: str = "append",
    partition: str | None = None,
    keys: Sequence[str] | None = None,
) -> None:
    if mode == "append":
        write_append(df, target, partition)
    elif mode == "overwrite":
        write_overwrite(df, target, partition)
    elif mode == "merge":
        if not keys:
            raise ValueError("mode 'merge' needs keys")
        write_merge(df, target, keys, partition)
    else:
        raise ValueError(f"unknown write mode {mode!r}")
