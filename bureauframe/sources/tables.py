"""Source scans. A source is a catalog table name, a parquet path or a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bureauframe.sources import commits, schemas
from bureauframe.sources.commits import files_at, is_path

Source = str | DataFrame


def read_source(spark: SparkSession, source: Source, fmt: str = "parquet") -> DataFrame:
    """A source whole: while a sink is being replaced, the old or the new rows."""
    return source if isinstance(source, DataFrame) else commits.read(spark, source, fmt)


def partition_columns(spark: SparkSession, source: str) -> list[str]:
    """Partition columns of a table, or of a parquet path written with partition folders."""
    if not is_path(source):
        return [c.name for c in spark.catalog.listColumns(source) if c.isPartition]
    files, at = files_at(spark, source)
    names: list[str] = []
    while files.exists(at):
        inner = [s for s in files.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not inner:
            break
        at = inner[0].getPath()
        names.append(at.getName().partition("=")[0])
    return names


def partition_dates(spark: SparkSession, source: str, column: str) -> list[str] | None:
    """Values of the first partition column, from metadata alone: no file is opened. None if the
    source is not partitioned by `column` first."""
    if partition_columns(spark, source)[:1] != [column]:
        return None
    if is_path(source):
        files, at = files_at(spark, source)
        found = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()]
    else:
        found = [row[0].split("/")[0] for row in spark.sql(f"SHOW PARTITIONS {source}").collect()]
    values = {f.partition("=")[2] for f in found if f.startswith(f"{column}=")}
    return sorted(values - {"__HIVE_DEFAULT_PARTITION__"})


def read_checked(
    spark: SparkSession, source: Source, schema: T.StructType, label: str
) -> DataFrame:
    return schemas.require_columns(read_source(spark, source), schema, label)


def read_tradeline(spark: SparkSession, source: Source, *scrub_dates: str) -> DataFrame:
    """Scan accounts; with dates the filter reaches the partition column, so other dates are
    never listed or opened."""
    df = read_checked(spark, source, schemas.TRADELINE, "tradeline")
    if not scrub_dates:
        return df
    return df.filter(F.col(schemas.SCRUB_DATE).isin([F.lit(d).cast("date") for d in scrub_dates]))


def read_enquiry(spark: SparkSession, source: Source) -> DataFrame:
    return read_checked(spark, source, schemas.ENQUIRY, "enquiry")


def read_master(spark: SparkSession, source: Source) -> DataFrame:
    return read_checked(spark, source, schemas.MASTER, "master")


def read_references(spark: SparkSession, source: Source) -> DataFrame:
    return read_checked(spark, source, schemas.RETRO_INPUT, "retro input")
