"""Parquet staging area and catalog tables.

The staging area is a folder that is replaced as a whole on each load; the
catalog tables live at explicit locations below the shared work folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def parquet_profile(spark: SparkSession, path: str) -> DataFrame:
    """Row count, column count and column names of a Parquet folder.

    The schema comes from the file footers; the row count is an aggregate
    that Parquet answers from row-group metadata.
    """
    df = spark.read.parquet(path)
    names = df.columns
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(names)).cast("int").alias("column_count"),
        F.lit(",".join(names)).alias("column_names"))


def replace_stage(df: DataFrame, stage_dir: str) -> str:
    """Empty the staging folder and place the new data (one overwrite)."""
    return write_parquet(df, stage_dir, mode="overwrite")


def read_stage(spark: SparkSession, stage_dir: str) -> DataFrame:
    return spark.read.parquet(stage_dir)


def with_computed_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``SELECT *, expr AS name``: computed before the single write, since a
    table cannot be overwritten by a query that reads it."""
    return df.select("*", expr.alias(name))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    return name


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 location: str) -> str:
    """Create an empty typed Parquet table at ``location`` if absent."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{location}'")
    return name


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               location: str | None = None) -> str:
    writer = df.write.mode(mode).format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return name


def file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists; storage errors propagate."""
    fs, location = file_system(spark, path)
    return fs.exists(location)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, location = file_system(spark, path)
    fs.delete(location, True)


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file, replaced if it exists."""
    fs, location = file_system(spark, path)
    fs.create(location, True).close()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if it does not exist."""
    fs, location = file_system(spark, folder)
    if not fs.exists(location):
        return []
    return [s.getPath().getName() for s in fs.listStatus(location)]


def publish_files(spark: SparkSession, done_dir: str, target_dir: str) -> None:
    """Move the part files of a finished write into a table's folder.

    Each move is one rename; a run that stops half-way leaves the rest in
    ``done_dir``, and calling this again finishes it, adding nothing twice.
    """
    fs, source = file_system(spark, done_dir)
    _, target = file_system(spark, target_dir)
    fs.mkdirs(target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(source):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(status.getPath(), path(target, name)):
            raise OSError(f"could not move {status.getPath()} to {target}")
    fs.delete(source, True)
