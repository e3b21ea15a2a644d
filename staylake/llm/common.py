"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import staylake
from staylake.session import run_dir

# A Python task hands rows back in Arrow batches of about this many bytes.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application."""
    context = spark.sparkContext
    if getattr(context, "_staylake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(staylake.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="staylake-"), "staylake_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    context._staylake_shipped = True


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back.

    Cuts the lineage: an executor lost later costs no recomputation.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def emit(rows: Iterable[tuple[int, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as (bytes, values) to record batches of bounded size."""
    held: list[tuple] = []
    size = 0
    for weight, row in rows:
        held.append(row)
        size += weight + 64
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
