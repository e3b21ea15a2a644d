"""Incremental loads whose state store, not the target, decides what is new.

Two streams hand over through a folder of typed rows below the checkpoint:

1. landing CSV files are read by header name, a micro-batch at a time, and their
   rows written as Parquet, one row per key (the smallest of a batch);
2. these rows go through ``dropDuplicates`` on the keys, whose state RocksDB
   keeps on disk and in the checkpoint; what passes becomes a load of a
   versioned table, with ids that continue from the manifest.

A micro-batch therefore reads its own rows and the state of its keys, however
large the target is.  A checkpoint that is new to a table which holds rows
already takes up their keys first, once.  A repeated micro-batch finds its load
in the manifest and adds nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import assign_keys
from ..operators.merge import SORTED_ROWS, first_per_key
from ..operators.quality import all_of
from ..sources.csv import CSV_NAMES, read_csv_by_name
from ..sources.files import path_exists
from ..sources.snapshots import Load, Transaction, read_snapshot
from .incremental import BINARY_FILE_SCHEMA, MAX_FILES_PER_TRIGGER

_HELD = "__held"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _parse_landing(spark: SparkSession, landing_dir: str, schema: T.StructType,
                   keys: Sequence[str], checkpoint_dir: str, max_files_per_trigger: int) -> None:
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", CSV_NAMES).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", int(max_files_per_trigger))
             .load(landing_dir).select("path"))

    def parse(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]      # <= max_files_per_trigger rows
        if not paths:
            return
        rows = read_csv_by_name(batch.sparkSession, paths, schema, keep_extra=False)
        plain = all_of([F.col(k).isNotNull() for k in keys])
        first = first_per_key(rows.where(plain), keys, keys).unionByName(rows.where(~plain))
        (first.withColumn(_HELD, F.lit(False)).write.mode("overwrite")
         .parquet(f"{checkpoint_dir}/rows/batch-{batch_id:09d}"))

    (files.writeStream.foreachBatch(parse).option("checkpointLocation", f"{checkpoint_dir}/landing")
     .trigger(availableNow=True).start().awaitTermination())


def _load_new_rows(spark: SparkSession, schema: T.StructType, warehouse: str, table: str,
                   keys: Sequence[str], checkpoint_dir: str, null_safe: bool,
                   id_col: str | None, order_cols: Sequence[str], stream_id: str):
    held = T.StructType([*schema.fields, T.StructField(_HELD, T.BooleanType())])
    rows = spark.readStream.schema(held).parquet(f"{checkpoint_dir}/rows/*")
    if null_safe:
        new = rows.dropDuplicates(list(keys))
    else:                                       # a NULL key never matches
        plain = all_of([F.col(k).isNotNull() for k in keys])
        new = rows.where(plain).dropDuplicates(list(keys)).union(rows.where(~plain))

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        tx = Transaction(session, warehouse)
        name = f"{table}/{stream_id}-{batch_id:09d}"
        if any(load.folder == name for load in tx.current.tables.get(table, ())):
            return                              # this micro-batch was published before
        start, folder = tx.current.max_id(table), f"{tx.current.root}/{name}"
        # written once: state may only be read in one pass of a micro-batch
        staged = f"{checkpoint_dir}/new/batch-{batch_id:09d}"
        batch.where(~F.col(_HELD)).drop(_HELD).write.mode("overwrite").parquet(staged)
        fresh = session.read.schema(schema).parquet(staged)
        count = fresh.count()
        if not count:
            return
        if id_col:
            fresh = assign_keys(fresh, list(order_cols), id_col, start=start,
                                buckets=-(-count // SORTED_ROWS))
        fresh.write.mode("overwrite").parquet(folder)
        tx.add(table, Load(name, count, start + count if id_col else None))
        tx.commit()

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (new.writeStream.foreachBatch(load)
                 .option("checkpointLocation", f"{checkpoint_dir}/state")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    return query


def incremental_distinct(spark: SparkSession, landing_dir: str, schema: T.StructType,
                         warehouse: str, table: str, keys: Sequence[str], checkpoint_dir: str,
                         null_safe: bool = True, id_col: str | None = None,
                         order_cols: Sequence[str] | None = None,
                         max_files_per_trigger: int = MAX_FILES_PER_TRIGGER):
    """Load what has landed since the last call; returns the second stream's
    finished ``StreamingQuery``, whose progress counts the rows it read.

    ``table`` gets the rows of ``schema`` (and ``id_col``, dense, in
    ``order_cols`` within a micro-batch) whose ``keys`` no earlier row had.  A NULL
    in a key matches NULL, or with ``null_safe=False`` nothing.  An empty landing
    folder loads nothing.
    """
    base = checkpoint_dir.rstrip("/")
    stream_id = "stream-" + hashlib.sha256(base.encode()).hexdigest()[:12]
    args = (spark, schema, warehouse, table, keys, base, null_safe, id_col,
            list(order_cols or keys), stream_id)
    snapshot = read_snapshot(spark, warehouse)
    if snapshot.rows(table) and not path_exists(spark, f"{base}/state"):
        rows = snapshot.read(spark, table, schema).select(*keys).distinct()
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields
                  if f.name not in keys]
        (rows.select(*keys, *others).select(*[f.name for f in schema.fields])
         .withColumn(_HELD, F.lit(True)).write.mode("overwrite").parquet(f"{base}/rows/held"))
        _load_new_rows(*args)
    _parse_landing(spark, landing_dir, schema, keys, base, max_files_per_trigger)
    if not path_exists(spark, f"{base}/rows"):
        return None
    return _load_new_rows(*args)
