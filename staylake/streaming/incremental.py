"""Incremental loads with Structured Streaming.

The stream tracks files landing in a folder; every micro-batch reads its
new CSV files *by header name* (files from different producer versions may
order or extend their columns differently) and merges them into a Parquet
target with the insert-only merge.

File tracking uses the ``binaryFile`` source with only the ``path`` column
selected, so the stream itself never reads file contents; a micro-batch
carries at most ``max_files_per_trigger`` paths, and only those paths come
back to the driver.  ``availableNow`` processes everything that has landed
and stops, so the same code serves scheduled and continuous runs.  The
source checkpoint records processed files; a replayed batch inserts nothing
twice because the merge skips keys already present (NULL keys need
``null_safe=True`` for that).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.merge import insert_only_merge
from ..sources.csv import CSV_NAMES, read_csv_by_name
from ..sources.files import create_empty, file_names, read_stage, remove_path

MAX_FILES_PER_TRIGGER = 1000
COMPILED_BYTES = 8000   # of bytecode: the JVM interprets longer methods, as of rows this wide
# The binaryFile source's fixed columns; only ``path`` is selected.
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def incremental_merge(spark: SparkSession, landing_dir: str, schema: T.StructType,
                      target_path: str, keys: Sequence[str], checkpoint_dir: str,
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      target_schema: T.StructType | None = None,
                      id_col: str | None = None, null_safe: bool = True,
                      max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                      available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery`` (already finished
    when ``available_now``)."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", CSV_NAMES)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", int(max_files_per_trigger))
             .load(landing_dir)
             .select("path"))

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]      # <= max_files_per_trigger rows
        if not paths:
            return
        rows = read_csv_by_name(batch.sparkSession, paths, schema, keep_extra=False)
        rows = transform(rows) if transform else rows
        insert_only_merge(rows, target_path, keys, schema=target_schema, id_col=id_col,
                          null_safe=null_safe, distinct_source=True)

    writer = (files.writeStream.foreachBatch(merge_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def incremental_star(spark: SparkSession, landing_dir: str, warehouse: str, checkpoint_dir: str,
                     schema: T.StructType | None = None, clean_cfg=None, star_opts=None,
                     max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                     available_now: bool = True):
    """Landing CSV files -> per micro-batch: read by name, clean, stage, merge
    into the star schema.  By default every merge matches whole rows with NULL
    equal to NULL, so the tables hold the same rows (apart from surrogate ids)
    for any ``max_files_per_trigger`` and replays add nothing.  Each batch
    stages into its own folder.

    With ``available_now`` a batch is merged while the next one is read: the few files of
    a batch keep few cores busy.  Merges run one at a time, in order.  A batch is listed
    below ``<checkpoint_dir>/pending`` from its staging until it is merged; what a stopped
    run left there is merged first by the next one, and an error of a merge is raised."""
    from .. import schemas as S
    from ..plans.clean import clean_listings
    from ..plans.star import build_star, load_staging, streaming_options

    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", CSV_NAMES)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", int(max_files_per_trigger))
             .load(landing_dir)
             .select("path"))
    base = checkpoint_dir.rstrip("/")

    def merge_batch(session: SparkSession, name: str) -> None:
        build_star(read_stage(session, f"{base}/stage/{name}"), warehouse,
                   star_opts or streaming_options())
        remove_path(session, f"{base}/pending/{name}")

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]      # <= max_files_per_trigger rows
        if not paths:
            return
        session = batch.sparkSession                      # the stream's own session
        session.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_BYTES)
        name = f"batch={batch_id}"
        raw = read_csv_by_name(session, paths, schema or S.LISTING_SCHEMA, keep_extra=False)
        load_staging(clean_listings(raw, clean_cfg), f"{base}/stage/{name}")
        create_empty(session, f"{base}/pending/{name}")
        if merges is None:
            merge_batch(session, name)
            return
        for running in merging:
            running.result()                              # one at a time; raises its error
        merging[:] = [merges.submit(merge_batch, session, name)]

    for name in sorted(file_names(spark, f"{base}/pending"), key=lambda n: int(n.split("=")[1])):
        merge_batch(spark, name)
    writer = (files.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", f"{base}/source"))
    merging: list[Future] = []
    if not available_now:
        merges = None
        return writer.start()
    with ThreadPoolExecutor(max_workers=1) as merges:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        for running in merging:
            running.result()
    return query
