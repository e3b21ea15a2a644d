"""Insert-only merges into Parquet targets.

``WHEN NOT MATCHED THEN INSERT`` with no update branch is a left-anti join
of the source against the target's key columns followed by an append.

``merge_into`` adds the new rows as a load of a versioned warehouse: several
tables become visible together, and a membership index keeps a small batch from
reading the whole target.  ``insert_only_merge`` serves a plain folder of Parquet
files: new rows are written once below ``<target>/_pending`` (which readers skip)
and their finished files are then moved into the target.  A merge that finds
a finished pending load publishes the rest of it first; an unfinished one is
discarded.  So a failed load is completed or repeated, never half-counted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_dir
from ..sources.files import path_exists, publish_files, remove_path
from ..sources.snapshots import Load, Snapshot, Transaction
from .keys import assign_keys
from .membership import buckets_for, candidate_files, key_bitmaps, rows_maybe_in
from .quality import all_of

SORTED_ROWS = 250_000       # rows that one task numbers
INDEXED_ROWS = 100_000      # a smaller load costs less to read than to index
HASH = "__key_hash"         # of the keys, in a merge's staged source
PROBES = 50_000_000         # (key, file) pairs that a merge tests against bitmaps
INDEX = "_index"            # below a load's folder; readers of the load skip it

_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
_PLAIN = (*_ORDERED, T.BooleanType, T.BinaryType)      # equal values have equal hashes


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def read_target(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The target table, or None if nothing was written yet.  Any other
    problem (permissions, a broken file, an unknown file system) propagates."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def in_key_range(target: DataFrame, source: DataFrame, key: str, null_safe: bool) -> DataFrame:
    """Target rows whose ``key`` lies in the source's range: a filter that
    Parquet answers from row-group statistics.  Others cannot match."""
    if not isinstance(source.schema[key].dataType, _ORDERED):
        return target
    low, high = source.agg(F.min(key), F.max(key)).first()
    inside = F.lit(False) if low is None else F.col(key).between(low, high)
    return target.where(inside | F.col(key).isNull() if null_safe else inside)


def anti_join(source: DataFrame, target: DataFrame | None, keys: Sequence[str],
              null_safe: bool = False, hash_col: str | None = None,
              size: int | None = None) -> DataFrame:
    """Source rows whose key has no match in the target.

    With ``null_safe`` False (SQL ``=``), a NULL key never matches, so such
    rows are inserted on every run, as a MERGE on ``=`` does.  ``hash_col`` holds
    the source's hashed keys, for key columns of the target's types: rows then meet
    by one long and are told apart by value.  With the source's ``size`` as well,
    target rows that it cannot hold are left out before they are shuffled.
    """
    if target is None:
        return source
    renamed = [f"__t{i}" for i in range(len(keys))]
    theirs = target.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)])
    pairs = [(F.col(k), F.col(r)) for k, r in zip(keys, renamed)]
    cond = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    if hash_col:
        # Behind the renamed columns: Spark infers a constraint from a hash for every
        # subset of the columns that are renamed after it.
        theirs = theirs.withColumn("__th", F.xxhash64(*renamed))
        # Written as two bounds, since every = and <=> becomes a join key (or two).
        cond = [(a <= b) & (a >= b) for a, b in pairs]
        if null_safe:
            cond = [F.coalesce(c, a.isNull() & b.isNull()) for c, (a, b) in zip(cond, pairs)]
        cond.append(F.col(hash_col) == F.col("__th"))
        if size is not None:
            theirs = rows_maybe_in(theirs, "__th", source, hash_col, size)
    # Only distinct target keys matter: a key repeated in the target (e.g. a
    # timestamp shared by many facts) ships one row to the join.
    return source.join(theirs.distinct(), on=all_of(cond), how="left_anti")


def hashable(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys of both tables have equal hashes: plain columns of one type each."""
    types = [(source.schema[k].dataType, target.schema[k].dataType) for k in keys]
    return all(a == b and isinstance(a, _PLAIN) for a, b in types)


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order_cols`` (an aggregation)."""
    others = [c for c in df.columns if c not in keys]
    ordered = list(order_cols) + [c for c in others if c not in order_cols]
    best = F.min(F.struct(*[F.col(c) for c in ordered]))
    return (df.groupBy(*keys).agg(best.alias("__b"))
            .select(*keys, *[F.col(f"__b.{c}").alias(c) for c in others])
            .select(*df.columns))


def finish_pending(spark: SparkSession, target_path: str) -> None:
    """Publish what a stopped run had finished; discard what it had not."""
    pending = f"{target_path.rstrip('/')}/_pending"
    if path_exists(spark, f"{pending}/_SUCCESS"):
        publish_files(spark, pending, target_path)
    elif path_exists(spark, pending):
        remove_path(spark, pending)


def write_new_rows(source: DataFrame, held: Callable[[DataFrame], DataFrame | None],
                   folder: str, keys: Sequence[str], schema: T.StructType | None = None,
                   id_col: str | None = None, start: int = 0,
                   order_cols: Sequence[str] | None = None, null_safe: bool = False,
                   distinct_source: bool = False, dedupe_on_key: bool = False,
                   large_target: bool = False) -> int:
    """Write the source rows whose keys are not held yet to ``folder``; returns
    their number.

    The source is evaluated once, into a table of the shared folder; what the
    merge needs to know of it (size, key range, hashed keys) is read from there.
    ``held`` gets that table and gives the target's rows that can match, or None;
    of a ``large_target`` those that the source cannot hold are not shuffled.
    """
    spark = source.sparkSession
    src = source.distinct() if distinct_source else source
    if dedupe_on_key:
        src = first_per_key(src, keys, order_cols or keys)
    # Parquet has no column of nulls only
    src = src.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name)
                       if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`")
                       for f in src.schema.fields])
    stage = run_dir(spark, "merge-source")
    plain = [k for k in keys if isinstance(src.schema[k].dataType, _PLAIN)]
    src = src.withColumn(HASH, F.xxhash64(*plain) if plain else F.lit(0).cast("long"))
    src.write.option("compression", "zstd").parquet(stage)
    staged = spark.read.schema(src.schema).parquet(stage)
    target = held(staged)
    count = staged.count() if id_col or target is not None else 0      # from the footers
    new = staged
    if target is not None and hashable(staged, target, keys):
        new = anti_join(staged, target, keys, null_safe, HASH, count if large_target else None)
    elif target is not None:
        new = anti_join(staged, target, keys, null_safe)
    new = new.drop(HASH)
    if id_col:
        if target is not None and count > SORTED_ROWS:
            # numbering reads its rows twice (sampled, then sorted), so the join is written
            unseen = run_dir(spark, "merge-new")
            new.write.option("compression", "zstd").parquet(unseen)
            new = spark.read.schema(new.schema).parquet(unseen)
            count = new.count()
            if not count:
                return 0
        parts = -(-count // SORTED_ROWS)
        new = assign_keys(new, list(order_cols or keys), id_col, start=start,
                          buckets=max(1, parts))
    if schema is not None:
        new = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    new.write.mode("overwrite").parquet(folder)
    return spark.read.schema(new.schema).parquet(folder).count()          # from the footers


def insert_only_merge(source: DataFrame, target_path: str, keys: Sequence[str],
                      schema: T.StructType | None = None, id_col: str | None = None,
                      order_cols: Sequence[str] | None = None, null_safe: bool = False,
                      distinct_source: bool = False, dedupe_on_key: bool = False) -> int:
    """Append source rows whose ``keys`` are not in the target folder yet.

    ``id_col`` gets dense ids continuing after the target's maximum, ordered
    by ``order_cols`` (default: the keys).  ``distinct_source`` removes
    duplicate source rows first (a MERGE inserts them all);
    ``dedupe_on_key`` keeps one source row per key.  Returns the number of
    rows appended.  One merge at a time may write to a target.
    """
    spark = source.sparkSession
    finish_pending(spark, target_path)
    target = read_target(spark, target_path, schema)
    # Answered from Parquet footers when aggregate pushdown is on.
    start = target.agg(F.max(id_col)).first()[0] or 0 if id_col and target is not None else 0
    pending = f"{target_path.rstrip('/')}/_pending"

    def held(staged: DataFrame) -> DataFrame | None:
        if target is None:
            return None
        return in_key_range(target.select(*keys), staged, keys[0], null_safe)

    inserted = write_new_rows(source, held, pending, keys, schema, id_col, start, order_cols,
                              null_safe, distinct_source, dedupe_on_key)
    if inserted == 0 and target is not None:
        remove_path(spark, pending)
    else:
        publish_files(spark, pending, target_path)
    return inserted


def matching_rows(snapshot: Snapshot, table: str, batch: DataFrame, keys: Sequence[str],
                  schema: T.StructType, null_safe: bool = False) -> DataFrame | None:
    """Key columns of a table's rows that can match a row of ``batch``.

    Indexed loads are read at the files whose bitmaps hold a key of the batch;
    the others, and those with fewer rows than pairs of key and file to test (or more
    than ``PROBES`` such pairs), within the batch's key range.
    """
    spark = batch.sparkSession
    size = batch.count()
    same = all(batch.schema[k].dataType == schema[k].dataType for k in keys)
    folders = []
    for load in snapshot.tables.get(table, ()):
        folder = f"{snapshot.root}/{load.folder}"
        if same and load.index_keys == tuple(keys) and size * load.files <= min(PROBES, load.rows):
            index = spark.read.parquet(f"{folder}/{INDEX}")
            files = candidate_files(index, batch, keys, load.index_buckets).collect()
            folders += [f"{folder}/{r['file']}" for r in files]
        else:
            folders.append(folder)
    if not folders:
        return None
    rows = spark.read.schema(schema).parquet(*folders).select(*keys)
    return in_key_range(rows, batch, keys[0], null_safe)


def merge_into(tx: Transaction, table: str, source: DataFrame, keys: Sequence[str],
               schema: T.StructType, id_col: str | None = None,
               order_cols: Sequence[str] | None = None, null_safe: bool = False,
               distinct_source: bool = False, dedupe_on_key: bool = False) -> int:
    """The same merge into a table of a versioned warehouse: the new rows become
    a load of the transaction, visible when it is committed.  A load of at least
    ``INDEXED_ROWS`` rows gets a membership index on the merge's keys."""
    spark, before = tx.spark, tx.current
    name = tx.new_folder(table)
    folder = f"{before.root}/{name}"
    start = before.max_id(table)

    def held(staged: DataFrame) -> DataFrame | None:
        if not before.tables.get(table):
            return None
        return matching_rows(before, table, staged, keys, schema, null_safe)

    inserted = write_new_rows(source, held, folder, keys, schema, id_col, start, order_cols,
                              null_safe, distinct_source, dedupe_on_key,
                              large_target=before.rows(table) >= INDEXED_ROWS)
    if not inserted:
        remove_path(spark, folder)
        return 0
    files = buckets = 0
    if inserted >= INDEXED_ROWS:
        rows = spark.read.schema(schema).parquet(folder)
        files = len(rows.inputFiles())
        buckets = buckets_for(inserted, files)
        key_bitmaps(rows, keys, buckets).write.parquet(f"{folder}/{INDEX}")
    tx.add(table, Load(name, inserted, start + inserted if id_col else None,
                       tuple(keys) if buckets else (), buckets, files))
    return inserted


def compact(tx: Transaction, table: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Write a table's loads as one, with a membership index on ``keys``."""
    before = tx.current
    if len(before.tables.get(table, ())) < 2:
        return
    name = tx.new_folder(table)
    folder = f"{before.root}/{name}"
    before.read(tx.spark, table, schema).write.parquet(folder)
    rows = tx.spark.read.schema(schema).parquet(folder)
    files = len(rows.inputFiles())
    buckets = buckets_for(before.rows(table), files)
    key_bitmaps(rows, keys, buckets).write.parquet(f"{folder}/{INDEX}")
    tx.replace(table, Load(name, before.rows(table), before.max_id(table) or None,
                           tuple(keys), buckets, files))
