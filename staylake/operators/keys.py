"""Surrogate keys and row fingerprints.

Dense, ordered ids (1, 2, 3, ... by a business key, continuing after the
target's current maximum) without a global single-partition window, in one
way for every size:

1. the rows are range-partitioned by the key (``repartitionByRange``: Spark
   samples boundaries; adaptive execution sizes the partitions) and sorted
   inside each partition; a hash of the whole row breaks ties, so a key that
   holds many rows spreads over several partitions;
2. the position of a row inside its partition comes from
   ``monotonically_increasing_id`` (partition index in the upper bits,
   position in the lower 33 bits);
3. rows and positions are written once as Parquet in the shared folder:
   boundaries are sampled anew by every job, so counting and numbering must
   read the very same partitions, also when lost tasks are recomputed;
4. the row counts of the partitions (one row each) become running offsets,
   which are joined back: id = start + offset[partition] + position + 1.

Rows that a caller knows to fit one partition (``buckets=1``) have no offsets,
so steps 3 and 4 fall away.  Ids equal ``row_number() OVER (ORDER BY key)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import run_dir

_POS_BITS = 33


def assign_keys(df: DataFrame, order_cols: Sequence[str], id_col: str,
                start: int = 0, buckets: int | None = None) -> DataFrame:
    """Add ``id_col`` = start + rank of the row by ``order_cols`` (NULLs
    first).  Ties get distinct ids by a hash of the row.  ``buckets`` fixes
    the number of partitions; by default Spark sizes them."""
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    if not set(df.columns) <= set(order_cols):      # else tied rows are equal
        # an expression of the order, so no row carries it through the shuffle
        order.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc())
    if buckets == 1:
        position = F.monotonically_increasing_id()      # of the only partition
        return (df.repartition(1).sortWithinPartitions(*order)
                .withColumn(id_col, (F.lit(start + 1).cast("long") + position).cast("long")))
    ranged = (df.repartitionByRange(buckets, *order) if buckets
              else df.repartitionByRange(*order))
    stage = run_dir(spark, "numbered")
    (ranged.sortWithinPartitions(*order).withColumn("__pos", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(stage))
    rows = spark.read.parquet(stage).withColumn("__part", F.shiftright("__pos", _POS_BITS))
    # One row per partition: small enough for one window and one broadcast.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
               .select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset")))
    local = F.col("__pos").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    new_id = (F.lit(start).cast("long") + F.col("__offset") + local + 1).cast("long")
    return (rows.join(F.broadcast(offsets), "__part").withColumn(id_col, new_id)
            .select(*df.columns, id_col))


def row_fingerprint(cols: Sequence[str]) -> Column:
    """Deterministic SHA-256 hex id of a row's values (repeatable across
    runs, unlike a random UUID).  The values are encoded as a JSON array of
    text, NULLs kept, so different rows never share an encoding."""
    values = F.array(*[F.col(c).cast("string") for c in cols])
    return F.sha2(F.to_json(values), 256)
