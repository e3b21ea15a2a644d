"""Review summaries that new passes update without reading old reviews.

The state of a summary is a sum and a count per (listing, type): states of
separate passes add up.  A pass is aggregated into such states and becomes a
load of a versioned table; a correction takes the old review out and puts the
new one in, so it is two rows of opposite sign.  Reading adds the loads up;
``compact_summaries`` folds them into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..sources.snapshots import Load, Snapshot, Transaction, read_snapshot

TABLE = "review_state"
SIGN = "sign"       # 1: a review to count, -1: one to take out


def state_schema(listing_type: T.DataType, scale: int) -> T.StructType:
    return T.StructType([
        T.StructField("listing", listing_type), T.StructField("kind", T.StringType()),
        T.StructField("total", T.DecimalType(38, scale)), T.StructField("reviews", T.LongType())])


def _states(reviews: DataFrame, listing: str, kind: str, score: str, scale: int) -> DataFrame:
    sign = F.coalesce(F.col(SIGN), F.lit(1)) if SIGN in reviews.columns else F.lit(1)
    exact = F.col(score).cast(f"decimal(18,{scale})") * sign.cast("decimal(1,0)")
    return _added(reviews.where(F.col(score).isNotNull()).select(
        F.col(listing).alias("listing"), F.col(kind).alias("kind"),
        exact.cast(f"decimal(38,{scale})").alias("total"), sign.cast("long").alias("reviews")), scale)


def _added(states: DataFrame, scale: int) -> DataFrame:
    return (states.groupBy("listing", "kind")
            .agg(F.sum("total").cast(f"decimal(38,{scale})").alias("total"),
                 F.sum("reviews").alias("reviews"))
            .where((F.col("reviews") != 0) | (F.col("total") != 0)))


def add_reviews(spark: SparkSession, warehouse: str, reviews: DataFrame, listing: str,
                kind: str = "kind", score: str = "score", scale: int = 1) -> Snapshot:
    """Add one pass of (listing, kind, score[, sign]) rows as a new version.

    Rows without a score do not count; a NULL type is a type of its own and a
    NULL listing a listing.  Scores are summed as decimals of ``scale`` digits,
    so the result does not depend on how reviews are cut into passes.
    """
    tx = Transaction(spark, warehouse)
    states = _states(reviews, listing, kind, score, scale)
    name = tx.new_folder(TABLE)
    states.write.parquet(f"{tx.current.root}/{name}")
    rows = spark.read.schema(states.schema).parquet(f"{tx.current.root}/{name}").count()
    if rows:
        tx.add(TABLE, Load(name, rows))
    return tx.commit()


def compact_summaries(spark: SparkSession, warehouse: str, listing_type: T.DataType,
                      scale: int = 1) -> Snapshot:
    """Fold the states of all passes into one load."""
    tx = Transaction(spark, warehouse)
    schema = state_schema(listing_type, scale)
    if len(tx.current.tables.get(TABLE, ())) < 2:
        return tx.base
    name = tx.new_folder(TABLE)
    folder = f"{tx.current.root}/{name}"
    _added(tx.current.read(spark, TABLE, schema), scale).write.parquet(folder)
    tx.replace(TABLE, Load(name, spark.read.schema(schema).parquet(folder).count()))
    return tx.commit()


def read_summaries(spark: SparkSession, warehouse: str, listing: str, listing_type: T.DataType,
                   kind: str = "kind", scale: int = 1) -> DataFrame:
    """(listing, kind, avg_score, review_count): what ``reviews.summarize`` gives
    over all reviews counted so far, with an 'all' row per listing."""
    schema = state_schema(listing_type, scale)
    states = _added(read_snapshot(spark, warehouse).read(spark, TABLE, schema), scale)
    rolled = (states.rollup("listing", "kind")
              .agg(F.sum("total").alias("total"), F.sum("reviews").alias("n"),
                   F.grouping("listing").alias("gl"), F.grouping("kind").alias("gk"))
              .where((F.col("gl") == 0) & (F.col("n") != 0)))
    return rolled.select(
        F.col("listing").alias(listing),
        F.when(F.col("gk") == 1, F.lit(S.ALL_TYPE)).otherwise(F.col("kind")).alias(kind),
        F.try_divide(F.col("total").cast("double"), F.col("n").cast("double")).alias("avg_score"),
        F.col("n").alias("review_count"))
