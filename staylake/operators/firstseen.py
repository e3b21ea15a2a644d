"""Links that no earlier run has seen.

The set of canonical URLs of all runs is a bucketed table: every run's rows are
hashed by URL into the same number of buckets.  A run shuffles its own links to
those buckets and joins them there; the table side is read bucket by bucket and
never moved, however many runs it holds, as long as it has at least as many
buckets as ``spark.sql.shuffle.partitions`` (with fewer, Spark moves both sides to
keep its parallelism; give thousands on a cluster).  New URLs are appended; ``compact_seen``
rewrites the table with one file per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .extract import first_per_canonical

BUCKETS = 64


def unseen_links(links: DataFrame, table: str, order_cols: Sequence[str],
                 href: str = "href") -> DataFrame:
    """The first link of every canonical URL that ``table`` does not hold."""
    spark = links.sparkSession
    firsts = first_per_canonical(links.where(F.col(href).isNotNull()), order_cols, href)
    if not spark.catalog.tableExists(table):
        return firsts
    seen = spark.table(table).select("canonical").hint("merge")
    return firsts.join(seen, "canonical", "left_anti")


def record_links(links: DataFrame, table: str, location: str, order_cols: Sequence[str], run: int,
                 href: str = "href", buckets: int = BUCKETS) -> str:
    """Append a run's unseen links with its number; returns the table's name.

    Two runs hold what one run over both would: the first link, by run and then
    ``order_cols``, of every canonical URL.  NULL links are no links; a repeated
    run adds nothing.
    """
    new = unseen_links(links, table, order_cols, href).withColumn("run", F.lit(run))
    (new.write.format("parquet").mode("append").bucketBy(buckets, "canonical")
     .sortBy("canonical").option("path", location).saveAsTable(table))
    return table


def compact_seen(spark: SparkSession, table: str, into: str, location: str,
                 buckets: int = BUCKETS) -> str:
    """The same set as a new table ``into`` with one file per bucket."""
    (spark.table(table).repartition(buckets, "canonical").write.format("parquet")
     .bucketBy(buckets, "canonical").sortBy("canonical").option("path", location)
     .saveAsTable(into))
    return into
