"""Staging load and star-schema build with insert-only merges.

Dimensions are loaded first (property, category, date, location), the fact
last because it joins the category dimension.  Every load is an
insert-only merge keyed like the source warehouse's MERGE statements, so
re-running a load adds nothing new.  All tables of a load are published
together, as one version of the warehouse.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.dates import date_parts, epoch_ms_to_timestamp
from ..operators.merge import merge_into
from ..sources.files import ensure_database, read_stage, replace_stage, with_computed_column
from ..sources.snapshots import Snapshot, Transaction, read_snapshot


def load_staging(df: DataFrame, stage_dir: str, table: str | None = None) -> DataFrame:
    """Add ``normalized_timestamp``, replace the staging folder, read it back.

    The computed column is added before the single write (a table cannot be
    replaced by a query over itself).  With ``table`` ("db.name"), the
    database is created if absent and the staging table is replaced in the
    catalog at the staging folder.  Errors propagate to the caller.
    """
    ts = df.schema["scrape_timestamp"].dataType
    if isinstance(ts, (T.TimestampNTZType, T.TimestampType)):
        norm = F.col("scrape_timestamp").cast("timestamp_ntz")
    else:
        norm = epoch_ms_to_timestamp("scrape_timestamp")
    replace_stage(with_computed_column(df, "normalized_timestamp", norm), stage_dir)
    spark = df.sparkSession
    if table:
        if "." in table:
            ensure_database(spark, table.split(".", 1)[0])
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{stage_dir}'")
    return read_stage(spark, stage_dir)


_PROPERTY_COLS = ("property_url", "address", "wifi_speed", "latitude", "longitude")


@dataclass
class StarOptions:
    null_safe_location: bool = False     # a NULL zone never matches by default
    null_safe: bool = False              # NULL matches NULL in every merge
    distinct_dates: bool = True          # a MERGE would insert equal timestamps twice
    dedupe_property_on_url: bool = False
    # Columns a property is matched on: one URL may hold several rows of one
    # load, later loads add only unseen URLs.
    property_keys: tuple[str, ...] = ("property_url",)
    # The fact's merge key (fact columns).  MATCH_TIMESTAMP is the source
    # load's match: another listing scraped in the same second of a later run
    # is then skipped, and so is the rest of a load whose first rows exist.
    fact_keys: tuple[str, ...] = ("scrape_timestamp", "listing_key")
    distinct_facts: bool = False


MATCH_TIMESTAMP = ("scrape_timestamp",)


def streaming_options() -> StarOptions:
    """Whole-row, NULL-safe matching: the star is the same set of rows however
    the landing files are cut into micro-batches, and replays add nothing."""
    return StarOptions(
        null_safe_location=True, null_safe=True, property_keys=_PROPERTY_COLS, distinct_facts=True,
        fact_keys=("scrape_timestamp", "listing_key", "category_id", *S.FACT_MEASURES))


def _cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields
                       if f.name in df.columns])


def register_star(spark: SparkSession, snapshot: Snapshot, database: str) -> list[str]:
    """Create the database and a view of each star table at one version.

    The catalog replaces views one by one; ``read_star`` reads all five tables
    of one version.
    """
    ensure_database(spark, database)
    names = []
    for table, schema in S.STAR_SCHEMAS.items():
        columns = ", ".join(f"`{f.name}`" for f in schema.fields)
        parts = [f"SELECT {columns} FROM parquet.`{folder}`" for folder in snapshot.folders(table)]
        if not parts:
            nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                              for f in schema.fields)
            parts = [f"SELECT {nulls} WHERE false"]
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS " + " UNION ALL ".join(parts))
        names.append(f"{database}.{table}")
    return names


def build_star(staging: DataFrame, warehouse: str,
               opts: StarOptions | None = None, database: str | None = None) -> dict[str, int]:
    """Merge the staged listings into the four dimensions and the fact.

    The four dimension merges are independent, so they are submitted to
    Spark concurrently (one driver thread each; the cluster runs their
    small jobs side by side); the fact follows once the category dimension
    is complete.  The five loads become one new version of the warehouse: a
    reader sees the star before or after, also if this stops half-way.  Returns
    rows appended per table.
    """
    opts = opts or StarOptions()
    spark = staging.sparkSession
    tx = Transaction(spark, warehouse)

    prop_cols = list(_PROPERTY_COLS)
    ts = F.col("normalized_timestamp")
    dims = {
        "dim_property": lambda: merge_into(
            tx, "dim_property", _cast_to(staging.select(*prop_cols).distinct(), S.DIM_PROPERTY),
            keys=list(opts.property_keys), schema=S.DIM_PROPERTY, id_col="property_id",
            order_cols=prop_cols, dedupe_on_key=opts.dedupe_property_on_url,
            null_safe=opts.null_safe),
        "dim_category": lambda: merge_into(
            tx, "dim_category", staging.select("category").distinct(),
            keys=["category"], schema=S.DIM_CATEGORY, id_col="category_id",
            null_safe=opts.null_safe),
        "dim_date": lambda: merge_into(
            tx, "dim_date", staging.select(ts.alias("scrape_timestamp"), *date_parts(ts)),
            keys=["scrape_timestamp"], schema=S.DIM_DATE, id_col="date_id",
            order_cols=["scrape_timestamp", "day", "month", "year", "weekday"],
            distinct_source=opts.distinct_dates, null_safe=opts.null_safe),
        "dim_location": lambda: merge_into(
            tx, "dim_location", staging.select("city", "zone").distinct(),
            keys=["city", "zone"], schema=S.DIM_LOCATION, id_col="location_id",
            null_safe=opts.null_safe_location or opts.null_safe),
    }
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        futures = {name: pool.submit(fn) for name, fn in dims.items()}
        added = {name: f.result() for name, f in futures.items()}

    categories = tx.current.read(spark, "dim_category", S.DIM_CATEGORY)
    added["fact_property_reviews"] = merge_into(
        tx, "fact_property_reviews", fact_source(staging, categories),
        keys=list(opts.fact_keys), schema=S.FACT_REVIEWS, id_col="fact_id",
        order_cols=["scrape_timestamp", "listing_key"], null_safe=opts.null_safe,
        distinct_source=opts.distinct_facts)
    snapshot = tx.commit()
    if database:
        register_star(spark, snapshot, database)
    return added


def fact_source(staging: DataFrame, categories: DataFrame) -> DataFrame:
    """Staged rows joined to the category dimension (inner: rows whose
    category is NULL or unknown drop out)."""
    rows = staging.select(
        F.col("normalized_timestamp").alias("scrape_timestamp"),
        F.col("property_id").cast("string").alias("listing_key"), "category",
        *[F.col(m).cast("double").alias(m) for m in S.FACT_MEASURES])
    return rows.join(categories.select("category", "category_id"), on="category", how="inner")


def read_star(spark: SparkSession, warehouse: str,
              version: int | None = None) -> dict[str, DataFrame]:
    """The five tables of one version (the newest by default)."""
    snapshot = read_snapshot(spark, warehouse, version)
    return {name: snapshot.read(spark, name, schema) for name, schema in S.STAR_SCHEMAS.items()}
