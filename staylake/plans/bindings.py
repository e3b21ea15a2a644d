"""Operators bound to the shared test tables, each with an equivalent SQL.

The test tables are TPC-H-like (orders, lineitem, part, customer, ...), not
listings, so listing-shaped inputs are composed from their columns with
plain SQL expressions.  The same expressions feed the Spark plan and the
SQL check, so both sides see identical inputs; the operator under test is
then applied with this library on the Spark side and written out in SQL
on the other.

Every query reads whole tables.  Queries that exercise writers (CSV, stage,
merges, streams) write below the session's shared work folder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.dates import (date_parts, epoch_ms_to_timestamp, normalize_timestamp,
                               parse_timestamp, run_id, timestamp_to_epoch_ms)
from ..functions import variants
from ..functions.text import json_field
from ..operators import (extract, firstseen, keys, merge, metrics, nearest, profiles, quality, reviews,
                         summaries)
from ..session import run_dir
from ..sources import csv as csvio
from ..sources import files
from ..sources.pages import read_pages
from ..sources.snapshots import read_snapshot
from ..streaming.incremental import incremental_merge, incremental_star
from ..streaming.stateful import incremental_distinct
from .clean import CleanConfig, clean_listings
from .etl import RunConfig, run_etl
from .listing_pages import extract_listings
from .star import MATCH_TIMESTAMP, StarOptions, build_star, load_staging, read_star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cte(name: str, exprs: list[tuple[str, str]], source: str) -> str:
    body = ",\n    ".join(f"{e} AS {n}" for n, e in exprs)
    return f"{name} AS (SELECT\n    {body}\n  FROM {source})"


def _view(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in exprs])


# ---------------------------------------------------------------------------
# Listing-shaped view of lineitem (one listing per line item).
# ---------------------------------------------------------------------------
LISTING_EXPRS: list[tuple[str, str]] = [
    ("property_id", "CAST(l_orderkey * 10 + l_linenumber AS STRING)"),
    ("scrape_timestamp", "l_shipdate"),
    ("property_url", "concat('https://stay.example.com/hotel/', CAST(l_partkey AS STRING), '.html?aid=', CAST(l_suppkey AS STRING))"),
    ("category", "CASE l_returnflag WHEN 'A' THEN 'Hotel' WHEN 'N' THEN 'Riad' ELSE 'Apartment' END"),
    ("general_review", "l_tax * 100"),
    ("general_review_count", "CAST(floor(l_quantity) AS BIGINT)"),
    ("comfort_score", "l_discount * 100"),
    ("value_score", "l_tax * 100"),
    ("location_score", "l_quantity / 5"),
    ("wifi_score", "l_quantity / 6"),
    ("avg_review_score_all", "l_extendedprice / (l_quantity * 200)"),
    ("avg_review_score_all_count",
     "l_linenumber + CAST(floor(l_quantity) AS BIGINT) % 4 + CAST(floor(l_quantity) AS BIGINT) % 7"
     " + l_linenumber % 3 + (l_linenumber + 1)"
     " + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"),
    ("avg_review_score_families", "l_quantity / 5"),
    ("avg_review_score_families_count", "CAST(l_linenumber AS BIGINT)"),
    ("avg_review_score_couples", "l_discount * 100"),
    ("avg_review_score_couples_count", "CAST(floor(l_quantity) AS BIGINT) % 4"),
    ("avg_review_score_solo_travelers", "l_tax * 100 + 1"),
    ("avg_review_score_solo_travelers_count", "CAST(floor(l_quantity) AS BIGINT) % 7"),
    ("avg_review_score_business_travellers", "10 - l_discount * 100"),
    ("avg_review_score_business_travellers_count", "CAST(l_linenumber % 3 AS BIGINT)"),
    ("avg_review_score_groups_friends", "(l_quantity + l_linenumber) / 6"),
    ("avg_review_score_groups_friends_count", "CAST(l_linenumber + 1 AS BIGINT)"),
    ("min_price", "l_extendedprice * (1 - l_discount)"),
    ("max_price", "CASE WHEN l_linenumber = 7 THEN l_extendedprice * l_discount ELSE l_extendedprice * (1 + l_tax) END"),
    ("latitude", "l_quantity * 2 - 10"),
    ("longitude", "l_discount * 1000 - 20"),
    ("address", "concat_ws('  ', concat('Riad ', CAST(l_partkey AS STRING)),"
                " CASE WHEN l_suppkey % 3 = 0 THEN concat('Commune de Sidi ', CAST(l_suppkey AS STRING)) END,"
                " CASE WHEN l_suppkey % 3 = 1 THEN concat('Hay ', CAST(l_suppkey AS STRING)) END,"
                " CASE l_returnflag WHEN 'A' THEN 'Marrakech Medina' WHEN 'N' THEN 'Tangier Prefecture' ELSE 'Marrakesh-Safi' END,"
                " 'Morocco')"),
    ("zone", "CASE WHEN l_linestatus = 'O' THEN NULL ELSE concat('Zone ', CAST(l_suppkey AS STRING)) END"),
    ("city", "CASE WHEN l_linenumber % 2 = 0 THEN 'Tamansourt' ELSE 'Ksar' END"),
    ("wifi_speed", "'Not specified'"),
]
LISTINGS_CTE = _cte("listings", LISTING_EXPRS, "lineitem")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(table(spark, sf_dir, "lineitem"), LISTING_EXPRS)


# SQL fragments shared by the listing checks.
_SCORES = S.RULE_SCORES
_COUNTS = S.RULE_COUNTS
SQL_SCORE_RANGE = " AND ".join(f"({c} > 0 AND {c} < 10)" for c in _SCORES)
SQL_POSITIVE = " AND ".join(f"{c} > 0" for c in _COUNTS)
SQL_GEO = "(latitude > -90 AND latitude < 90) AND (longitude > -180 AND longitude < 180)"
SQL_PRICE = "min_price >= 0 AND max_price >= min_price"
SQL_TYPE_COUNT_SUM = " + ".join(S.count_col(t) for t in S.TRAVELER_TYPES)
SQL_WEIGHTED = ("(" + " + ".join(f"{s} * {c}" for s, c in S.WEIGHT_PAIRS) + ") / nullif("
                + " + ".join(c for _, c in S.WEIGHT_PAIRS) + ", 0)")


def _sql_any(col: str, words: list[str], fn: str = "contains") -> str:
    return "(" + " OR ".join(f"{fn}({col}, '{w}')" for w in words) + ")"


def _sql_zone(address: str) -> str:
    """Zone from address in SQL list functions (1-based lists)."""
    parts = (f"list_filter(list_transform(string_split({address}, '  '), lambda x: trim(x)),"
             f" lambda x: x <> '')")
    by_prefix = f"list_filter({parts}, lambda x: {_sql_any('x', extract.ZONE_PREFIXES, 'starts_with')})[1]"
    pos = (f"list_position(list_transform({parts}, lambda x, i: i > 1 AND "
           f"{_sql_any('x', extract.REGION_WORDS)}), true)")
    before = f"CASE WHEN {pos} > 1 THEN {parts}[{pos} - 1] END"
    return f"coalesce({by_prefix}, {before})"


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])
NATION_SCHEMA = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
    T.StructField("n_regionkey", T.IntegerType()),
])


@query("csv_union_by_name", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def csv_union_by_name(spark, sf):
    o = table(spark, sf, "orders")
    d = run_dir(spark, "csv_union")
    csvio.write_csv(o.where(F.col("o_orderstatus") == "F"), f"{d}/landing/full")
    csvio.write_csv(o.where(F.col("o_orderstatus") != "F")
                    .select("o_orderdate", "o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey"),
                    f"{d}/landing/reordered")
    return csvio.read_csv_by_name(spark, f"{d}/landing", ORDERS_SCHEMA)


@query("csv_inferred_read", "SELECT r_regionkey, r_name FROM region")
def csv_inferred_read(spark, sf):
    d = run_dir(spark, "csv_inferred")
    csvio.write_csv(table(spark, sf, "region"), d)
    return csvio.read_csv_inferred(spark, d)


# A file with line breaks in its values is one task's to read, so files of texts are kept small.
_FILE_TEXTS = 5_000


@query("csv_inferred_documents", """
SELECT CAST(doc_id AS INTEGER) AS doc_id, '"' || text || '", ' || chr(10) || ' end' AS body,
       nullif(lang, 'en') AS lang, CAST(n_chars AS INTEGER) AS n_chars,
       n_chars / 4.0E0 AS quarter FROM documents""")
def csv_inferred_documents(spark, sf):
    """Inferred types of a growing table with quotes, line breaks and nulls."""
    d = run_dir(spark, "csv_inferred_documents")
    csvio.write_csv(table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('"'), "text", F.lit('", \n end')).alias("body"),
        F.nullif("lang", F.lit("en")).alias("lang"), "n_chars",
        (F.col("n_chars") / 4.0).alias("quarter")), d, max_records_per_file=_FILE_TEXTS)
    return csvio.read_csv_inferred(spark, d)


@query("raw_snapshot_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def raw_snapshot_orders(spark, sf):
    path = csvio.snapshot_csv(table(spark, sf, "orders"), run_dir(spark, "raw_snapshot_orders"),
                              "20250904_081719")
    return csvio.read_csv_by_name(spark, path, ORDERS_SCHEMA, keep_extra=False)


@query("raw_snapshot", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def raw_snapshot(spark, sf):
    d = run_dir(spark, "raw_snapshot")
    path = csvio.snapshot_csv(table(spark, sf, "nation"), d, "20250904_081719")
    return csvio.read_csv_by_name(spark, path, NATION_SCHEMA)


_TEXT_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("body", T.StringType()),
                             T.StructField("n_chars", T.IntegerType())])


@query("csv_quoted_text", """
SELECT doc_id, '"' || text || '", ' || chr(10) || ' end' AS body, CAST(n_chars AS INTEGER) AS n_chars
FROM documents""")
def csv_quoted_text(spark, sf):
    """Text with quotes, commas and line breaks, counts written as 12.0, in a
    folder whose name holds a space and glob characters."""
    d = f"{run_dir(spark, 'csv_quoted')}/a b [1] {{x}}*?"
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('"'), "text", F.lit('", \n end')).alias("body"),
        F.concat(F.col("n_chars").cast("string"), F.lit(".0")).alias("n_chars"))
    csvio.write_csv(docs.where("doc_id % 2 = 0"), f"{d}/even",
                    max_records_per_file=_FILE_TEXTS)
    csvio.write_csv(docs.where("doc_id % 2 = 1").select("n_chars", "body", "doc_id"), f"{d}/odd",
                    max_records_per_file=_FILE_TEXTS)
    return csvio.read_csv_by_name(spark, d, _TEXT_SCHEMA)


@query("append_with_defaults", """
SELECT o_orderkey AS key, o_orderpriority AS category, CAST(0 AS BIGINT) AS general_review_count,
       CAST(NULL AS VARCHAR) AS city FROM orders
UNION ALL SELECT c_custkey, c_mktsegment, 0, NULL FROM customer""")
def append_with_defaults(spark, sf):
    """Two appends; the second reads the folder's header, both fill defaults."""
    d = run_dir(spark, "append_defaults")
    base = ["key", "category", "general_review_count", "city"]
    for name, key, category in (("orders", "o_orderkey", "o_orderpriority"),
                                ("customer", "c_custkey", "c_mktsegment")):
        rows = table(spark, sf, name).select(F.col(key).alias("key"), F.col(category).alias("category"),
                                             F.lit(None).cast("long").alias("general_review_count"))
        csvio.append_records(rows, d, base)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("category", T.StringType()),
                           T.StructField("general_review_count", T.LongType()),
                           T.StructField("city", T.StringType())])
    return csvio.read_csv_by_name(spark, d, schema)


@query("parquet_profile", """
SELECT count(*) AS row_count, CAST(6 AS INTEGER) AS column_count,
       'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' AS column_names
FROM part""")
def parquet_profile(spark, sf):
    path = files.write_parquet(table(spark, sf, "part"), run_dir(spark, "parquet_profile"))
    return files.parquet_profile(spark, path)


@query("stage_overwrite", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def stage_overwrite(spark, sf):
    s = table(spark, sf, "supplier")
    d = run_dir(spark, "stage")
    files.replace_stage(s.withColumn("s_acctbal", -F.col("s_acctbal")), f"{d}/stage")
    files.replace_stage(s, f"{d}/stage")
    name = f"staylake_stage_{d.rsplit('-', 1)[-1]}"
    files.save_table(files.read_stage(spark, f"{d}/stage"), name, "overwrite", f"{d}/table")
    return spark.table(name)


@query("staging_with_timestamp", """
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS normalized_timestamp
FROM events""")
def staging_with_timestamp(spark, sf):
    e = table(spark, sf, "events").select("event_id", timestamp_to_epoch_ms("ts").alias("epoch_ms"))
    staged = files.with_computed_column(e, "normalized_timestamp", epoch_ms_to_timestamp("epoch_ms"))
    d = files.replace_stage(staged, run_dir(spark, "staging_ts"))
    return files.read_stage(spark, d)


@query("append_with_new_fields", """
SELECT r_regionkey AS key, r_name AS name, CAST(NULL AS INTEGER) AS name_length,
       CAST(NULL AS INTEGER) AS regionkey FROM region
UNION ALL
SELECT n_nationkey, n_name, CAST(length(n_name) AS INTEGER), n_regionkey FROM nation""")
def append_with_new_fields(spark, sf):
    d = run_dir(spark, "append_fields")
    base = ["key", "name"]
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    csvio.append_records(r, d, base, fill=False)
    n = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("regionkey"), F.length("n_name").alias("name_length"))
    csvio.append_records(n, d, base, batch_size=10, fill=False)
    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("name_length", T.IntegerType()),
                           T.StructField("regionkey", T.IntegerType())])
    return csvio.read_csv_by_name(spark, d, schema)


@query("append_orders_with_new_fields", """
SELECT o_orderkey AS key, o_orderstatus AS status, CAST(NULL AS BIGINT) AS customer,
       CAST(NULL AS DOUBLE) AS price FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def append_orders_with_new_fields(spark, sf):
    """Appends whose later rows bring fields that the folder does not have."""
    d = run_dir(spark, "append_orders")
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer"))
    csvio.append_records(o.where("status = 'F'").select("key", "status"), d, ["key", "status"], fill=False)
    csvio.append_records(o.where("status <> 'F'"), d, ["key", "status"], batch_size=10_000, fill=False)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("status", T.StringType()),
                           T.StructField("customer", T.LongType()), T.StructField("price", T.DoubleType())])
    return csvio.read_csv_by_name(spark, d, schema)


_FILL_EXPRS = [
    ("o_orderkey", "o_orderkey"),
    ("category", "nullif(o_orderpriority, '5-LOW')"),
    ("city", "nullif(o_orderstatus, 'P')"),
    ("min_price", "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END"),
    ("general_review_count", "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END"),
]


@query("default_fill", f"""
WITH {_cte('src', _FILL_EXPRS, 'orders')}
SELECT o_orderkey, coalesce(category, '') AS category, coalesce(city, '') AS city,
       coalesce(min_price, 0) AS min_price, coalesce(general_review_count, 0) AS general_review_count
FROM src""")
def default_fill(spark, sf):
    src = _view(table(spark, sf, "orders"), _FILL_EXPRS)
    return csvio.fill_defaults(src, ["category", "city"])


@query("drop_duplicate_rows", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def drop_duplicate_rows(spark, sf):
    return quality.drop_duplicate_rows(table(spark, sf, "orders").select("o_custkey", "o_orderpriority"))


@query("duplicate_rows", """
SELECT o_custkey, o_orderpriority FROM (
  SELECT o_custkey, o_orderpriority,
         count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS n FROM orders) t
WHERE n > 1""")
def duplicate_rows(spark, sf):
    return quality.duplicated_rows(table(spark, sf, "orders").select("o_custkey", "o_orderpriority"))


# ---------------------------------------------------------------------------
# Metrics and data quality over the listing view
# ---------------------------------------------------------------------------
_LISTING_COLS = [n for n, _ in LISTING_EXPRS]
_WITH_WAVG = (_LISTING_COLS[:_LISTING_COLS.index("general_review_count") + 1] + ["weighted_avg"]
              + _LISTING_COLS[_LISTING_COLS.index("general_review_count") + 1:])


@query("insert_weighted_avg", f"""
WITH {LISTINGS_CTE}
SELECT {', '.join(c if c != 'weighted_avg' else SQL_WEIGHTED + ' AS weighted_avg' for c in _WITH_WAVG)}
FROM listings""")
def insert_weighted_avg(spark, sf):
    return metrics.insert_after(listings(spark, sf), "general_review_count", "weighted_avg",
                                metrics.weighted_avg())


@query("count_consistency", f"""
WITH {LISTINGS_CTE}
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE coalesce({SQL_TYPE_COUNT_SUM} = avg_review_score_all_count, false)) AS consistent_rows,
       count(*) FILTER (WHERE NOT coalesce({SQL_TYPE_COUNT_SUM} = avg_review_score_all_count, false)) AS inconsistent_rows
FROM listings""")
def count_consistency(spark, sf):
    return quality.consistency_report(listings(spark, sf))


@query("score_range", f"""
WITH {LISTINGS_CTE}
SELECT property_id, {', '.join(_SCORES)} FROM listings WHERE {SQL_SCORE_RANGE}""")
def score_range(spark, sf):
    df = quality.nan_to_null(listings(spark, sf))
    return quality.apply_rules(df, {"score_range": quality.scores_in_range()}).select("property_id", *_SCORES)


@query("positive_counts", f"""
WITH {LISTINGS_CTE}
SELECT property_id, {', '.join(_COUNTS)} FROM listings WHERE {SQL_POSITIVE}""")
def positive_counts(spark, sf):
    return quality.apply_rules(listings(spark, sf), {"positive_counts": quality.counts_positive()}) \
        .select("property_id", *_COUNTS)


@query("geo_valid", f"""
WITH {LISTINGS_CTE}
SELECT property_id, latitude, longitude FROM listings WHERE {SQL_GEO}""")
def geo_valid(spark, sf):
    df = quality.nan_to_null(listings(spark, sf), ["latitude", "longitude"])
    return quality.apply_rules(df, {"geo": quality.geo_valid()}).select("property_id", "latitude", "longitude")


@query("price_valid", f"""
WITH {LISTINGS_CTE}
SELECT property_id, min_price, max_price FROM listings WHERE {SQL_PRICE}""")
def price_valid(spark, sf):
    df = quality.nan_to_null(listings(spark, sf), ["min_price", "max_price"])
    return quality.apply_rules(df, {"price": quality.price_valid()}).select("property_id", "min_price", "max_price")


@query("dq_report", f"""
WITH {LISTINGS_CTE}
SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE NOT coalesce({SQL_SCORE_RANGE}, false)) AS failed_score_range,
  count(*) FILTER (WHERE NOT coalesce({SQL_POSITIVE}, false)) AS failed_positive_counts,
  count(*) FILTER (WHERE NOT coalesce({SQL_GEO}, false)) AS failed_geo_valid,
  count(*) FILTER (WHERE NOT coalesce({SQL_PRICE}, false)) AS failed_price_valid,
  count(*) FILTER (WHERE coalesce({SQL_SCORE_RANGE}, false) AND coalesce({SQL_POSITIVE}, false)
                     AND coalesce({SQL_GEO}, false) AND coalesce({SQL_PRICE}, false)) AS passed_all,
  count(*) FILTER (WHERE coalesce({SQL_TYPE_COUNT_SUM} = avg_review_score_all_count, false)) AS consistent_counts
FROM listings""")
def dq_report(spark, sf):
    df = quality.nan_to_null(listings(spark, sf))
    return quality.dq_report(df, quality.default_rules(),
                             {"consistent_counts": quality.counts_consistent()})


_CITY_RULES = [("NATION_1", "North City"), ("MACHINERY", "Machine City")]
_CUST_ADDR = [
    ("c_custkey", "c_custkey"),
    ("address", "CASE WHEN c_acctbal < 0 THEN NULL ELSE concat_ws('  ', c_name, n_name, c_mktsegment) END"),
    ("city", "c_mktsegment"),
]


@query("city_override", f"""
WITH {_cte('src', _CUST_ADDR, 'customer JOIN nation ON c_nationkey = n_nationkey')}
SELECT c_custkey, address,
       CASE WHEN contains(address, 'MACHINERY') THEN 'Machine City'
            WHEN contains(address, 'NATION_1') THEN 'North City' ELSE city END AS city
FROM src""")
def city_override(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    src = _view(c.join(n, c.c_nationkey == n.n_nationkey), _CUST_ADDR)
    return src.withColumn("city", extract.city_override("city", "address", _CITY_RULES))


_SUPP_ADDR = [
    ("s_suppkey", "s_suppkey"),
    ("address", "concat_ws('  ', s_name,"
                " CASE WHEN s_suppkey % 4 = 0 THEN concat('Commune de ', n_name)"
                "      WHEN s_suppkey % 4 = 1 THEN concat('Quartier ', n_name) END,"
                " CASE WHEN s_nationkey % 2 = 0 THEN concat('Province ', r_name) ELSE r_name END)"),
    ("zone", "CASE WHEN s_acctbal > 5000 THEN concat('Z', CAST(s_suppkey AS STRING)) END"),
]
_SUPP_JOIN = "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query("zone_from_address", f"""
WITH {_cte('src', _SUPP_ADDR, _SUPP_JOIN)}
SELECT s_suppkey, address, coalesce(zone, {_sql_zone('address')}) AS zone FROM src""")
def zone_from_address(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    joined = (s.join(n, s.s_nationkey == n.n_nationkey)
              .join(r, F.col("n_regionkey") == r.r_regionkey))
    return metrics.fill_missing(_view(joined, _SUPP_ADDR), "zone", extract.zone_from_address("address"))


# ---------------------------------------------------------------------------
# Dates
# ---------------------------------------------------------------------------
_TS_TEXT_SQL = ("CASE WHEN event_type IN ('click', 'view') THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)"
                " WHEN event_type = 'error' THEN 'not a time'"
                " ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END")


@query("normalize_timestamp", f"""
WITH t AS (SELECT event_id, {_TS_TEXT_SQL} AS ts_text FROM events),
n AS (SELECT event_id, ts_text,
  CASE WHEN regexp_full_match(ts_text, '\\s*-?[0-9]+(\\.[0-9]+)?\\s*') THEN
    strftime(make_timestamp(CAST(round(CAST(ts_text AS DOUBLE) * 1000) AS BIGINT)), '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN CAST(round(CAST(ts_text AS DOUBLE) * 1000) AS BIGINT) % 1000000 <> 0
            THEN '.' || strftime(make_timestamp(CAST(round(CAST(ts_text AS DOUBLE) * 1000) AS BIGINT)), '%f')
            ELSE '' END || '+00:00'
  ELSE ts_text END AS normalized FROM t)
SELECT event_id, ts_text, normalized, try_cast(normalized AS TIMESTAMP) AS parsed FROM n""")
def normalize_timestamp_q(spark, sf):
    e = table(spark, sf, "events")
    text = (F.when(F.col("event_type").isin("click", "view"), timestamp_to_epoch_ms("ts").cast("string"))
            .when(F.col("event_type") == "error", F.lit("not a time"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    df = e.select("event_id", text.alias("ts_text"))
    df = df.withColumn("normalized", normalize_timestamp("ts_text"))
    return df.withColumn("parsed", parse_timestamp("normalized"))


@query("date_parts", """
SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS day, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday
FROM orders""")
def date_parts_q(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *date_parts("o_orderdate"))


_BASE_URL = "https://search.example.com/searchresults.html?"
_SEARCH_DAY = _dt.date(2025, 9, 4)


@query("search_urls", f"""
SELECT n_nationkey, concat('{_BASE_URL}', 'ss=', n_name, '&checkin=2025-09-04&checkout=2025-09-05',
       '&group_adults=1&no_rooms=1&group_children=0') AS url FROM nation""")
def search_urls(spark, sf):
    return table(spark, sf, "nation").select(
        "n_nationkey", extract.search_url("n_name", _BASE_URL, _SEARCH_DAY).alias("url"))


@query("search_urls_customers", f"""
SELECT c_custkey, concat('{_BASE_URL}', 'ss=', c_name, '&checkin=2025-09-04&checkout=2025-09-05',
       '&group_adults=1&no_rooms=1&group_children=0') AS url FROM customer""")
def search_urls_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", extract.search_url("c_name", _BASE_URL, _SEARCH_DAY).alias("url"))


@query("helper_column", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_extendedprice / l_quantity > 1000""")
def helper_column(spark, sf):
    """Rows kept by a helper column that is dropped again."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return metrics.with_helper(li, "unit_price", F.col("l_extendedprice") / F.col("l_quantity"),
                               lambda df: df.where("unit_price > 1000"))


@query("run_stamped_rows", """
SELECT n_nationkey, n_name, n_regionkey, '20250904_081719' AS run FROM nation""")
def run_stamped_rows(spark, sf):
    """A snapshot below the id of its run (one hour before it began)."""
    d = run_dir(spark, "run_stamped")
    rid = run_id(_dt.datetime(2025, 9, 4, 9, 17, 19))
    csvio.snapshot_csv(table(spark, sf, "nation"), d, rid)
    return (spark.read.options(**csvio.DIALECT).schema(NATION_SCHEMA.add("run", "string")).csv(d))


@query("run_stamped_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN o_orderstatus = 'F' THEN '20250904_081719' ELSE '20250905_081719' END AS run
FROM orders""")
def run_stamped_orders(spark, sf):
    """Two runs below one folder, each under its own id."""
    d = run_dir(spark, "run_stamped_orders")
    o = table(spark, sf, "orders").select(*ORDERS_SCHEMA.names)
    for day, part in ((4, "o_orderstatus = 'F'"), (5, "o_orderstatus <> 'F'")):
        csvio.snapshot_csv(o.where(part), d, run_id(_dt.datetime(2025, 9, day, 9, 17, 19)))
    schema = T.StructType([*ORDERS_SCHEMA.fields, T.StructField("run", T.StringType())])
    return spark.read.options(**csvio.DIALECT).schema(schema).csv(d)


# ---------------------------------------------------------------------------
# Pages: links and status
# ---------------------------------------------------------------------------
_LINKS_SQL = """l AS (
  SELECT page_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos, unnest(arr) AS href
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS arr FROM pages))"""


@query("page_links", f"WITH {_LINKS_SQL} SELECT page_id, pos, href FROM l")
def page_links_q(spark, sf):
    return extract.page_links(read_pages(spark, f"{sf.rstrip('/')}/pages.parquet"))


@query("canonical_links", f"""
WITH {_LINKS_SQL},
f AS (SELECT *, split_part(href, '?', 1) AS canonical FROM l WHERE href <> '' AND contains(href, '/')),
r AS (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY page_id, pos) AS rn FROM f)
SELECT canonical, page_id, pos, href FROM r WHERE rn = 1 ORDER BY page_id, pos LIMIT 50""")
def canonical_links_q(spark, sf):
    links = extract.page_links(table(spark, sf, "pages"))
    return extract.canonical_links(links, ["page_id", "pos"], token="/", max_links=50)


@query("first_links", f"""
WITH {_LINKS_SQL},
f AS (SELECT *, split_part(href, '?', 1) AS canonical FROM l WHERE href <> '' AND contains(href, '/')),
r AS (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY page_id, pos) AS rn FROM f)
SELECT canonical, page_id, pos, href FROM r WHERE rn = 1""")
def first_links(spark, sf):
    """The first link of every canonical URL, all of them."""
    links = extract.page_links(table(spark, sf, "pages")).where(extract.link_filter("href", "/"))
    return extract.first_per_canonical(links, ["page_id", "pos"])


_TIERS = ['href="(/ha[^"]*)"', 'href="(/th[^"]*)"', 'href="([^"]*)"']


@query("links_by_tier", f"""
WITH t AS (SELECT page_id, {', '.join(f"regexp_extract_all(html, '{p}', 1) AS t{n}" for n, p in enumerate(_TIERS))}
           FROM pages),
c AS (SELECT page_id, CASE WHEN len(t0) > 0 THEN t0 WHEN len(t1) > 0 THEN t1 ELSE t2 END AS arr FROM t)
SELECT page_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos, unnest(arr) AS href FROM c""")
def links_by_tier(spark, sf):
    """Links by the first pattern of an ordered list that hits at all."""
    return extract.page_links(table(spark, sf, "pages"), patterns=_TIERS)


_STATUS_PATTERN = 'href="(/e[^"]*)"'


_SQL_VISIBLE = (r"regexp_replace(html, '<(script|style|head|noscript|template)\b.*?"
                r"(</(script|style|head|noscript|template)\s*>|\z)|<!--.*?(-->|\z)|<[a-z/!?][^>]*(>|\z)', ' ', 'gis')")


@query("page_status", f"""
WITH s AS (SELECT page_id, {_SQL_VISIBLE} AS html,
                  len(regexp_extract_all(html, '{_STATUS_PATTERN}', 1)) AS link_count FROM pages)
SELECT page_id, CAST(link_count AS INTEGER) AS link_count,
  CASE WHEN link_count > 0 THEN 'links'
       WHEN contains(lower(html), 'captcha') OR contains(lower(html), 'verify') THEN 'suspect'
       WHEN contains(lower(html), 'no properties found') OR contains(lower(html), 'no results') THEN 'empty'
       ELSE 'unknown' END AS status
FROM s""")
def page_status_q(spark, sf):
    p = table(spark, sf, "pages")
    links = extract.extract_links("html", [_STATUS_PATTERN])
    return p.select("page_id", F.size(links).alias("link_count"),
                    extract.page_status("html", F.size(links) > 0).alias("status"))


# ---------------------------------------------------------------------------
# Field extraction from composed page fragments
# ---------------------------------------------------------------------------
_PRICE_HTML = [
    ("p_partkey", "p_partkey"),
    ("html", "concat('<div class=\"room\">',"
             " CASE WHEN p_size % 3 = 0 THEN concat('<span class=\"price-cell\">MAD ',"
             "   CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING), '</span><span class=\"price-cell\"> ',"
             "   CAST(CAST(floor(p_retailprice) AS BIGINT) + p_size AS STRING), ' MAD</span>') ELSE '' END,"
             " CASE WHEN p_size % 3 = 1 THEN concat('<span class=\"price-generic\">MAD ',"
             "   CAST(CAST(floor(p_retailprice * 10 / 1000) AS BIGINT) AS STRING), ',',"
             "   lpad(CAST(CAST(floor(p_retailprice * 10) AS BIGINT) % 1000 AS STRING), 3, '0'), '</span>') ELSE '' END,"
             " CASE WHEN p_size % 7 = 0 THEN '<p>ask for price</p>' ELSE concat('<p>from €',"
             "   CAST(p_size + 40 AS STRING), ' to $ ', CAST(p_size * 100 AS STRING), '</p>') END,"
             " '</div>')"),
]
_CELL = '<span class="price-cell">([^<]*)</span>'
_GENERIC = '<span class="price-generic">([^<]*)</span>'


@query("price_extract", f"""
WITH {_cte('h', _PRICE_HTML, 'part')},
t AS (SELECT p_partkey,
  list_filter(list_transform(regexp_extract_all(html, '{_CELL}', 1),
    lambda x: try_cast(nullif(regexp_replace(trim(x), '[^0-9]', '', 'g'), '') AS BIGINT)), lambda x: x IS NOT NULL) AS t1,
  list_filter(list_transform(regexp_extract_all(html, '{_GENERIC}', 1),
    lambda x: try_cast(nullif(regexp_replace(replace(trim(x), ',', ''), '[^0-9]', '', 'g'), '') AS BIGINT)), lambda x: x IS NOT NULL) AS t2,
  list_transform(regexp_extract_all(html, '[€$£]\\s?(\\d{{2,5}})', 1), lambda x: try_cast(x AS BIGINT)) AS t3
  FROM h),
c AS (SELECT p_partkey, CASE WHEN len(t1) > 0 THEN t1 WHEN len(t2) > 0 THEN t2 ELSE t3 END AS prices FROM t)
SELECT p_partkey, list_min(prices) AS min_price, list_max(prices) AS max_price FROM c""")
def price_extract(spark, sf):
    h = _view(table(spark, sf, "part"), _PRICE_HTML)
    prices = extract.price_candidates(extract.find_all("html", _CELL, 1),
                                      extract.find_all("html", _GENERIC, 1), F.col("html"))
    lo, hi = metrics.price_range(F.col("prices"))
    return (h.select("p_partkey", prices.alias("prices"))
            .select("p_partkey", lo.alias("min_price"), hi.alias("max_price")))


_CRUMB = [
    ("p_partkey", "p_partkey"),
    ("crumb", "concat(' ', p_name, CASE p_size % 4 WHEN 0 THEN ''"
              " WHEN 1 THEN concat(' (', p_type, ')')"
              " WHEN 2 THEN concat(' (Guest House) (', p_brand, ')')"
              " ELSE concat(' (', p_type, ') (Condo Hotel) (', p_brand, ')') END, ' ')"),
]


@query("category_extract", f"""
WITH {_cte('b', _CRUMB, 'part')},
m AS (SELECT p_partkey, trim(crumb) AS t, regexp_extract_all(trim(crumb), '\\(([^)]+)\\)', 1) AS g FROM b),
c AS (SELECT p_partkey, CASE WHEN len(g) >= 2 THEN g[len(g) - 1] WHEN len(g) = 1 THEN g[1] ELSE t END AS raw FROM m)
SELECT p_partkey, CASE raw WHEN 'Guest House' THEN 'Riad' WHEN 'Condo Hotel' THEN 'Apartment-Hotel' ELSE raw END AS category
FROM c""")
def category_extract(spark, sf):
    b = _view(table(spark, sf, "part"), _CRUMB)
    return b.select("p_partkey", extract.category_from_breadcrumb("crumb").alias("category"))


_LAT = "concat(CAST(c_nationkey - 12 AS STRING), '.', CAST(c_custkey % 1000 AS STRING))"
_LON = "concat('-', CAST(c_custkey % 170 AS STRING), '.', CAST(c_nationkey AS STRING))"
_COORD_HTML = [
    ("c_custkey", "c_custkey"),
    ("html", f"CASE c_custkey % 6"
             f" WHEN 0 THEN concat('<script>{{\"latitude\":', {_LAT}, ',\"longitude\":', {_LON}, '}}</script>')"
             f" WHEN 1 THEN concat('var map = {{\"lat\":', {_LAT}, ',\"lng\":', {_LON}, '}};')"
             f" WHEN 2 THEN concat('\"latitude\":', {_LAT}, '.5.5,\"longitude\":1 and \"lat\":', {_LON}, ',\"lng\":', {_LAT})"
             f" WHEN 3 THEN concat('\"lat\":0,\"lng\":', {_LON})"
             f" WHEN 4 THEN concat('\"latitude\":', {_LAT}, ',\"longitude\":-')"
             f" ELSE 'no coordinates here' END"),
]
_P1 = '"latitude":([0-9\\.\\-]+),"longitude":([0-9\\.\\-]+)'
_P2 = '"lat":([0-9\\.\\-]+),"lng":([0-9\\.\\-]+)'


def _sql_pair(p: str, g: int) -> str:
    return f"CASE WHEN regexp_matches(html, '{p}') THEN try_cast(regexp_extract(html, '{p}', {g}) AS DOUBLE) END"


@query("coordinates", f"""
WITH {_cte('h', _COORD_HTML, 'customer')},
p AS (SELECT c_custkey, {_sql_pair(_P1, 1)} AS a1, {_sql_pair(_P1, 2)} AS b1,
             {_sql_pair(_P2, 1)} AS a2, {_sql_pair(_P2, 2)} AS b2 FROM h),
c AS (SELECT c_custkey,
  CASE WHEN a1 IS NOT NULL AND b1 IS NOT NULL THEN a1 WHEN a2 IS NOT NULL AND b2 IS NOT NULL THEN a2 END AS lat,
  CASE WHEN a1 IS NOT NULL AND b1 IS NOT NULL THEN b1 WHEN a2 IS NOT NULL AND b2 IS NOT NULL THEN b2 END AS lon FROM p)
SELECT c_custkey,
  CASE WHEN lat IS NOT NULL AND lat <> 0 AND lon IS NOT NULL AND lon <> 0 THEN lat END AS latitude,
  CASE WHEN lat IS NOT NULL AND lat <> 0 AND lon IS NOT NULL AND lon <> 0 THEN lon END AS longitude
FROM c""")
def coordinates_q(spark, sf):
    h = _view(table(spark, sf, "customer"), _COORD_HTML)
    c = extract.usable_coordinates(extract.coordinates("html"))
    return h.select("c_custkey", c.alias("at")).select("c_custkey", "at.*")


_WIFI = [
    ("s_suppkey", "s_suppkey"),
    ("speed_line", "CASE WHEN s_acctbal < 0 THEN NULL"
                   " WHEN s_suppkey % 2 = 0 THEN concat('Free WiFi • ', CAST(s_suppkey % 100 AS STRING), ' Mbps')"
                   " ELSE concat('Internet • Free WiFi •  ', CAST(s_nationkey * 10 AS STRING), ' Mbps ') END"),
]


@query("wifi_speed", f"""
WITH {_cte('w', _WIFI, 'supplier')}
SELECT s_suppkey, CASE WHEN speed_line IS NULL THEN 'Not specified'
                       ELSE trim(string_split(speed_line, '•')[-1]) END AS wifi_speed FROM w""")
def wifi_speed_q(spark, sf):
    w = _view(table(spark, sf, "supplier"), _WIFI)
    return w.select("s_suppkey", extract.wifi_speed("speed_line").alias("wifi_speed"))


_COUNT_TEXT = [
    ("o_orderkey", "o_orderkey"),
    ("count_text", "CASE WHEN o_orderstatus = 'P' THEN 'No reviews yet'"
                   " ELSE concat('(', CAST(o_custkey AS STRING), ',', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'),"
                   " ' reviews)') END"),
]


@query("review_count_digits", f"""
WITH {_cte('t', _COUNT_TEXT, 'orders')}
SELECT o_orderkey, try_cast(nullif(regexp_replace(count_text, '[^0-9]', '', 'g'), '') AS BIGINT) AS review_count FROM t""")
def review_count_digits(spark, sf):
    t = _view(table(spark, sf, "orders"), _COUNT_TEXT)
    return t.select("o_orderkey", extract.review_count("count_text").alias("review_count"))


_SUB = '<div aria-hidden="true">([^<]*)</div>'


def _sub_cell(expr: str) -> str:
    return f"concat('<div aria-hidden=\"true\">', {expr}, '</div>')"


_SUB_TEXT = [
    ("o_orderkey", "o_orderkey"),
    ("review_html", "concat(" + ", ".join(
        _sub_cell(f"concat(CAST((o_orderkey + {i}) % 10 AS STRING), '.', CAST((o_custkey + {i}) % 10 AS STRING))")
        for i in range(5))
     + ", CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat("
     + ", ".join(_sub_cell(f"concat(CAST((o_custkey + {i}) % 10 AS STRING), '.', CAST({i} AS STRING))")
                 for i in range(5, 8))
     + ") END)"),
]
_SUBSCORES = [("comfort_score", 4), ("value_score", 5), ("location_score", 6), ("wifi_score", 7)]


@query("nth_subscore", f"""
WITH {_cte('t', _SUB_TEXT, 'orders')}
SELECT o_orderkey, {', '.join(f"try_cast(regexp_extract_all(review_html, '{_SUB}', 1)[{n}] AS DOUBLE) AS {name}" for name, n in _SUBSCORES)}
FROM t""")
def nth_subscore(spark, sf):
    t = _view(table(spark, sf, "orders"), _SUB_TEXT)
    scores = extract.nth_numbers("review_html", _SUB, dict(_SUBSCORES))
    return t.select("o_orderkey", scores.alias("s")).select("o_orderkey", "s.*")


_GEO_JSON = [
    ("c_custkey", "c_custkey"),
    ("payload", "CASE c_custkey % 6"
                " WHEN 0 THEN concat('{\"display_name\": \"', c_name, ', ', n_name, ', Région Sud\", \"address\":"
                " {\"neighbourhood\": \"Quartier ', n_name, '\", \"city\": \" Marrakech \"}}')"
                " WHEN 1 THEN concat('{\"display_name\": \"', c_name, '\", \"address\": {\"suburb\": \"\","
                " \"quarter\": \"حي ', n_name, '\", \"town\": \"Town', CAST(c_nationkey AS STRING), '\"}}')"
                " WHEN 2 THEN concat('{\"display_name\": \"#', c_name, '\", \"address\": {\"neighbourhood\": \"مراكش\","
                " \"district\": \"D', CAST(c_nationkey AS STRING), '\", \"village\": \"قرية\"}}')"
                " WHEN 3 THEN '{\"address\": {\"neighbourhood\": \"###\", \"municipality\": \"\"}}'"
                " WHEN 4 THEN 'not json'"
                " ELSE concat('{\"display_name\": \"', n_name, '\"}') END"),
]
_NON_LATIN_SQL = "'[^a-zA-Z0-9\\s\\-,\\.'']'"


def _sql_clean(e: str) -> str:
    return f"trim(regexp_replace({e}, {_NON_LATIN_SQL}, '', 'g'))"


def _sql_geo() -> str:
    zf = [f"json_extract_string(payload, '$.address.{f}')" for f in extract.ZONE_FIELDS]
    cf = [f"json_extract_string(payload, '$.address.{f}')" for f in extract.CITY_FIELDS]
    zone_first = ", ".join(f"CASE WHEN coalesce({z} <> '', false) THEN nullif({_sql_clean(z)}, '') END" for z in zf)
    any_z = " OR ".join(f"coalesce({z} <> '', false)" for z in zf)
    city_first = ", ".join(f"CASE WHEN coalesce({c} <> '', false) THEN trim({c}) END" for c in cf)
    addr = "replace(" + _sql_clean("coalesce(json_extract_string(payload, '$.display_name'), '')") + ", ',', ' ')"
    return (f"CASE WHEN json_valid(payload) THEN {addr} END AS address,\n"
            f"  CASE WHEN json_valid(payload) THEN coalesce({zone_first}, CASE WHEN {any_z} THEN '' END) END AS zone,\n"
            f"  CASE WHEN json_valid(payload) THEN coalesce({city_first}) END AS city")


@query("geocode_fields", f"""
WITH {_cte('g', _GEO_JSON, 'customer JOIN nation ON c_nationkey = n_nationkey')}
SELECT c_custkey, {_sql_geo()}
FROM g""")
def geocode_fields_q(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    g = _view(c.join(n, c.c_nationkey == n.n_nationkey), _GEO_JSON)
    fields = extract.geocode_fields("payload")
    return g.select("c_custkey", fields.alias("at")).select("c_custkey", "at.*")


@query("json_props", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k,
       json_extract_string(props, '$.missing') AS missing
FROM events""")
def json_props(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", json_field("props", "$.k", "bigint", default=-1).alias("k"),
                    json_field("props", "$.missing").alias("missing"))


_ENRICH_SRC = [
    ("c_custkey", "c_custkey"),
    ("latitude", "CAST((c_nationkey - 12) * 1.5 AS DOUBLE)"),
    ("longitude", "CAST(c_nationkey * 2 AS DOUBLE)"),
    ("address", "concat('Addr ', c_name)"),
    ("zone", "CAST(NULL AS STRING)"),
    ("city", "c_mktsegment"),
]
_LOOKUP = [
    # one region lies where nobody is
    ("latitude", "CAST((n_nationkey - 12) * 1.5 + CASE WHEN n_regionkey = 4 THEN 500 ELSE 0 END AS DOUBLE)"),
    ("longitude", "CAST(n_nationkey * 2 AS DOUBLE)"),
    ("address", "concat(n_name, ' Road')"),
    ("zone", "CASE WHEN n_regionkey = 0 THEN NULL ELSE concat('Z', CAST(n_regionkey AS STRING)) END"),
    ("city", "concat('City ', n_name)"),
]


@query("geocode_enrich", f"""
WITH {_cte('c', _ENRICH_SRC, 'customer')},
{_cte('g', _LOOKUP, 'nation')}
SELECT c.c_custkey, c.latitude, c.longitude,
  CASE WHEN m.latitude IS NOT NULL AND c.latitude <> 0 AND c.longitude <> 0 THEN m.address ELSE c.address END AS address,
  CASE WHEN m.latitude IS NOT NULL AND c.latitude <> 0 AND c.longitude <> 0 THEN m.zone ELSE c.zone END AS zone,
  CASE WHEN m.latitude IS NOT NULL AND c.latitude <> 0 AND c.longitude <> 0 THEN m.city ELSE c.city END AS city
FROM c LEFT JOIN g m ON c.latitude = m.latitude AND c.longitude = m.longitude""")
def geocode_enrich(spark, sf):
    c = _view(table(spark, sf, "customer"), _ENRICH_SRC)
    lookup = _view(table(spark, sf, "nation"), _LOOKUP)
    out = extract.merge_lookup(c, lookup, ["latitude", "longitude"],
                               ["address", "zone", "city"], when=quality.coordinates_present())
    return out.select("c_custkey", "latitude", "longitude", "address", "zone", "city")


# ---------------------------------------------------------------------------
# Reviews (events as review cards: user = listing, value -> score)
# ---------------------------------------------------------------------------
_LABEL = ("CASE event_type"
          " WHEN 'click' THEN CASE WHEN user_id % 2 = 0 THEN 'Solo traveler' ELSE 'Solo-Traveller' END"
          " WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN 'Family' ELSE 'Families' END"
          " WHEN 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'Group of friends' ELSE 'Group' END"
          " WHEN 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN 'Business traveller' ELSE 'Business-Traveler' END"
          " ELSE CASE WHEN user_id % 2 = 0 THEN 'Couple' ELSE 'Couples' END END")
_CARDS = [
    ("event_id", "event_id"),
    ("user_id", "user_id"),
    ("ts", "ts"),
    ("event_type", "event_type"),
    ("score_text", "CASE WHEN event_type = 'error' AND user_id % 2 = 1 THEN 'Scored n/a'"
                   " ELSE concat('Scored ', CAST(CAST(floor(value) AS BIGINT) % 10 AS STRING), '.',"
                   " CAST(event_id % 10 AS STRING)) END"),
    ("traveler_type", f"CASE WHEN user_id % 7 = 0 THEN '  ' ELSE {_LABEL} END"),
]
_NORM_SQL = ("CASE replace(replace(lower({x}), ' ', '_'), '-', '_') "
             + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in reviews.TRAVELER_MAPPINGS.items())
             + " ELSE replace(replace(lower({x}), ' ', '_'), '-', '_') END")
_PARSED_SQL = f"""{_cte('cards', _CARDS, 'events')},
parsed AS (
  SELECT event_id, user_id, ts, event_type,
         try_cast(trim(split_part(score_text, 'Scored ', 2)) AS DOUBLE) AS score,
         coalesce(nullif(trim(traveler_type), ''), 'Unknown') AS traveler_label
  FROM cards),
typed AS (
  SELECT *, {_NORM_SQL.format(x='traveler_label')} AS kind FROM parsed
  WHERE score IS NOT NULL AND traveler_label <> 'Unknown')"""
_EXACT_AVG = "CAST(sum(CAST(score AS DECIMAL(18,1))) AS DOUBLE) / CAST(count(*) AS DOUBLE)"


def review_cards(spark: SparkSession, sf: str) -> DataFrame:
    cards = reviews.parse_cards(_view(table(spark, sf, "events"), _CARDS))
    return cards.withColumn("kind", reviews.normalize_traveler_type("traveler_label"))


@query("traveler_type", f"""
SELECT event_id, label, {_NORM_SQL.format(x='label')} AS kind
FROM (SELECT event_id, {_LABEL} AS label FROM events) t""")
def traveler_type(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", f"{_LABEL} AS label")
    return e.withColumn("kind", reviews.normalize_traveler_type("label"))


@query("review_scores", f"WITH {_PARSED_SQL} SELECT event_id, user_id, score, kind FROM typed")
def review_scores(spark, sf):
    return review_cards(spark, sf).select("event_id", "user_id", "score", "kind")


@query("review_page_cap", f"""
WITH {_PARSED_SQL},
p AS (SELECT event_id, user_id, CAST(ts AS DATE) AS page, score,
             dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS r FROM typed)
SELECT event_id, user_id, page, score FROM p WHERE r <= 5""")
def review_page_cap(spark, sf):
    cards = review_cards(spark, sf).withColumn("page", F.to_date("ts"))
    return reviews.cap_pages(cards, "user_id", "page", 5).select("event_id", "user_id", "page", "score")


@query("review_union", f"""
WITH {_PARSED_SQL},
u AS (SELECT user_id, kind, score FROM typed
      UNION ALL
      SELECT user_id, 'business_travellers' AS kind, score FROM parsed
      WHERE event_type = 'purchase' AND score IS NOT NULL)
SELECT user_id, kind, {_EXACT_AVG} AS avg_score, count(*) AS review_count FROM u GROUP BY user_id, kind""")
def review_union(spark, sf):
    typed = review_cards(spark, sf)
    business = (reviews.parse_cards(_view(table(spark, sf, "events"), _CARDS)
                                    .where(F.col("event_type") == "purchase")
                                    .withColumn("traveler_type", F.lit(reviews.BUSINESS_LABEL)))
                .withColumn("kind", reviews.normalize_traveler_type("traveler_label")))
    both = reviews.union_passes(typed.select("user_id", "kind", "score"),
                                business.select("user_id", "kind", "score"))
    return (both.groupBy("user_id", "kind")
            .agg(F.sum(F.col("score").cast("decimal(18,1)")).alias("s"), F.count(F.lit(1)).alias("review_count"))
            .select("user_id", "kind", (F.col("s").cast("double") / F.col("review_count").cast("double"))
                    .alias("avg_score"), "review_count"))


@query("review_summary", f"""
WITH {_PARSED_SQL}
SELECT user_id, CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS kind,
       {_EXACT_AVG} AS avg_score, count(*) AS review_count
FROM typed GROUP BY GROUPING SETS ((user_id, kind), (user_id))""")
def review_summary(spark, sf):
    return reviews.summarize(review_cards(spark, sf), "user_id", "kind", scale=1)


def _pivot_sql() -> str:
    cols = [f"{_EXACT_AVG} AS {S.score_col('all')}", f"count(*) AS {S.count_col('all')}"]
    for t in S.TRAVELER_TYPES:
        n = f"count(*) FILTER (WHERE kind = '{t}')"
        s = f"sum(CAST(score AS DECIMAL(18,1))) FILTER (WHERE kind = '{t}')"
        cols.append(f"CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / CAST({n} AS DOUBLE) END AS {S.score_col(t)}")
        cols.append(f"CASE WHEN {n} > 0 THEN {n} END AS {S.count_col(t)}")
    known = "kind IN (" + ", ".join(f"'{t}'" for t in S.TRAVELER_TYPES) + ")"
    n = f"count(*) FILTER (WHERE NOT coalesce({known}, false))"
    s = f"sum(CAST(score AS DECIMAL(18,1))) FILTER (WHERE NOT coalesce({known}, false))"
    cols.append(f"CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / CAST({n} AS DOUBLE) END AS {S.score_col('other')}")
    cols.append(f"CASE WHEN {n} > 0 THEN {n} END AS {S.count_col('other')}")
    return ",\n  ".join(cols)


@query("review_pivot", f"""
WITH {_PARSED_SQL}
SELECT user_id,
  {_pivot_sql()}
FROM typed GROUP BY user_id""")
def review_pivot(spark, sf):
    return reviews.summarize_wide(review_cards(spark, sf), "user_id", "kind", scale=1)


# ---------------------------------------------------------------------------
# Dimensions, keys and merges
# ---------------------------------------------------------------------------
@query("distinct_dims", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_dims(spark, sf):
    return merge.distinct_rows(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"])


@query("surrogate_keys", """
SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS customer_sk,
       sha256('["' || o_custkey || '"]') AS row_hash
FROM (SELECT DISTINCT o_custkey FROM orders) t""")
def surrogate_keys(spark, sf):
    d = merge.distinct_rows(table(spark, sf, "orders"), ["o_custkey"])
    out = keys.assign_keys(d, ["o_custkey"], "customer_sk")
    return out.withColumn("row_hash", keys.row_fingerprint(["o_custkey"]))


_CUST_DIM = T.StructType([T.StructField("customer_sk", T.LongType()), T.StructField("c_custkey", T.LongType()),
                          T.StructField("c_name", T.StringType()), T.StructField("c_nationkey", T.IntegerType())])


@query("merge_single_key", """
WITH t0 AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey, c_name, c_nationkey
            FROM customer WHERE c_mktsegment = 'BUILDING'),
new AS (SELECT c_custkey, c_name, c_nationkey FROM customer c
        WHERE NOT EXISTS (SELECT 1 FROM t0 WHERE t0.c_custkey = c.c_custkey))
SELECT * FROM t0
UNION ALL
SELECT (SELECT max(customer_sk) FROM t0) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name, c_nationkey
FROM new""")
def merge_single_key(spark, sf):
    c = table(spark, sf, "customer")
    target = f"{run_dir(spark, 'merge_single')}/dim_customer"
    cols = ["c_custkey", "c_name", "c_nationkey"]
    merge.insert_only_merge(c.where(F.col("c_mktsegment") == "BUILDING").select(*cols), target,
                            ["c_custkey"], schema=_CUST_DIM, id_col="customer_sk")
    merge.insert_only_merge(c.select(*cols), target, ["c_custkey"], schema=_CUST_DIM, id_col="customer_sk")
    return spark.read.schema(_CUST_DIM).parquet(target)


_LOC_SRC = [
    ("city", "c_mktsegment"),
    ("zone", "CASE WHEN c_nationkey < 5 THEN NULL ELSE concat('Z', CAST(c_nationkey AS STRING)) END"),
]


@query("merge_composite_nulls", f"""
WITH {_cte('src', _LOC_SRC, 'customer')},
s AS (SELECT DISTINCT city, zone FROM src),
t0 AS (SELECT row_number() OVER (ORDER BY city, zone NULLS FIRST) AS location_id, city, zone
       FROM s WHERE city = 'BUILDING'),
new AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t0 WHERE t0.city = s.city AND t0.zone = s.zone))
SELECT location_id, city, zone FROM t0
UNION ALL
SELECT (SELECT max(location_id) FROM t0) + row_number() OVER (ORDER BY city, zone NULLS FIRST), city, zone FROM new""")
def merge_composite_nulls(spark, sf):
    src = _view(table(spark, sf, "customer"), _LOC_SRC).distinct()
    target = f"{run_dir(spark, 'merge_location')}/dim_location"
    merge.insert_only_merge(src.where(F.col("city") == "BUILDING"), target, ["city", "zone"],
                            schema=S.DIM_LOCATION, id_col="location_id")
    merge.insert_only_merge(src, target, ["city", "zone"], schema=S.DIM_LOCATION, id_col="location_id")
    return spark.read.schema(S.DIM_LOCATION).parquet(target)


_PART_DIM = T.StructType([T.StructField("part_sk", T.LongType()), T.StructField("p_partkey", T.LongType()),
                          T.StructField("p_name", T.StringType()), T.StructField("p_brand", T.StringType())])


@query("merge_twice", """
SELECT row_number() OVER (ORDER BY p_partkey) AS part_sk, p_partkey, p_name, p_brand FROM part""")
def merge_twice(spark, sf):
    d = run_dir(spark, "merge_twice")
    db = files.ensure_database(spark, f"staylake_{d.rsplit('-', 1)[-1]}", f"{d}/db")
    name = files.ensure_table(spark, f"{db}.dim_part", _PART_DIM, f"{d}/db/dim_part")
    src = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    for _ in range(2):
        merge.insert_only_merge(src, f"{d}/db/dim_part", ["p_partkey"], schema=_PART_DIM, id_col="part_sk")
    spark.catalog.refreshTable(name)
    return spark.table(name)


_PROP_COLS = ["property_url", "address", "wifi_speed", "latitude", "longitude"]
_PROP_ORDER = ", ".join(_PROP_COLS)


@query("dim_property_merge", f"""
WITH {LISTINGS_CTE},
s1 AS (SELECT DISTINCT {_PROP_ORDER} FROM listings WHERE category = 'Hotel'),
s2 AS (SELECT DISTINCT {_PROP_ORDER} FROM listings),
t0 AS (SELECT row_number() OVER (ORDER BY {_PROP_ORDER}) AS property_id, {_PROP_ORDER} FROM s1),
new AS (SELECT * FROM s2 WHERE NOT EXISTS (SELECT 1 FROM t0 WHERE t0.property_url = s2.property_url))
SELECT * FROM t0
UNION ALL
SELECT (SELECT max(property_id) FROM t0) + row_number() OVER (ORDER BY {_PROP_ORDER}), {_PROP_ORDER} FROM new""")
def dim_property_merge(spark, sf):
    """Distinct on five columns, matched on the URL only: one URL can hold
    several rows after the first load, later loads add only unseen URLs."""
    lst = listings(spark, sf)
    target = f"{run_dir(spark, 'dim_property')}/dim_property"
    for src in (lst.where(F.col("category") == "Hotel"), lst):
        merge.insert_only_merge(src.select(*_PROP_COLS).distinct(), target, ["property_url"],
                                schema=S.DIM_PROPERTY, id_col="property_id", order_cols=_PROP_COLS)
    return spark.read.schema(S.DIM_PROPERTY).parquet(target)


@query("dim_property_by_url", f"""
WITH {LISTINGS_CTE},
d AS (SELECT DISTINCT {_PROP_ORDER} FROM listings),
f AS (SELECT *, row_number() OVER (PARTITION BY property_url ORDER BY address, wifi_speed, latitude, longitude) AS rn
      FROM d)
SELECT row_number() OVER (ORDER BY {_PROP_ORDER}) AS property_id, {_PROP_ORDER} FROM f WHERE rn = 1""")
def dim_property_by_url(spark, sf):
    """The same dimension with one row per URL (the smallest by the other
    columns), the opt-in fix for URLs seen with several addresses."""
    target = f"{run_dir(spark, 'dim_property_url')}/dim_property"
    merge.insert_only_merge(listings(spark, sf).select(*_PROP_COLS).distinct(), target, ["property_url"],
                            schema=S.DIM_PROPERTY, id_col="property_id", order_cols=_PROP_COLS,
                            dedupe_on_key=True)
    return spark.read.schema(S.DIM_PROPERTY).parquet(target)


def _category_dim_sql(src: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY category) AS category_id, category FROM (SELECT DISTINCT category FROM {src}) d"


@query("fact_by_category", f"""
WITH st AS (SELECT l_quantity, l_extendedprice, p_type AS category
            FROM lineitem JOIN part ON l_partkey = p_partkey),
dim AS ({_category_dim_sql('st')})
SELECT dim.category_id, dim.category, count(*) AS line_count,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM st JOIN dim ON st.category = dim.category
GROUP BY dim.category_id, dim.category""")
def fact_by_category(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    # Sums and counts are decomposable, so line items are pre-aggregated per
    # part before the join (a hot part collapses map-side), and the joined
    # result is rolled up per category: the big side shuffles once, already
    # reduced, and the category join sees one row per category.
    per_part = li.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("r"))
    staging = (per_part.join(p.select("p_partkey", F.col("p_type").alias("category")),
                             F.col("l_partkey") == F.col("p_partkey"))
               .groupBy("category").agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("r").alias("r"))
               .checkpoint(eager=True))
    target = f"{run_dir(spark, 'fact_by_category')}/dim_category"
    merge.insert_only_merge(staging.select("category"), target, ["category"],
                            schema=S.DIM_CATEGORY, id_col="category_id")
    dim = spark.read.schema(S.DIM_CATEGORY).parquet(target)
    return staging.join(dim, "category").select(
        "category_id", "category", F.col("n").alias("line_count"),
        F.col("q").cast("double").alias("total_quantity"), F.col("r").cast("double").alias("total_revenue"))


_FACT = T.StructType([T.StructField("fact_id", T.LongType()),
                      T.StructField("scrape_timestamp", T.TimestampNTZType()),
                      T.StructField("category_id", T.LongType()),
                      T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                      T.StructField("l_quantity", T.DoubleType())])


@query("fact_merge", f"""
WITH st AS (SELECT l_shipdate AS scrape_timestamp, l_orderkey, l_linenumber, l_quantity, l_returnflag,
                   p_type AS category FROM lineitem JOIN part ON l_partkey = p_partkey),
dim AS ({_category_dim_sql('st')}),
src AS (SELECT st.*, dim.category_id FROM st JOIN dim ON st.category = dim.category),
t0 AS (SELECT row_number() OVER (ORDER BY scrape_timestamp, l_orderkey, l_linenumber, category_id, l_quantity) AS fact_id,
              scrape_timestamp, category_id, l_orderkey, l_linenumber, l_quantity FROM src WHERE l_returnflag = 'R'),
new AS (SELECT * FROM src WHERE NOT EXISTS (SELECT 1 FROM t0 WHERE t0.scrape_timestamp = src.scrape_timestamp))
SELECT * FROM t0
UNION ALL
SELECT (SELECT max(fact_id) FROM t0) + row_number() OVER (ORDER BY scrape_timestamp, l_orderkey, l_linenumber, category_id, l_quantity),
       scrape_timestamp, category_id, l_orderkey, l_linenumber, l_quantity FROM new""")
def fact_merge(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    st = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_shipdate").alias("scrape_timestamp"), "l_orderkey", "l_linenumber", "l_quantity",
        "l_returnflag", F.col("p_type").alias("category"))
    d = run_dir(spark, "fact_merge")
    # Categories come from the parts that were sold; the line items are joined once.
    sold = p.join(li.select("l_partkey").distinct(), p.p_partkey == F.col("l_partkey"), "left_semi")
    merge.insert_only_merge(sold.select(F.col("p_type").alias("category")).distinct(),
                            f"{d}/dim_category", ["category"],
                            schema=S.DIM_CATEGORY, id_col="category_id")
    dim = spark.read.schema(S.DIM_CATEGORY).parquet(f"{d}/dim_category")
    src = spark.read.parquet(files.write_parquet(st.join(dim, "category"), f"{d}/stage"))
    # (order, line) pairs repeat in the test data, so the id order covers
    # every output column: tied rows are then identical.
    order = ["scrape_timestamp", "l_orderkey", "l_linenumber", "category_id", "l_quantity"]
    merge.insert_only_merge(src.where(F.col("l_returnflag") == "R"), f"{d}/fact", ["scrape_timestamp"],
                            schema=_FACT, id_col="fact_id", order_cols=order)
    merge.insert_only_merge(src, f"{d}/fact", ["scrape_timestamp"], schema=_FACT, id_col="fact_id",
                            order_cols=order)
    return spark.read.schema(_FACT).parquet(f"{d}/fact")


# ---------------------------------------------------------------------------
# Cleaning and the star schema end to end
# ---------------------------------------------------------------------------
_CLEAN_COLS = [c for c in _WITH_WAVG]
_CITY_SQL = ("CASE WHEN contains(address, 'Tangier') THEN 'Tangier'"
             " WHEN contains(address, 'Marrakech') THEN 'Marrakech' ELSE city END")
CLEAN_SQL = f"""{LISTINGS_CTE},
d AS (SELECT DISTINCT * FROM listings),
w AS (SELECT * REPLACE ({_CITY_SQL} AS city), {SQL_WEIGHTED} AS weighted_avg FROM d),
v AS (SELECT * FROM w WHERE coalesce({SQL_SCORE_RANGE}, false) AND coalesce({SQL_POSITIVE}, false)
                        AND coalesce({SQL_GEO}, false) AND coalesce({SQL_PRICE}, false)),
cleaned AS (SELECT {', '.join(c if c != 'zone' else 'coalesce(zone, ' + _sql_zone('address') + ') AS zone' for c in _CLEAN_COLS)} FROM v)"""


# Report over a loaded star schema: facts per category with review totals
# and distinct scrape times (shared by the three end-to-end queries).
STAR_REPORT_SQL = f"""
WITH {CLEAN_SQL},
dim AS ({_category_dim_sql('cleaned')})
SELECT dim.category_id, dim.category, count(*) AS fact_rows,
       CAST(sum(CAST(c.general_review_count AS DECIMAL(18,0))) AS DOUBLE) AS total_reviews,
       count(DISTINCT c.scrape_timestamp) AS dates
FROM cleaned c JOIN dim ON c.category = dim.category
GROUP BY dim.category_id, dim.category"""


def star_report(fact: DataFrame, categories: DataFrame) -> DataFrame:
    return (fact.join(categories, "category_id")
            .groupBy("category_id", "category")
            .agg(F.count(F.lit(1)).alias("fact_rows"),
                 F.sum(F.col("general_review_count").cast("decimal(18,0)")).cast("double").alias("total_reviews"),
                 F.countDistinct("scrape_timestamp").alias("dates")))


_PAGE_SRC = [
    ("property_id", "CAST(p_partkey AS STRING)"),
    ("scrape_timestamp", "CAST('2025-09-04 08:00:00' AS TIMESTAMP_NTZ)"),
    ("property_url", "concat('https://hotels.example.com/h/', CAST(p_partkey AS STRING))"),
    ("html", "concat('<ul><li class=\"breadcrumb\"> ', p_name, ' (', p_type, ') (', p_brand, ')</li></ul>',"
             " '<span class=\"price-cell\">MAD ', CAST(p_size * 10 AS STRING), '</span>',"
             " '<span class=\"price-cell\">', CAST(p_size * 12 AS STRING), ' MAD</span>',"
             " CASE WHEN p_size % 4 = 0 THEN '' ELSE concat('<div>Fast • ', CAST(p_size AS STRING), ' Mbps</div>') END,"
             + ", ".join(f" '<div aria-hidden=\"true\">{i}.', CAST(p_size % 10 AS STRING), '</div>'" for i in range(8))
             + ", '<div class=\"general-score\"> 8.', CAST(p_size % 10 AS STRING), ' </div>',"
             " '<div class=\"review-count\">1,', CAST(100 + p_size AS STRING), ' reviews</div>',"
             " CASE WHEN p_size % 5 = 0 THEN '' ELSE concat('<script>{\"latitude\":31.', CAST(p_size + 10 AS STRING),"
             " ',\"longitude\":-7.5}</script>') END)"),
]
_PAGE_TYPES = ["couples", "solo_travelers", "families", "business_travellers", "groups_friends"]
_PAGE_LABELS = ["Couple", "Solo traveler", "Family", "Business traveller", "Group", "Digital nomad"]


def _page_scores_sql() -> str:
    out = []
    for n, kind in [(None, "all"), *enumerate(_PAGE_TYPES)]:
        hit = "true" if n is None else f"l_linenumber % 6 = {n}"
        total = f"sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE {hit})"
        count = f"count(*) FILTER (WHERE {hit})"
        out += [f"CAST({total} AS DOUBLE) / nullif({count}, 0) AS {S.score_col(kind)}",
                f"nullif({count}, 0) AS {S.count_col(kind)}"]
    return ", ".join(out)


@query("pages_to_listings", f"""
WITH r AS (SELECT l_partkey, {_page_scores_sql()} FROM lineitem GROUP BY l_partkey),
p AS (SELECT p_partkey, p_size, p_type, CASE WHEN p_size % 5 <> 0
             THEN CAST('31.' || (p_size + 10) AS DOUBLE) END AS lat FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS property_id, TIMESTAMP '2025-09-04 08:00:00' AS scrape_timestamp,
  'https://hotels.example.com/h/' || p_partkey AS property_url, p_type AS category,
  CAST('8.' || (p_size % 10) AS DOUBLE) AS general_review, CAST(1100 + p_size AS BIGINT) AS general_review_count,
  {', '.join(f"CAST('{i}.' || (p_size % 10) AS DOUBLE) AS {n}" for i, n in
             enumerate(['comfort_score', 'value_score', 'location_score', 'wifi_score'], 3))},
  {', '.join(f"{c}" for k in ['all', *_PAGE_TYPES] for c in (S.score_col(k), S.count_col(k)))},
  CAST(p_size * 10 AS DOUBLE) AS min_price, CAST(p_size * 12 AS DOUBLE) AS max_price,
  lat AS latitude, CASE WHEN lat IS NOT NULL THEN CAST(-7.5 AS DOUBLE) END AS longitude,
  CASE WHEN lat IS NOT NULL AND p_size % 2 = 0 THEN 'Rue ' || p_size END AS address,
  CAST(NULL AS VARCHAR) AS zone,
  CASE WHEN lat IS NOT NULL AND p_size % 2 = 0 THEN 'Marrakech' END AS city,
  CASE WHEN p_size % 4 = 0 THEN 'Not specified' ELSE p_size || ' Mbps' END AS wifi_speed
FROM p LEFT JOIN r ON p_partkey = l_partkey""")
def pages_to_listings(spark, sf):
    """Listing rows assembled from composed pages, review cards and places."""
    part, li = table(spark, sf, "part"), table(spark, sf, "lineitem")
    label = F.element_at(F.array(*[F.lit(x) for x in _PAGE_LABELS]),
                         (F.col("l_linenumber") % 6 + 1).cast("int"))
    cards = li.select(F.col("l_partkey").cast("string").alias("property_id"),
                      F.concat(F.lit("Scored "), F.col("l_quantity").cast("string")).alias("score_text"),
                      label.alias("traveler_type"))
    places = part.where("p_size % 2 = 0").select(
        F.concat(F.lit("31."), (F.col("p_size") + 10).cast("string")).cast("double").alias("latitude"),
        F.lit(-7.5).alias("longitude"), F.concat(F.lit("Rue "), F.col("p_size").cast("string")).alias("address"),
        F.lit(None).cast("string").alias("zone"), F.lit("Marrakech").alias("city"))
    return extract_listings(_view(part, _PAGE_SRC), cards, places, score_scale=2)


@query("clean_listings", f"WITH {CLEAN_SQL} SELECT * FROM cleaned")
def clean_listings_q(spark, sf):
    return clean_listings(listings(spark, sf), CleanConfig())


@query("star_load", STAR_REPORT_SQL)
def star_load(spark, sf):
    d = run_dir(spark, "star")
    db = f"staylake_star_{d.rsplit('-', 1)[-1]}"
    staging = load_staging(clean_listings(listings(spark, sf)), f"{d}/stage", table=f"{db}.listing_stage")
    build_star(staging, f"{d}/warehouse", database=db)
    fact, cat = spark.table(f"{db}.fact_property_reviews"), spark.table(f"{db}.dim_category")
    return star_report(fact, cat)


@query("etl_run", STAR_REPORT_SQL)
def etl_run(spark, sf):
    d = run_dir(spark, "etl")
    lst = listings(spark, sf)
    # Two crawler runs whose files carry the columns in different orders.
    csvio.write_csv(lst.where(F.col("category") == "Hotel"), f"{d}/raw/run1", compression="gzip")
    csvio.write_csv(lst.where(F.col("category") != "Hotel").select(*reversed(lst.columns)), f"{d}/raw/run2",
                    compression="gzip")
    run_etl(spark, RunConfig(raw_dir=f"{d}/raw", out_dir=f"{d}/out", now=_dt.datetime(2025, 9, 4, 9),
                             snapshots=False))
    star = read_star(spark, f"{d}/out/warehouse")
    fact, cat = star["fact_property_reviews"], star["dim_category"]
    return star_report(fact, cat)


def _streamed_star(spark, sf, name: str) -> str:
    """Lands the listing view twice over (hotels, then everything) and streams
    it in; returns the folder."""
    d = run_dir(spark, name)
    lst = listings(spark, sf)
    csvio.write_csv(lst.where(F.col("category") == "Hotel"), f"{d}/landing/hotels", compression="gzip")
    csvio.write_csv(lst.select(*reversed(lst.columns)), f"{d}/landing/all", compression="gzip")
    incremental_star(spark, f"{d}/landing", f"{d}/warehouse", f"{d}/checkpoint",
                     max_files_per_trigger=4)
    return d


@query("incremental_star", f"""
WITH {CLEAN_SQL},
dim AS (SELECT DISTINCT category FROM cleaned)
SELECT c.category, count(*) AS fact_rows,
       CAST(sum(CAST(c.general_review_count AS DECIMAL(18,0))) AS DOUBLE) AS total_reviews,
       count(DISTINCT c.scrape_timestamp) AS dates
FROM cleaned c JOIN dim ON c.category = dim.category GROUP BY c.category""")
def incremental_star_q(spark, sf):
    """Overlapping CSV batches with different column orders stream into the
    star schema, a few files to a micro-batch."""
    d = _streamed_star(spark, sf, "incremental_star")
    star = read_star(spark, f"{d}/warehouse")
    # ids follow the order of arrival, so the report goes by category name
    return star_report(star["fact_property_reviews"], star["dim_category"]).drop("category_id")


_FACT_OUT = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in S.FACT_MEASURES)


@query("streamed_fact", f"""
WITH {CLEAN_SQL}
SELECT DISTINCT scrape_timestamp, CAST(property_id AS VARCHAR) AS listing_key, category, {_FACT_OUT}
FROM cleaned WHERE category IS NOT NULL""")
def streamed_fact(spark, sf):
    """Every fact row of the streamed star, with its category's name."""
    star = read_star(spark, f"{_streamed_star(spark, sf, 'streamed_fact')}/warehouse")
    return star["fact_property_reviews"].join(star["dim_category"], "category_id").drop(
        "category_id", "fact_id")


@query("streamed_dimensions", f"""
WITH {CLEAN_SQL}
SELECT 'property' AS dimension, CAST(to_json([property_url, address, wifi_speed]) AS VARCHAR) AS value,
       latitude, longitude
FROM (SELECT DISTINCT property_url, address, wifi_speed, latitude, longitude FROM cleaned)
UNION ALL SELECT 'category', to_json([category]), NULL, NULL FROM (SELECT DISTINCT category FROM cleaned)
UNION ALL SELECT 'date', to_json([strftime(scrape_timestamp, '%Y-%m-%d %H:%M:%S')]), NULL, NULL
FROM (SELECT DISTINCT scrape_timestamp FROM cleaned)
UNION ALL SELECT 'location', to_json([city, zone]), NULL, NULL FROM (SELECT DISTINCT city, zone FROM cleaned)""")
def streamed_dimensions(spark, sf):
    """Every row of the four streamed dimensions."""
    star = read_star(spark, f"{_streamed_star(spark, sf, 'streamed_dimensions')}/warehouse")

    def rows(name, *cols):
        dim = star[f"dim_{name}"]
        places = [(F.col(c) if c in dim.columns else F.lit(None).cast("double")).alias(c)
                  for c in ("latitude", "longitude")]
        return dim.select(F.lit(name).alias("dimension"), F.to_json(
            F.array(*cols), {"ignoreNullFields": "false"}).alias("value"), *places)

    return (rows("property", "property_url", "address", "wifi_speed")
            .unionByName(rows("category", "category"))
            .unionByName(rows("date", F.date_format("scrape_timestamp", "yyyy-MM-dd HH:mm:ss")))
            .unionByName(rows("location", "city", "zone")))


def _loaded_star(spark, sf, name: str) -> dict[str, DataFrame]:
    d = run_dir(spark, name)
    build_star(load_staging(clean_listings(listings(spark, sf)), f"{d}/stage"), f"{d}/warehouse")
    return read_star(spark, f"{d}/warehouse")


@query("star_dimension_keys", f"""
WITH {CLEAN_SQL}
SELECT 'property' AS dimension, row_number() OVER (ORDER BY {_PROP_ORDER}) AS id,
       property_url AS name, address, wifi_speed, latitude, longitude, NULL AS zone
FROM (SELECT DISTINCT {_PROP_ORDER} FROM cleaned)
UNION ALL SELECT 'category', row_number() OVER (ORDER BY category), category,
       NULL, NULL, NULL, NULL, NULL FROM (SELECT DISTINCT category FROM cleaned)
UNION ALL SELECT 'date', row_number() OVER (ORDER BY scrape_timestamp),
       strftime(scrape_timestamp, '%Y-%m-%d %H:%M:%S'), NULL, NULL, NULL, NULL, NULL
FROM (SELECT DISTINCT scrape_timestamp FROM cleaned)
UNION ALL SELECT 'location', row_number() OVER (ORDER BY city, zone NULLS FIRST), city,
       NULL, NULL, NULL, NULL, zone FROM (SELECT DISTINCT city, zone FROM cleaned)""")
def star_dimension_keys(spark, sf):
    """Surrogate ids and columns of every row of the four batch-loaded dimensions."""
    star = _loaded_star(spark, sf, "star_dims")
    kinds = {"address": "string", "wifi_speed": "string", "latitude": "double",
             "longitude": "double", "zone": "string"}

    def rows(name, key):
        dim = star[f"dim_{name}"]
        others = [(F.col(c) if c in dim.columns else F.lit(None).cast(kind)).alias(c)
                  for c, kind in kinds.items()]
        return dim.select(F.lit(name).alias("dimension"), F.col(f"{name}_id").alias("id"),
                          key.alias("name"), *others)

    return (rows("property", F.col("property_url")).unionByName(rows("category", F.col("category")))
            .unionByName(rows("date", F.date_format("scrape_timestamp", "yyyy-MM-dd HH:mm:ss")))
            .unionByName(rows("location", F.col("city"))))


@query("star_fact", f"""
WITH {CLEAN_SQL}, dim AS ({_category_dim_sql('cleaned')})
SELECT row_number() OVER (ORDER BY scrape_timestamp, CAST(property_id AS VARCHAR)) AS fact_id,
       scrape_timestamp, CAST(property_id AS VARCHAR) AS listing_key, dim.category_id, {_FACT_OUT}
FROM cleaned JOIN dim ON cleaned.category = dim.category""")
def star_fact(spark, sf):
    """Every row of the batch-loaded fact, ids included."""
    return _loaded_star(spark, sf, "star_fact")["fact_property_reviews"]


@query("hot_surrogate_keys", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, hot,
       row_number() OVER (ORDER BY hot, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS sk
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
             CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS hot FROM lineitem)""")
def hot_surrogate_keys(spark, sf):
    """A third of the rows share the leading key."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END").alias("hot")).distinct()
    return keys.assign_keys(li, ["hot", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"],
                            "sk")


@query("fact_merge_timestamp", f"""
WITH {CLEAN_SQL},
t0 AS (SELECT * FROM cleaned WHERE category = 'Hotel'),
c AS (SELECT * FROM t0 UNION ALL SELECT * FROM cleaned s WHERE s.category IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM t0 WHERE t0.scrape_timestamp = s.scrape_timestamp))
SELECT scrape_timestamp, CAST(property_id AS VARCHAR) AS listing_key, category FROM c""")
def fact_merge_timestamp(spark, sf):
    """The source load's fact match: on the timestamp alone."""
    d = run_dir(spark, "fact_timestamp")
    staging = load_staging(clean_listings(listings(spark, sf)), f"{d}/stage")
    opts = StarOptions(fact_keys=MATCH_TIMESTAMP)
    for part in (staging.where(F.col("category") == "Hotel"), staging):
        build_star(part, f"{d}/warehouse", opts)
    star = read_star(spark, f"{d}/warehouse")
    return star["fact_property_reviews"].join(star["dim_category"], "category_id").select(
        "scrape_timestamp", "listing_key", "category")


_INC_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderstatus", T.StringType()),
                            T.StructField("o_totalprice", T.DoubleType())])


@query("incremental_load", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def incremental_load(spark, sf):
    o = table(spark, sf, "orders").select(*[f.name for f in _INC_SCHEMA.fields])
    d = run_dir(spark, "incremental")
    csvio.write_csv(o.where(F.col("o_orderstatus").isin("F", "O")), f"{d}/landing", mode="append")
    csvio.write_csv(o.where(F.col("o_orderstatus").isin("O", "P")), f"{d}/landing", mode="append")
    for attempt in range(2):              # the second run replays every file
        incremental_merge(spark, f"{d}/landing", _INC_SCHEMA, f"{d}/target", ["o_orderkey"],
                          checkpoint_dir=f"{d}/checkpoint-{attempt}", target_schema=_INC_SCHEMA,
                          max_files_per_trigger=2)
    return spark.read.schema(_INC_SCHEMA).parquet(f"{d}/target")


_SK_SCHEMA = T.StructType([*_INC_SCHEMA.fields, T.StructField("order_sk", T.LongType())])


@query("stateful_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       row_number() OVER (ORDER BY o_orderkey) AS order_sk FROM orders""")
def stateful_load(spark, sf):
    """Orders land in two overlapping folders and are loaded by stream state,
    then all files again under a new checkpoint."""
    o = table(spark, sf, "orders").select(*[f.name for f in _INC_SCHEMA.fields])
    d = run_dir(spark, "stateful")
    csvio.write_csv(o.where(F.col("o_orderstatus").isin("F", "O")), f"{d}/landing", mode="append")
    csvio.write_csv(o.where(F.col("o_orderstatus").isin("O", "P")), f"{d}/landing", mode="append")
    for attempt in range(2):
        incremental_distinct(spark, f"{d}/landing", _INC_SCHEMA, f"{d}/warehouse", "orders",
                             ["o_orderkey"], f"{d}/checkpoint-{attempt}", id_col="order_sk")
    return read_snapshot(spark, f"{d}/warehouse").read(spark, "orders", _SK_SCHEMA)


_SPOT = [  # a third of the orders fall into one small area
    ("o_orderkey", "o_orderkey"),
    ("latitude", "CASE WHEN o_orderkey % 3 = 0 THEN 31.6 + CAST(o_orderkey % 97 AS DOUBLE) / CAST(9700 AS DOUBLE) "
                 "ELSE CAST(o_orderkey * 7919 % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - 90 END"),
    ("longitude", "CASE WHEN o_orderkey % 3 = 0 THEN -8.0 + CAST(o_orderkey % 89 AS DOUBLE) / CAST(8900 AS DOUBLE) "
                  "ELSE CAST(o_orderkey * 104729 % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - 180 END"),
]
_PLACE = [
    ("c_custkey", "c_custkey"),
    ("latitude", "CASE WHEN c_custkey % 2 = 0 THEN 31.6 + CAST(c_custkey % 101 AS DOUBLE) / CAST(10100 AS DOUBLE) "
                 "ELSE CAST(c_custkey * 6007 % 18000 AS DOUBLE) / CAST(100 AS DOUBLE) - 90 END"),
    ("longitude", "CASE WHEN c_custkey % 2 = 0 THEN -8.0 + CAST(c_custkey % 103 AS DOUBLE) / CAST(10300 AS DOUBLE) "
                  "ELSE CAST(c_custkey * 50021 % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - 180 END"),
]


@query("nearest_place", f"""
WITH {_cte('o', _SPOT, 'orders')}, {_cte('c', _PLACE, 'customer')},
pairs AS (SELECT o_orderkey, o.latitude, o.longitude, c_custkey,
                 (c.latitude - o.latitude) * (c.latitude - o.latitude)
                 + (c.longitude - o.longitude) * (c.longitude - o.longitude) AS distance_sq
          FROM o, c)
SELECT o_orderkey, latitude, longitude, c_custkey, distance_sq FROM pairs
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY distance_sq, c_custkey) = 1""")
def nearest_place_q(spark, sf):
    """The customer's place nearest to every order's coordinate; half of the
    places and a third of the orders crowd one area."""
    return nearest.nearest_place(_view(table(spark, sf, "orders"), _SPOT),
                                 _view(table(spark, sf, "customer"), _PLACE), "c_custkey")


@query("links_over_runs", f"""
WITH {_LINKS_SQL},
f AS (SELECT *, split_part(href, '?', 1) AS canonical, CASE WHEN page_id % 2 = 0 THEN 0 ELSE 1 END AS run FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY run, page_id, pos) AS rn FROM f)
SELECT canonical, page_id, pos, href, run FROM r WHERE rn = 1""")
def links_over_runs(spark, sf):
    """Unique links over two runs: even pages, then all pages."""
    pages = table(spark, sf, "pages")
    d = run_dir(spark, "links")
    name = f"staylake_links_{d.rsplit('-', 1)[-1]}"
    for run, part in enumerate((pages.where("page_id % 2 = 0"), pages)):
        firstseen.record_links(extract.page_links(part), name, f"{d}/seen", ["page_id", "pos"], run,
                               buckets=16)
    return spark.table(name)


@query("maintained_summary", f"""
WITH {_PARSED_SQL}, now AS (
  SELECT user_id, kind, CASE WHEN event_type = 'purchase' THEN CAST(5.5 AS DOUBLE) ELSE score END AS score
  FROM typed)
SELECT user_id, CASE WHEN grouping(kind) = 1 THEN 'all' ELSE kind END AS kind,
       {_EXACT_AVG} AS avg_score, count(*) AS review_count
FROM now GROUP BY GROUPING SETS ((user_id, kind), (user_id))""")
def maintained_summary(spark, sf):
    """Review summaries after three passes: clicks and views, purchases, and a
    correction that sets every purchase's score."""
    cards = review_cards(spark, sf)
    bought = cards.where(F.col("event_type") == "purchase")
    d = run_dir(spark, "summaries")
    fixed = (bought.withColumn("sign", F.lit(-1))
             .unionByName(bought.withColumn("score", F.lit(5.5)).withColumn("sign", F.lit(1))))
    for part in (cards.where(~F.col("event_type").eqNullSafe("purchase")), bought, fixed):
        summaries.add_reviews(spark, d, part, "user_id")
    return summaries.read_summaries(spark, d, "user_id", cards.schema["user_id"].dataType)


@query("event_variants", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k,
       json_extract_string(props, '$.missing') AS missing, CAST(json(props) AS VARCHAR) AS props
FROM events""")
def event_variants(spark, sf):
    """Events with their JSON parsed once, stored and read by path, whole fields kept."""
    e = table(spark, sf, "events").select("event_id", "props")
    held = variants.store_parsed(e, ["props"], f"{run_dir(spark, 'variants')}/events")
    return held.select("event_id", variants.variant_field("props", "$.k", "bigint", -1).alias("k"),
                       variants.variant_field("props", "$.missing").alias("missing"),
                       F.to_json("props").alias("props"))


_PROFILED = ["l_quantity", "l_extendedprice", "l_suppkey"]


@query("profile_runs", """
WITH f AS (SELECT count(*) AS n, count_if(NOT coalesce(l_quantity < 25, FALSE)) AS failed_small,
                  count_if(NOT coalesce(l_discount > 0, FALSE)) AS failed_discounted FROM lineitem),
c AS (SELECT 'l_quantity' AS "column", count(l_quantity) AS held FROM lineitem
      UNION ALL SELECT 'l_extendedprice', count(l_extendedprice) FROM lineitem
      UNION ALL SELECT 'l_suppkey', count(l_suppkey) FROM lineitem)
SELECT "column", n AS rows, n - held AS nulls, CAST(failed_small AS BIGINT) AS failed_small,
       CAST(failed_discounted AS BIGINT) AS failed_discounted,
       TRUE AS distinct_close, TRUE AS median_close FROM c, f""")
def profile_runs(spark, sf):
    """Line items profiled in two runs by return flag, the profiles merged; the
    sketches' figures are held against exact ones in the last two columns."""
    li = table(spark, sf, "lineitem")
    d = run_dir(spark, "profiles")
    rules = {"small": F.col("l_quantity") < 25, "discounted": F.col("l_discount") > 0}
    returned = F.col("l_returnflag").eqNullSafe("R")
    for run, part in enumerate((li.where(returned), li.where(~returned))):
        profiles.record_profile(spark, d, profiles.profile(part, _PROFILED, rules, run))
    merged = profiles.estimates(profiles.merged(profiles.read_profiles(spark, d)), (0.5,))
    exact = profiles.exact_figures(li, _PROFILED, (0.47, 0.53))
    joined = merged.join(exact, F.col("column") == F.col("of"))
    return joined.select(
        "column", "rows", "nulls", F.col("failed.small").alias("failed_small"),
        F.col("failed.discounted").alias("failed_discounted"),
        (F.abs(F.col("distinct_values") - F.col("n")) <= F.col("n") * 0.08).alias("distinct_close"),
        F.col("q50").between(F.col("p")[0], F.col("p")[1]).alias("median_close"))
