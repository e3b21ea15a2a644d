"""Schemas of the listing data and the star tables, plus fixed defaults.

Column names and the traveller-type vocabulary must equal the source data's
field names, so they are fixed values (not derived).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Listing field names, traveller types and their score pairs.
# ---------------------------------------------------------------------------
TRAVELER_TYPES = ["families", "couples", "solo_travelers",
                  "business_travellers", "groups_friends"]
ALL_TYPE = "all"
SCORE_PREFIX = "avg_review_score_"

LISTING_FIELDS = [
    ("property_id", T.StringType()),
    ("scrape_timestamp", T.TimestampNTZType()),
    ("property_url", T.StringType()),
    ("category", T.StringType()),
    ("general_review", T.DoubleType()),
    ("general_review_count", T.LongType()),
    ("comfort_score", T.DoubleType()),
    ("value_score", T.DoubleType()),
    ("location_score", T.DoubleType()),
    ("wifi_score", T.DoubleType()),
    ("avg_review_score_all", T.DoubleType()),
    ("avg_review_score_all_count", T.LongType()),
    ("avg_review_score_families", T.DoubleType()),
    ("avg_review_score_families_count", T.LongType()),
    ("avg_review_score_couples", T.DoubleType()),
    ("avg_review_score_couples_count", T.LongType()),
    ("avg_review_score_solo_travelers", T.DoubleType()),
    ("avg_review_score_solo_travelers_count", T.LongType()),
    ("avg_review_score_business_travellers", T.DoubleType()),
    ("avg_review_score_business_travellers_count", T.LongType()),
    ("avg_review_score_groups_friends", T.DoubleType()),
    ("avg_review_score_groups_friends_count", T.LongType()),
    ("min_price", T.DoubleType()),
    ("max_price", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("address", T.StringType()),
    ("zone", T.StringType()),
    ("city", T.StringType()),
    ("wifi_speed", T.StringType()),
]
LISTING_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in LISTING_FIELDS])
LISTING_COLUMNS = [n for n, _ in LISTING_FIELDS]

# Fields the CSV writer fills with '' when absent; every other one gets 0.
TEXT_DEFAULT_FIELDS = ["property_url", "category", "address", "zone", "city",
                       "wifi_speed", "latitude", "longitude"]


def score_col(kind: str) -> str:
    return f"{SCORE_PREFIX}{kind}"


def count_col(kind: str) -> str:
    return f"{SCORE_PREFIX}{kind}_count"


# The five typed (score, count) pairs that make up the weighted average and
# the six (incl. "all") that the validity rules look at.
WEIGHT_PAIRS = [(score_col(t), count_col(t)) for t in TRAVELER_TYPES]
RULE_SCORES = [score_col(ALL_TYPE)] + [score_col(t) for t in TRAVELER_TYPES]
RULE_COUNTS = [count_col(ALL_TYPE)] + [count_col(t) for t in TRAVELER_TYPES]

# ---------------------------------------------------------------------------
# Star tables.
# ---------------------------------------------------------------------------
DIM_PROPERTY = T.StructType([
    T.StructField("property_id", T.LongType()),
    T.StructField("property_url", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("wifi_speed", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
DIM_CATEGORY = T.StructType([
    T.StructField("category_id", T.LongType()),
    T.StructField("category", T.StringType()),
])
DIM_DATE = T.StructType([
    T.StructField("date_id", T.LongType()),
    T.StructField("scrape_timestamp", T.TimestampNTZType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("weekday", T.IntegerType()),
])
DIM_LOCATION = T.StructType([
    T.StructField("location_id", T.LongType()),
    T.StructField("city", T.StringType()),
    T.StructField("zone", T.StringType()),
])
FACT_MEASURES = (["general_review_count", "weighted_avg", "comfort_score",
                  "value_score", "location_score", "wifi_score"]
                 + [c for kind in [ALL_TYPE] + TRAVELER_TYPES
                    for c in (score_col(kind), count_col(kind))]
                 + ["min_price", "max_price"])
FACT_REVIEWS = T.StructType(
    [T.StructField("fact_id", T.LongType()),
     T.StructField("scrape_timestamp", T.TimestampNTZType()),
     T.StructField("listing_key", T.StringType()),
     T.StructField("category_id", T.LongType())]
    + [T.StructField(m, T.DoubleType()) for m in FACT_MEASURES])

STAR_SCHEMAS = {
    "dim_property": DIM_PROPERTY,
    "dim_category": DIM_CATEGORY,
    "dim_date": DIM_DATE,
    "dim_location": DIM_LOCATION,
    "fact_property_reviews": FACT_REVIEWS,
}
