"""Cleaning a raw listing table into the staged listing table (lazy).

Order of steps: full-row de-duplication, timestamp normalisation, city
override from the address, weighted average inserted after the review
count, validity rules, zone filled from the address.  The whole chain is
one logical plan; nothing runs until the caller writes the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.dates import normalize_timestamp, parse_timestamp
from ..operators import extract, metrics, quality

# Address words that force the city name (a later rule wins).
CITY_RULES = [("Marrakech", "Marrakech"), ("Tangier", "Tangier")]


@dataclass
class CleanConfig:
    city_rules: Sequence[tuple[str, str]] = tuple(CITY_RULES)
    score_low: float = 0.0
    score_high: float = 10.0
    zone_prefixes: Sequence[str] = tuple(extract.ZONE_PREFIXES)
    region_words: Sequence[str] = tuple(extract.REGION_WORDS)
    weight_pairs: Sequence[tuple[str, str]] = tuple(S.WEIGHT_PAIRS)
    insert_after: str = "general_review_count"
    extra_rules: Mapping[str, Column] = field(default_factory=dict)
    enforce_count_consistency: bool = False


def listing_rules(cfg: CleanConfig) -> "dict[str, Column]":
    rules = {
        "score_range": quality.scores_in_range(S.RULE_SCORES, cfg.score_low, cfg.score_high),
        "positive_counts": quality.counts_positive(S.RULE_COUNTS),
        "geo_valid": quality.geo_valid(),
        "price_valid": quality.price_valid(),
    }
    rules.update(cfg.extra_rules)
    return rules


def clean_listings(raw: DataFrame, cfg: CleanConfig | None = None) -> DataFrame:
    cfg = cfg or CleanConfig()
    df = quality.drop_duplicate_rows(raw)

    ts_type = df.schema["scrape_timestamp"].dataType
    if isinstance(ts_type, T.StringType):
        df = df.withColumn("scrape_timestamp",
                           parse_timestamp(normalize_timestamp("scrape_timestamp")))
    elif not isinstance(ts_type, T.TimestampNTZType):
        df = df.withColumn("scrape_timestamp", F.col("scrape_timestamp").cast("timestamp_ntz"))

    df = df.withColumn("city", metrics.override_when_contains("city", "address", cfg.city_rules))
    df = metrics.insert_after(df, cfg.insert_after, "weighted_avg",
                              metrics.weighted_avg(cfg.weight_pairs))
    if cfg.enforce_count_consistency:
        # Helper column for the check, dropped again right after it.
        df = metrics.with_helper(
            df, "count_sum", quality.count_sum([c for _, c in cfg.weight_pairs]),
            lambda d: d.where(F.col("count_sum") == F.col(S.count_col(S.ALL_TYPE))))
    df = quality.nan_to_null(df)
    df = quality.apply_rules(df, listing_rules(cfg))
    return metrics.fill_missing(df, "zone", extract.zone_from_address(
        "address", cfg.zone_prefixes, cfg.region_words))


def clean_report(raw: DataFrame, cfg: CleanConfig | None = None) -> DataFrame:
    """Per-rule failure counts plus the count-consistency check, in one pass
    over the de-duplicated input (what the cleaning step would drop)."""
    cfg = cfg or CleanConfig()
    df = quality.nan_to_null(quality.drop_duplicate_rows(raw))
    return quality.dq_report(df, listing_rules(cfg),
                             {"consistent_counts": quality.counts_consistent()})
