"""Listing rows from fetched pages: every extractor put together.

Input is what a crawl has stored: one page per listing, its review cards and
a table of geocoded coordinates.  Each page column is searched once per
pattern; reviews and locations are joined on their keys.  The result has the
columns of ``LISTING_SCHEMA`` and feeds ``clean_listings``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import find_all, search_group
from ..operators import extract, metrics, reviews


@dataclass(frozen=True)
class PagePatterns:
    """One capture group each."""

    breadcrumb: str = r'<li class="breadcrumb">([^<]*)</li>'
    price_cell: str = r'<span class="price-cell">([^<]*)</span>'
    price_generic: str = r'<span class="price-generic">([^<]*)</span>'
    wifi: str = r"<div>([^<]*Mbps[^<]*)</div>"
    subscore: str = r'<div aria-hidden="true">([^<]*)</div>'
    general_score: str = r'<div class="general-score">([^<]*)</div>'
    review_count: str = r'<div class="review-count">([^<]*)</div>'


# Positions of the sub-scores among a page's score cells.
SUBSCORES = {"comfort_score": 4, "value_score": 5, "location_score": 6, "wifi_score": 7}
LOCATION_FIELDS = ["address", "zone", "city"]


def extract_listings(pages: DataFrame, cards: DataFrame, locations: DataFrame,
                     patterns: PagePatterns = PagePatterns(),
                     score_scale: int | None = None) -> DataFrame:
    """One row per page: ``pages`` has property_id, scrape_timestamp,
    property_url and html; ``cards`` property_id, score_text and
    traveler_type; ``locations`` latitude, longitude and the located fields.

    A page without a value gives NULL ('Not specified' for the Wi-Fi speed);
    a page without usable coordinates is not located.
    """
    html = F.col("html")
    cell = find_all(html, patterns.price_cell, 1)
    generic = find_all(html, patterns.price_generic, 1)
    found = pages.select(
        "property_id", "scrape_timestamp", "property_url",
        extract.category_from_breadcrumb(search_group(html, patterns.breadcrumb, 1)).alias("category"),
        extract.price_candidates(cell, generic, html).alias("__prices"),
        extract.wifi_speed(search_group(html, patterns.wifi, 1)).alias("wifi_speed"),
        extract.nth_numbers(html, patterns.subscore, SUBSCORES).alias("__sub"),
        search_group(html, patterns.general_score, 1).try_cast("double").alias("general_review"),
        extract.review_count(search_group(html, patterns.review_count, 1)).alias("general_review_count"),
        extract.usable_coordinates(extract.coordinates(html)).alias("__at"))
    low, high = metrics.price_range(F.col("__prices"))
    flat = found.select(
        "property_id", "scrape_timestamp", "property_url", "category", "wifi_speed",
        "general_review", "general_review_count", "__sub.*", low.alias("min_price"),
        high.alias("max_price"), "__at.*",
        *[F.lit(None).cast("string").alias(c) for c in LOCATION_FIELDS])
    typed = reviews.parse_cards(cards).withColumn(
        "kind", reviews.normalize_traveler_type("traveler_label"))
    summary = reviews.summarize_wide(typed, "property_id", scale=score_scale)
    located = extract.merge_lookup(flat, locations, ["latitude", "longitude"], LOCATION_FIELDS)
    joined = located.join(summary, "property_id", "left")
    return joined.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in S.LISTING_SCHEMA.fields])
