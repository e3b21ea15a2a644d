"""Invented listing rows with the edge cases the cleaning rules care about."""

from __future__ import annotations

import datetime as dt
import math

from staylake import schemas as S

BASE = {
    "property_id": "p0", "scrape_timestamp": dt.datetime(2025, 9, 4, 8, 0, 0),
    "property_url": "https://stay.example.com/hotel/a.html?x=1", "category": "Riad",
    "general_review": 8.5, "general_review_count": 120,
    "comfort_score": 8.0, "value_score": 7.5, "location_score": 9.0, "wifi_score": 6.0,
    "min_price": 50.0, "max_price": 90.0, "latitude": 31.6, "longitude": -8.0,
    "address": "Riad Dar  Commune de Sidi Youssef  Marrakech  Morocco",
    "zone": "Medina", "city": "Saada", "wifi_speed": "Not specified",
}
# (score, count) per type: all, families, couples, solo, business, groups
GOOD_SCORES = {"all": (8.0, 10), "families": (8.0, 2), "couples": (7.0, 3),
               "solo_travelers": (9.0, 1), "business_travellers": (8.5, 2), "groups_friends": (8.0, 2)}


def listing(pid: str, **overrides) -> dict:
    row = dict(BASE, property_id=pid)
    for kind, (s, c) in GOOD_SCORES.items():
        row[S.score_col(kind)] = s
        row[S.count_col(kind)] = c
    row.update(overrides)
    return row


def listing_rows() -> list[dict]:
    return [
        listing("ok1"),
        listing("ten", avg_review_score_couples=10.0),                 # 10.0 fails (< 10)
        listing("edge", avg_review_score_couples=9.99),                # passes
        listing("zero", avg_review_score_families=0.0,
                avg_review_score_families_count=0),                    # fails score and count
        listing("nullscore", avg_review_score_solo_travelers=None),    # NULL fails
        listing("nanscore", avg_review_score_groups_friends=math.nan), # NaN fails
        listing("lat90", latitude=90.0),                               # open bound fails
        listing("lonneg", longitude=-180.0),                           # open bound fails
        listing("price", min_price=100.0, max_price=90.0),             # max < min fails
        listing("dup"), listing("dup"),                                # exact duplicate
        listing("nozone", zone=None),                                  # zone filled from address
        listing("tangier", address="Hotel  Tangier Prefecture  Morocco", zone=None),
    ]


def listings_df(spark):
    rows = listing_rows()
    return spark.createDataFrame([tuple(r.get(c) for c in S.LISTING_COLUMNS) for r in rows],
                                 S.LISTING_SCHEMA)
