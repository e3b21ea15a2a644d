"""Review cards -> per-listing, per-traveller-type score summaries.

Cards are rows (listing, page, score text, traveller label).  Scores are
parsed and labels normalised with column expressions; summaries are hash
aggregations with map-side partial sums, so a listing with a huge number of
reviews is pre-aggregated in every map task before the shuffle.  With
``scale`` (the scores' number of decimals, one for "Scored 8.5") sums are
taken over decimals, which makes them exact and independent of
partitioning and retries; without it they are double sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import text_after, trim_ws

# ---------------------------------------------------------------------------
# Traveller label spellings and the field name each maps to.
# ---------------------------------------------------------------------------
TRAVELER_MAPPINGS = {
    "couple": "couples",
    "group": "groups_friends",
    "solo_traveler": "solo_travelers",
    "solo_traveller": "solo_travelers",
    "group_of_friends": "groups_friends",
    "families": "families",
    "family": "families",
    "business_traveller": "business_travellers",
    "business_traveler": "business_travellers",
}
UNKNOWN_TYPE = "Unknown"
SCORE_MARKER = "Scored "
BUSINESS_LABEL = "Business travellers"


def normalize_traveler_type(label: str | Column,
                            mappings: Mapping[str, str] = TRAVELER_MAPPINGS) -> Column:
    """Lower-case, spaces and hyphens -> '_', then map known spellings;
    unknown spellings pass through."""
    col = F.col(label) if isinstance(label, str) else label
    known = F.create_map(*[F.lit(x) for pair in mappings.items() for x in pair])
    key = F.translate(F.lower(col), " -", "__")
    return F.coalesce(F.try_element_at(known, key), key)


def parse_cards(cards: DataFrame, score_text: str = "score_text",
                label: str = "traveler_type") -> DataFrame:
    """Parse 'Scored x' and the traveller label of every card.

    A card whose score does not parse is dropped; a blank or missing label
    is 'Unknown' and such cards are dropped too.
    """
    score = text_after(score_text, SCORE_MARKER, "double")
    raw_label = F.coalesce(F.nullif(trim_ws(label), F.lit("")), F.lit(UNKNOWN_TYPE))
    return (cards.withColumns({"score": score, "traveler_label": raw_label})
            .where(F.col("score").isNotNull() & (F.col("traveler_label") != UNKNOWN_TYPE)))


def cap_pages(cards: DataFrame, listing: str, page: str, max_pages: int) -> DataFrame:
    """Keep the cards of the first ``max_pages`` pages of every listing.

    Pages are ranked over the distinct (listing, page) pairs (a partial
    aggregation), with ``row_number() <= n`` planned as a partial
    window-group limit ahead of the shuffle, so no task ever holds more
    than n pages per listing from each map task.  Cards are then kept by a
    semi join on the kept pairs; Spark picks the join by their measured size
    and splits hot keys.
    """
    pages = cards.select(listing, page).distinct()
    w = Window.partitionBy(listing).orderBy(F.col(page).asc())
    kept = (pages.withColumn("__page_rank", F.row_number().over(w))
            .where(F.col("__page_rank") <= max_pages).drop("__page_rank"))
    return cards.join(kept, on=[listing, page], how="left_semi")


def union_passes(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both passes' cards together before any averaging."""
    return first.unionByName(second, allowMissingColumns=True)


OTHER_TYPE = "other"


def _exact_sum(score: Column, scale: int | None) -> Column:
    """Sum of scores: as decimals of ``scale`` digits when the scores' precision
    is known (exact and independent of partitioning), else as doubles."""
    if scale is None:
        return F.sum(score.cast("double"))
    return F.sum(score.cast(f"decimal(18,{scale})"))


def _mean(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))


def summarize(cards: DataFrame, listing: str, kind: str = "kind",
              score: str = "score", scale: int | None = None) -> DataFrame:
    """Mean and count per (listing, type) plus an 'all' row per listing.

    Reviews are summed once per (listing, type); the 'all' rows add up those
    few sums, so no review row is duplicated.
    """
    per_type = cards.groupBy(listing, kind).agg(
        _exact_sum(F.col(score), scale).alias("__sum"),
        F.count(F.lit(1)).alias("review_count"))
    rolled = (per_type.rollup(listing, kind)
              .agg(F.sum("__sum").alias("__sum"), F.sum("review_count").alias("review_count"),
                   F.grouping(listing).alias("__gl"), F.grouping(kind).alias("__gk"))
              .where(F.col("__gl") == 0))
    return rolled.select(
        listing,
        F.when(F.col("__gk") == 1, F.lit(S.ALL_TYPE)).otherwise(F.col(kind)).alias(kind),
        _mean(F.col("__sum"), F.col("review_count")).alias("avg_score"),
        F.col("review_count"))


def summarize_wide(cards: DataFrame, listing: str, kind: str = "kind",
                   score: str = "score", types: Sequence[str] = S.TRAVELER_TYPES,
                   scale: int | None = None) -> DataFrame:
    """One row per listing with ``avg_review_score_<type>`` and
    ``avg_review_score_<type>_count`` for each known type and for 'all'.

    A single grouped aggregation with conditional sums (what a pivot with
    an explicit value list plans to); absent types give NULL.  Types that
    are not listed share the columns of ``OTHER_TYPE``, so the typed counts
    always add up to that of 'all'.
    """
    aggs = []
    listed = F.coalesce(F.col(kind).isin(*types), F.lit(False))
    for t, hit in [*((t, F.col(kind) == t) for t in types), (OTHER_TYPE, ~listed)]:
        s = _exact_sum(F.when(hit, F.col(score)), scale)
        n = F.count(F.when(hit, F.lit(1)))
        aggs += [F.when(n > 0, _mean(s, n)).alias(S.score_col(t)),
                 F.when(n > 0, n).alias(S.count_col(t))]
    s_all = _exact_sum(F.col(score), scale)
    n_all = F.count(F.lit(1))
    aggs = [_mean(s_all, n_all).alias(S.score_col(S.ALL_TYPE)),
            n_all.alias(S.count_col(S.ALL_TYPE))] + aggs
    return cards.groupBy(listing).agg(*aggs)


MAX_TYPES = 200


def discover_types(cards: DataFrame, kind: str = "kind") -> list[str]:
    """Distinct normalised types present (a small aggregation), for callers
    that want unseen types to become columns too.  More than ``MAX_TYPES``
    types are no column list; the caller then keeps the 'other' column."""
    found = [r[0] for r in cards.where(F.col(kind).isNotNull()).select(kind).distinct()
             .limit(MAX_TYPES + 1).collect()]
    if len(found) > MAX_TYPES:
        raise ValueError(f"more than {MAX_TYPES} reviewer types")
    return sorted(found)
