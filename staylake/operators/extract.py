"""Field extraction over a table of fetched pages and page fragments.

Each extractor is a Column expression (regex, split, array functions), so
extraction runs as narrow per-partition projections; only link
de-duplication needs a shuffle, and it is an aggregation.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (any_contains, before_first, digits_only, find_all,
                              first_match, last_piece, latin_only,
                              recode, search_group, second_last_or_last,
                              split_nonblank, starts_with_any, trim_ws)
from ..functions.dates import stay_dates

# ---------------------------------------------------------------------------
# Fixed values (must equal the source data's conventions).
# ---------------------------------------------------------------------------
# Category recodes applied after breadcrumb parsing.
CATEGORY_RECODES = {"Guest House": "Riad", "Condo Hotel": "Apartment-Hotel"}
# Coordinate patterns, tried in this order.
COORDINATE_PATTERNS = [
    r'"latitude":([0-9\.\-]+),"longitude":([0-9\.\-]+)',
    r'"lat":([0-9\.\-]+),"lng":([0-9\.\-]+)',
]
# Currency-sign price pattern used when no price cell is found.
CURRENCY_PRICE_PATTERN = r"[€$£]\s?(\d{2,5})"
# Parenthesised breadcrumb groups.
PAREN_GROUP_PATTERN = r"\(([^)]+)\)"
WIFI_SEPARATOR = "•"
WIFI_DEFAULT = "Not specified"
# Page-status words, checked on lower-cased page text.
SUSPECT_WORDS = ["captcha", "verify"]
EMPTY_WORDS = ["no properties found", "no results"]
# Address zone markers: parts starting with one of these name the zone.
ZONE_PREFIXES = ["Cercle de", "Cercle d", "Prefecture de", "Prefecture d",
                 "Province de", "Province d", "Arrondissement de", "Arrondissement d",
                 "cadat de", "cadat d", "Pachalik de", "Pachalik d",
                 "Commune de", "Commune d"]
# Words that mark the region part of an address (the zone is the part before).
REGION_WORDS = ["Marrakesh", "Province", "Prefecture"]
# Geocoder address fields, in preference order.
ZONE_FIELDS = ["neighbourhood", "suburb", "quarter", "city_district", "district"]
CITY_FIELDS = ["city", "town", "municipality", "village"]
# Search URL parameters besides the destination and dates.
SEARCH_PARAMS = [("group_adults", "1"), ("no_rooms", "1"), ("group_children", "0")]
HREF_PATTERN = r'href="([^"]*)"'


# ---------------------------------------------------------------------------
# Links (E1, F6, W1, L1, E14)
# ---------------------------------------------------------------------------
def extract_links(html: str | Column, patterns: Sequence[str] = (HREF_PATTERN,)) -> Column:
    """All link targets of a page from the first pattern that hits at all."""
    col = F.col(html) if isinstance(html, str) else html
    tiers = [find_all(col, p, 1) for p in patterns]
    out = None
    for t in tiers[:-1]:
        out = F.when(F.size(t) > 0, t) if out is None else out.when(F.size(t) > 0, t)
    return tiers[-1] if out is None else out.otherwise(tiers[-1])


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               patterns: Sequence[str] = (HREF_PATTERN,)) -> DataFrame:
    """One row per link: (page id, position in page, href)."""
    return pages.select(id_col, F.posexplode(extract_links(html_col, patterns)).alias("pos", "href"))


def link_filter(href: str | Column, token: str) -> Column:
    """Non-empty link containing the path token."""
    col = F.col(href) if isinstance(href, str) else href
    return col.isNotNull() & (col != "") & col.contains(token)


def canonical_url(href: str | Column) -> Column:
    return before_first(href, "?")


def first_per_canonical(links: DataFrame, order_cols: Sequence[str],
                        href: str = "href") -> DataFrame:
    """Keep the first link (by ``order_cols``) of every canonical URL.

    An aggregation with ``min`` of a struct: map-side partial minima mean a
    canonical URL seen a billion times ships one row per map task.
    """
    first = F.min(F.struct(*[F.col(c) for c in order_cols], F.col(href)))
    agg = links.groupBy(canonical_url(href).alias("canonical")).agg(first.alias("__f"))
    return agg.select("canonical", *[F.col(f"__f.{c}").alias(c) for c in order_cols],
                      F.col(f"__f.{href}").alias(href))


def canonical_links(links: DataFrame, order_cols: Sequence[str], token: str,
                    max_links: int, href: str = "href") -> DataFrame:
    """Unique property links in arrival order, stopping after ``max_links``.

    The limit is the feature here (a top-k by arrival order).
    """
    kept = links.where(link_filter(href, token))
    firsts = first_per_canonical(kept, order_cols, href)
    return firsts.orderBy(*order_cols).limit(max_links)


# Everything that is not visible text: scripts, styles, the head, comments, tags.
INVISIBLE_PATTERN = (r"(?is)<(script|style|head|noscript|template)\b.*?(</\1\s*>|\z)"
                     r"|<!--.*?(-->|\z)|<[a-z/!?][^>]*(>|\z)")


def visible_text(html: str | Column) -> Column:
    """The page without what a reader does not see; tags become spaces.  A "<"
    without a letter, "/", "!" or "?" behind it is text."""
    col = F.col(html) if isinstance(html, str) else html
    return F.regexp_replace(col, INVISIBLE_PATTERN, " ")


def page_status(html: str | Column, has_links: Column) -> Column:
    """'links' when the page had links; otherwise, by its visible text,
    'suspect' for challenge pages, 'empty' for no-result pages, else
    'unknown'."""
    low = F.lower(visible_text(html))
    return (F.when(has_links, F.lit("links"))
            .when(any_contains(low, SUSPECT_WORDS), F.lit("suspect"))
            .when(any_contains(low, EMPTY_WORDS), F.lit("empty"))
            .otherwise(F.lit("unknown")))


# ---------------------------------------------------------------------------
# Prices, category, coordinates, Wi-Fi (E2-E5, E12, E13)
# ---------------------------------------------------------------------------
def _to_numbers(texts: Column, drop_commas: bool) -> Column:
    def one(x):
        t = trim_ws(x)
        if drop_commas:
            t = F.regexp_replace(t, ",", "")
        return F.nullif(digits_only(t), F.lit("")).try_cast("bigint")
    return F.filter(F.transform(texts, one), lambda v: v.isNotNull())


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once however often it is read.

    A column named in several places of an expression is computed in each of
    them; a lambda variable over a one-element array is computed once.
    """
    return F.transform(F.array(value), use)[0]


def price_candidates(cells: Column, generic: Column, page: Column) -> Column:
    """Prices from the first non-empty tier: digits of each price cell, then
    digits of generic price elements (commas removed), then currency-sign
    amounts anywhere in the page."""
    none = F.array().cast("array<string>")
    t1 = _to_numbers(F.coalesce(cells, none), False)
    t2 = _to_numbers(F.coalesce(generic, none), True)
    t3 = F.transform(find_all(page, CURRENCY_PRICE_PATTERN, 1), lambda x: x.try_cast("bigint"))
    return once(t1, lambda a: F.when(F.size(a) > 0, a).otherwise(
        once(t2, lambda b: F.when(F.size(b) > 0, b).otherwise(t3))))


def category_from_breadcrumb(text: str | Column,
                             recodes: Mapping[str, str] = CATEGORY_RECODES) -> Column:
    """Second-from-last parenthesised group, else the only one, else the
    whole (stripped) text; then recode."""
    def piece(t):
        return once(find_all(t, PAREN_GROUP_PATTERN, 1), lambda groups: second_last_or_last(groups, t))

    return once(once(trim_ws(text), piece), lambda name: recode(name, dict(recodes)))


def coordinates(page: str | Column, patterns: Sequence[str] = COORDINATE_PATTERNS) -> Column:
    """struct(latitude, longitude) from the first pattern whose first match
    parses as two numbers; NULLs if none does."""
    col = F.col(page) if isinstance(page, str) else page
    out = F.struct(F.lit(None).cast("double").alias("latitude"),
                   F.lit(None).cast("double").alias("longitude"))

    def pair(p):
        def read(found):
            return F.struct(search_group(found, p, 1).try_cast("double").alias("latitude"),
                            search_group(found, p, 2).try_cast("double").alias("longitude"))
        # the page is searched once; both groups are read from the short match
        return once(F.regexp_substr(col, F.lit(p)), read)

    def first_of(p, otherwise):
        return once(pair(p), lambda x: F.when(
            x["latitude"].isNotNull() & x["longitude"].isNotNull(), x).otherwise(otherwise))

    for p in reversed(patterns):
        out = first_of(p, out)
    return out


def usable_coordinates(coord: Column) -> Column:
    """Keep the pair only when both values are present and non-zero."""
    lat, lon = coord["latitude"], coord["longitude"]
    ok = lat.isNotNull() & (lat != 0) & lon.isNotNull() & (lon != 0)
    empty = F.struct(F.lit(None).cast("double").alias("latitude"),
                     F.lit(None).cast("double").alias("longitude"))
    return F.when(ok, coord).otherwise(empty)


def wifi_speed(text: str | Column, default: str = WIFI_DEFAULT) -> Column:
    """Text after the last bullet of the speed line; default when absent."""
    col = F.col(text) if isinstance(text, str) else text
    return F.when(col.isNull(), F.lit(default)).otherwise(last_piece(col, WIFI_SEPARATOR))


def review_count(text: str | Column) -> Column:
    """Digits of a count text as a number; no digits -> NULL."""
    return F.nullif(digits_only(text), F.lit("")).try_cast("bigint")


def nth_number(text: str | Column, pattern: str, n: int) -> Column:
    """The n-th (1-based) match of ``pattern`` read as a double."""
    return F.get(find_all(text, pattern, 1), n - 1).try_cast("double")


def nth_numbers(text: str | Column, pattern: str, positions: Mapping[str, int]) -> Column:
    """struct of several n-th matches by name, from one search of the text."""
    return once(find_all(text, pattern, 1), lambda found: F.struct(*[
        F.get(found, n - 1).try_cast("double").alias(name) for name, n in positions.items()]))


# ---------------------------------------------------------------------------
# Geocoder responses and addresses (E9, E10, E11, J5, P7)
# ---------------------------------------------------------------------------
GEOCODER_SCHEMA = T.StructType([
    T.StructField("display_name", T.StringType()),
    T.StructField("address", T.MapType(T.StringType(), T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])


def geocode_fields(payload: str | Column) -> Column:
    """struct(address, zone, city) from a reverse-geocoder JSON response.

    address: display name with non-Latin characters removed, stripped,
    commas turned into spaces; zone: first address field (in preference
    order) that is still non-blank after the same cleaning ('' if fields
    were present but all cleaned to nothing); city: first non-empty of the
    city fields, stripped but not cleaned.  Malformed JSON gives NULLs.
    """
    raw = F.col(payload) if isinstance(payload, str) else payload
    # One parse: input that is not a JSON object of this shape fills the
    # corrupt-record field instead of failing.
    return once(F.from_json(raw, GEOCODER_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"}),
                _geocode_parts)


def _geocode_parts(doc: Column) -> Column:
    valid = doc.isNotNull() & doc["_corrupt_record"].isNull()
    parts = doc["address"]

    address = trim_ws(latin_only(F.coalesce(doc["display_name"], F.lit(""))))
    address = F.regexp_replace(address, ",", " ")

    present = [F.try_element_at(parts, F.lit(f)) for f in ZONE_FIELDS]
    truthy = [F.coalesce(v != "", F.lit(False)) for v in present]
    cleaned = [F.when(t, trim_ws(latin_only(v))) for v, t in zip(present, truthy)]
    zone = F.coalesce(*[F.nullif(c, F.lit("")) for c in cleaned],
                      F.when(any_true(truthy), F.lit("")))

    city_vals = [F.try_element_at(parts, F.lit(f)) for f in CITY_FIELDS]
    city = F.coalesce(*[F.when(F.coalesce(v != "", F.lit(False)), trim_ws(v)) for v in city_vals])

    null = F.lit(None).cast("string")
    return F.struct(F.when(valid, address).otherwise(null).alias("address"),
                    F.when(valid, zone).otherwise(null).alias("zone"),
                    F.when(valid, city).otherwise(null).alias("city"))


def any_true(flags: Sequence[Column]) -> Column:
    out = F.lit(False)
    for f in flags:
        out = out | f
    return out


def zone_from_address(address: str | Column, prefixes: Sequence[str] = ZONE_PREFIXES,
                      region_words: Sequence[str] = REGION_WORDS,
                      delimiter: str = "  ") -> Column:
    """Zone name inferred from an address split on double spaces.

    The first part starting with a zone prefix; otherwise the part just
    before the first later part (index > 0) naming the region; else NULL.
    """
    parts = split_nonblank(address, delimiter)
    by_prefix = first_match(parts, lambda x: starts_with_any(x, prefixes))
    flags = F.transform(parts, lambda x, i: (i > 0) & any_contains(x, region_words))
    pos = F.array_position(flags, True)
    before_region = F.when(pos > 1, F.element_at(parts, (pos - 1).cast("int")))
    return F.coalesce(by_prefix, before_region)


def merge_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str],
                 fields: Sequence[str], when: Column | None = None) -> DataFrame:
    """Left-join enrichment where a matched lookup row replaces ``fields``
    (even with NULLs, as a dict update would); unmatched rows keep theirs.

    ``when`` restricts which rows are looked up at all.  A key that the
    lookup repeats counts once, with its smallest row (NULLs last), so no row
    of ``df`` is multiplied.
    """
    flag = "__matched"
    order = [x for f in fields for x in (F.col(f).isNull(), F.col(f))]
    one = lookup.groupBy(*keys).agg(F.min_by(F.struct(*fields), F.struct(*order)).alias("__row"))
    right = one.select(*keys, *[F.col(f"__row.{f}").alias(f"__new_{f}") for f in fields],
                       F.lit(True).alias(flag))
    joined = df.join(right, on=list(keys), how="left")
    use = F.coalesce(F.col(flag), F.lit(False))
    if when is not None:
        use = use & F.coalesce(when, F.lit(False))
    out = joined.withColumns({f: F.when(use, F.col(f"__new_{f}")).otherwise(F.col(f))
                              for f in fields})
    return out.drop(flag, *[f"__new_{f}" for f in fields])


# ---------------------------------------------------------------------------
# Search URLs (P9, D5)
# ---------------------------------------------------------------------------
def search_url(destination: str | Column, base_url: str, day: _dt.date,
               params: Sequence[tuple[str, str]] = SEARCH_PARAMS) -> Column:
    """``base?ss=<dest>&checkin=<day>&checkout=<day+1>&k=v...`` per row;
    the parameters are literals, so no join is needed."""
    dest = F.col(destination) if isinstance(destination, str) else destination
    checkin, checkout = stay_dates(day)
    pieces = [F.concat(F.lit("ss="), dest),
              F.concat(F.lit("checkin="), checkin),
              F.concat(F.lit("checkout="), checkout)]
    pieces += [F.lit(f"{k}={v}") for k, v in params]
    return F.concat(F.lit(base_url), F.concat_ws("&", *pieces))


def city_override(city: str, address: str, rules: Sequence[tuple[str, str]]) -> Column:
    from .metrics import override_when_contains
    return override_when_contains(city, address, rules)

