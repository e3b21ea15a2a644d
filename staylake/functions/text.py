"""Scalar text helpers, all built from JVM-side Spark functions (no UDFs).

Every helper takes and returns ``Column`` objects, so callers can compose
them inside one projection and keep the whole chain in generated code.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: characters kept by the Latin-text cleaner (letters, digits,
# whitespace, hyphen, comma, dot, apostrophe); everything else is removed.
NON_LATIN_PATTERN = r"[^a-zA-Z0-9\s\-,\.']"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


WHITE = " \t\n\x0b\f\r"


def trim_ws(c: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace of any kind (tabs, newlines too).

    Spark's ``trim`` removes only spaces, so the characters are named.
    """
    return F.btrim(_col(c), F.lit(WHITE))


def contains_text(c: ColumnOrName, needle: str) -> Column:
    """Case-sensitive substring test where NULL text is simply false."""
    return F.coalesce(_col(c).contains(needle), F.lit(False))


def starts_with_any(c: ColumnOrName, prefixes: Sequence[str]) -> Column:
    col = _col(c)
    out = F.lit(False)
    for p in prefixes:
        out = out | F.coalesce(col.startswith(p), F.lit(False))
    return out


def split_nonblank(c: ColumnOrName, delimiter: str) -> Column:
    """Split on a literal delimiter, strip every piece, drop blank pieces."""
    pieces = F.split(_col(c), re.escape(delimiter), -1)
    return F.filter(F.transform(pieces, trim_ws), lambda x: x != "")


def first_match(arr: Column, predicate) -> Column:
    """First array element satisfying ``predicate`` (NULL if none)."""
    return F.get(F.filter(arr, predicate), 0)


def digits_only(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def digits_to_long(c: ColumnOrName) -> Column:
    """Keep the digits of a text and read them as a number; none -> NULL."""
    return F.nullif(digits_only(c), F.lit("")).try_cast("bigint")


def text_after(c: ColumnOrName, marker: str, as_type: str = "double") -> Column:
    """The piece after the first ``marker``, stripped, cast (NULL on failure)."""
    col = _col(c)
    piece = F.when(col.contains(marker), F.split_part(col, F.lit(marker), F.lit(2)))
    return trim_ws(piece).try_cast(as_type)


def last_piece(c: ColumnOrName, separator: str) -> Column:
    """Text after the last separator, stripped (whole text if absent)."""
    return trim_ws(F.element_at(F.split(_col(c), re.escape(separator), -1), -1))


def before_first(c: ColumnOrName, separator: str) -> Column:
    return F.substring_index(_col(c), separator, 1)


def nonblank(c: ColumnOrName) -> Column:
    """The text, or NULL when it is NULL, empty or only whitespace."""
    return F.nullif(trim_ws(c), F.lit(""))


def latin_only(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), NON_LATIN_PATTERN, "")


def lookup_or_self(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Map known values; unknown values pass through unchanged."""
    col = _col(c)
    out = None
    for key, value in mapping.items():
        out = (F.when(col == key, F.lit(value)) if out is None
               else out.when(col == key, F.lit(value)))
    return col if out is None else out.otherwise(col)


def recode(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    return lookup_or_self(c, mapping)


def find_all(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(pattern), group)


def search_group(c: ColumnOrName, pattern: str, group: int) -> Column:
    """First match's capture group; NULL (not '') when there is no match."""
    col = _col(c)
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def second_last_or_last(arr: Column, fallback: Column) -> Column:
    """Second-from-last element if there are two or more, else the last,
    else the fallback."""
    n = F.size(arr)
    return (F.when(n >= 2, F.element_at(arr, -2))
            .when(n == 1, F.element_at(arr, -1))
            .otherwise(fallback))


def any_contains(c: ColumnOrName, needles: Iterable[str]) -> Column:
    col = _col(c)
    out = F.lit(False)
    for n in needles:
        out = out | F.coalesce(col.contains(n), F.lit(False))
    return out


def json_field(c: ColumnOrName, path: str, as_type: str = "string", default=None) -> Column:
    """A JSON path's value cast to ``as_type`` (NULL when absent, malformed
    or not castable), or ``default`` when given."""
    value = F.get_json_object(_col(c), path).try_cast(as_type)
    return value if default is None else F.coalesce(value, F.lit(default).cast(as_type))
