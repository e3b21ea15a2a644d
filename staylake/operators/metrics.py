"""Row-wise metrics and column edits (weighted mean, inserts, overrides)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import contains_text


def weighted_avg(pairs: Sequence[tuple[str, str]] = S.WEIGHT_PAIRS) -> Column:
    """sum(score * count) / sum(count) across the pairs of one row.

    A zero total weight gives NULL (``try_divide``) rather than an error.
    """
    num = reduce(lambda a, b: a + b, [F.col(s) * F.col(c) for s, c in pairs])
    den = reduce(lambda a, b: a + b, [F.col(c) for _, c in pairs])
    return F.try_divide(num, den)


def insert_after(df: DataFrame, after: str, name: str, expr: Column) -> DataFrame:
    """Add ``expr`` as ``name`` right after column ``after``."""
    cols = [c for c in df.columns if c != name]
    i = cols.index(after) + 1
    sel = [F.col(f"`{c}`") for c in cols]
    return df.select(*sel[:i], expr.alias(name), *sel[i:])


def override_when_contains(target: str, source: str,
                           rules: Sequence[tuple[str, str]]) -> Column:
    """Set ``target`` to a value when ``source`` contains a needle.

    Rules apply in order and a later matching rule wins; NULL source text
    matches nothing.
    """
    out = None
    for needle, value in reversed(list(rules)):
        cond = contains_text(source, needle)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return F.col(target) if out is None else out.otherwise(F.col(target))


def fill_missing(df: DataFrame, col: str, expr: Column) -> DataFrame:
    """Fill only NULL values of ``col`` from ``expr`` (evaluated lazily)."""
    return df.withColumn(col, F.coalesce(F.col(col), expr))


def with_helper(df: DataFrame, name: str, expr: Column,
                step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add a helper column, run ``step`` with it, drop it again."""
    return step(df.withColumn(name, expr)).drop(name)


def price_range(prices: Column) -> tuple[Column, Column]:
    """Min and max of a price array; an empty or NULL array gives NULLs."""
    return F.array_min(prices), F.array_max(prices)
