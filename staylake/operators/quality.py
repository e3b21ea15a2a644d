"""Data-quality rules, a one-pass rule report, and duplicate handling.

Rules are plain boolean ``Column`` expressions.  A rule on a NULL value is
NULL and the row does not pass, which is how missing values behave in the
source data's own filters.  NaN is turned into NULL first because Spark
orders NaN above every number (``NaN > 10`` is true).
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Floating NaN -> NULL so comparisons treat it as missing."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or df.columns) if c in floats]
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in targets})


def all_of(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def in_open_range(c: str | Column, low: float, high: float) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return (col > low) & (col < high)


def scores_in_range(cols: Sequence[str] = S.RULE_SCORES, low: float = 0.0,
                    high: float = 10.0) -> Column:
    """Every score strictly between ``low`` and ``high`` (10.0 fails)."""
    return all_of([in_open_range(c, low, high) for c in cols])


def counts_positive(cols: Sequence[str] = S.RULE_COUNTS) -> Column:
    return all_of([F.col(c) > 0 for c in cols])


def geo_valid(lat: str = "latitude", lon: str = "longitude") -> Column:
    return in_open_range(lat, -90, 90) & in_open_range(lon, -180, 180)


def price_valid(min_price: str = "min_price", max_price: str = "max_price") -> Column:
    return (F.col(min_price) >= 0) & (F.col(max_price) >= F.col(min_price))


def coordinates_present(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Both coordinates present and non-zero (a 0 counts as missing)."""
    return (F.col(lat).isNotNull() & (F.col(lat) != 0)
            & F.col(lon).isNotNull() & (F.col(lon) != 0))


def count_sum(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols])


def counts_consistent(parts: Sequence[str] = tuple(S.count_col(t) for t in S.TRAVELER_TYPES),
                      total: str = S.count_col(S.ALL_TYPE)) -> Column:
    """The per-type counts add up to the overall count."""
    return count_sum(parts) == F.col(total)


def default_rules() -> "OrderedDict[str, Column]":
    """The listing validity rules, in the order the cleaning step applies them."""
    return OrderedDict([
        ("score_range", scores_in_range()),
        ("positive_counts", counts_positive()),
        ("geo_valid", geo_valid()),
        ("price_valid", price_valid()),
    ])


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Keep rows that pass every rule (NULL = fail).  One filter, which
    Catalyst pushes down into the scan where the columns allow it."""
    return df.where(all_of([F.coalesce(r, F.lit(False)) for r in rules.values()]))


def dq_report(df: DataFrame, rules: Mapping[str, Column],
              extra_checks: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: total rows, rows failing each rule, rows passing all rules,
    and rows satisfying each extra (report-only) check.  A single
    aggregation pass with map-side partial counts."""
    passes = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(~p).alias(f"failed_{name}") for name, p in passes.items()]
    aggs.append(F.count_if(all_of(list(passes.values()))).alias("passed_all"))
    for name, check in (extra_checks or {}).items():
        aggs.append(F.count_if(F.coalesce(check, F.lit(False))).alias(name))
    return df.agg(*aggs)


def consistency_report(df: DataFrame,
                       parts: Sequence[str] = tuple(S.count_col(t) for t in S.TRAVELER_TYPES),
                       total: str = S.count_col(S.ALL_TYPE)) -> DataFrame:
    """How many rows have type counts adding up to the total.  A report
    only; rows are not removed."""
    check = counts_consistent(parts, total)
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(F.coalesce(check, F.lit(False))).alias("consistent_rows"),
                  F.count_if(~F.coalesce(check, F.lit(False))).alias("inconsistent_rows"))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Remove full-row duplicates (NULL equals NULL).  A hash aggregate with
    a map-side partial step, so a heavily repeated row is collapsed before
    the shuffle."""
    return df.dropDuplicates()


def duplicated_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every copy of the rows whose (``cols``) tuple occurs more than once.

    A first pass counts 64-bit hashes of the tuples, so only 8 bytes a row are
    shuffled; tuples whose hash occurs once are single.  Only the others, the
    candidates, are counted by value: a partial aggregation (skew-safe), whose
    repeated tuples are matched back with a null-safe left-semi join, whose hot
    keys AQE splits across tasks.  No window holds a whole group, and two tuples
    that share a hash are told apart.
    """
    cols = list(cols or df.columns)
    keys = [f"__k{i}" for i in range(len(cols))]
    # -0.0 and 0.0 are one value to grouping, and hash alike
    hashed = df.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in cols]))
    repeated = (hashed.groupBy(F.col("__h").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
                .where(F.col("__n") > 1).select("__r"))
    candidates = hashed.join(repeated, F.col("__h") == F.col("__r"), "left_semi")
    dup_keys = (candidates.groupBy(*[F.col(f"`{c}`").alias(k) for c, k in zip(cols, keys)],
                                   F.col("__h").alias("__kh"))
                .agg(F.count(F.lit(1)).alias("__n"))
                .where(F.col("__n") > 1).drop("__n"))
    cond = [F.col("__h") == F.col("__kh"),
            *[F.col(f"`{c}`").eqNullSafe(F.col(k)) for c, k in zip(cols, keys)]]
    return candidates.join(dup_keys, on=all_of(cond), how="left_semi").drop("__h")
