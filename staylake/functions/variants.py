"""JSON parsed once into the variant type, stored and read by path.

A variant keeps every field of the text, also those nobody has declared; reading
a field afterwards walks the binary value and parses nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed_json(c: str | Column) -> Column:
    """The text as a variant; NULL if it is no JSON."""
    return F.try_parse_json(F.col(c) if isinstance(c, str) else c)


def variant_field(c: str | Column, path: str, as_type: str = "string", default=None) -> Column:
    """A path's value as ``as_type`` (NULL when absent or not castable), or
    ``default`` when given."""
    value = F.try_variant_get(F.col(c) if isinstance(c, str) else c, path, as_type)
    return value if default is None else F.coalesce(value, F.lit(default).cast(as_type))


def store_parsed(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Write ``df`` with its JSON ``columns`` as variants (Parquet) and read it
    back.  Text that is no JSON is kept beside them as ``<column>_text``."""
    out = df
    for c in columns:
        parsed = parsed_json(c)
        out = out.withColumn(f"{c}_variant", parsed).withColumn(
            f"{c}_text", F.when(F.col(f"{c}_variant").isNull(), F.col(c)))
    names = {f"{c}_variant": c for c in columns}
    out.drop(*columns).withColumnsRenamed(names).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fields_of(df: DataFrame, column: str) -> DataFrame:
    """(field, rows): the top-level fields that a variant column's objects hold,
    declared or not, each with the number of rows that have it."""
    keys = F.json_object_keys(F.to_json(F.col(column)))
    return (df.select(F.explode(F.array_distinct(keys)).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("rows")))
