"""Rule reports and column profiles of every run, as sketches that add up.

A run's profile is one aggregation pass: exact counts of rows, NULLs and rows
that fail each rule, and for every column a quantile sketch (KLL) and a
distinct sketch (HLL).  Profiles are stored as loads of a versioned table;
those of several runs merge without reading any run's rows again, and a new
run's sketch against the earlier ones' tells how far its values have moved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_dir
from ..sources.snapshots import Load, Snapshot, Transaction, read_snapshot

TABLE = "profiles"
KLL_K = 200         # ranks within about 1.7 % (99 % of sketches)
HLL_LG = 12         # distinct counts within about 3.2 % (two standard errors)

SCHEMA = T.StructType([
    T.StructField("run", T.LongType()), T.StructField("column", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("nulls", T.LongType()),
    T.StructField("failed", T.MapType(T.StringType(), T.LongType())),
    T.StructField("quantiles", T.BinaryType()), T.StructField("distinct", T.BinaryType())])


def profile(df: DataFrame, columns: Sequence[str], rules: Mapping[str, Column], run: int) -> DataFrame:
    """One row per numeric column: counts, failures of every rule, sketches.
    NaN counts as NULL; a rule that gives NULL fails."""
    def value(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(x), x)

    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"failed{n}")
             for n, rule in enumerate(rules.values())]
    for n, c in enumerate(columns):
        aggs += [F.count(value(c)).alias(f"n{n}"),
                 F.kll_sketch_agg_double(value(c), F.lit(KLL_K)).alias(f"q{n}"),
                 F.hll_sketch_agg(F.when(value(c).isNotNull(), F.xxhash64(value(c))),
                                  F.lit(HLL_LG)).alias(f"d{n}")]
    failed = F.create_map(*[x for n, name in enumerate(rules)
                            for x in (F.lit(name), F.col(f"failed{n}"))])
    if not rules:
        failed = F.create_map().cast("map<string,bigint>")
    one = F.array(*[F.struct(F.lit(c).alias("column"), F.col("rows"),
                             (F.col("rows") - F.col(f"n{n}")).alias("nulls"),
                             F.col(f"q{n}").alias("quantiles"), F.col(f"d{n}").alias("distinct"))
                    for n, c in enumerate(columns)])
    return (df.agg(*aggs).select(failed.alias("failed"), F.explode(one).alias("c"))
            .select(F.lit(run).cast("long").alias("run"), "c.column", "c.rows", "c.nulls", "failed",
                    "c.quantiles", "c.distinct"))


def record_profile(spark: SparkSession, warehouse: str, profiled: DataFrame) -> Snapshot:
    """Store a run's profile as a new version."""
    tx = Transaction(spark, warehouse)
    name = tx.new_folder(TABLE)
    folder = f"{tx.current.root}/{name}"
    profiled.select(SCHEMA.names).coalesce(1).write.parquet(folder)
    tx.add(TABLE, Load(name, spark.read.schema(SCHEMA).parquet(folder).count()))
    return tx.commit()


def read_profiles(spark: SparkSession, warehouse: str) -> DataFrame:
    return read_snapshot(spark, warehouse).read(spark, TABLE, SCHEMA)


def merged(profiles: DataFrame) -> DataFrame:
    """All runs of ``profiles`` as one row per column."""
    failed = (profiles.select("column", F.explode("failed").alias("rule", "n"))
              .groupBy("column", "rule").agg(F.sum("n").alias("n"))
              .groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("rule", "n")))
                                     .alias("failed")))          # one entry per rule
    sums = profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"))
    return sums.join(failed, "column", "left")


def estimates(profiles: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Distinct values and quantiles of every profile row; NULL without values."""
    some = F.col("rows") > F.col("nulls")
    return profiles.withColumn("distinct_values", F.hll_sketch_estimate("distinct")).withColumns({
        f"q{int(r * 100)}": F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(r)))
        for r in ranks})


def exact_figures(df: DataFrame, columns: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """(of, n, p): every numeric column's number of distinct values and its
    exact percentiles, interpolated as ``percentile`` does; NULL without values.

    Values are counted and the counts ordered by range in tasks; only parts in
    which a wanted position falls are summed row by row.
    """
    spark = df.sparkSession
    counts = reduce(DataFrame.union, [
        df.select(F.col(f"`{c}`").cast("double").alias("v")).where("v IS NOT NULL")
        .groupBy("v").agg(F.count(F.lit(1)).alias("held")).select(F.lit(c).alias("of"), "v", "held")
        for c in columns])
    stage = run_dir(spark, "counted")
    # Boundaries are sampled anew by every job: parts are written once.
    (counts.repartitionByRange("of", "v").withColumn("part", F.spark_partition_id())
     .write.parquet(stage))
    counted = spark.read.parquet(stage)
    # One row per column and part: small enough to broadcast.
    earlier = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (counted.groupBy("of", "part").agg(F.sum("held").alias("rows"), F.count(F.lit(1)).alias("n"))
             .withColumns({"before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
                           "last": F.sum("rows").over(Window.partitionBy("of")) - 1}))
    spot = F.array(*[F.col("last") * F.lit(float(r)) for r in ranks])
    wanted = F.array_distinct(F.flatten(F.transform(spot, lambda x: F.array(F.floor(x), F.ceil(x)))))

    def inside(k: Column) -> Column:
        return (k >= F.col("before")) & (k < F.col("before") + F.col("rows"))

    asked = parts.withColumn("wanted", F.filter(wanted, inside)).where(F.size("wanted") > 0)
    run = Window.partitionBy("of", "part").orderBy("v")
    found = (counted.join(F.broadcast(asked.select("of", "part", "before", "wanted")), ["of", "part"])
             .withColumn("upto", F.col("before") + F.sum("held").over(run))
             .withColumn("k", F.explode(F.filter("wanted", lambda k: (k < F.col("upto"))
                                                 & (k >= F.col("upto") - F.col("held")))))
             .groupBy("of").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("at")))

    def percentile(x: Column) -> Column:
        low, high = F.element_at("at", F.floor(x)), F.element_at("at", F.ceil(x))
        return F.when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    figures = (parts.groupBy("of").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
               .join(found, "of").select("of", "n", F.transform(spot, percentile).alias("p")))
    names = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("of"))
    return names.join(figures, "of", "left").select("of", F.coalesce("n", F.lit(0)).alias("n"), "p")


def drift(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """(column, drift): how far the current run's values moved against earlier
    runs, as the largest difference of rank at the percentiles of both (0: alike,
    near 1: apart).  Both are one row per column; columns without values have none."""
    def percentiles(profiles: DataFrame, name: str) -> DataFrame:
        points = [F.kll_sketch_get_quantile_double("quantiles", F.lit(n / 100)) for n in range(1, 100)]
        return profiles.where("rows > nulls").select("column", F.array(*points).alias(name))

    def gap(of: str, within: str) -> Column:
        ranks = F.transform(of, lambda v: F.abs(
            F.size(F.filter(within, lambda t: t <= v)) / 100.0
            - F.size(F.filter(of, lambda t: t <= v)) / 100.0))
        return F.array_max(ranks)

    both = percentiles(current, "now").join(percentiles(earlier, "then"), "column")
    return both.select("column", F.greatest(gap("now", "then"), gap("then", "now")).alias("drift"))
