"""Run profiles: exact counts, sketch bounds, drift."""

import pytest
from pyspark.sql import functions as F

from staylake.operators import profiles


def _run(spark, first, last, shift=0.0):
    return spark.range(first, last, numPartitions=5).select(
        (F.col("id") % 5000).alias("k"), ((F.col("id") * 7919 % 10007) / 10007 + shift).alias("x"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 10 == 1, float("nan"))
        .otherwise(F.col("id").cast("double")).alias("y"), F.lit(None).cast("double").alias("z"))


def _rules():
    return {"low": F.col("x") < 0.5, "has_y": F.col("y").isNotNull()}


COLUMNS = ["k", "x", "y", "z"]


def test_profiles_of_runs_merge(spark, scratch):
    runs = [_run(spark, 0, 20_000), _run(spark, 20_000, 50_000)]
    for n, df in enumerate(runs):
        profiles.record_profile(spark, scratch, profiles.profile(df, COLUMNS, _rules(), n))
    held = profiles.read_profiles(spark, scratch)
    assert held.count() == 8
    both = runs[0].unionByName(runs[1])
    rows = {r["column"]: r for r in profiles.estimates(profiles.merged(held), (0.1, 0.5, 0.9)).collect()}
    assert {(r["rows"], r["failed"]["has_y"]) for r in rows.values()} == {(50_000, 5_000)}
    assert rows["x"]["failed"]["low"] == both.where("x >= 0.5").count()
    assert [rows[c]["nulls"] for c in COLUMNS] == [0, 0, 10_000, 50_000]
    assert rows["z"]["q50"] is None and rows["z"]["distinct_values"] == 0
    for c, distinct in (("k", 5000), ("x", 10007), ("y", 40_000)):
        assert rows[c]["distinct_values"] == pytest.approx(distinct, rel=0.05)
        values = both.where(F.col(c).isNotNull() & ~F.isnan(c))
        n = values.count()
        for p in (10, 50, 90):
            below = values.where(F.col(c) < rows[c][f"q{p}"]).count() / n
            upto = values.where(F.col(c) <= rows[c][f"q{p}"]).count() / n
            assert below - 0.02 <= p / 100 <= upto + 0.02


def test_drift(spark):
    old = profiles.profile(_run(spark, 0, 20_000), COLUMNS, {}, 0)
    same = profiles.profile(_run(spark, 20_000, 40_000), COLUMNS, {}, 1)
    moved = profiles.profile(_run(spark, 0, 20_000, shift=0.3), COLUMNS, {}, 2)
    far = profiles.profile(_run(spark, 0, 100, shift=5.0), COLUMNS, {}, 3)

    def of(now):
        return {r["column"]: r["drift"] for r in profiles.drift(now, old).collect()}

    assert of(same)["x"] < 0.05 and of(same)["y"] > 0.9 and "z" not in of(same)
    assert of(moved)["x"] == pytest.approx(0.3, abs=0.05)
    assert of(far)["x"] > 0.9


def test_no_rows(spark, scratch):
    profiles.record_profile(spark, scratch, profiles.profile(_run(spark, 0, 0), COLUMNS, _rules(), 0))
    rows = profiles.estimates(profiles.merged(profiles.read_profiles(spark, scratch))).collect()
    assert {(r["rows"], r["nulls"], r["q50"], r["distinct_values"]) for r in rows} == {(0, 0, None, 0)}


def test_exact_figures_equal_the_aggregates(spark):
    df = _run(spark, 0, 10_001).withColumn("w", F.when(F.col("k") % 2 == 0, F.col("k") / 3))
    columns, ranks = [*COLUMNS, "w"], (0.0, 0.1, 0.47, 0.53, 0.999, 1.0)
    found = {r["of"]: r for r in profiles.exact_figures(df, columns, ranks).collect()}
    assert sorted(found) == sorted(columns)
    for c in columns:
        exact = df.agg(F.count_distinct(c).alias("n"),
                       F.percentile(c, F.array(*[F.lit(r) for r in ranks])).alias("p")).first()
        assert found[c]["n"] == exact["n"]
        assert found[c]["p"] == (exact["p"] and pytest.approx(exact["p"], nan_ok=True))
