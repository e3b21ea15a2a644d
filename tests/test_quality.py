from pyspark.sql import functions as F

from staylake.operators import metrics, quality
from staylake.plans.clean import CleanConfig, clean_listings, clean_report

from .fixtures import listings_df


def test_rules_reject_edges(spark):
    df = quality.nan_to_null(quality.drop_duplicate_rows(listings_df(spark)))
    kept = {r[0] for r in quality.apply_rules(df, quality.default_rules()).select("property_id").collect()}
    assert kept == {"ok1", "edge", "dup", "nozone", "tangier"}


def test_nan_counts_as_missing(spark):
    df = listings_df(spark).where(F.col("property_id") == "nanscore")
    raw = df.where(quality.scores_in_range()).count()
    fixed = quality.nan_to_null(df).where(quality.scores_in_range()).count()
    assert raw == 0 and fixed == 0


def test_dq_report_one_pass(spark):
    df = quality.nan_to_null(quality.drop_duplicate_rows(listings_df(spark)))
    row = quality.dq_report(df, quality.default_rules(),
                            {"consistent": quality.counts_consistent()}).first().asDict()
    assert row["total_rows"] == 12
    assert row["failed_score_range"] == 4          # ten, zero, nullscore, nan
    assert row["failed_positive_counts"] == 1      # zero
    assert row["failed_geo_valid"] == 2
    assert row["failed_price_valid"] == 1
    assert row["passed_all"] == 5
    assert row["consistent"] == 11                 # zero's counts no longer add up


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    dups = sorted(tuple(r) for r in quality.duplicated_rows(df).collect())
    assert dups == [(1, "a"), (1, "a"), (2, None), (2, None)]
    assert quality.drop_duplicate_rows(df).count() == 3


def test_weighted_avg_and_insert_position(spark):
    df = listings_df(spark).where(F.col("property_id") == "ok1")
    out = metrics.insert_after(df, "general_review_count", "weighted_avg", metrics.weighted_avg())
    cols = out.columns
    assert cols[cols.index("general_review_count") + 1] == "weighted_avg"
    assert abs(out.first()["weighted_avg"] - 7.9) < 1e-12


def test_weighted_avg_zero_weight_is_null(spark):
    df = listings_df(spark).where(F.col("property_id") == "ok1").withColumns(
        {c: F.lit(0).cast("long") for _, c in metrics.S.WEIGHT_PAIRS})
    assert df.select(metrics.weighted_avg().alias("w")).first()["w"] is None


def test_override_later_rule_wins(spark):
    df = spark.createDataFrame([("x Marrakech y Tangier", "c"), ("Marrakech", "c"), (None, "c"), ("q", "c")],
                               "address string, city string")
    rules = [("Marrakech", "Marrakech"), ("Tangier", "Tangier")]
    out = [r[0] for r in df.select(metrics.override_when_contains("city", "address", rules)).collect()]
    assert out == ["Tangier", "Marrakech", "c", "c"]


def test_clean_listings(spark):
    out = {r["property_id"]: r for r in clean_listings(listings_df(spark), CleanConfig()).collect()}
    assert set(out) == {"ok1", "edge", "dup", "nozone", "tangier"}
    assert out["ok1"]["city"] == "Marrakech"                      # overridden from the address
    assert out["nozone"]["zone"] == "Commune de Sidi Youssef"      # filled from address
    assert out["tangier"]["city"] == "Tangier"
    assert out["tangier"]["zone"] == "Hotel"                       # part before the region part
    assert out["ok1"]["zone"] == "Medina"                          # present zones are kept


def test_clean_report(spark):
    row = clean_report(listings_df(spark)).first()
    assert row["total_rows"] == 12 and row["passed_all"] == 5


def test_count_consistency_filter_is_optional(spark):
    df = listings_df(spark)
    bad = df.where(F.col("property_id") == "ok1").withColumn("property_id", F.lit("bad")) \
        .withColumn("avg_review_score_all_count", F.lit(99).cast("long"))
    both = df.unionByName(bad)
    assert "bad" in {r[0] for r in clean_listings(both).select("property_id").collect()}
    kept = clean_listings(both, CleanConfig(enforce_count_consistency=True))
    assert "bad" not in {r[0] for r in kept.select("property_id").collect()}
    assert "count_sum" not in kept.columns


def test_duplicates_whose_hashes_collide(spark, monkeypatch):
    rows = [(n, f"v{n % 7}" if n % 3 else None) for n in range(40)] * 2 + [(n, "once") for n in range(20)]
    df = spark.createDataFrame([(None, None), *rows], "a int, b string")
    whole = sorted(map(repr, quality.duplicated_rows(df).collect()))
    assert len(whole) == 80
    monkeypatch.setattr(quality.F, "xxhash64", lambda *cols: quality.F.lit(1).cast("long"))
    assert sorted(map(repr, quality.duplicated_rows(df).collect())) == whole


def test_twenty_copies_among_many_rows(spark):
    df = spark.range(20_000).select((F.col("id") % 19_990).alias("k"), F.repeat(F.lit("x"), 200).alias("v"))
    plan = quality.duplicated_rows(df)
    assert plan.count() == 20
