import datetime as dt
import os

from pyspark.sql import functions as F

from staylake import schemas as S
from staylake.operators import quality
from staylake.plans.etl import RunConfig, run_etl
from staylake.plans.star import read_star
from staylake.sources.csv import write_csv
from staylake.streaming.incremental import incremental_merge

from .fixtures import listings_df


def _raw_folder(spark, folder):
    df = listings_df(spark).withColumn("scrape_timestamp", F.date_format("scrape_timestamp", "yyyy-MM-dd HH:mm:ss"))
    # Two files with different column orders, like two crawler runs.
    write_csv(df.where(F.col("property_id") < "o"), f"{folder}/run1")
    cols = list(reversed(df.columns))
    write_csv(df.where(F.col("property_id") >= "o").select(*cols), f"{folder}/run2")


def test_etl_twice_is_idempotent(spark, scratch):
    raw = f"{scratch}/raw"
    _raw_folder(spark, raw)
    cfg = RunConfig(raw_dir=raw, out_dir=f"{scratch}/out", now=dt.datetime(2025, 9, 4, 9))
    first = run_etl(spark, cfg)
    # One URL with two addresses gives two property rows (distinct on five
    # columns, matched on the URL only), as the source warehouse load does.
    assert first == {"dim_property": 2, "dim_category": 1, "dim_date": 1, "dim_location": 3,
                     "fact_property_reviews": 5}
    second = run_etl(spark, cfg)
    assert second == {"dim_property": 0, "dim_category": 0, "dim_date": 0, "dim_location": 0,
                      "fact_property_reviews": 0}
    star = read_star(spark, f"{scratch}/out/warehouse")
    fact = star["fact_property_reviews"]
    assert [r["fact_id"] for r in fact.orderBy("fact_id").collect()] == [1, 2, 3, 4, 5]
    assert fact.select("category_id").distinct().collect()[0][0] == 1
    dates = star["dim_date"].first()
    assert (dates["day"], dates["month"], dates["year"], dates["weekday"]) == (4, 9, 2025, 4)
    assert os.path.isdir(f"{scratch}/out/raw_snapshot/run=20250904_080000")


def test_stream_batches_and_replay(spark, scratch):
    schema = S.LISTING_SCHEMA
    landing = f"{scratch}/landing"
    df = listings_df(spark).dropDuplicates()
    write_csv(df.where(F.col("property_id") < "p"), landing, mode="append")
    # A later producer writes the columns in another order; overlaps the first batch.
    write_csv(df.where(F.col("property_id") >= "n").select(*reversed(df.columns)), landing, mode="append")
    target = f"{scratch}/target"
    for attempt in range(2):
        incremental_merge(spark, landing, schema, target, ["property_id"],
                          checkpoint_dir=f"{scratch}/ckpt{attempt}", target_schema=schema,
                          max_files_per_trigger=1)
    got = spark.read.schema(schema).parquet(target)
    assert got.exceptAll(quality.nan_to_null(df)).count() == 0
    assert got.count() == df.count()
    assert got.select("property_id").distinct().count() == df.count()


def test_fact_key_option(spark, scratch):
    from staylake.plans.star import StarOptions, build_star, load_staging
    from staylake.plans.clean import clean_listings
    staging = load_staging(clean_listings(listings_df(spark)), f"{scratch}/stage")
    opts = StarOptions(fact_keys=("scrape_timestamp", "category_id"), null_safe_location=True)
    first = build_star(staging, f"{scratch}/wh", opts)
    again = build_star(staging, f"{scratch}/wh", opts)
    assert first["fact_property_reviews"] == 5 and sum(again.values()) == 0


def test_catalog_registration(spark, scratch):
    from staylake.plans.star import build_star, load_staging
    from staylake.plans.clean import clean_listings
    staging = load_staging(clean_listings(listings_df(spark)), f"{scratch}/stage",
                           table="staylake_cat_test.listing_stage")
    assert spark.table("staylake_cat_test.listing_stage").count() == 5
    assert "normalized_timestamp" in spark.table("staylake_cat_test.listing_stage").columns
    build_star(staging, f"{scratch}/wh", database="staylake_cat_test")
    assert spark.table("staylake_cat_test.fact_property_reviews").count() == 5
    assert spark.table("staylake_cat_test.dim_category").count() == 1


def test_null_zone_location_reinserts_unless_null_safe(spark, scratch):
    from staylake.plans.star import StarOptions, build_star, load_staging
    from staylake.plans.clean import clean_listings
    df = listings_df(spark).where(F.col("property_id") == "ok1") \
        .withColumn("zone", F.lit(None).cast("string")) \
        .withColumn("address", F.lit("Plain street  Morocco"))      # no zone can be inferred
    staging = load_staging(clean_listings(df), f"{scratch}/stage")
    assert staging.first()["zone"] is None
    plain = [build_star(staging, f"{scratch}/wh1")["dim_location"] for _ in range(2)]
    safe = [build_star(staging, f"{scratch}/wh2", StarOptions(null_safe_location=True))["dim_location"]
            for _ in range(2)]
    assert plain == [1, 1] and safe == [1, 0]


def _natural(star):
    """The star's rows without surrogate ids."""
    fact = star["fact_property_reviews"].join(star["dim_category"], "category_id")
    frames = [fact.drop("fact_id", "category_id"), star["dim_property"].drop("property_id"),
              star["dim_date"].drop("date_id"), star["dim_location"].drop("location_id"),
              star["dim_category"].drop("category_id")]
    return [sorted(map(repr, f.collect())) for f in frames]


def test_streamed_star_does_not_depend_on_batching(spark, scratch):
    from staylake.streaming.incremental import incremental_star
    df = listings_df(spark)
    landing = f"{scratch}/landing"
    # overlapping files; zones that are missing; two listings of one timestamp
    for part in (df.where(F.col("property_id") < "p"), df, df.withColumn("zone", F.lit(None).cast("string"))
                 .withColumn("address", F.lit("Plain street"))):
        write_csv(part.coalesce(1), landing, mode="append")
    seen = []
    for cap in (1, 3, 1000):
        base = f"{scratch}/cap{cap}"
        for attempt in range(2):                     # the second run replays every file
            incremental_star(spark, landing, f"{base}/wh", f"{base}/ckpt{attempt}",
                             max_files_per_trigger=cap)
        seen.append(_natural(read_star(spark, f"{base}/wh")))
    assert seen[0] == seen[1] == seen[2]
    assert len(seen[0][0]) >= 5


def test_a_stopped_merge_of_the_stream_is_made_up(spark, scratch, monkeypatch):
    """Batches are merged while the next is read: an error is raised, nothing is lost."""
    from staylake.plans import star
    from staylake.streaming.incremental import incremental_star
    df = listings_df(spark)
    for part in (df.where(F.col("property_id") < "p"), df, df.withColumn("city", F.lit("Fes"))):
        write_csv(part.coalesce(1), f"{scratch}/landing", mode="append")
    incremental_star(spark, f"{scratch}/landing", f"{scratch}/whole", f"{scratch}/ckpt0",
                     max_files_per_trigger=1)
    real, calls = star.build_star, []

    def second_fails(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return real(*args, **kwargs)

    def stream():
        incremental_star(spark, f"{scratch}/landing", f"{scratch}/wh", f"{scratch}/ckpt1",
                         max_files_per_trigger=1)

    with monkeypatch.context() as patch:
        patch.setattr(star, "build_star", second_fails)
        try:
            stream()
        except Exception as stopped:
            assert "stopped" in str(stopped)
        else:
            raise AssertionError("the error was not raised")
    stream()
    assert _natural(read_star(spark, f"{scratch}/wh")) == _natural(read_star(spark, f"{scratch}/whole"))


def test_partly_present_fact_load_is_completed(spark, scratch):
    from staylake.plans.clean import clean_listings
    from staylake.plans.star import MATCH_TIMESTAMP, StarOptions, build_star, load_staging
    staging = load_staging(clean_listings(listings_df(spark)), f"{scratch}/stage")
    some = staging.where(F.col("property_id") < "p")
    for opts, total in ((StarOptions(), 5), (StarOptions(fact_keys=MATCH_TIMESTAMP), some.count())):
        wh = f"{scratch}/wh{total}"
        build_star(some, wh, opts)
        build_star(staging, wh, opts)
        assert read_star(spark, wh)["fact_property_reviews"].count() == total
    assert 0 < some.count() < 5


def test_listings_of_pages_can_be_cleaned(spark):
    from staylake.plans import bindings
    from staylake.plans.clean import clean_listings
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    rows = bindings.pages_to_listings(spark, sf)
    assert rows.schema == S.LISTING_SCHEMA or rows.columns == S.LISTING_COLUMNS
    cleaned = clean_listings(rows.withColumns({k: F.coalesce(k, F.lit(1)) for k in S.RULE_COUNTS}))
    assert "weighted_avg" in cleaned.columns and cleaned.count() <= rows.count()
