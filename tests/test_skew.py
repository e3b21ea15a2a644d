"""Results stay whole and exact when one key holds most of the rows."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from staylake.operators import keys, quality, reviews


def test_page_cap_with_a_hot_listing(spark):
    hot = spark.range(0, 20000).select(F.lit("hot").alias("listing"), (F.col("id") % 40).alias("page"),
                                       F.col("id").alias("card"))
    cold = spark.range(0, 300).select(F.concat(F.lit("c"), (F.col("id") % 30).cast("string")).alias("listing"),
                                      (F.col("id") % 7).alias("page"), (F.col("id") + 100000).alias("card"))
    cards = hot.unionByName(cold)
    got = reviews.cap_pages(cards, "listing", "page", 3)
    w = Window.partitionBy("listing").orderBy("page")
    expected = cards.withColumn("r", F.dense_rank().over(w)).where("r <= 3").drop("r")
    assert got.count() == expected.count()
    assert got.where(F.col("listing") == "hot").count() == 1500      # 3 pages x 500 cards
    assert got.exceptAll(expected).count() == 0


def test_duplicates_with_a_hot_tuple(spark):
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    got = quality.duplicated_rows(df)
    assert got.count() == 10001                    # multiples of 3, plus id 1 itself
    assert quality.drop_duplicate_rows(df).count() == 20000


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(min_value=-1000, max_value=1000), min_size=1, max_size=300, unique=True),
       st.integers(min_value=1, max_value=60))
def test_keys_equal_row_number(spark, values, buckets):
    df = spark.createDataFrame([(v,) for v in values], "k int")
    got = keys.assign_keys(df, ["k"], "sk", start=5, buckets=buckets)
    expected = df.withColumn("sk", (F.row_number().over(Window.orderBy("k")) + 5).cast("long"))
    assert got.exceptAll(expected).count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abc ", max_size=8)), min_size=1, max_size=40),
       st.lists(st.tuples(st.text(alphabet="abc", min_size=1, max_size=2), st.sampled_from(["X", "Y", "Z"])),
                min_size=1, max_size=4))
def test_override_later_rule_wins_matches_brute_force(spark, texts, rules):
    from staylake.operators.metrics import override_when_contains
    df = spark.createDataFrame([(i, t, "orig") for i, t in enumerate(texts)], "i int, address string, city string")
    got = {r["i"]: r["c"] for r in df.select("i", override_when_contains("city", "address", rules).alias("c")).collect()}
    for i, t in enumerate(texts):
        want = "orig"
        for needle, value in rules:
            if t is not None and needle in t:
                want = value
        assert got[i] == want
