from pyspark.sql import functions as F

from staylake import schemas as S
from staylake.operators import reviews

CARDS = [
    # listing, page, position, score_text, traveler_type
    ("L1", 1, 1, "Scored 8.0", "Couple"),
    ("L1", 1, 2, "Scored 6.0", "Couples"),          # unseen spelling -> 'couples' too
    ("L1", 1, 3, "Scored x", "Family"),             # unparsable: dropped
    ("L1", 2, 1, "Scored 9.0", "  "),               # blank -> Unknown: dropped
    ("L1", 2, 2, "Scored 7.0", "Unknown"),          # dropped
    ("L1", 2, 3, "Scored 10.0", "Solo traveller"),
    ("L1", 3, 1, "Scored 5.0", "Group of friends"),
    ("L1", 3, 2, "Scored 4.0", "Group"),            # same field as above
    ("L1", 9, 1, "Scored 1.0", "Family"),           # beyond the page cap of 3
    ("L2", 1, 1, "Scored 7.5", "Business-Traveler"),
    ("L2", 1, 2, "Scored 8.5", "Digital nomad"),    # unseen type passes through
]


def cards_df(spark):
    return spark.createDataFrame(CARDS, "listing string, page int, position int, "
                                        "score_text string, traveler_type string")


def typed(spark):
    c = reviews.parse_cards(cards_df(spark))
    return c.withColumn("kind", reviews.normalize_traveler_type("traveler_label"))


def test_normalize(spark):
    df = spark.createDataFrame([(x,) for x in ["Solo traveler", "Solo-Traveller", "Family", "Families",
                                               "Group", "Group of friends", "Business-Traveler",
                                               "Business traveller", "Couple", "Digital nomad"]], "t string")
    out = [r[0] for r in df.select(reviews.normalize_traveler_type("t")).collect()]
    assert out == ["solo_travelers", "solo_travelers", "families", "families", "groups_friends",
                   "groups_friends", "business_travellers", "business_travellers", "couples", "digital_nomad"]


def test_parse_drops_bad_cards(spark):
    assert typed(spark).count() == 8


def test_page_cap(spark):
    capped = reviews.cap_pages(typed(spark), "listing", "page", 3)
    assert sorted(r["page"] for r in capped.where(F.col("listing") == "L1").collect()) == [1, 1, 2, 3, 3]


def test_summary_and_invariants(spark):
    t = reviews.cap_pages(typed(spark), "listing", "page", 3)
    rows = {(r["listing"], r["kind"]): (r["avg_score"], r["review_count"])
            for r in reviews.summarize(t, "listing", "kind").collect()}
    assert rows[("L1", "couples")] == (7.0, 2)
    assert rows[("L1", "groups_friends")] == (4.5, 2)
    assert rows[("L1", "all")] == (33.0 / 5, 5)
    # The overall count is the sum of the type counts, and the overall mean
    # equals the count-weighted mean of the type means.
    kinds = [k for (l, k) in rows if l == "L1" and k != "all"]
    assert sum(rows[("L1", k)][1] for k in kinds) == rows[("L1", "all")][1]
    wmean = sum(rows[("L1", k)][0] * rows[("L1", k)][1] for k in kinds) / rows[("L1", "all")][1]
    assert abs(wmean - rows[("L1", "all")][0]) < 1e-12


def test_wide_summary(spark):
    t = reviews.cap_pages(typed(spark), "listing", "page", 3)
    wide = {r["listing"]: r.asDict() for r in reviews.summarize_wide(t, "listing", "kind").collect()}
    l1, l2 = wide["L1"], wide["L2"]
    assert l1[S.score_col("solo_travelers")] == 10.0 and l1[S.count_col("solo_travelers")] == 1
    assert l1[S.score_col("families")] is None and l1[S.count_col("families")] is None
    assert l2[S.count_col("all")] == 2 and l2[S.count_col("business_travellers")] == 1
    assert sum(l2[S.count_col(k)] or 0 for k in [*S.TRAVELER_TYPES, "other"]) == l2[S.count_col("all")]
    assert reviews.discover_types(t) == ["business_travellers", "couples", "digital_nomad",
                                         "groups_friends", "solo_travelers"]


def test_second_pass_union(spark):
    first = typed(spark)
    business = reviews.parse_cards(
        spark.createDataFrame([("L2", 1, 1, "Scored 6.5", None)], "listing string, page int, position int, "
                                                                  "score_text string, traveler_type string")
        .withColumn("traveler_type", F.lit(reviews.BUSINESS_LABEL)))
    business = business.withColumn("kind", reviews.normalize_traveler_type("traveler_label"))
    both = reviews.union_passes(first, business)
    rows = {(r["listing"], r["kind"]): r["review_count"]
            for r in reviews.summarize(both, "listing", "kind").collect()}
    assert rows[("L2", "business_travellers")] == 2
    scores = sorted(r["score"] for r in both.where("listing = 'L2' AND kind = 'business_travellers'").collect())
    assert scores == [6.5, 7.5]


def test_decimal_sums_only_on_request(spark):
    cards = spark.createDataFrame([("L", "couples", 7.25), ("L", "couples", 7.25)],
                                  "listing string, kind string, score double")
    plain = {r["kind"]: r["avg_score"] for r in reviews.summarize(cards, "listing", "kind").collect()}
    assert plain["couples"] == 7.25
    exact = {r["kind"]: r["avg_score"] for r in reviews.summarize(cards, "listing", "kind", scale=2).collect()}
    assert exact["couples"] == 7.25
