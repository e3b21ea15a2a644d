"""Work that runs add to: links seen before, review summaries."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.operators import extract, firstseen, reviews, summaries


def _links(spark, rows):
    return spark.createDataFrame(rows, "page_id long, pos int, href string")


def test_two_runs_equal_one_run_over_both(spark, scratch):
    draw = random.Random(2)
    rows = [(p, n, f"/h/{draw.randint(0, 80)}.html?x={n}") for p in range(20) for n in range(10)]
    rows.append((3, 99, None))
    first, second = _links(spark, rows[:100]), _links(spark, rows[90:])
    name = f"seen_{abs(hash(scratch))}"
    for run, links in enumerate((first, second, second)):
        firstseen.record_links(links, name, f"{scratch}/seen", ["page_id", "pos"], run, buckets=16)
    got = spark.table(name)
    both = first.withColumn("run", F.lit(0)).unionByName(second.withColumn("run", F.lit(1)))
    want = extract.first_per_canonical(both.where("href is not null"), ["run", "page_id", "pos"])
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()
    firstseen.compact_seen(spark, name, f"{name}_c", f"{scratch}/compact", buckets=16)
    assert spark.table(f"{name}_c").exceptAll(got).count() == 0
    # only the links of the run are shuffled, the set is read in its buckets
    later = firstseen.unseen_links(_links(spark, rows), f"{name}_c", ["page_id", "pos"])
    assert later.count() == 0
    plan = later._jdf.queryExecution().executedPlan().toString()
    at = plan.rindex("FileScan parquet")
    assert "Bucketed: true" in plan[at:]
    above = plan[plan.rindex("+- Sort", 0, at):at]          # between the join's sort and the scan
    assert "canonical" in above and "Exchange" not in above


def test_summaries_after_passes_equal_a_full_computation(spark, scratch):
    draw = random.Random(3)
    kinds = ["couples", "families", None]
    held = [(draw.randint(0, 9), draw.choice(kinds), draw.choice([8.5, 9.1, 3.3, None]))
            for _ in range(300)]
    schema = "listing_id int, kind string, score double, sign int"

    def add(rows):
        return summaries.add_reviews(spark, scratch, spark.createDataFrame(rows, schema), "listing_id")

    def check(now):
        df = spark.createDataFrame([(i, k, s) for i, k, s in now if s is not None],
                                   "listing_id int, kind string, score double")
        want = reviews.summarize(df, "listing_id", scale=1)
        got = summaries.read_summaries(spark, scratch, "listing_id", T.IntegerType())
        assert sorted(map(repr, got.select(want.columns).collect())) == \
            sorted(map(repr, want.collect()))

    add([(*r, 1) for r in held[:100]])
    check(held[:100])
    add([(*r, None) for r in held[100:]])
    check(held)
    # corrections: some reviews change, some go; one listing loses all of them
    changed = [(i, k, 1.0) for i, k, s in held[:20]]
    gone = [r for r in held[20:] if r[0] == 3]
    version = add([(*r, -1) for r in held[:20]] + [(*r, 1) for r in changed]
                  + [(*r, -1) for r in gone]).version
    now = changed + [r for r in held[20:] if r[0] != 3]
    check(now)
    assert version == 3
    folded = summaries.compact_summaries(spark, scratch, T.IntegerType())
    assert len(folded.tables[summaries.TABLE]) == 1
    check(now)
    assert summaries.compact_summaries(spark, scratch, T.IntegerType()).version == folded.version
    assert add([]).version == folded.version
