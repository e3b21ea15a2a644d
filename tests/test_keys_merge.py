from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.operators import keys, merge


def test_assign_keys_matches_global_row_number_int(spark):
    df = spark.range(0, 15000).select((F.col("id") * 7919 % 100003).alias("k"))
    out = keys.assign_keys(df, ["k"], "sk", start=100, buckets=15)
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("k")) + 100)
    assert out.exceptAll(expected).count() == 0 and out.count() == 15000


def test_assign_keys_strings_with_null_and_composite(spark):
    rows = [(None,)] + [(f"key{i:05d}",) for i in range(1495)]
    df = spark.createDataFrame(rows, "k string")
    out = keys.assign_keys(df, ["k"], "sk", buckets=10)
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first())))
    assert out.exceptAll(expected).count() == 0
    comp = spark.range(0, 3000).select((F.col("id") % 7).alias("a"), (F.col("id") * 13 % 3001).alias("b"))
    out2 = keys.assign_keys(comp, ["a", "b"], "sk", buckets=8)
    exp2 = comp.withColumn("sk", F.row_number().over(Window.orderBy("a", "b")))
    assert out2.exceptAll(exp2).count() == 0


def test_fingerprint_is_deterministic(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    fp = [r[0] for r in df.select(keys.row_fingerprint(["x", "y"])).collect()]
    assert fp[0] == fp[1] != fp[2] and len(fp[0]) == 64


SCHEMA = T.StructType([T.StructField("sk", T.LongType()), T.StructField("city", T.StringType()),
                       T.StructField("zone", T.StringType())])


def test_insert_only_merge_idempotent_and_null_keys(spark, scratch):
    src = spark.createDataFrame([("A", "z1"), ("A", None), ("B", "z2")], "city string, zone string")
    target = f"{scratch}/loc"
    assert merge.insert_only_merge(src, target, ["city", "zone"], schema=SCHEMA, id_col="sk") == 3
    # '=' semantics: the NULL-zone row never matches and is inserted again.
    assert merge.insert_only_merge(src, target, ["city", "zone"], schema=SCHEMA, id_col="sk") == 1
    # null-safe matching makes the rerun a no-op.
    assert merge.insert_only_merge(src, target, ["city", "zone"], schema=SCHEMA, id_col="sk",
                                   null_safe=True) == 0
    rows = spark.read.schema(SCHEMA).parquet(target).orderBy("sk").collect()
    assert [r["sk"] for r in rows] == [1, 2, 3, 4]
    assert rows[3]["city"] == "A" and rows[3]["zone"] is None


def test_merge_source_duplicates_and_dedupe(spark, scratch):
    s = T.StructType([T.StructField("id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("lat", T.DoubleType())])
    src = spark.createDataFrame([("u1", 1.0), ("u1", 1.0), ("u1", 1.5), ("u2", 2.0)], "url string, lat double")
    merge.insert_only_merge(src, f"{scratch}/a", ["url"], schema=s, id_col="id", order_cols=["url", "lat"])
    assert spark.read.schema(s).parquet(f"{scratch}/a").count() == 4      # a MERGE inserts them all
    merge.insert_only_merge(src, f"{scratch}/b", ["url"], schema=s, id_col="id", order_cols=["url", "lat"],
                            distinct_source=True)
    assert spark.read.schema(s).parquet(f"{scratch}/b").count() == 3
    merge.insert_only_merge(src, f"{scratch}/c", ["url"], schema=s, id_col="id", order_cols=["url", "lat"],
                            dedupe_on_key=True)
    got = sorted((r["url"], r["lat"]) for r in spark.read.schema(s).parquet(f"{scratch}/c").collect())
    assert got == [("u1", 1.0), ("u2", 2.0)]


def test_fingerprints_of_different_rows_differ(spark):
    df = spark.createDataFrame([("a|b", None), ("a", "b"), ("a|b", ""), (None, "a|b"), ("a", "|b")],
                               "x string, y string")
    assert df.select(keys.row_fingerprint(["x", "y"])).distinct().count() == 5


def test_hot_key_spreads_over_partitions(spark):
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    out = keys.assign_keys(df, ["k"], "sk", buckets=10)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 9000
    assert sorted(r["sk"] for r in out.select("sk").collect()) == list(range(1, 30001))


def test_finished_pending_load_is_published_once(spark, scratch):
    src = spark.createDataFrame([(f"c{n}", "z") for n in range(10)], "city string, zone string")
    target = f"{scratch}/loc"
    merge.insert_only_merge(src.limit(0), target, ["city"], schema=SCHEMA, id_col="sk")
    rows = src.withColumn("sk", F.expr("cast(substr(city, 2) as bigint) + 1")).select("sk", "city", "zone")
    # a run that stopped after moving some of its files
    rows.where("sk <= 4").write.mode("append").parquet(target)
    rows.where("sk > 4").write.parquet(f"{target}/_pending")
    assert merge.insert_only_merge(src, target, ["city"], schema=SCHEMA, id_col="sk") == 0
    assert sorted(r["sk"] for r in spark.read.schema(SCHEMA).parquet(target).collect()) == list(range(1, 11))


def test_unfinished_pending_load_is_discarded(spark, scratch):
    import os
    src = spark.createDataFrame([("a", "z"), ("b", "z")], "city string, zone string")
    target = f"{scratch}/loc"
    src.withColumn("sk", F.lit(9).cast("long")).write.parquet(f"{target}/_pending")
    os.remove(f"{target}/_pending/_SUCCESS")
    assert merge.insert_only_merge(src, target, ["city"], schema=SCHEMA, id_col="sk") == 2
    assert sorted(r["sk"] for r in spark.read.schema(SCHEMA).parquet(target).collect()) == [1, 2]


def test_read_errors_propagate(spark, scratch):
    import os
    import pytest
    assert merge.read_target(spark, f"{scratch}/none") is None
    with pytest.raises(Exception, match="nosuch"):
        merge.read_target(spark, "nosuch://host/folder")
    os.makedirs(f"{scratch}/broken")
    with open(f"{scratch}/broken/part-0.parquet", "w") as f:
        f.write("not parquet")
    src = spark.createDataFrame([("a", "z")], "city string, zone string")
    with pytest.raises(Exception):
        merge.insert_only_merge(src, f"{scratch}/broken", ["city"])


def test_target_scan_is_pruned_by_the_source_range(spark, scratch):
    spark.range(1000).write.parquet(f"{scratch}/t")
    target = spark.read.parquet(f"{scratch}/t")
    held = merge.in_key_range(target, spark.range(40, 60), "id", False)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,40)" in plan and "LessThanOrEqual(id,59)" in plan


def test_only_the_rows_themselves_are_dealt_by_range(spark, scratch, monkeypatch):
    df = spark.range(0, 6000).select((F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 6007).alias("v"))
    seen, real = [], type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda d, *a: seen.append(d.columns) or real(d, *a))
    out = keys.assign_keys(df, ["k"], "sk", buckets=5)
    tie = F.xxhash64("k", "v")                  # rows of one key go by their hash
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("k", tie)).cast("long"))
    assert seen == [["k", "v"]] and out.exceptAll(expected).count() == 0 and out.count() == 6000


def test_hashed_anti_join_tells_keys_apart_by_value(spark):
    rows = [(0.0, "a"), (-0.0, "b"), (float("nan"), "c"), (None, "d"), (None, None), (1.0, None), (2.0, "e")]
    held = [(-0.0, "a"), (0.0, "b"), (float("nan"), "c"), (None, "d"), (None, None), (2.0, "f"), (2.0, "f")]
    schema = "x double, y string"
    source, target = spark.createDataFrame(rows, schema), spark.createDataFrame(held, schema)
    for null_safe, new in ((True, {(1.0, None), (2.0, "e")}),
                           (False, {(1.0, None), (2.0, "e"), (None, "d"), (None, None)})):
        plain = merge.anti_join(source, target, ["x", "y"], null_safe)
        hashed = source.withColumn("h", F.xxhash64("x", "y"))
        for size in (None, len(rows), 10 ** 9):
            got = merge.anti_join(hashed, target, ["x", "y"], null_safe, "h", size).drop("h")
            assert set(map(tuple, got.collect())) == new == set(map(tuple, plain.collect()))
        # equal hashes decide nothing
        same = source.withColumn("h", F.lit(7).cast("long"))
        assert merge.anti_join(same, target, ["x", "y"], null_safe).count() == len(new)


def test_a_wide_merge_is_joined_by_one_long(spark):
    wide = spark.range(50).select(*[(F.col("id") * n).alias(f"c{n}") for n in range(1, 19)])
    hashed = wide.withColumn("h", F.xxhash64(*wide.columns))
    new = merge.anti_join(hashed, wide.where("c1 < 20"), wide.columns, True, "h", 50)
    assert new.count() == 30
    plan = new._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "LeftAnti" in line]
    assert joins and not any("isnull(c1" in line.split("LeftAnti")[0] for line in joins)


def test_rows_maybe_in_keeps_all_held_rows_and_few_others(spark):
    from staylake.operators.membership import rows_maybe_in
    keys = spark.range(40_000).select("id", F.xxhash64("id").alias("h"))
    for size in (1, 5, 20_000):
        batch = spark.range(size).select(F.xxhash64("id").alias("b"))
        got = rows_maybe_in(keys, "h", batch, "b", size)
        assert got.columns == ["id", "h"]
        assert got.where(F.col("id") < size).count() == size
        assert got.count() <= size + 4_000
