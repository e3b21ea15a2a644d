"""Versioned warehouses: stopped loads, conflicts, membership indexes, compaction."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake import schemas as S
from staylake.operators import membership, merge
from staylake.plans import star as star_module
from staylake.plans.clean import clean_listings
from staylake.plans.star import build_star, load_staging, read_star
from staylake.sources import snapshots
from staylake.sources.snapshots import ConflictError, Load, Transaction, read_snapshot, versions

from .fixtures import listings_df

DIM = T.StructType([T.StructField("sk", T.LongType()), T.StructField("k", T.LongType()),
                    T.StructField("name", T.StringType())])


def _source(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("k"),
                                           F.concat(F.lit("n"), "id").alias("name"))


def _merge(spark, root, source, **options):
    tx = Transaction(spark, root)
    n = merge.merge_into(tx, "dim", source, ["k"], DIM, id_col="sk", **options)
    return n, tx.commit()


def test_versions_hold_every_load(spark, scratch):
    assert read_snapshot(spark, scratch).version == 0
    assert _merge(spark, scratch, _source(spark, 0, 10))[0] == 10
    n, second = _merge(spark, scratch, _source(spark, 5, 15))
    assert (n, second.version, second.rows("dim"), second.max_id("dim")) == (5, 2, 15, 15)
    n, same = _merge(spark, scratch, _source(spark, 0, 15))
    assert (n, same.version) == (0, 2) and versions(spark, scratch) == [1, 2]
    rows = second.read(spark, "dim", DIM).orderBy("sk").collect()
    assert [(r["sk"], r["k"]) for r in rows] == [(k + 1, k) for k in range(15)]
    old = read_snapshot(spark, scratch, 1).read(spark, "dim", DIM)
    assert old.count() == 10
    assert second.read(spark, "other", DIM).count() == 0


def test_one_of_two_writers_fails(spark, scratch):
    first, second = Transaction(spark, scratch), Transaction(spark, scratch)
    for tx in (first, second):
        merge.merge_into(tx, "dim", _source(spark, 0, 3), ["k"], DIM, id_col="sk")
    first.commit()
    with pytest.raises(ConflictError):
        second.commit()
    assert read_snapshot(spark, scratch).rows("dim") == 3


def _natural(star):
    return {name: sorted(map(repr, df.collect())) for name, df in star.items()}


def test_a_load_stopped_anywhere_shows_the_old_or_the_new_star(spark, scratch, monkeypatch):
    staging = load_staging(clean_listings(listings_df(spark)), f"{scratch}/stage")
    some = staging.where(F.col("property_id") < "p")
    build_star(staging, f"{scratch}/whole")
    build_star(some, f"{scratch}/wh")
    old = _natural(read_star(spark, f"{scratch}/wh"))
    calls = []

    def stopped(real, at):
        def run(*args, **kwargs):
            calls.append(at)
            if len(calls) > at:
                raise RuntimeError("stopped")
            return real(*args, **kwargs)
        return run

    # after 0 to 4 of the five merges
    for at in range(5):
        calls.clear()
        with monkeypatch.context() as patch:
            patch.setattr(star_module, "merge_into", stopped(merge.merge_into, at))
            with pytest.raises(RuntimeError):
                build_star(staging, f"{scratch}/wh")
        assert _natural(read_star(spark, f"{scratch}/wh")) == old
    # before the version is renamed
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "file_system", stopped(snapshots.file_system, 2))
        calls.clear()
        with pytest.raises(RuntimeError):
            build_star(staging, f"{scratch}/wh")
    assert _natural(read_star(spark, f"{scratch}/wh")) == old
    build_star(staging, f"{scratch}/wh")
    new = read_star(spark, f"{scratch}/wh")
    whole = read_star(spark, f"{scratch}/whole")
    assert new["fact_property_reviews"].count() == whole["fact_property_reviews"].count()
    assert new["dim_date"].drop("date_id").exceptAll(whole["dim_date"].drop("date_id")).count() == 0
    assert snapshots.vacuum(spark, f"{scratch}/wh", keep=1) > 0
    assert _natural(read_star(spark, f"{scratch}/wh")) == _natural(new)


def test_files_read_fall_with_the_batch(spark, scratch, monkeypatch):
    monkeypatch.setattr(merge, "INDEXED_ROWS", 0)
    # keys in random order: every file spans the whole range
    keys = spark.range(20_000).select((F.col("id") * 7919 % 20_011 * 2).alias("k"))
    target = keys.withColumn("name", F.col("k").cast("string")).repartition(40)
    tx = Transaction(spark, scratch)
    folder = tx.new_folder("dim")
    target.select(F.lit(1).cast("long").alias("sk"), "k", "name").write.parquet(f"{scratch}/{folder}")
    rows = spark.read.parquet(f"{scratch}/{folder}")
    buckets = membership.buckets_for(20_000, 40)
    membership.key_bitmaps(rows, ["k"], buckets).write.parquet(f"{scratch}/{folder}/{merge.INDEX}")
    tx.add("dim", Load(folder, 20_000, 20_000, ("k",), buckets, 40))
    snapshot = tx.commit()

    def files(batch):
        held = merge.matching_rows(snapshot, "dim", batch, ["k"], DIM)
        return 0 if held is None else len(held.inputFiles())

    held = [r["k"] for r in keys.orderBy("k").limit(1000).collect()]

    def batch(ks):
        return spark.createDataFrame([(k,) for k in ks], "k long")

    assert files(batch([held[7]])) <= 3
    assert files(batch(held[:10])) <= 20
    assert files(batch(held)) == 40
    absent = [2 * n + 1 for n in range(0, 20_000, 2_000)]      # odd keys: in no file
    assert files(batch(absent)) <= 8
    # what is read decides as the whole table would
    mixed = batch([*held[:20], *absent]).withColumn("name", F.lit("x"))
    tx = Transaction(spark, scratch)
    assert merge.merge_into(tx, "dim", mixed, ["k"], DIM, id_col="sk") == len(absent)
    monkeypatch.setattr(merge, "PROBES", 0)
    assert len(merge.matching_rows(snapshot, "dim", batch([held[7]]), ["k"], DIM).inputFiles()) == 40


@pytest.mark.parametrize("null_safe,again", [(True, 0), (False, 2)])
def test_indexed_merge_of_composite_keys(spark, scratch, monkeypatch, null_safe, again):
    monkeypatch.setattr(merge, "INDEXED_ROWS", 0)
    rows = [("a", "x"), ("a", None), (None, "y"), ("b", "x"), ("c", "zz")]
    source = spark.createDataFrame(rows, "city string, zone string")

    def load():
        tx = Transaction(spark, scratch)
        n = merge.merge_into(tx, "dim_location", source, ["city", "zone"], S.DIM_LOCATION,
                             id_col="location_id", null_safe=null_safe)
        tx.commit()
        return n

    assert load() == 5
    assert read_snapshot(spark, scratch).tables["dim_location"][0].index_buckets == 1
    assert load() == again


def test_an_index_on_other_keys_or_types_is_left_alone(spark, scratch, monkeypatch):
    monkeypatch.setattr(merge, "INDEXED_ROWS", 0)
    _merge(spark, scratch, _source(spark, 0, 100))
    by_int = _source(spark, 50, 120).withColumn("k", F.col("k").cast("int"))
    assert _merge(spark, scratch, by_int)[0] == 20          # int keys hash otherwise than longs
    tx = Transaction(spark, scratch)
    assert merge.merge_into(tx, "dim", _source(spark, 110, 130), ["name"], DIM, id_col="sk") == 10


def test_compaction_keeps_rows_and_old_versions(spark, scratch):
    for n in range(3):
        _merge(spark, scratch, _source(spark, 0, 10 * (n + 1)))
    tx = Transaction(spark, scratch)
    merge.compact(tx, "dim", DIM, ["k"])
    after = tx.commit()
    assert len(after.tables["dim"]) == 1 and after.rows("dim") == 30 and after.max_id("dim") == 30
    assert after.read(spark, "dim", DIM).count() == 30
    assert read_snapshot(spark, scratch, 3).read(spark, "dim", DIM).count() == 30
    assert _merge(spark, scratch, _source(spark, 25, 35))[0] == 5
    assert snapshots.vacuum(spark, scratch, keep=1) == 3
    assert read_snapshot(spark, scratch).read(spark, "dim", DIM).count() == 35


def test_the_source_is_evaluated_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(k):
        seen.add(1)
        return k

    source = _source(spark, 0, 50).withColumn("k", counted("k"))
    for expected in (50, 100):
        _merge(spark, scratch, source)
        assert seen.value == expected


def test_empty_source(spark, scratch):
    n, snapshot = _merge(spark, scratch, _source(spark, 0, 0))
    assert (n, snapshot.version) == (0, 0)
    columns = spark.createDataFrame([(1, None)], "k long, name void")
    assert _merge(spark, scratch, columns)[0] == 1


def test_bitmap_bits(spark):
    df = spark.range(200).select((F.col("id") * 131 % 32768).alias("at"))
    bits = df.agg(F.bitmap_construct_agg("at").alias("bits"))
    probe = spark.range(32768).select(F.col("id").alias("p")).crossJoin(bits)
    hit = {r["p"] for r in probe.where(membership._bit(F.col("bits"), F.col("p"))).collect()}
    assert hit == {r["at"] for r in df.collect()}
