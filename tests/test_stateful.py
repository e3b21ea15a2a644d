"""Incremental loads by stream state."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.sources.csv import write_csv
from staylake.sources.snapshots import read_snapshot
from staylake.streaming.stateful import incremental_distinct

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])
TABLE = T.StructType([*SCHEMA.fields, T.StructField("sk", T.LongType())])


def _land(spark, folder, first, last, reverse=False, name="n"):
    df = spark.range(first, last).select(F.col("id").alias("k"),
                                         F.concat(F.lit(name), "id").alias("name"))
    write_csv((df.select("name", "k") if reverse else df).coalesce(1), folder, mode="append")


def _run(spark, scratch, checkpoint="ckpt", **options):
    return incremental_distinct(spark, f"{scratch}/landing", SCHEMA, f"{scratch}/wh", "t", ["k"],
                                f"{scratch}/{checkpoint}", id_col="sk", **options)


def _rows(spark, scratch):
    return sorted(tuple(r) for r in read_snapshot(spark, f"{scratch}/wh").read(
        spark, "t", TABLE).select("k", "name", "sk").collect())


def test_rows_read_do_not_grow_with_the_target(spark, scratch):
    _land(spark, f"{scratch}/landing", 0, 2000)
    _run(spark, scratch)
    assert len(_rows(spark, scratch)) == 2000
    for first in (1995, 2000):
        _land(spark, f"{scratch}/landing", first, first + 10, reverse=True, name="later")
        query = _run(spark, scratch)
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        assert sum(p["numInputRows"] for p in progress) == 10
        state = progress[-1]["stateOperators"][0]
        assert "rocksdb" in " ".join(state["customMetrics"]).lower()
    rows = _rows(spark, scratch)
    assert [r[0] for r in rows] == list(range(2010))
    assert [r[2] for r in rows] == list(range(1, 2011))
    assert rows[1999][1] == "n1999" and rows[2000][1] == "later2000"


def test_a_new_checkpoint_takes_up_what_the_table_holds(spark, scratch):
    _land(spark, f"{scratch}/landing", 0, 20)
    _land(spark, f"{scratch}/landing", 10, 30)
    _run(spark, scratch, max_files_per_trigger=1)
    before = _rows(spark, scratch)
    assert [r[0] for r in before] == list(range(30))
    _run(spark, scratch, "other")                           # replays every file
    assert _rows(spark, scratch) == before
    _land(spark, f"{scratch}/landing", 25, 35)
    _run(spark, scratch, "other")
    assert [r[0] for r in _rows(spark, scratch)] == list(range(35))


def test_null_keys_and_nothing_landed(spark, scratch):
    import os
    os.makedirs(f"{scratch}/landing")
    assert _run(spark, scratch) is None
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (1, "a"), (None, "a")], SCHEMA)
    write_csv(rows.coalesce(1), f"{scratch}/landing", mode="append")
    _run(spark, scratch)
    got = read_snapshot(spark, f"{scratch}/wh").read(spark, "t", TABLE).collect()
    assert sorted(((r["k"], r["name"]) for r in got), key=repr) == [(1, "a"), (None, "a")]
    incremental_distinct(spark, f"{scratch}/landing", SCHEMA, f"{scratch}/wh2", "t", ["k"],
                         f"{scratch}/ckpt2", null_safe=False)
    assert read_snapshot(spark, f"{scratch}/wh2").rows("t") == 3
