import datetime as dt

from pyspark.sql import functions as F

from staylake.functions import dates, text


def _one(spark, col, rows, schema="v string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_trim_ws_strips_tabs_and_newlines(spark):
    assert _one(spark, text.trim_ws("v"), [("\t a b \n",), (None,), ("   ",)]) == ["a b", None, ""]


def test_split_nonblank_drops_blank_pieces(spark):
    out = _one(spark, text.split_nonblank("v", "  "),
               [("a  b   c  ",), ("  x  ",), ("",), (None,)])
    assert out == [["a", "b", "c"], ["x"], [], None]


def test_contains_text_null_is_false(spark):
    assert _one(spark, text.contains_text("v", "ab"), [("xaby",), (None,), ("a",)]) == [True, False, False]


def test_text_after_marker(spark):
    out = _one(spark, text.text_after("v", "Scored "),
               [("Scored 8.5",), ("Scored  9 ",), ("Scored x",), ("8.0",), (None,)])
    assert out == [8.5, 9.0, None, None, None]


def test_last_piece_and_digits(spark):
    assert _one(spark, text.last_piece("v", "•"), [("a • b •  50 Mbps ",), ("plain",)]) == ["50 Mbps", "plain"]
    assert _one(spark, text.digits_to_long("v"), [("1,234 reviews",), ("none",), (None,)]) == [1234, None, None]


def test_lookup_or_self(spark):
    out = _one(spark, text.lookup_or_self("v", {"a": "A", "b": "B"}), [("a",), ("c",), (None,)])
    assert out == ["A", "c", None]


def test_second_last_or_last(spark):
    df = spark.createDataFrame([(["x", "y", "z"],), (["x"],), ([],)], "a array<string>")
    out = [r[0] for r in df.select(text.second_last_or_last(F.col("a"), F.lit("fb"))).collect()]
    assert out == ["y", "x", "fb"]


def test_normalize_timestamp(spark):
    out = _one(spark, dates.normalize_timestamp("v"),
               [("1704067207179",), ("1704067200000",), ("2024-01-01 10:00:00",), ("junk",), (None,)])
    assert out == ["2024-01-01T00:00:07.179000+00:00", "2024-01-01T00:00:00+00:00",
                   "2024-01-01 10:00:00", "junk", None]


def test_parse_timestamp_keeps_wall_clock(spark):
    out = _one(spark, dates.parse_timestamp("v"),
               [("2024-01-01T00:00:07.179000+00:00",), ("2024-01-01 10:00:00",), ("bad",)])
    assert out == [dt.datetime(2024, 1, 1, 0, 0, 7, 179000), dt.datetime(2024, 1, 1, 10), None]


def test_epoch_round_trip_is_zone_independent(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1704067207179,)], "ms long")
        row = df.select(dates.epoch_ms_to_timestamp("ms").alias("t")).select(
            "t", dates.timestamp_to_epoch_ms("t").alias("back")).first()
        assert row["t"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
        assert row["back"] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_parts_sunday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 12),), (dt.datetime(2024, 1, 13),)], "t timestamp_ntz")
    rows = df.select(*dates.date_parts("t")).collect()
    assert [tuple(r) for r in rows] == [(7, 1, 2024, 0), (13, 1, 2024, 6)]


def test_run_id_and_stay_dates(spark):
    assert dates.run_id(dt.datetime(2025, 9, 4, 8, 17, 19)) == "20250904_071719"
    ci, co = dates.stay_dates(dt.date(2025, 12, 31))
    assert tuple(spark.range(1).select(ci, co).first()) == ("2025-12-31", "2026-01-01")


def test_json_field(spark):
    rows = [('{"k": 12, "s": "x"}',), ('{"k": "oops"}',), ("not json",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    out = [tuple(r) for r in df.select(text.json_field("v", "$.k", "bigint", default=-1),
                                       text.json_field("v", "$.s")).collect()]
    assert out == [(12, "x"), (-1, None), (-1, None), (-1, None)]
