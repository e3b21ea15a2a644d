"""JSON as variants."""

from pyspark.sql import functions as F

from staylake.functions import variants

ROWS = [(1, '{"k": 5, "x": {"deep": [1, "two"]}}'), (2, '{"k": "7", "new": null}'), (3, "not json"),
        (4, None), (5, "[1, 2]"), (6, '{"k": 1.5}'), (7, "{}"), (8, "")]


def test_fields_are_read_from_the_stored_variant(spark, scratch):
    df = spark.createDataFrame(ROWS, "id int, props string")
    stored = variants.store_parsed(df, ["props"], scratch)
    assert dict(stored.dtypes)["props"] == "variant"
    read = stored.select("id", variants.variant_field("props", "$.k", "bigint", -1).alias("k"),
                         variants.variant_field("props", "$.x.deep[1]").alias("deep"), "props_text")
    assert "parse_json" not in read._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: (r["k"], r["deep"], r["props_text"]) for r in read.collect()}
    assert got[1] == (5, "two", None) and got[2] == (7, None, None)
    assert got[3] == (-1, None, "not json") and got[4] == (-1, None, None)
    assert got[5] == got[7] == (-1, None, None) and got[8][2] == ""
    kept = stored.where("id = 1").select(F.to_json("props").alias("j")).first()["j"]
    assert kept == '{"k":5,"x":{"deep":[1,"two"]}}'
    fields = {r["field"]: r["rows"] for r in variants.fields_of(stored, "props").collect()}
    assert fields == {"k": 3, "x": 1, "new": 1}


def test_one_parse_for_many_fields(spark):
    df = spark.createDataFrame(ROWS, "id int, props string").withColumn(
        "v", variants.parsed_json("props")).repartition(2)
    plan = df.select(*[variants.variant_field("v", f"$.{c}").alias(c) for c in "abcde"])
    assert plan._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") <= 1
