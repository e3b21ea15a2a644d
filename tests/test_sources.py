import os

from pyspark.sql import types as T

from staylake.sources import csv as csvio
from staylake.sources import files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("score", T.DoubleType()), T.StructField("city", T.StringType())])


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_by_header_name(spark, scratch):
    base = scratch
    _write(f"{base}/a.csv", "id,name,score,city\n1,a,8.5,X\n2,b,NA,\n")
    _write(f"{base}/b.csv", "city,score,id,name\nY,NaN,3,c\nZ,7,4,\"d, e\"\n")
    _write(f"{base}/c.csv", "name,id,extra\nf,5,hello\n")            # one missing, one extra column
    _write(f"{base}/notes.txt", "ignored\n")
    df = csvio.read_csv_by_name(spark, base, SCHEMA)
    assert df.columns == ["id", "name", "score", "city", "extra"]
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["score"] == 8.5 and rows[1]["city"] == "X"
    assert rows[2]["score"] is None and rows[2]["city"] is None      # NA and blank -> NULL
    assert rows[3]["score"] is None and rows[3]["city"] == "Y"       # NaN token -> NULL
    assert rows[4]["name"] == "d, e" and rows[4]["score"] == 7.0
    assert rows[5]["city"] is None and rows[5]["extra"] == "hello"
    assert len(rows) == 5


def test_a_name_that_a_header_repeats(spark, scratch):
    _write(f"{scratch}/a.csv", "id,name,name,City,city,name_2\n1,a,b,X,Y,c\n")
    _write(f"{scratch}/b.csv", "name,id\nz,2\n")
    got = csvio.read_csv_by_name(spark, scratch, SCHEMA).orderBy("id")
    assert got.columns == ["id", "name", "score", "city", "name_3", "city_2", "name_2"]
    first, second = got.collect()
    assert (first["name"], first["name_3"], first["name_2"], first["city_2"]) == ("a", "b", "c", "Y")
    assert second["name"] == "z" and second["name_3"] is None
    assert csvio.read_csv_by_name(spark, scratch, SCHEMA, keep_extra=False).columns == SCHEMA.names


def test_files_that_land_after_the_listing_are_left_for_the_next_read(spark, scratch, monkeypatch):
    _write(f"{scratch}/a.csv", "id,name\n1,a\n")
    real = csvio.file_headers

    def listed(*args):
        found = real(*args)
        _write(f"{scratch}/late.csv", "name,id\nb,2\n")
        return found

    monkeypatch.setattr(csvio, "file_headers", listed)
    assert [r["id"] for r in csvio.read_csv_by_name(spark, scratch, SCHEMA).collect()] == [1]


def test_header_of_every_file(spark, scratch):
    _write(f"{scratch}/x.csv", "a,b\n1,2\n")
    _write(f"{scratch}/sub/y.csv", "b,a\n3,4\n")
    heads = csvio.file_headers(spark, scratch)
    assert sorted(tuple(h) for h in heads.values()) == [("a", "b"), ("b", "a")]


def test_append_widens_header_by_name(spark, scratch):
    a = spark.createDataFrame([(1, "x")], "property_id int, category string")
    order1 = csvio.append_records(a, scratch, ["property_id", "category", "city"], fill=False)
    b = spark.createDataFrame([(2, "y", "z", 3, 4)], "property_id int, category string, city string, "
                                                      "zeta int, alpha int")
    order2 = csvio.append_records(b, scratch, ["property_id", "category", "city"],
                                  batch_size=1, fill=False)
    assert order1 == ["property_id", "category", "city"]
    assert order2 == ["property_id", "category", "city", "alpha", "zeta"]
    got = csvio.read_csv_by_name(spark, scratch).orderBy("property_id").collect()
    assert [tuple(r) for r in got] == [("1", "x", None, None, None), ("2", "y", "z", "4", "3")]


def test_fill_defaults_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "city string, latitude double, min_price double")
    row = csvio.fill_defaults(df, ["city", "latitude"]).first()
    assert tuple(row) == ("", "", 0.0)


def test_inferred_read_and_snapshot(spark, scratch):
    df = spark.createDataFrame([(1, "a", 2.5)], "k int, s string, d double")
    path = csvio.snapshot_csv(df, scratch, "20250101_000000")
    assert path.endswith("run=20250101_000000")
    back = csvio.read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in back.schema.fields] == ["int", "string", "double"]


def test_stage_replace_and_profile(spark, scratch):
    files.replace_stage(spark.range(5), f"{scratch}/stage")
    files.replace_stage(spark.range(3), f"{scratch}/stage")
    assert files.read_stage(spark, f"{scratch}/stage").count() == 3
    prof = files.parquet_profile(spark, f"{scratch}/stage").first()
    assert tuple(prof) == (3, 1, "id")


def test_tables(spark, scratch):
    db = files.ensure_database(spark, "staylake_test_db", f"{scratch}/db")
    name = files.ensure_table(spark, f"{db}.t", T.StructType([T.StructField("a", T.LongType())]),
                              f"{scratch}/db/t")
    files.ensure_table(spark, f"{db}.t", T.StructType([T.StructField("a", T.LongType())]), f"{scratch}/db/t")
    assert spark.table(name).count() == 0
    files.save_table(spark.range(4).withColumnRenamed("id", "a"), f"{db}.u", "overwrite", f"{scratch}/db/u")
    files.save_table(spark.range(2).withColumnRenamed("id", "a"), f"{db}.u", "append")
    assert spark.table(f"{db}.u").count() == 6


def test_header_with_byte_order_mark(spark, scratch):
    _write(f"{scratch}/bom.csv", "\ufeffid,name\n7,q\n")
    df = csvio.read_csv_by_name(spark, scratch, SCHEMA)
    assert [tuple(r) for r in df.select("id", "name").collect()] == [(7, "q")]


def test_quotes_line_breaks_and_odd_paths(spark, scratch):
    folder = f"{scratch}/a b [1] {{x}}"
    rows = [(1, 'say "hi"\nthere', 1.0), (2, ' "quoted", and commas ', 2.0), (3, "back\\slash", None),
            (4, "'single' \r\n line", 4.0)]
    df = spark.createDataFrame(rows, "id long, name string, score double")
    csvio.write_csv(df, folder)
    got = csvio.read_csv_by_name(spark, folder, SCHEMA).orderBy("id")
    assert [(r["id"], r["name"], r["score"]) for r in got.collect()] == rows


def test_file_written_by_pandas(spark, scratch):
    import pandas as pd
    os.makedirs(scratch, exist_ok=True)
    frame = pd.DataFrame({"id": [1, None, 3], "name": ['He said ""hi"", "ok"', "two\nlines", "a,b"],
                          "score": [12.0, float("nan"), 3.5]})
    frame.to_csv(f"{scratch}/pandas.csv", index=False)
    got = csvio.read_csv_by_name(spark, scratch, SCHEMA).collect()
    assert [(r["id"], r["name"], r["score"]) for r in got] == [
        (1, 'He said ""hi"", "ok"', 12.0), (None, "two\nlines", None), (3, "a,b", 3.5)]


def test_whole_numbers_with_fractions(spark, scratch):
    _write(f"{scratch}/n.csv", "id,name\n12.0,a\n12.5,b\n9007199254740993,c\n1e3,d\nx,e\nNA,f\n")
    got = {r["name"]: r["id"] for r in csvio.read_csv_by_name(spark, scratch, SCHEMA).collect()}
    assert got == {"a": 12, "b": None, "c": 9007199254740993, "d": 1000, "e": None, "f": None}


def test_headers_read_only_the_first_line(spark, scratch):
    _write(f"{scratch}/big.csv", "id,name\n" + "1,x\n" * 1000)
    _write(f"{scratch}/empty.csv", "")
    assert sorted(map(tuple, csvio.file_headers(spark, scratch).values())) == [("id", "name")]


def test_headers_of_many_files_are_found_in_tasks(spark, scratch, monkeypatch):
    for n in range(10_000):
        _write(f"{scratch}/{n % 100}/{n}.csv", ("id,name\n" if n % 2 else "name,id,x\n") + "1,2,3\n")

    def opened(*args):
        raise AssertionError("the driver opens files")

    monkeypatch.setattr(files, "file_system", opened)
    heads = csvio.file_headers(spark, scratch)
    assert len(heads) == 10_000
    assert all(tuple(h) == (("id", "name") if int(p.rsplit("/", 1)[1][:-4]) % 2 else ("name", "id", "x"))
               for p, h in heads.items())


def test_headers_of_large_files(spark, scratch, monkeypatch):
    folder = f"{scratch}/a b [1] {{x}}%20é"
    _write(f"{folder}/one.csv", "\ufeffid,\"na,me\"\r\n" + "1,x\r\n" * 100_000)
    _write(f"{folder}/two.csv", "name,id\n" + "\"a\nb\",2\n" * 50_000)
    _write(f"{folder}/three.csv", "id\n3\n")
    small = csvio.file_headers(spark, scratch)
    assert sorted(map(tuple, small.values())) == [("id",), ("id", "na,me"), ("name", "id")]
    monkeypatch.setattr(csvio, "WHOLE_BYTES", 6)
    assert csvio.file_headers(spark, scratch) == small
    assert csvio.read_csv_by_name(spark, scratch, SCHEMA).count() == 150_001


def test_append_reads_header_and_fills_defaults(spark, scratch):
    a = spark.createDataFrame([(None, 1.0)], "category string, min_price double")
    csvio.append_records(a, scratch, ["category"])
    b = spark.createDataFrame([("h", None)], "category string, max_price double")
    order = csvio.append_records(b, scratch, ["category"])
    assert order == ["category", "min_price", "max_price"]
    text = sorted({r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(scratch).collect()})
    assert text == ['"",1.0', "category,min_price", "category,min_price,max_price", "h,0,0.0"]


def test_the_header_of_a_large_file_is_read_from_its_start(spark, scratch):
    csvio.write_csv(spark.range(0, 200_000, numPartitions=1).selectExpr("id", "repeat('x', 150) AS name"), scratch)
    held = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics()
    before = held.get("file").getLong("bytesRead")
    assert list(csvio.file_headers(spark, scratch).values()) == [["id", "name"]]
    assert held.get("file").getLong("bytesRead") - before < 8_000_000       # of 31 MB


def test_compressed_files_are_read_beside_plain_ones(spark, scratch):
    rows = spark.range(0, 300, numPartitions=2).selectExpr(
        "concat('a, \"', id, '\"', char(10), 'b') AS name", "id")
    csvio.write_csv(rows.where("id < 200"), f"{scratch}/packed", compression="gzip")
    csvio.write_csv(rows.where("id >= 200").select("id", "name"), f"{scratch}/plain")
    assert {p.rsplit(".csv", 1)[1] for p in csvio.csv_files(spark, scratch)} == {".gz", ""}
    got = csvio.read_csv_by_name(spark, scratch, SCHEMA).select("name", "id")
    assert sorted(got.collect()) == sorted(rows.collect())


def test_texts_land_in_files_of_bounded_size(spark, scratch, monkeypatch):
    from staylake.plans import bindings

    spark.range(1, 12_001, numPartitions=1).selectExpr(
        "id AS doc_id", "concat('t', id) AS text", "'en' AS lang", "CAST(3 AS BIGINT) AS n_chars"
    ).write.parquet(f"{scratch}/in/documents.parquet")
    monkeypatch.setattr(bindings, "run_dir", lambda spark, name: f"{scratch}/{name}")
    assert bindings.csv_inferred_documents(spark, f"{scratch}/in").count() == 12_000
    assert len(csvio.csv_files(spark, f"{scratch}/csv_inferred_documents")) == 3


def test_typed_columns_keep_row_loops_short(spark, scratch):
    """The JVM interprets a method above 8,000 bytes: reading a listing took three times as long."""
    from staylake import schemas as S
    row = spark.createDataFrame([tuple("12.0" if f.name.endswith("_count") else None for f in S.LISTING_SCHEMA)],
                                ", ".join(f"{c} string" for c in S.LISTING_COLUMNS))
    csvio.write_csv(row, scratch)
    rows = csvio.read_csv_by_name(spark, scratch, S.LISTING_SCHEMA)
    got = rows.first()
    assert got["general_review_count"] == 12 and got["property_id"] is None
    codegen = spark._jvm.org.apache.spark.sql.execution.debug
    stages = getattr(codegen, "package$").__getattr__("MODULE$").codegenStringSeq(
        rows._jdf.queryExecution().executedPlan())
    assert all(stages.apply(n)._3().maxMethodCodeSize() <= 8000 for n in range(stages.size()))
