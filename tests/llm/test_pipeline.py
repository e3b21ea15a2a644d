"""The entry's registration and the pipeline's stages on the smallest tables."""

import re

import pytest

import corpus_pipeline
import __spark_entry__ as entry
from staylake.llm import decontaminate, queries, quality, simhash
from tests.llm.helpers import HAVE_TABLES, SF, documents


def test_entry_registers_every_operator():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before, tables = docs.columns, docs.cache(), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        tables.append((name, before, after))
        if name != "bpe":
            assert after.columns == columns
        before = after
    by_name = {name: (x, y) for name, x, y in tables}
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    x, y = by_name["quality"]
    model = quality.train(x, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(y) == ids(quality.score(x, model).where("score >= 0.3"))
    x, y = by_name["line_dedup"]
    assert ids(x) == ids(y)
    assert y.where("n_chars <> length(text)").count() == 0
    x, y = by_name["simhash_near_dedup"]
    assert ids(y) == {r["component"] for r in simhash.near_duplicates(x, 4, 4).collect()}
    x, y = by_name["benchmark_decontamination"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(x) - ids(y) == ids(decontaminate.contaminated(x, items))
    x, y = by_name["bpe"]
    assert ids(x) == ids(y)


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
def test_stages_take_empty_and_awkward_documents(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    awkward = documents(spark).selectExpr(
        "doc_id", "text", "cast(null AS string) lang", "'s' source", "0L n_chars")
    for docs in (base.limit(0), awkward):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()
