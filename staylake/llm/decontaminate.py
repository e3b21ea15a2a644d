"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents may be long, so the search asks which items
are contained in a document, not which are similar to it.  Items are dealt
into partitions by their number of distinct shingles (powers of two).  The
signature of an item is its smallest shingle hashes (a bottom-k MinHash), with
k chosen by the largest size of its partition: more than the number of
shingles that an item of the partition may miss at the wanted containment.  A
document that contains enough of an item therefore holds at least one hash of
its signature; this loses no match, whatever the document's length.
Candidates found so are verified by exact shingle containment.

DataFrame functions only.  Documents are read twice, the second time only
candidates.  Signatures and item shingles are broadcast in blocks of at most
``block_rows`` rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import stored

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BLOCK_ROWS = 500_000  # rows of two longs and a short string at most


def words(text: str) -> Column:
    """Lower-cased runs of letters and digits of a column."""
    return F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingle_starts(tokens: Column, n: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(tokens) - n, F.lit(0)))


def shingle_hashes(tokens: str, n: int) -> Column:
    """One hash per shingle; fewer words make one shingle, none make none."""
    column = F.col(tokens)

    def of(i):
        return F.xxhash64(*[F.get(column, i + k) for k in range(n)])

    return F.when(F.size(column) > 0, F.transform(_shingle_starts(column, n), of)).otherwise(
        F.array().cast("array<bigint>"))


def shingle_texts(tokens: str, n: int) -> Column:
    column = F.col(tokens)
    return F.when(
        F.size(column) > 0,
        F.transform(_shingle_starts(column, n),
                    lambda i: F.array_join(F.slice(column, i + 1, n), " "))
    ).otherwise(F.array().cast("array<string>"))


def _in_blocks(rows: DataFrame, key: str, block_rows: int) -> list[DataFrame]:
    """``rows`` cut by its key into parts of about ``block_rows`` rows."""
    blocks = -(-rows.count() // block_rows)
    if blocks <= 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)) == n)
            for n in range(blocks)]


def item_shingles(items: DataFrame, n: int) -> DataFrame:
    """(item, shingle, h, size): the distinct shingles of every item."""
    tokens = (items.where("item_id is not null and text is not null")
              .select(F.col("item_id").alias("item"), F.col("text").cast("string").alias("text"))
              .select("item", words("text").alias("w")))
    single = tokens.select("item", F.explode(shingle_texts("w", n)).alias("shingle")).distinct()
    sizes = single.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    # The hash is that of the shingle's words, as for documents.
    parts = F.split("shingle", " ")
    return single.join(sizes, "item").select(
        "item", "shingle", F.xxhash64(*[F.get(parts, F.lit(k)) for k in range(n)]).alias("h"),
        "size")


def signatures(shingles: DataFrame, containment: float) -> DataFrame:
    """(item, h): each item's smallest hashes, k by its size partition."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2("size")) + 1) - 1
    spare = F.floor((1.0 - containment) * largest + 1e-9).cast("int")
    return (shingles.groupBy("item", "size").agg(F.sort_array(F.collect_set("h")).alias("all"))
            .select("item", F.explode(F.slice("all", F.lit(1), spare + 1)).alias("h")))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", n: int = SHINGLE_WORDS,
                 containment: float = CONTAINMENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, item_id, item_shingles, shared, containment) of every match.

    A match is a pair of document and item whose distinct ``n``-word shingles
    are in the document to at least ``containment``.  Words are lower-cased
    runs of letters and digits.  An item of fewer words has one shingle, all
    its words, which only a document of just these words holds; items without
    words and null ids or texts match nothing.  Repeated rows of a document or
    item give one pair; items that share an id are one set of shingles.
    Other columns are ignored.
    """
    shingles = stored(item_shingles(items, n), "decontaminate-items")
    marks = stored(signatures(shingles, containment), "decontaminate-signatures")
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    tokens = texts.select("doc", words("text").alias("w"))
    hashed = tokens.select("doc", F.explode(shingle_hashes("w", n)).alias("h"))
    # Each block is at most block_rows rows of two longs, so it may be broadcast.
    candidates = reduce(DataFrame.union, [
        hashed.join(F.broadcast(block.select("h").distinct()), "h", "left_semi").select("doc")
        for block in _in_blocks(marks, "h", block_rows)]).distinct()
    candidates = stored(candidates, "decontaminate-candidates")
    held = tokens.join(candidates.withColumnRenamed("doc", "candidate"),
                       F.col("doc") == F.col("candidate"), "left_semi")
    held = held.select("doc", F.explode(shingle_texts("w", n)).alias("shingle"))
    verified = reduce(DataFrame.union, [
        held.join(F.broadcast(block.select("item", "size", "shingle")), "shingle")
        .select("doc", "item", "size", "shingle")
        for block in _in_blocks(shingles, "shingle", block_rows)])
    return (verified.distinct().groupBy("doc", "item", "size")
            .agg(F.count(F.lit(1)).alias("shared"))
            .withColumn("containment", F.col("shared") / F.col("size"))
            .where(F.col("containment") >= containment)
            .select(F.col("doc").alias(id_col), F.col("item").alias("item_id"),
                    F.col("size").alias("item_shingles"), "shared", "containment"))


def _key(id_col: str) -> Column:
    """The id as a string, for rows without one the hash of their text."""
    return F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")),
                      F.concat(F.lit("t"), F.sha2(F.col("text").cast("string"), 256)))


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of documents that hold no test item.

    Rows and items with a null id are judged by their own text.
    """
    found = stored(contaminated(
        docs.select(_key("doc_id").alias("key"), "text"),
        items.select(_key("item_id").alias("item_id"), "text"), id_col="key")
        .select(F.col("key").alias("held_key")).distinct(), "decontaminate-found")
    return docs.join(found, _key("doc_id") == F.col("held_key"), "left_anti")


ORACLE_SQL = r"""
WITH toks AS (
  SELECT 'd' AS kind, doc_id AS id,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT 'i', item_id,
         list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')
  FROM benchmark WHERE text IS NOT NULL),
sh AS (
  SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
        FROM toks WHERE len(w) > 0)),
sizes AS (SELECT id, count(*) AS size FROM sh WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, z.size AS item_shingles, count(*) AS shared,
       count(*) / z.size AS containment
FROM sh d JOIN sh i ON d.s = i.s AND d.kind = 'd' AND i.kind = 'i' JOIN sizes z ON z.id = i.id
GROUP BY d.id, i.id, z.size HAVING count(*) / z.size >= 0.8
"""
