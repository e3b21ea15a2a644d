"""Ranked lexical search by pipelined term partitioning.

Documents are cut into blocks of bounded size; a block's inverted lists over the
items' terms stay together.  The terms are dealt to owners, the rarest to the
first and the commonest to the last, each owner with about the same number of
postings.  The bundle of an item in a block carries sparse accumulators, one
integer per document that can still be among the item's best.  It passes the
owners one after another: a cogroup by block brings it to the owner's lists,
which add their contributions.

After every stage the best partial scores over all blocks give each item a
score that its last place needs at least, and the owners ahead give the most a
document can still gain.  Accumulators that cannot reach the one with the other
go, and documents not met so far are not taken up once all owners ahead cannot
bring one there.  Both are exact: contributions are never negative, and equal
scores stay.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylake.llm.common import emit, ship, stored

OWNERS = 5
BLOCK_DOCS = 2048
BLOCK_TEXT = 16 << 20  # bytes of text that close a block early
ITEM_PAIRS = 100_000  # (item, term) pairs that one pipeline serves, about
ITEMS = 4096  # items that one pipeline serves, about

# --- fixed values of the scoring rule ---
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
LOW, HIGH = 10, 90  # a document's m is 10 plus 90 times its length over the mean
SCALE = 1_000_000_000
WEIGHT_SCALE = 1000
LENGTH_FACTOR = 8
# --- end of fixed values ---

# A-Z to a-z, separators to blanks; bytes above 0x7F are parts of letters.
_TABLE = bytes(0x20 if b in SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b
               for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, repeats included."""
    return text.translate(_TABLE).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, term) pairs; rows without an id or a text have none."""

    def split(batches):
        def pairs():
            for batch in batches:
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for term in set(terms(text.as_py())):
                        yield len(term), (item, term)

        return emit(pairs(), pa.schema([("item", pa.int64()), ("term", pa.binary())]))

    return (items.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
            .mapInArrow(split, "item long, term binary").distinct())


def _inverted(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict) -> DataFrame:
    """One row per block: its documents' ids and lengths, and for every term
    of ``vocabulary`` that it holds the slots and counts, all as packed arrays."""

    def build(batches):
        held: list[tuple] = []
        size = number = 0
        part = TaskContext.get().partitionId()

        def close():
            by_term: dict[int, list] = {}
            for slot, (_, _, found) in enumerate(held):
                for term, tf in found.items():
                    by_term.setdefault(term, []).append((slot, tf))
            order = sorted(by_term)
            flat = np.array([p for t in order for p in by_term[t]], dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 33) | number], pa.int64()),
                "docs": pa.array([[d for d, _, _ in held]], pa.list_(pa.int64())),
                "lengths": [np.array([n for _, n, _ in held], "<i8").tobytes()],
                "terms": pa.array([order], pa.list_(pa.int32())),
                "counts": pa.array([[len(by_term[t]) for t in order]], pa.list_(pa.int32())),
                "slots": [flat[:, 0].astype("<i4").tobytes()],
                "tfs": [flat[:, 1].astype("<i8").tobytes()]})

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py()
                words = terms(raw)
                if not words:
                    continue
                found = Counter(map(vocabulary.get, words))
                found.pop(None, None)
                held.append((doc, len(words), found))
                size += len(raw)
                if len(held) >= BLOCK_DOCS or size >= BLOCK_TEXT:
                    yield close()
                    held, size, number = [], 0, number + 1
        if held:
            yield close()

    return docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(
        build, "block long, docs array<long>, lengths binary, terms array<int>, "
               "counts array<int>, slots binary, tfs binary")


def _weights(n_docs: int, df: dict[int, int], n_terms: int) -> np.ndarray:
    """w of every term; 0 where no document holds it."""
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                     if t in df else 0 for t in range(n_terms)], dtype=np.int64)


def _owners(df: dict[int, int], n_terms: int) -> np.ndarray:
    """Owner of every term: rarest first, postings dealt evenly."""
    owner = np.zeros(n_terms, dtype=np.int32)
    total, seen = sum(df.values()), 0
    for term in sorted(df, key=lambda t: (df[t], t)):
        owner[term] = min(OWNERS - 1, seen * OWNERS // total)
        seen += df[term]
    return owner


def _postings(blocks: DataFrame, owner: np.ndarray, n_docs: int, length: int) -> DataFrame:
    """(owner, block, n, terms, counts, slots, gains, best): a block's lists of
    one owner; a gain is a posting's contribution without the term's weight."""

    def deal(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held = np.array(row["terms"], dtype=np.int64)
                counts = np.array(row["counts"], dtype=np.int64)
                lengths = np.frombuffer(row["lengths"], "<i8").tolist()
                m = [LOW + HIGH * n * n_docs // length for n in lengths]
                slots = np.frombuffer(row["slots"], "<i4")
                tfs = np.frombuffer(row["tfs"], "<i8")
                m_of = np.array(m, dtype=np.int64)[slots]
                gains = (SCALE * tfs) // (WEIGHT_SCALE * tfs + LENGTH_FACTOR * m_of)
                starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
                best = np.maximum.reduceat(gains, starts) if len(held) else gains
                by = owner[held]
                each = np.repeat(by, counts)
                for o in np.unique(by).tolist():
                    yield pa.RecordBatch.from_pydict({
                        "owner": pa.array([o], pa.int32()),
                        "block": pa.array([row["block"]], pa.int64()),
                        "n": pa.array([len(m)], pa.int32()),
                        "terms": pa.array([held[by == o]], pa.list_(pa.int32())),
                        "counts": pa.array([counts[by == o]], pa.list_(pa.int32())),
                        "slots": [slots[each == o].tobytes()],
                        "gains": [gains[each == o].astype("<i4").tobytes()],
                        "best": pa.array([best[by == o]], pa.list_(pa.int32()))})

    return blocks.select("block", "lengths", "terms", "counts", "slots", "tfs").mapInArrow(
        deal, "owner int, block long, n int, terms array<int>, counts array<int>, "
              "slots binary, gains binary, best array<int>")


_BUNDLE = "block long, item int, slots binary, scores binary, best array<long>"


def _stage(holders: dict[int, np.ndarray], weights: np.ndarray, floor: np.ndarray,
           ahead: np.ndarray, before: np.ndarray, k: int):
    """One owner's work on a block: contributions added to the items' bundles."""
    n_items = len(floor)

    def add(bundles: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        arrived = {i: (np.frombuffer(s, "<i4"), np.frombuffer(v, "<i8")) for i, s, v in
                   zip(bundles["item"], bundles["slots"], bundles["scores"])}
        n = max([int(lists["n"].iloc[0]) if len(lists) else 0,
                 *(int(s[-1]) + 1 for s, _ in arrived.values() if len(s))], default=0)
        score = np.zeros((n_items, n), dtype=np.int64)
        known = np.zeros((n_items, n), dtype=bool)
        for item, (slots, scores) in arrived.items():
            score[item, slots] = scores
            known[item, slots] = True
        if len(lists):
            slots = np.frombuffer(lists["slots"].iloc[0], "<i4")
            gains = np.frombuffer(lists["gains"].iloc[0], "<i4").astype(np.int64)
            at = 0
            for term, count in zip(lists["terms"].iloc[0].tolist(),
                                   lists["counts"].iloc[0].tolist()):
                score[holders[term][:, None], slots[None, at:at + count]] += (
                    weights[term] * gains[at:at + count])
                at += count
        # a new document is taken up only where the owners from here on could
        # bring it among the best
        live = (known | (before >= floor)[:, None]) & (score > 0)
        live &= score + ahead[:, None] >= floor[:, None]
        out = {"block": [], "item": [], "slots": [], "scores": [], "best": []}
        block = int((lists if len(lists) else bundles)["block"].iloc[0])
        for item in np.flatnonzero(live.any(1)).tolist():
            at = np.flatnonzero(live[item])
            values = score[item, at]
            out["block"].append(block)
            out["item"].append(item)
            out["slots"].append(at.astype("<i4").tobytes())
            out["scores"].append(values.astype("<i8").tobytes())
            out["best"].append(np.sort(values)[::-1][:k].tolist())
        return pd.DataFrame({c: pd.Series(v, dtype="object" if c in ("slots", "scores", "best")
                                          else "int64") for c, v in out.items()})

    return add


def _needed(bundles: DataFrame, n_items: int, k: int) -> np.ndarray:
    """Per item the k-th best partial score over all blocks, 0 if there are fewer."""
    ranked = Window.partitionBy("item").orderBy(F.desc("score"))
    best = (bundles.select("item", F.explode("best").alias("score"))
            .withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k))
    floor = np.zeros(n_items, dtype=np.int64)
    for r in best.where(F.col("place") == k).select("item", "score").collect():
        floor[r["item"]] = r["score"]
    return floor


def _first_places(bundles: DataFrame, blocks: DataFrame, names: np.ndarray, k: int) -> DataFrame:
    """(item_id, doc_id, score): every bundle's k best by score and document id."""

    def select(batches):
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    slots = np.frombuffer(row["slots"], "<i4")
                    scores = np.frombuffer(row["scores"], "<i8")
                    docs = [row["docs"][s] for s in slots.tolist()]
                    order = sorted(range(len(docs)), key=lambda j: (
                        -scores[j], docs[j] is None, docs[j] or 0))
                    for j in order[:k]:
                        yield 24, (int(names[row["item"]]), docs[j], int(scores[j]))

        return emit(rows(), pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()),
                                       ("score", pa.int64())]))

    return (bundles.select("block", "item", "slots", "scores")
            .join(blocks.select("block", "docs"), "block")
            .select("item", "slots", "scores", "docs")
            .mapInArrow(select, "item_id long, doc_id long, score long"))


def _pipeline(spark: SparkSession, docs: DataFrame, pairs: list, id_col: str, text_col: str,
              k: int) -> DataFrame | None:
    """Every owner in turn for the items of ``pairs``; None without any match."""
    vocabulary = {t: n for n, t in enumerate(sorted({bytes(r["term"]) for r in pairs}))}
    names = np.array(sorted({r["item"] for r in pairs}), dtype=np.int64)
    number = {name: n for n, name in enumerate(names.tolist())}
    holding: dict[int, list[int]] = {}
    for r in pairs:
        holding.setdefault(vocabulary[bytes(r["term"])], []).append(number[r["item"]])
    holders = {t: np.array(sorted(i)) for t, i in holding.items()}

    blocks = stored(_inverted(docs, id_col, text_col, vocabulary), "lexical-blocks")
    totals = blocks.agg(
        F.sum(F.size("docs")).alias("docs"),
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)).alias("postings"),
    ).first()
    if not totals["postings"]:
        return None
    length = (blocks.select("lengths").mapInArrow(_total_length, "total long")
              .agg(F.sum(F.col("total").cast("decimal(38,0)"))).first()[0])
    n_docs, length = int(totals["docs"]), int(length)
    # at most one row per term of the vocabulary
    df = {r["t"]: r["df"] for r in blocks.select(F.explode(F.arrays_zip("terms", "counts")))
          .groupBy(F.col("col.terms").alias("t")).agg(F.sum("col.counts").alias("df")).collect()}
    weights = _weights(n_docs, df, len(vocabulary))
    owner = _owners(df, len(vocabulary))
    lists = stored(_postings(blocks, owner, n_docs, length), "lexical-postings",
                   partition_by=["owner"])
    most = {r["t"]: r["m"] for r in lists.select(F.explode(F.arrays_zip("terms", "best")))
            .groupBy(F.col("col.terms").alias("t")).agg(F.max("col.best").alias("m")).collect()}
    # the most an owner can add to any document's score for an item
    reach = np.zeros((OWNERS + 1, len(names)), dtype=np.int64)
    for term, items in holders.items():
        if term in most:
            reach[owner[term], items] += weights[term] * most[term]
    ahead = np.cumsum(reach[::-1], axis=0)[::-1]

    floor = np.zeros(len(names), dtype=np.int64)
    bundles = spark.createDataFrame([], _BUNDLE)
    for stage in range(OWNERS):
        mine = lists.where(F.col("owner") == stage).drop("owner", "best")
        add = _stage(holders, weights, floor, ahead[stage + 1], ahead[stage], k)
        bundles = stored(bundles.drop("best").groupBy("block").cogroup(mine.groupBy("block"))
                         .applyInPandas(add, _BUNDLE), "lexical-bundles")
        floor = np.maximum(floor, _needed(bundles, len(names), k))
    return _first_places(bundles, blocks, names, k)


def _total_length(batches):
    for batch in batches:
        for lengths in batch.column(0):
            yield pa.RecordBatch.from_pydict(
                {"total": [int(np.frombuffer(lengths.as_py(), "<i8").sum())]})


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item.

    Every row of ``docs`` is a document; rows with one id are ranked apart and a
    null id comes after others of its score.  Rows of ``items`` with one id are
    one item of all their terms; those without an id, a text or a term in any
    document give no row, as do empty tables.  Items are served in groups of
    about ``ITEMS`` items and ``ITEM_PAIRS`` distinct (item, term) pairs, which
    bounds the terms, weights and thresholds on the driver and the accumulators
    of a task; each group reads all documents.
    """
    spark = docs.sparkSession
    ship(spark)
    pairs = stored(item_terms(items, item_col, item_text_col), "lexical-items")
    size = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item").alias("items")).first()
    groups = max(1, -(-size["n"] // ITEM_PAIRS), -(-size["items"] // ITEMS))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for group in range(groups):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == group).collect()
        best = _pipeline(spark, docs, mine, doc_col, text_col, k) if mine else None
        if best is not None:
            found = found.unionByName(best)
    by_item = Window.partitionBy("item_id").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL),
l AS (SELECT r, doc_id, words, len(words) AS n FROM d WHERE len(words) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM l),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM l) GROUP BY r, term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1)))
                    AS BIGINT) AS w
  FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term),
x AS (
  SELECT item_id, p.r, CAST(sum(w * ((1000000000 * tf)
           // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN l ON l.r = p.r, s
  GROUP BY item_id, p.r),
y AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM x JOIN l USING (r) WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM y WHERE place <= 10
"""
