"""Line de-duplication through sharded minimal perfect hashes.

Distinct line hashes that occur in at least two documents are dealt into
shards of bounded size.  Each shard is a minimal perfect hash (levels of bit
arrays; a key's slot is the rank of the one bit it owns) over a compact
fingerprint array, a count array and an array with the smallest document of
each line.  Occurrences are dealt to the shard of their hash and probe its
arrays there; lines themselves are never joined or moved.  A shard that holds
a frequent line is probed in several places, with a share of the occurrences
each.

A line hash has 128 bits: 64 choose shard and slot, 64 are the fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import emit, ship, shuffle_partitions, stored

MIN_CHARS = 10
WHITE = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 1 << 16
PROBE_ROWS = 200_000
LEVEL_ROOM = 2.0  # bits per key still without a slot


def line_key(line: bytes) -> bytes:
    """White space off both ends, A-Z lower-cased (UTF-8 bytes)."""
    return line.strip(WHITE).lower()


def _counts(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (
        len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixer; one hash function per seed."""
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


class MinimalPerfectHash:
    """Distinct 64-bit keys to 0..n-1.

    On each level the keys left hash into a bit array; a key alone on its bit
    owns it, the others go on to the next level.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = []
        base = 0
        for bits in levels:
            self.ranks.append(base + np.cumsum(bits) - bits)
            base += int(bits.sum())
        self.size = base

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        levels = []
        while keys.size:
            size = int(LEVEL_ROOM * keys.size) + 1
            at = (_mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.int64))
            keys = keys[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for one that owns no bit (never a member)."""
        found = np.full(keys.size, -1, dtype=np.int64)
        left = np.arange(keys.size)
        for n, bits in enumerate(self.levels):
            at = (_mix(keys[left], n) % np.uint64(bits.size)).astype(np.int64)
            owned = bits[at] == 1
            found[left[owned]] = self.ranks[n][at[owned]]
            left = left[~owned]
        return found

    def to_bytes(self) -> tuple[list[int], bytes]:
        return ([b.size for b in self.levels],
                b"".join(np.packbits(b.astype(np.uint8)).tobytes() for b in self.levels))

    @classmethod
    def from_bytes(cls, sizes, packed: bytes) -> MinimalPerfectHash:
        levels, at = [], 0
        for size in sizes:
            n = (int(size) + 7) // 8
            part = np.frombuffer(packed, dtype=np.uint8, count=n, offset=at)
            levels.append(np.unpackbits(part)[:int(size)].astype(np.int64))
            at += n
        return cls(levels)


def _line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, text_hash, line, h1, h2) of every line long enough to count."""
    schema = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("line", pa.int32()),
                        ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches):
        for batch in batches:
            doc, text_hash, line, high, low = [], [], [], [], []
            for key, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       batch.column(2)):
                for n, part in enumerate(text.as_py().encode().split(b"\n")):
                    found = line_key(part)
                    if _counts(found, min_chars):
                        digest = xxhash.xxh3_128_intdigest(found)
                        doc.append(key)
                        text_hash.append(mark)
                        line.append(n)
                        high.append(digest >> 64)
                        low.append(digest & (2**64 - 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(text_hash, pa.int64()),
                 pa.array(line, pa.int32()),
                 pa.array(np.array(high, dtype=np.uint64).view(np.int64)),
                 pa.array(np.array(low, dtype=np.uint64).view(np.int64))], schema=schema)

    return (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("doc"),
                    F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
                    F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc long, text_hash long, line int, h1 long, h2 long"))


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    keys = rows["h1"].to_numpy(np.int64).view(np.uint64)
    # Two lines may share the 64 bits that choose a slot: one slot, a run of
    # entries behind it.
    distinct, entries = np.unique(keys, return_counts=True)
    mph = MinimalPerfectHash.build(distinct)
    slot = mph.slots(keys)
    order = np.argsort(slot, kind="stable")
    per_slot = np.zeros(mph.size, dtype=np.int32)
    per_slot[mph.slots(distinct)] = entries
    sizes, packed = mph.to_bytes()
    return pd.DataFrame({
        "shard": [rows["shard"].iloc[0]], "sizes": [sizes], "bits": [packed],
        "entries": [per_slot.tobytes()],
        "fingerprints": [rows["h2"].to_numpy(np.int64)[order].tobytes()],
        "counts": [rows["n"].to_numpy(np.int64)[order].tobytes()],
        "firsts": [rows["first"].to_numpy(np.int64)[order].tobytes()]})


def _probe(lines: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
    empty = pd.DataFrame({"doc": np.zeros(0, np.int64), "text_hash": np.zeros(0, np.int64),
                          "line": np.zeros(0, np.int32)})
    if not len(lines) or not len(shards):
        return empty
    shard = shards.iloc[0]
    mph = MinimalPerfectHash.from_bytes(shard["sizes"], shard["bits"])
    entries = np.frombuffer(shard["entries"], dtype=np.int32)
    begins = np.cumsum(entries) - entries
    prints = np.frombuffer(shard["fingerprints"], dtype=np.int64)
    firsts = np.frombuffer(shard["firsts"], dtype=np.int64)
    slot = mph.slots(lines["h1"].to_numpy(np.int64).view(np.uint64))
    mark = lines["h2"].to_numpy(np.int64)
    doc = lines["doc"].to_numpy(np.int64)
    drop = np.zeros(len(lines), dtype=bool)
    member = np.flatnonzero(slot >= 0)
    for step in range(int(entries.max())):
        member = member[entries[slot[member]] > step]
        at = begins[slot[member]] + step
        drop[member] |= (prints[at] == mark[member]) & (doc[member] > firsts[at])
    return lines.loc[drop, ["doc", "text_hash", "line"]]


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, text_hash, lines): the line numbers each text loses, from 0."""
    spark = docs.sparkSession
    ship(spark)
    parts = shuffle_partitions(spark)
    lines = stored(_line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    repeated = stored(
        lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"),
                                      F.count(F.lit(1)).alias("n"))
        .where("first < last").select("h1", "h2", "first", "n"), "line-repeated")
    n_shards = max(4 * parts, -(-repeated.count() // SHARD_KEYS))
    shard = F.pmod(F.xxhash64("h1"), F.lit(n_shards)).alias("shard")
    arrays = stored(
        repeated.select(shard, "h1", "h2", "first", "n").groupBy("shard").applyInPandas(
            _build_shard, "shard long, sizes array<long>, bits binary, entries binary, "
                          "fingerprints binary, counts binary, firsts binary"), "line-shards")
    # A shard is probed in as many places as its occurrences need.
    dealt = lines.select(shard, "doc", "text_hash", "line", "h1", "h2")
    per_shard = stored(dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")), "line-loads")
    total = per_shard.agg(F.sum("rows")).first()[0] or 0
    share = min(PROBE_ROWS, max(500, 2 * total // n_shards))
    places = per_shard.select("shard", F.ceil(F.col("rows") / share).cast("int").alias("places"))
    spread = (dealt.join(places, "shard")
              .withColumn("place", F.pmod(F.xxhash64("doc", "text_hash", "line"),
                                          F.col("places")).cast("int")).drop("places"))
    copies = (arrays.join(places, "shard")
              .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("places") - 1)))
              .drop("places"))
    dropped = spread.groupBy("shard", "place").cogroup(copies.groupBy("shard", "place")
                                                       ).applyInPandas(
        _probe, "doc long, text_hash long, line int")
    return stored(dropped.groupBy("doc", "text_hash")
                  .agg(F.collect_set("line").alias("lines")), "line-dropped")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row with its kept text and the columns n_lines and n_dropped.

    A line whose key (see :func:`line_key`) has ``min_chars`` code points and
    is found in two or more documents stays only in the document with the
    smallest id.  Null and empty texts are one empty line; their kept text is
    empty.  Rows with a null id are no document to compare with: they neither
    count nor lose lines.  Repeated rows of one id are one document.  Other
    columns pass through; an existing n_lines or n_dropped is replaced.
    """
    spark = docs.sparkSession
    lost = repeated_lines(docs, id_col, text_col, min_chars).select(
        F.col("doc").alias("_lost_doc"), F.col("text_hash").alias("_lost_hash"),
        F.col("lines").alias("_lost_lines"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.drop("n_lines", "n_dropped").join(
        lost, (docs[id_col].cast("long") == lost["_lost_doc"])
        & (F.xxhash64(docs[text_col].cast("string")) == lost["_lost_hash"]), "left"
    ).withColumn(text_col, text).drop("_lost_doc", "_lost_hash")
    kept = joined.drop("_lost_lines").schema
    at = [f.name for f in kept].index(text_col)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, losses = [], [], []
            for text, lines in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                parts = text.as_py().split("\n")
                drop = set(lines.as_py() or ())
                texts.append("\n".join(p for n, p in enumerate(parts) if n not in drop)
                             if drop else text.as_py())
                totals.append(len(parts))
                losses.append(len(drop))
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(losses, pa.int64())],
                [*batch.schema.names[:-1], "n_lines", "n_dropped"])

    ship(spark)
    return joined.mapInArrow(run, f"{ddl}, n_lines long, n_dropped long")


def contract_columns(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)),
repeated AS (
  SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT l.doc_id, l.i, l.line, r.k IS NOT NULL AND l.doc_id > r.first AS lost
  FROM lines l LEFT JOIN repeated r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
