"""SimHash near-duplicates through a byte-position index with count filtering.

A fingerprint of 64 bits has eight positional bytes.  Two that differ in at
most ``d`` bits differ in at most ``d`` bytes, so they share at least
``8 - d`` positional bytes.  A list per single byte would hold 1/256 of all
fingerprints, so the index lists are keyed by small sets of positions instead,
chosen so that every pair with the guaranteed number of shared bytes meets in
at least one list (for d <= 4: Turan's 20 triples, about N / 2^24 per list).
Where a pair meets, its shared positional bytes are tallied, pairs that reach
the guaranteed minimum are retained and their bit distance is verified.

Only distinct fingerprints are indexed.  A list gives the links of a spanning
forest of its members, not all pairs: a member that already hangs in a tree is
not compared again, so a dense group of copies costs little more than one
comparison per member.  A list longer than ``block_rows`` is cut into blocks,
and every pair of blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import ship, shuffle_partitions, stored
from staylake.llm.components import connected_components

SEED = 42
BITS = 64
SHINGLES_AT_ONCE = 1 << 16
BLOCK_ROWS = 4096


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle_words: int) -> int:
    """Unsigned SimHash of a text: see :func:`fingerprints`."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    width = min(shingle_words, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    begins = ends - lengths + 1
    begins, ends = begins[:n].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        hashes = np.array([digest(joined[b:e], SEED) for b, e in
                           zip(begins[at:at + SHINGLES_AT_ONCE], ends[at:at + SHINGLES_AT_ONCE])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fp): the SimHash of every whole text as a signed long.

    A-Z are lower-cased, words end at ASCII white space, shingles are hashed
    by XXH64 with seed 42, repeats included; fewer words than a shingle make
    one shingle; a null, empty or blank text has fingerprint 0.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)],
                             dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(run, f"id {kind}, fp long")


# ----------------------------------------------------------------------- index

def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions: any ``8 - max_bits`` positions hold one of them."""
    shared = 8 - max_bits
    if shared < 1:
        raise ValueError("max_bits must be 7 or less")
    if shared < 4:
        return list(combinations(range(8), shared))
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
    found = [g for g in groups if len(g) == 3]
    for n, group in enumerate(groups):
        found += [(*pair, other) for pair in combinations(group, 2)
                  for other in groups[(n + 1) % 3]]
    return found


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Positions linked by a spanning forest of all links between ``fps``."""
    links: list[tuple[int, int]] = []
    rest = np.arange(1, len(fps))
    open_, seed = [0], 0
    while rest.size:
        if not open_:
            open_, rest = [int(rest[0])], rest[1:]
            continue
        seed = open_.pop()
        differ = fps[rest] ^ fps[seed]
        tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        retained = np.flatnonzero(tally >= 8 - max_bits)
        linked = retained[np.bitwise_count(differ[retained]) <= max_bits]
        if linked.size:
            hits = rest[linked].tolist()
            links += [(seed, h) for h in hits]
            open_ += hits
            rest = np.delete(rest, linked)
    return links


LINK_SCHEMA = "a long, b long, list_key long, block int, fp long, rep long"
_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("list_key", pa.int64()),
                    ("block", pa.int32()), ("fp", pa.int64()), ("rep", pa.int64())])


def _runs(batches, keys: int):
    """(key, [columns]) in pieces of at most a batch, in sorted order."""
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns[:keys]:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield tuple(int(c[begin]) for c in columns[:keys]), [c[begin:end]
                                                                 for c in columns[keys:]]


def _groups(batches, keys: int):
    """Runs of one key as wholes, in pieces: (key, piece number, fps, reps)."""
    key, held, size = None, [], 0
    for found, columns in _runs(batches, keys):
        if found != key:
            if held:
                yield key, held
            key, held = found, []
        held.append(columns)
    if held:
        yield key, held


def _links_in(fps: np.ndarray, reps: np.ndarray, max_bits: int):
    return [(int(reps[i]), int(reps[j])) for i, j in forest(fps, max_bits)]


def similar_links(distinct: DataFrame, max_bits: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``max_bits``.

    ``distinct`` has one row per fingerprint: fp and rep, the id that stands
    for it.
    """
    spark = distinct.sparkSession
    parts = shuffle_partitions(spark)
    keys = []
    for n, positions in enumerate(position_sets(max_bits)):
        picked = F.lit(n).cast("long")
        for p in positions:
            picked = F.shiftleft(picked, 8).bitwiseOR(
                F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long")))
        keys.append(picked)
    listed = (distinct.select("fp", "rep", F.explode(F.array(*keys)).alias("list_key"))
              .select("list_key", "fp", "rep")
              .repartition(parts, "list_key").sortWithinPartitions("list_key", "fp"))

    def link_lists(batches):
        out: list[tuple] = []

        def flush():
            columns = list(zip(*out)) if out else [[]] * 6
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
            out.clear()
            return batch

        def close(key, held, block, fps, reps):
            """End of a list: links, or its last block if it was cut."""
            if block:
                out.extend((None, None, key, block, f, r) for f, r in zip(fps, reps))
            elif len(fps) > 1:
                out.extend((a, b, None, None, None, None)
                           for a, b in _links_in(np.array(fps, dtype=np.int64).view(np.uint64),
                                                 reps, max_bits))

        key, block, fps, reps = None, 0, [], []
        for (found,), (more_fps, more_reps) in _runs(batches, 1):
            if found != key:
                close(key, None, block, fps, reps)
                key, block, fps, reps = found, 0, [], []
            fps += more_fps.tolist()
            reps += more_reps.tolist()
            while len(fps) > block_rows:
                out.extend((None, None, key, block, f, r)
                           for f, r in zip(fps[:block_rows], reps[:block_rows]))
                fps, reps, block = fps[block_rows:], reps[block_rows:], block + 1
            if len(out) >= 100_000:
                yield flush()
        close(key, None, block, fps, reps)
        yield flush()

    found = stored(listed.mapInArrow(link_lists, LINK_SCHEMA), "simhash-links")
    links = found.where("a is not null").select("a", "b")
    members = found.where("a is null").select("list_key", "block", "fp", "rep")
    blocks = members.groupBy("list_key").agg(F.max("block").alias("last"))
    tasks = (members.join(blocks, "list_key")
             .select("list_key", "block", "fp", "rep",
                     F.explode(F.sequence(F.lit(0), "last")).alias("other"))
             .select("list_key", F.least("block", "other").alias("i"),
                     F.greatest("block", "other").alias("j"), "fp", "rep")
             .repartition(parts, "list_key", "i", "j")
             .sortWithinPartitions("list_key", "i", "j", "fp"))

    def link_blocks(batches):
        for _, pieces in _groups(batches, 3):
            fps = np.concatenate([p[0] for p in pieces]).view(np.uint64)
            reps = np.concatenate([p[1] for p in pieces])
            pairs = _links_in(fps, reps, max_bits)
            a, b = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             ["a", "b"])

    return links.union(tasks.mapInArrow(link_blocks, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle_words: int, max_bits: int,
                    id_col: str = "doc_id", text_col: str = "text",
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, fp, component): the smallest id reachable over links.

    One row for every input row, in any order.  Rows with a null id have a
    fingerprint but take no part in linking: their component is null.
    Repeated rows repeat in the result.  Empty texts share fingerprint 0 and
    are linked like any other.  Ids must be integers; other columns are
    ignored.
    """
    marked = stored(fingerprints(docs, shingle_words, id_col, text_col)
                    .select(F.col("id").cast("long").alias("id"), "fp"), "simhash-fingerprints")
    distinct = stored(marked.where("id is not null").groupBy("fp")
                      .agg(F.min("id").alias("rep")), "simhash-distinct")
    components = connected_components(similar_links(distinct, max_bits, block_rows))
    classes = stored(distinct.join(components.withColumnRenamed("node", "rep"), "rep", "left")
                     .select("fp", F.coalesce("component", "rep").alias("component")),
                     "simhash-classes")
    return (marked.join(classes, "fp", "left")
            .select(F.col("id").alias(id_col), "fp",
                    F.when(F.col("id").isNotNull(), F.col("component")).alias("component")))


def keep_first(docs: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """The rows of each component's smallest id; rows with a null id stay."""
    dropped = (near_duplicates(docs, shingle_words, max_bits)
               .where("component is not null and doc_id <> component")
               .select(F.col("doc_id").alias("dropped_id")).distinct())
    dropped = stored(dropped, "simhash-dropped")
    return docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")


def contract_columns(found: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 lowercase hex digits, component_id."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
