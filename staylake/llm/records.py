"""Token ids as length-delimited binary records with an offset index.

A data file is a run of frames, one per document, in ascending order of ids::

    uint64 length | uint32 masked crc of the length | body | uint32 masked crc of the body

All numbers are little-endian.  The body holds a byte that is 1 if the document
has an id, the width of its token ids, its id (int64), the number of token ids
before it in this file (uint64) and its token ids, 2 bytes each (uint16) if the
vocabulary has no more than 65,536 of them, else 4 (uint32).  Checksums are CRC-32, turned by 15
bits and offset by a constant, so a checksum stored inside a body does not check
itself.  Beside each data file lies an index: one frame whose body is the
offset of every frame of the data file and, as the last entry, the file's length.

A task writes its files under names of its own, so a repeated or rival attempt
never touches another's; the manifest, a Parquet table with one row per data
file, is committed by Spark and alone says which files count.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylake.llm.common import emit, ship

MASK_TURN = 15
MASK_DELTA = 0xA282EAD8
_LENGTH, _CRC, _HEAD = "<QI", "<I", "<BBqQ"
LENGTH_BYTES, CRC_BYTES, HEAD_BYTES = map(struct.calcsize, (_LENGTH, _CRC, _HEAD))
BLOCK_BYTES = 8 << 20  # a reading task opens a file for about this many bytes
TASK_BYTES = 4 * BLOCK_BYTES  # of data files for one reading task
OPEN_INDEXES = 64  # indexes that a reading task keeps
CACHED_WORDS = 300_000  # words whose ids a Python worker remembers
CACHED_LENGTH = 48
# letters up to U+00FF, then ASCII marks
LAST_MARKS = re.compile(rb"(?<=[a-z0-9])([.,;:!?]+)(?=[\t-\r ]|\Z)")
SPECIAL = b"<|"  # begins the special tokens, which are not folded
COMBINING = b"\xcc"  # begins U+0300 to U+033F: folding first could change what composes
PLAIN_WORD = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")
_MANIFEST = ("file_no long, data string, idx string, records long, ids long, bytes long")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> MASK_TURN) | (crc << (32 - MASK_TURN))) + MASK_DELTA) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    length = struct.pack("<Q", len(body))
    return b"".join((length, struct.pack(_CRC, masked_crc(length)), body, struct.pack(_CRC, masked_crc(body))))


def unframe(data: bytes, at: int = 0) -> bytes:
    """The body of the frame that starts at ``at``; a damaged one is an error."""
    if len(data) - at < LENGTH_BYTES:
        raise ValueError(f"the frame at {at} is cut short")
    length, crc = struct.unpack_from(_LENGTH, data, at)
    start = at + LENGTH_BYTES
    if masked_crc(data[at:at + 8]) != crc:
        raise ValueError(f"the frame at {at} has a wrong length")
    body = data[start:start + length]
    if len(body) < length or len(data) < start + length + CRC_BYTES:
        raise ValueError(f"the frame at {at} is cut short")
    if masked_crc(body) != struct.unpack_from(_CRC, data, start + length)[0]:
        raise ValueError(f"the frame at {at} has a damaged body")
    return body


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder and the folder's name there."""
    if "://" not in path:
        path = path.removeprefix("file:")
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


class WordEncoder:
    """Token ids of whole texts under a vocabulary whose tokens never hold ASCII
    white space: what the library gives for the words between, one after another.

    The vocabulary file lower-cases and cuts letters from marks, so a word of
    plain letters has the ids of its lower-case letters, which the library's model
    gives without another pass of its normaliser, and then those of the marks
    behind them.
    The ids of short words are remembered as bytes, ``width`` for each id, in two
    generations; the library encodes every other word.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.width = 2 if library.get_vocab_size() <= 1 << 16 else 4
        kind = "H" if self.width == 2 else "I"
        older: dict[bytes, bytes] = {}
        model = library.model
        as_characters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

        class Known(dict):
            def __missing__(self, word: bytes) -> bytes:
                ids = older.get(word)
                if ids is None:
                    ids = self.made(word)
                if len(word) <= CACHED_LENGTH:
                    if len(self) >= CACHED_WORDS:
                        older.clear()
                        older.update(self)
                        self.clear()
                    self[word] = ids
                return ids

            def made(self, word: bytes) -> bytes:
                cut = PLAIN_WORD.fullmatch(word)
                if cut:
                    letters, marks = cut.groups()
                    low = letters.decode("utf-8").lower()
                    if marks or letters != low.encode("utf-8"):
                        return self[low.encode("utf-8")] + (self[marks] if marks else b"")
                    characters = low if low.isascii() else as_characters(low)[0][0]
                    ids = [token.id for token in model.tokenize(characters)]
                else:
                    ids = library.encode(word.decode("utf-8"), add_special_tokens=False).ids
                return struct.pack(f"<{len(ids)}{kind}", *ids)

        self._ids_of = Known().__getitem__

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text, little-endian and ``width`` bytes each."""
        if SPECIAL not in text and COMBINING not in text:
            text = text.lower()  # ASCII only
        text = LAST_MARKS.sub(rb" \1", text)
        # bytes split at ASCII white space only
        return b"".join(map(self._ids_of, text.split()))


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker and vocabulary, kept over tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents in ranges of ascending ids; a hash of the text orders equal
    ids, so an id that many rows share spreads over ranges."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def write_records(docs: DataFrame, path: str, encoder: Callable[[], WordEncoder],
                  end_id: int | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> str:
    """Encode every whole text and write its ids below ``path``.

    ``encoder`` is called in the task and gives an object whose ``encode`` turns
    UTF-8 into little-endian ids of ``width`` bytes; ``end_id`` closes every document.  Null
    texts count as empty; documents without an id come first.  An empty table
    gives an empty manifest.  The folder has to be one that all executors share.
    """
    ship(docs.sparkSession)
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _place(path)
        number = TaskContext.get().partitionId()
        name = f"part-{number:07d}-{uuid.uuid4().hex[:12]}"
        words = encoder()
        encode, width = words.encode, words.width
        end = b"" if end_id is None else end_id.to_bytes(width, "little")
        data, offsets, before, at = None, [], 0, 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if data is None:
                    fs.create_dir(folder, recursive=True)
                    data = fs.open_output_stream(f"{folder}/{name}.rec",
                                                 buffer_size=1 << 20)
                ids = encode(text.as_py()) + end
                framed = frame(struct.pack(_HEAD, doc is not None, width, doc or 0, before) + ids)
                data.write(framed)
                offsets.append(at)
                before += len(ids) // width
                at += len(framed)
        if data is None:
            return
        data.close()
        with fs.open_output_stream(f"{folder}/{name}.idx") as index:
            index.write(frame(np.array([*offsets, at], dtype="<u8").tobytes()))
        yield pa.RecordBatch.from_pydict({
            "file_no": [number], "data": [f"{name}.rec"], "idx": [f"{name}.idx"],
            "records": [len(offsets)], "ids": [before], "bytes": [at]})

    (_ordered(docs, id_col, text_col).select("id", F.col("text").cast("binary"))
     .mapInArrow(write, _MANIFEST).write.parquet(f"{path}/manifest"))
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every data file with the number of token ids in the files before it."""
    files = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    # one row per file: no more than tasks wrote
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("ids_before", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


def read_records(spark: SparkSession, path: str, order: Column | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record of ``path``.

    ``start`` counts the ids of all documents before it; ``ids`` is binary,
    uint32 little-endian.  Files are read in blocks of about ``BLOCK_BYTES``,
    dealt over tasks; a block finds its records through the file's index.  With
    ``order`` (say ``F.xxhash64("file_no", "at", F.lit(seed))``) every record is
    a row of its own before reading, sorted by it inside each task: a shuffled
    read.  A damaged frame ends the read with an error.
    """
    ship(spark)
    files = read_manifest(spark, path)
    if order is None:
        pieces = F.least(F.ceil(F.col("bytes") / BLOCK_BYTES), F.col("records"))
        blocks = files.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                pieces - 1)))
        first = F.floor(F.col("piece") * F.col("records") / pieces)
        until = F.floor((F.col("piece") + 1) * F.col("records") / pieces)
        blocks = blocks.select("data", "idx", "ids_before", first.alias("at"),
                               until.alias("until"))
        # rows are few and small, their work is not: a fixed count is not coalesced
        size = files.agg(F.sum("bytes")).first()[0] or 0
        blocks = blocks.repartition(max(1, -(-size // TASK_BYTES)), F.col("data"), F.col("at"))
    else:
        blocks = files.withColumn("at", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("records") - 1)))
        blocks = blocks.withColumn("__order", order)
        blocks = (blocks.repartitionByRange("__order").sortWithinPartitions("__order")
                  .select("data", "idx", "ids_before", "at", (F.col("at") + 1).alias("until")))
    return blocks.mapInArrow(_reader(path),
                             "doc_id long, start long, n_tokens long, ids binary")


def _reader(path: str):
    def read(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()),
                            ("n_tokens", pa.int64()), ("ids", pa.binary())])
        fs, folder = _place(path)
        known: dict[str, np.ndarray] = {}

        def offsets(name):
            if name not in known:
                if len(known) >= OPEN_INDEXES:
                    known.clear()
                with fs.open_input_file(f"{folder}/{name}") as index:
                    known[name] = np.frombuffer(unframe(index.read()), dtype="<u8")
            return known[name]

        def frames(row):
            """The bodies of a block, read in runs of about BLOCK_BYTES."""
            places = offsets(row["idx"])[row["at"]:row["until"] + 1].astype(np.int64)
            with fs.open_input_file(f"{folder}/{row['data']}") as data:
                first = 0
                while first < len(places) - 1:
                    past = int(np.searchsorted(places, places[first] + BLOCK_BYTES, "right")) - 1
                    past = max(past, first + 1)
                    start = int(places[first])
                    run = data.read_at(int(places[past]) - start, start)
                    for place in places[first:past].tolist():
                        yield unframe(run, place - start)
                    first = past

        def records():
            for batch in batches:
                for row in batch.to_pylist():
                    for body in frames(row):
                        has_id, width, doc, before = struct.unpack_from(_HEAD, body)
                        ids = np.frombuffer(body, f"<u{width}", offset=HEAD_BYTES)
                        ids = ids.astype("<u4").tobytes()
                        yield len(ids), (doc if has_id else None, row["ids_before"] + before,
                                         len(ids) // 4, ids)

        return emit(records(), schema)

    return read


def digests(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of records read back."""
    return records.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
