"""Token counts of huge documents by overlap resynchronisation.

A text above ``chunk_chars`` is cut into overlapping chunks that tasks
encode apart, with offsets.  Two neighbours are spliced at a token boundary
inside their overlap that both encodings share and that is proven stable: no
vocabulary piece holds the characters on its two sides next to each other,
so no merge can ever cross it and what lies before cannot change what
follows.  Where an overlap holds no such boundary it is widened, at last to
the end of the text.

The vocabulary file is a parameter (a sentencepiece BPE model without
normalisation); nothing of it is stored here.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import emit, ship, shuffle_partitions

SPACE = "▁"  # how the model writes a space
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256


class PieceCounter:
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.joined = set()
        self.chars = np.zeros(size, dtype=np.int64)
        self.inside = np.zeros(size, dtype=np.int64)  # 1: a later byte of a character
        for i in range(size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):  # <0x..>
                self.inside[i] = 0x80 <= int(piece[3:5], 16) < 0xC0
                self.chars[i] = 1 - self.inside[i]
            elif not (self.model.is_control(i) or self.model.is_unknown(i)):
                self.chars[i] = len(piece)
                self.joined.update(zip(piece, piece[1:]))

    def count(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def stable(self, text: str, at: int) -> bool:
        """No piece holds the characters before and after ``at`` together."""
        left, right = text[at - 1].replace(" ", SPACE), text[at].replace(" ", SPACE)
        return (left, right) not in self.joined

    def first_stable(self, text: str, begin: int, end: int) -> int | None:
        """First stable boundary with both its characters in [begin, end)."""
        return next((at for at in range(begin + 1, end) if self.stable(text, at)), None)

    def chunks(self, text: str, step: int, overlap: int) -> Iterator[tuple[int, int, int, bool]]:
        """(begin, end, where the overlap with the next chunk begins, last).

        Where an overlap holds no stable boundary, one scan finds the next: the
        chunk is widened to it and the following chunk begins there, so that
        nothing but overlaps is encoded twice.
        """
        begin, size = 0, len(text)
        while True:
            following = begin + step
            end = following + overlap
            at = self.first_stable(text, following, size) if end < size else None
            if at is None:
                yield begin, size, size, True
                return
            if at >= end:
                following, end = at - 1, at + 1
            yield begin, end, following, False
            begin = following

    def token_starts(self, text: str) -> np.ndarray:
        """Offset in ``text`` of every token's first character.

        The model puts a space before the text; it counts at offset 0.
        """
        ids = np.array(self.model.encode(text, num_threads=1), dtype=np.int64)
        sizes = self.chars[ids]
        return np.maximum(np.cumsum(sizes) - sizes - self.inside[ids] - 1, 0)

    def spliced(self, chunk: str, head: int, tail: int) -> int:
        """Tokens between the splice in the head overlap and that in the tail.

        ``head`` is the width of the overlap with the chunk before (0: the
        text begins here), ``tail`` that with the chunk after.
        """
        size = len(chunk)
        low = self.first_stable(chunk, 0, head) if head else 0
        high = self.first_stable(chunk, size - tail, size) if tail else size
        starts = self.token_starts(chunk)
        for at in (low, high):
            if 0 < at < size and not (starts == at).any():
                raise ValueError("a token crosses a boundary that no piece can cross")
        return int(((starts >= low) & (starts < high)).sum())


@lru_cache(maxsize=4)
def load(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id",
                 text_col: str = "text", chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(id, n_bytes, n_tokens), one row for every input row.

    Null and empty texts count 0 bytes and 0 tokens.  Null ids and repeated
    rows keep their rows; other columns are ignored.  Texts up to
    ``chunk_chars`` are encoded where they are read; only the chunks of
    longer ones are shuffled, so that one huge text spreads over tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    short = texts.where(F.length("text") <= chunk_chars)
    long = texts.where(F.length("text") > chunk_chars)

    def count_short(batches):
        model = load(model_file)
        for batch in batches:
            sizes = [model.count(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())],
                ["id", "n_bytes", "n_tokens"])

    counted = (short.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
               .mapInArrow(count_short, f"id {kind}, n_bytes long, n_tokens long"))

    def cut(batches):
        model = load(model_file)

        def rows(batch):
            for row in zip(*(batch.column(i) for i in range(4))):
                key, n_bytes, fingerprint, text = (x.as_py() for x in row)
                head = 0
                for n, (begin, end, following, last) in enumerate(
                        model.chunks(text, chunk_chars, overlap_chars)):
                    tail = 0 if last else end - following
                    yield 4 * (end - begin), (key, n_bytes, fingerprint, n, head, tail,
                                              text[begin:end])
                    head = tail

        for batch in batches:
            schema = pa.schema([
                ("id", batch.schema.field(0).type), ("n_bytes", pa.int64()),
                ("fingerprint", pa.int64()), ("chunk", pa.int32()), ("head", pa.int32()),
                ("tail", pa.int32()), ("text", pa.string())])
            yield from emit(rows(batch), schema)

    def count_chunk(batches):
        model = load(model_file)
        for batch in batches:
            sizes = [model.spliced(text.as_py(), head.as_py(), tail.as_py()) for text, head, tail
                     in zip(batch.column("text"), batch.column("head"), batch.column("tail"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(sizes, pa.int64())],
                ["id", "n_bytes", "fingerprint", "chunk", "n_tokens"])

    chunks = (long.select("id", F.octet_length("text").cast("long").alias("n_bytes"),
                          F.xxhash64("text").alias("fingerprint"), "text")
              .mapInArrow(cut, f"id {kind}, n_bytes long, fingerprint long, chunk int, head int, "
                               "tail int, text string")
              .repartition(shuffle_partitions(spark), "id", "fingerprint", "chunk")
              .mapInArrow(count_chunk, f"id {kind}, n_bytes long, fingerprint long, chunk int, "
                                       "n_tokens long"))
    # Repeated rows meet in one group: each has its chunk 0, so that counts them.
    joined = chunks.groupBy("id", "n_bytes", "fingerprint").agg(
        F.sum("n_tokens").alias("total"),
        F.sum((F.col("chunk") == 0).cast("long")).alias("copies"))
    spliced = joined.select(
        "id", "n_bytes", F.expr("total div copies").alias("n_tokens"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")
    return counted.unionByName(spliced).withColumnRenamed("id", id_col)
