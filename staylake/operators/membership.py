"""Which files of a load can hold a key: bitmaps of hashed keys per file.

A file's keys are hashed into buckets; a bucket is one of Spark's 32,768-bit
bitmaps, in which every key sets four bits (a Bloom filter out of
``bitmap_construct_agg``).  About 2,048 keys share a bucket, so a key that a
file does not hold passes its bitmap about once in 400 times.  A batch of keys
then reads the files that hold some of them and hardly any others, whatever
order the target was written in.

``rows_maybe_in`` goes the other way: a small filter of a batch's keys decides which
rows of a target are shuffled to meet it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_KEYS = 2048
WORDS = 1 << 19                     # 64-bit words of a batch's filter: 4 MB of bits
WORD_KEYS = 16                      # a word of more keys lets too much pass
_BITS = 1 << 15                     # bits of one of Spark's bitmaps
_SLICES = (0, 15, 30, 45)           # four 15-bit slices of a 64-bit hash
_WORD_BITS = (40, 46, 52)           # three 6-bit slices: bits of a word


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(buckets)).cast("int")


def _positions(keys: Sequence[str]) -> list[Column]:
    h = F.xxhash64(*keys)
    return [F.shiftrightunsigned(h, s).bitwiseAND(F.lit(_BITS - 1)) for s in _SLICES]


def buckets_for(rows: int, files: int) -> int:
    """Buckets that leave about ``BUCKET_KEYS`` keys of a file to each."""
    return max(1, -(-rows // (max(1, files) * BUCKET_KEYS)))


def key_bitmaps(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(file, bucket, bits) of the files that ``rows`` are read from."""
    slices = [f"p{n}" for n in range(len(_SLICES))]
    hashed = rows.select(F.col("_metadata.file_name").alias("file"),
                         _bucket(keys, buckets).alias("bucket"),
                         *[p.alias(s) for p, s in zip(_positions(keys), slices)])
    # a bitmap per slice, then their union: a row is sorted once, not once a slice
    each = hashed.groupBy("file", "bucket").agg(*[F.bitmap_construct_agg(s).alias(s) for s in slices])
    return (each.select("file", "bucket", F.explode(F.array(*slices)).alias("bits"))
            .groupBy("file", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))


def _bit(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    shift = at.bitwiseAND(F.lit(7)).cast("int")
    return F.call_function("shiftright", byte.cast("int"), shift).bitwiseAND(F.lit(1)) == 1


def candidate_files(index: DataFrame, batch: DataFrame, keys: Sequence[str],
                    buckets: int) -> DataFrame:
    """(file) of every file that can hold a key of ``batch``, whose key columns
    have the types of the indexed ones."""
    asked = batch.select(_bucket(keys, buckets).alias("bucket"),
                         *[p.alias(f"p{n}") for n, p in enumerate(_positions(keys))]).distinct()
    hit = F.lit(True)
    for n in range(len(_SLICES)):
        hit = hit & _bit(F.col("bits"), F.col(f"p{n}"))
    return index.join(asked, "bucket").where(hit).select("file").distinct()


def _word(hashed: Column, words: int) -> tuple[Column, Column]:
    """The word of a hashed key and the bits that it sets there."""
    mask = F.lit(0).cast("long")
    for s in _WORD_BITS:
        at = F.shiftrightunsigned(hashed, s).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return hashed.bitwiseAND(F.lit(words - 1).cast("long")), mask


def rows_maybe_in(rows: DataFrame, hash_col: str, batch: DataFrame, batch_hash: str,
                  size: int) -> DataFrame:
    """The ``rows`` whose hashed key can be one of the ``size`` keys of ``batch``: those it
    holds and a few of a hundred others.  At most ``WORDS`` pairs of longs are broadcast;
    too large a batch leaves the rows as they are."""
    if size > WORDS * WORD_KEYS:
        return rows
    words = min(WORDS, 1 << max(0, size - 1).bit_length())
    word, mask = _word(F.col(batch_hash), words)
    asked = batch.select(word.alias("__word"), mask.alias("__mask")).groupBy("__word").agg(
        F.bit_or("__mask").alias("__bits"))
    word, mask = _word(F.col(hash_col), words)
    named = rows.select("*", word.alias("__word"), mask.alias("__mask"))
    return (named.join(F.broadcast(asked), "__word")
            .where(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"))
            .select(*rows.columns))
