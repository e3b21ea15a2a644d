"""Binary token records: written files against the library, damage, shuffled reads."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staylake.llm import records
from staylake.session import run_dir
from tests.llm.helpers import HAVE_TABLES, SF, documents, rows

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)


def _encoder():
    return records.word_encoder(VOCABULARY)


def _written(spark, docs):
    return records.write_records(docs, run_dir(spark, "records"), _encoder, 2)


def _ids(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
    return np.array(ids, dtype="<u4").tobytes()


def _wide(encoder, text):
    """An encoder's ids of a text and the end id, 4 bytes each."""
    ids = np.frombuffer(encoder.encode(text.encode()), f"<u{encoder.width}")
    return ids.astype("<u4").tobytes() + b"\2\0\0\0"


def _check(spark, docs):
    path = _written(spark, docs)
    got = sorted(records.digests(records.read_records(spark, path)).collect(),
                 key=lambda r: r["start"])
    texts = [(r["doc_id"], _ids(r["text"])) for r in docs.select("doc_id", "text").collect()]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == \
        sorted(((i, len(b) // 4, zlib.crc32(b)) for i, b in texts), key=repr)
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    return path


def test_odd_texts(spark):
    _check(spark, documents(spark))


def test_empty_table(spark):
    path = _written(spark, documents(spark, []))
    assert records.read_records(spark, path).collect() == []


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
def test_given_documents(spark):
    _check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_one_id_on_many_rows_spreads_over_files(spark):
    docs = documents(spark, [(7, f"text {n} of one id") for n in range(300)]
                     + [(n, "other") for n in range(100)]).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = _check(spark, docs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{path}/*.rec")) > 4


def test_blocks_of_any_size_read_the_same(spark, monkeypatch):
    path = _written(spark, documents(spark))
    whole = rows(records.read_records(spark, path))
    monkeypatch.setattr(records, "BLOCK_BYTES", 100)
    assert rows(records.read_records(spark, path)) == whole


def test_shuffled_reads_hold_every_record_in_another_order(spark):
    docs = documents(spark, [(n, f"text {n}") for n in range(200)])
    path = _written(spark, docs)
    plain = [r["doc_id"] for r in records.read_records(spark, path).collect()]
    seeds = [[r["doc_id"] for r in records.read_records(
        spark, path, F.xxhash64("data", "at", F.lit(seed))).collect()] for seed in (1, 2, 1)]
    assert seeds[0] == seeds[2] != seeds[1]
    assert sorted(seeds[0]) == sorted(plain) == list(range(200)) != seeds[0]


def test_frames(tmp_path):
    body = b"some bytes"
    data = records.frame(body)
    assert records.unframe(data) == body and len(data) == 8 + 4 + len(body) + 4
    assert records.unframe(records.frame(b"")) == b""
    assert records.unframe(b"xyz" + data, 3) == body
    for at in range(len(data)):
        damaged = bytearray(data)
        damaged[at] ^= 0x20
        with pytest.raises(ValueError):
            records.unframe(bytes(damaged))
    for cut in range(len(data)):
        with pytest.raises(ValueError):
            records.unframe(data[:cut])


def test_a_damaged_file_ends_the_read(spark):
    path = _written(spark, documents(spark, [(1, "some text here")]))
    name = glob.glob(f"{path}/*.rec")[0]
    data = bytearray(open(name, "rb").read())
    data[-6] ^= 1
    with open(name, "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(spark, path).collect()


def test_words_encoded_apart_equal_the_library():
    rng = random.Random(5)
    parts = ["́", "e", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "Σ", "ΑΣ", "ß", "İ",
             "'s", "'LL", "1", "中", "😀", "​", "ﬁ", "\x00", "a", "<|startoftext|>", "<|end",
             "oftext|>", " ", "\n", "\t", "\x0b", "  ", "\r\n", "J", "The", "x,", "Y.", "!", "?", "É",
             "×", "'", "_^", "Ñ&&&",
             "\u030c", "\u0308"]
    encoder = records.WordEncoder(VOCABULARY)
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert _wide(encoder, text) == _ids(text)


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(records, "CACHED_WORDS", 3)
    text = "one two three four five one two " + "x" * 100
    assert _wide(records.WordEncoder(VOCABULARY), text) == _ids(text)
