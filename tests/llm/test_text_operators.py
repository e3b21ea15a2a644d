"""Encoding, token counts, line dedup, SimHash and quality against plain versions."""

import hashlib
import math
import random
import re
import unicodedata
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from staylake.llm import bpe, components, line_dedup, quality, simhash, token_counts
from tests.llm.helpers import HAVE_TABLES, SF, TEXTS, documents, rows

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ BPE

def test_bpe_rows_match_the_library(spark):
    library = Tokenizer.from_file(WORD)
    want = []
    for i, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))),
                     sha(library.decode(ids, skip_special_tokens=False))))
    got = rows(bpe.digests(bpe.encode_documents(documents(spark), WORD)))
    assert got == sorted(want, key=repr)
    assert rows(bpe.encode_documents(documents(spark, []), WORD)) == []


def test_bpe_random_strings_match_the_library():
    library, model = Tokenizer.from_file(WORD), bpe.load(WORD)
    parts = ["a", "th", "ing", "Th", "'", "'s", " ", "é", "é", "İ", "Σ", "\x1c", "\x85",
             "　", "<|endoftext|>", "<|", "1", "²", "中文", "😀", "\n", "_", "</w>", "ß", "\0",
             "!!", ".", ",", "word,"]
    draw = random.Random(3)
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        if draw.random() < 0.3:
            text = "".join(draw.choice("aabcdeinth") for _ in range(draw.randint(1, 80)))
        want = library.encode(text, add_special_tokens=False).ids
        assert model.encode(text).tolist() == want, text
        assert model.decode(np.array(want, dtype=np.int32)) == library.decode(
            want, skip_special_tokens=False)


def test_bpe_characters_unknown_to_python_match_the_library():
    """Letters of newer Unicode versions, alone and between other characters."""
    library, model = Tokenizer.from_file(WORD), bpe.load(WORD)
    newer = [chr(c) for c in range(0x80, 0x40000)
             if unicodedata.category(chr(c)) == "Cn" and regex.match(r"\P{Cn}", chr(c))]
    draw = random.Random(4)
    parts = ["a", "B", "9", ".", "'s", " ", "\x1c", "\u3000", "É", "Σ", "\U00016d67", "<|endoftext|>"]
    texts = [f"ab{c}cd {c}{c}." for c in draw.sample(newer, min(800, len(newer)))]
    texts += ["".join(draw.choice(newer if draw.random() < 0.3 else parts)
                      for _ in range(draw.randint(1, 14))) for _ in range(1500)]
    for text in texts:
        assert model.encode(text).tolist() == library.encode(
            text, add_special_tokens=False).ids, ascii(text)


def test_bpe_pair_table_decides_merges():
    model = bpe.load(WORD)
    surface = "in" + bpe.END
    assert model._merge(model._symbols(surface)) == [surface]
    assert not model._compatible("i", "n" + bpe.END)


# ----------------------------------------------------------- token counts

def _counts(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    return sorted(((i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in texts),
                  key=repr)


@pytest.mark.parametrize("chunk,overlap", [(16_384, 256), (40, 2), (7, 1), (1000, 1)])
def test_token_counts_match_the_library(spark, chunk, overlap):
    got = rows(token_counts.count_tokens(documents(spark), PIECE, chunk_chars=chunk,
                                         overlap_chars=overlap))
    assert got == _counts(TEXTS)


@pytest.mark.parametrize("char", ["=", "a"])
def test_long_runs_are_encoded_once(char):
    counter = token_counts.load(PIECE)
    prose = "".join(f"Some words, number {n}, go here.\n" for n in range(12_000))
    text = char * 200_000 + prose
    chunks = list(counter.chunks(text, token_counts.CHUNK_CHARS, token_counts.OVERLAP_CHARS))
    assert sum(end - begin for begin, end, _, _ in chunks) <= 1.5 * len(text)
    total = head = 0
    for begin, end, following, last in chunks:
        tail = 0 if last else end - following
        total += counter.spliced(text[begin:end], head, tail)
        head = tail
    assert total == counter.count(text)


def test_token_counts_of_awkward_text(spark):
    draw = random.Random(8)
    parts = ["a", "aa", " ", "  ", "▁", "é", "😀", "\n", "<s>", "the", "\0", "中", "\t"]
    texts = [(n, "".join(draw.choice(parts) for _ in range(draw.randint(0, 200))))
             for n in range(200)]
    got = rows(token_counts.count_tokens(documents(spark, texts), PIECE, chunk_chars=11,
                                         overlap_chars=1))
    assert got == _counts(texts)


def test_overlap_widens_until_a_stable_boundary():
    counter = token_counts.load(PIECE)
    text = "a" * 50 + " b " + "a" * 50
    cuts = list(counter.chunks(text, 10, 2))
    assert cuts[0][1] > 12 and cuts[-1][1] == len(text)


# -------------------------------------------------------------- line dedup

def _plain_lines(docs):
    white = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(
        c.lower() if "A" <= c <= "Z" else c for c in line.strip(white))
    holders = {}
    for i, text in docs:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 10:
                    holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 2
                or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def test_line_dedup_matches_plain_version(spark):
    got = rows(line_dedup.contract_columns(line_dedup.dedup_lines(documents(spark))))
    assert got == _plain_lines(TEXTS)
    assert rows(line_dedup.dedup_lines(documents(spark, []))) == []


def test_line_dedup_hot_line(spark):
    texts = [(n, f"a line that every document has\nown line {n} of it\n" + "x" * (n % 12))
             for n in range(3000)]
    got = rows(line_dedup.contract_columns(line_dedup.dedup_lines(documents(spark, texts))))
    assert got == _plain_lines(texts)


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
def test_line_dedup_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = rows(line_dedup.contract_columns(line_dedup.dedup_lines(
        spark.read.parquet(f"{SF}/documents.parquet"))))
    assert got == sorted(con.execute(line_dedup.ORACLE_SQL).fetchall(), key=repr)


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 20_000, dtype=np.uint64))
    built = line_dedup.MinimalPerfectHash.build(keys)
    again = line_dedup.MinimalPerfectHash.from_bytes(*built.to_bytes())
    assert sorted(again.slots(keys)) == list(range(keys.size))
    assert line_dedup.MinimalPerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3


# ----------------------------------------------------------------- SimHash

def _plain_fingerprint(text, n=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i:i + n]).encode(), seed=42).intdigest()
              for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def _plain_simhash(texts, bits=4):
    prints = [(i, _plain_fingerprint(t)) for i, t in texts]
    known = sorted({p for p in prints if p[0] is not None})
    pairs = [(a, b) for a, x in known for b, y in known if bin(x ^ y).count("1") <= bits]
    of = _plain_components(pairs)
    return sorted(((i, f"{p:016x}", of.get(i)) for i, p in prints), key=repr)


def test_simhash_matches_plain_version(spark):
    texts = [*TEXTS[:11], *((100 + n, f"{'alpha beta gamma delta ' * 20} tail{n % 7} x{n}")
                            for n in range(40))]
    got = rows(simhash.contract_columns(simhash.near_duplicates(documents(spark, texts), 4, 4)))
    assert got == _plain_simhash(texts)
    assert rows(simhash.near_duplicates(documents(spark, []), 4, 4)) == []


@pytest.mark.parametrize("bits", [0, 3, 4, 5, 7])
def test_position_sets_cover(bits):
    from itertools import combinations
    sets = [set(s) for s in simhash.position_sets(bits)]
    for kept in combinations(range(8), 8 - bits):
        assert any(s <= set(kept) for s in sets)


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_similar_links_lose_nothing(spark, block_rows):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(60)]
    prints = set(base)
    for b in base[:20]:  # groups of near copies, one of them dense
        for _ in range(200 if b == base[0] else 5):
            x = b
            for _ in range(draw.randint(0, 4)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    known = sorted(prints)
    signed = [(x - (1 << 64) if x >> 63 else x, n) for n, x in enumerate(known)]
    links = simhash.similar_links(spark.createDataFrame(signed, "fp long, rep long"), 4, block_rows)
    got = _plain_components([tuple(r) for r in links.collect()])
    want = _plain_components([(a, b) for a, x in enumerate(known) for b, y in enumerate(known)
                              if a < b and (x ^ y).bit_count() <= 4])
    assert got == want


def test_components_of_paths_and_stars(spark):
    pairs = [(n, n + 1) for n in range(60)] + [(100, n) for n in range(101, 300)]
    pairs += [(500, 500), (None, 7), (7, None), (60, 59)]
    got = {r["node"]: r["component"] for r in components.connected_components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == _plain_components([p for p in pairs if None not in p and p[0] != p[1]])
    empty = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(empty).count() == 0


def test_keep_first_keeps_one_of_each(spark):
    texts = [(1, "a b c d e f"), (5, "a b c d e f"), (3, "other text here now"), (None, "a b c d e f")]
    kept = simhash.keep_first(documents(spark, texts), 4, 4)
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 3]


# ----------------------------------------------------------------- quality

def _labelled(spark):
    draw = random.Random(2)
    good = [" ".join(draw.choice(["the", "house", "stands", "near", "river,", "old", "trees."])
                     + draw.choice("abcdefgh") for _ in range(80)) for _ in range(300)]
    bad = [" ".join(draw.choice(["%%%", "buy$$$", "a###", "x|", "now&&&"]) for _ in range(80))
           for _ in range(300)]
    texts = list(enumerate(t for pair in zip(good, bad) for t in pair))
    labels = [(i, 1 - i % 2, 0) for i, _ in texts] + [(None, 1, 0), (3, None, 0), (9999, 1, 0)]
    return texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_held_out_accuracy(spark):
    texts, labels = _labelled(spark)
    docs = documents(spark, [*texts, (None, "some text"), (100_000, ""), (100_001, None)])
    out = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(out) == len(texts) + 3
    for r in out:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None
                                 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in out if r["held_out"] and r["doc_id"] < 600]
    right = sum(r["predicted"] == 1 - r["doc_id"] % 2 for r in held)
    assert len(held) > 60 and right / len(held) >= 0.98


def test_quality_ignores_held_out_labels(spark):
    texts, labels = _labelled(spark)
    docs = documents(spark, texts)
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 "
                  "THEN 1 - quality ELSE quality END AS quality")
    x = quality._scores_of([type("T", (), {"as_py": lambda self, t=t: t})() for _, t in texts[:50]])
    assert np.array_equal(quality.train(docs, labels).score(x),
                          quality.train(docs, flipped).score(x))


def test_quality_fit_counts_a_repeated_document_once(spark):
    texts, labels = _labelled(spark)
    x = quality._scores_of([type("T", (), {"as_py": lambda self, t=t: t})() for _, t in texts[:50]])
    once = quality.train(documents(spark, texts), labels)
    often = quality.train(documents(spark, texts + texts[:40] * 20), labels)
    assert np.array_equal(once.score(x), often.score(x))


def test_quality_without_both_labels(spark):
    texts, labels = _labelled(spark)
    docs = documents(spark, texts[:4])
    for some in (labels.where("quality = 1"), labels.limit(0)):
        scores = {r["score"] for r in quality.score(docs, quality.train(docs, some)).collect()}
        assert len(scores) == 1
    assert quality.score(documents(spark, []), quality.train(docs, labels)).count() == 0


def _plain_tree(g, h, depth, least):
    """Newton steps per bin of the best tree, one cut after another."""
    step = sum(g) / (sum(h) + 1.0)
    best, at = -1.0, None
    for i in range(1, len(g)) if depth else ():
        if sum(h[:i]) >= least and sum(h[i:]) >= least:
            gain = (sum(g[:i])**2 / (sum(h[:i]) + 1.0) + sum(g[i:])**2 / (sum(h[i:]) + 1.0))
            if gain > best:
                best, at = gain, i
    if at is None:
        return [step] * len(g)
    return (_plain_tree(g[:at], h[:at], depth - 1, least)
            + _plain_tree(g[at:], h[at:], depth - 1, least))


def _plain_fit(x, y, model, rounds, rate):
    """The feature tables of cyclic boosting over the model's bins, row by row."""
    bins = [[sum(v >= c for c in cuts) for v in x[:, j]] for j, cuts in enumerate(model.cuts)]
    tables = [[0.0] * (len(cuts) + 1) for cuts in model.cuts]
    total = [model.intercept] * len(y)
    for _ in range(rounds):
        for j, table in enumerate(tables):
            p = [1 / (1 + math.exp(-t)) for t in total]
            g, h, n = [0.0] * len(table), [0.0] * len(table), [0] * len(table)
            for at, label, chance in zip(bins[j], y, p):
                g[at] += label - chance
                h[at] += chance * (1 - chance)
                n[at] += 1
            mean = sum(p) / len(p)
            least = max(2.0, 0.0005 * len(y)) * mean * (1 - mean)
            steps = [rate * min(4.0, max(-4.0, s)) for s in _plain_tree(g, h, 2, least)]
            tables[j] = [t + (s if rows else 0.0) for t, s, rows in zip(table, steps, n)]
            total = [t + steps[at] for t, at in zip(total, bins[j])]
    return tables


def _some_features(n):
    draw = np.random.default_rng(3)
    x = np.round(draw.normal(size=(n, len(quality.FEATURES))), 3)
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 3] + 1.5 * x[:, 1] * x[:, 2])))
    return x, (draw.random(n) < chance).astype(float)


def test_quality_tables_equal_plain_boosting():
    x, y = _some_features(150)
    model = quality.fit(x, y, rounds=4, bins=8, pair_rounds=0)
    for table, plain in zip(model.tables, _plain_fit(x, y, model, 4, 0.15)):
        assert np.allclose(table, plain, atol=1e-9)


def test_quality_scores_equal_a_plain_sum():
    x, y = _some_features(400)
    model = quality.fit(x, y, rounds=20)
    assert model.pairs and any(np.abs(t).max() > 0 for t in model.pair_tables)

    def at(cuts, value):
        return sum(value >= c for c in cuts)

    for row, got in zip(x, model.score(x)):
        total = model.intercept + sum(
            table[at(model.cuts[j], row[j])] for j, table in enumerate(model.tables))
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[at(model.coarse[a], row[a])][at(model.coarse[b], row[b])]
        assert got == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
def test_quality_of_the_given_labels(spark):
    """Ranking of the held-out labelled documents: area under the ROC curve."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels))
    held = scored.where("held_out").join(labels, "doc_id").select("score", "quality").collect()
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    assert good and bad
    wins = sum((a > b) + 0.5 * (a == b) for a in good for b in bad)
    assert wins / len(good) / len(bad) >= 0.9
