"""Pipelined lexical search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from staylake.llm import lexical
from tests.llm.helpers import HAVE_TABLES, LONG, SF, documents, rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _terms(text):
    return TERM.findall(text.translate(LOWER))


def _plain(docs, items, k=10):
    """The contract, one document after another."""
    held = [(i, _terms(t)) for i, t in docs if t is not None]
    held = [(i, w) for i, w in held if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    asked = {}
    for i, t in items:
        if i is not None and t is not None:
            asked.setdefault(i, set()).update(_terms(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, words in held:
            tf = Counter(words)
            m = 10 + 90 * len(words) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms if tf[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def _items(spark, items):
    return spark.createDataFrame([(i, t, 1, "s") for i, t in items],
                                 "item_id long, text string, item int, score string")


def _check(spark, docs, items, k=10):
    assert rows(lexical.search(documents(spark, docs), _items(spark, items), k)) == \
        _plain(docs, items, k)


def test_terms():
    text = "It's A_b É2é Ünï\tx,中文 Ab\x7fc {q} \x00"
    assert [t.decode() for t in lexical.terms(text.encode())] == _terms(text)
    assert lexical.terms(b"") == lexical.terms(b" ,.\n") == []


@pytest.mark.parametrize("block,owners", [(2048, 5), (7, 3), (3, 1)])
def test_equals_plain_scoring(spark, monkeypatch, block, owners):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "OWNERS", owners)
    rng = random.Random(block)
    words = [f"w{n}" for n in range(60)]
    weights = [1 / (n + 1) for n in range(60)]

    def text(n):
        return " ".join(rng.choices(words, weights, k=n))

    docs = [(n, text(rng.choice([1, 5, 40, 300]))) for n in range(150)]
    docs += [(500 + n, "w1 w2 w3") for n in range(30)]  # equal scores: smallest ids first
    _check(spark, docs, [(n, text(12)) for n in range(20)], 10)
    _check(spark, docs, [(n, text(4)) for n in range(5)], 3)


def test_groups_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_PAIRS", 4)
    docs = [(n, f"a{n % 7} b{n % 5} c") for n in range(50)]
    _check(spark, docs, [(n, f"a{n} b{n} c z") for n in range(9)])


def test_odd_rows(spark):
    docs = [(1, "alpha beta"), (2, "alpha beta"), (2, "alpha beta"), (None, "alpha beta"),
            (3, None), (4, ""), (5, " ,; "), (6, LONG), (7, "ÀB alpha's"), (8, "Gamma GAMMA")]
    items = [(1, "Alpha"), (2, "beta gamma"), (2, "word7 beta"), (None, "alpha"), (3, None),
             (4, ""), (5, "nowhere"), (6, "Àb àb"), (7, LONG)]
    _check(spark, docs, items)


def test_terms_of_every_document_weigh_little(spark):
    _check(spark, [(n, "the") for n in range(40)], [(1, "the"), (2, "THE end")])


def test_empty_tables(spark):
    none = lexical.search(documents(spark, []), _items(spark, [(1, "a")]))
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.collect() == []
    assert lexical.search(documents(spark, [(1, "a")]), _items(spark, [])).collect() == []


@pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")
def test_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = lexical.search(*(spark.read.parquet(f"{SF}/{t}.parquet")
                           for t in ("documents", "benchmark")))
    assert rows(got) == sorted(con.execute(lexical.ORACLE_SQL).fetchall(), key=repr)
