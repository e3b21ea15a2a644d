"""Quality classifier: a generalised additive model with pairwise terms.

Every document becomes a fixed vector of surface statistics of its whole
text.  Cyclic boosting fits one shallow tree per feature and turn on the
current residuals; the trees of a feature add up to one lookup table over its
bins.  Pairs with the largest remaining gain get two-dimensional tables the
same way.  A score is a sum of table entries through a logistic link.

The fit runs on a bounded sample of labelled rows (``sample_rows``); scoring
covers every row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import ship

SAMPLE_ROWS = 20_000
HELD_OUT_FOLDS = 5
THRESHOLD = 0.3

FEATURES = [
    "log_words", "word_length", "distinct_words", "top_word", "repeated_neighbours",
    "symbols", "pipes", "upper", "digits", "sentence_marks", "exclamations", "non_ascii",
    "log_line_words", "repeated_lines", "marked_words", "one_letter_words",
]


def features(text: str | None) -> list[float]:
    """Surface statistics of a whole text; an empty text gives zeros."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, size = len(words), len(raw)
    spaces = int(seen[9:14].sum() + seen[32])
    letters_upper = int(seen[65:91].sum())
    letters_lower = int(seen[97:123].sum())
    digits = int(seen[48:58].sum())
    high = int(seen[128:].sum())
    marks = int(seen[46] + seen[44] + seen[59] + seen[58] + seen[63] + seen[39] + seen[34])
    symbols = size - spaces - letters_upper - letters_lower - digits - high - marks
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)), (size - spaces) / n, len(counts) / n,
        max(counts.values()) / n, sum(map(eq, words, words[1:])) / n,
        symbols / size, int(seen[124]) / n, letters_upper / max(1, letters_upper + letters_lower),
        digits / size, marks / n, int(seen[33]) / n, high / size,
        float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines),
        sum(1 for w in words if not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,;:?'\"")) / n,
        sum(1 for w in words if len(w) == 1) / n,
    ]


def _scores_of(batch_texts) -> np.ndarray:
    return np.array([features(t.as_py()) for t in batch_texts], dtype=np.float64).reshape(
        -1, len(FEATURES))


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], x[:, a], side="right"),
                           np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _sums(index: np.ndarray, size: int, gradient, weight) -> tuple[np.ndarray, np.ndarray]:
    return (np.bincount(index, gradient, minlength=size),
            np.bincount(index, weight, minlength=size))


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int, least: float) -> np.ndarray:
    """Newton steps per bin of the best tree of ``depth`` cuts over bins."""
    out = np.full(g.size, g.sum() / (h.sum() + 1.0))
    if depth == 0 or g.size < 2:
        return out
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + 1.0) + right_g**2 / (right_h + 1.0)
    gain = np.where((left_h >= least) & (right_h >= least), gain, -1.0)
    at = int(np.argmax(gain))
    if gain[at] < 0:
        return out
    return np.concatenate([_shallow_tree(g[:at + 1], h[:at + 1], depth - 1, least),
                           _shallow_tree(g[at + 1:], h[at + 1:], depth - 1, least)])


def _cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Best tree with one cut per axis (four leaves) and its gain."""
    sum_g, sum_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, steps = -1.0, np.zeros_like(g)
    all_g, all_h = sum_g[-1, -1], sum_h[-1, -1]
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            gs = (sum_g[i, j], sum_g[i, -1] - sum_g[i, j], sum_g[-1, j] - sum_g[i, j],
                  all_g - sum_g[i, -1] - sum_g[-1, j] + sum_g[i, j])
            hs = (sum_h[i, j], sum_h[i, -1] - sum_h[i, j], sum_h[-1, j] - sum_h[i, j],
                  all_h - sum_h[i, -1] - sum_h[-1, j] + sum_h[i, j])
            gain = sum(a * a / (b + 1.0) for a, b in zip(gs, hs))
            if gain > best:
                best, steps = gain, np.zeros_like(g)
                v = [a / (b + 1.0) for a, b in zip(gs, hs)]
                steps[:i + 1, :j + 1], steps[:i + 1, j + 1:] = v[0], v[1]
                steps[i + 1:, :j + 1], steps[i + 1:, j + 1:] = v[2], v[3]
    return steps, best - all_g**2 / (all_h + 1.0)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 48,
        n_pairs: int = 4, pair_bins: int = 6, pair_rounds: int = 15) -> AdditiveModel:
    """Cyclic boosting; without rows of both labels the score is the rate of 1."""
    n, width = x.shape[0], len(FEATURES)
    base = (y.sum() + 0.5) / (n + 1.0)
    model = AdditiveModel(float(np.log(base / (1 - base))), [np.zeros(0)] * width,
                          [np.zeros(1)] * width, [], [np.zeros(0)] * width, [])
    if n == 0 or y.min() == y.max():
        return model
    model.cuts = [_cuts(x[:, j], bins) for j in range(width)]
    index = [np.searchsorted(model.cuts[j], x[:, j], side="right") for j in range(width)]
    model.tables = [np.zeros(c.size + 1) for c in model.cuts]
    total = np.full(n, model.intercept)
    least = max(2.0, 0.0005 * n)
    for _ in range(rounds):
        for j in range(width):
            p = 1.0 / (1.0 + np.exp(-total))
            g, h = _sums(index[j], model.tables[j].size, y - p, p * (1 - p))
            weight = np.bincount(index[j], minlength=model.tables[j].size)
            step = rate * np.clip(_shallow_tree(g, h, 2, least * p.mean() * (1 - p.mean())
                                                ), -4, 4)
            step[weight == 0] = 0.0
            model.tables[j] += step
            total += step[index[j]]
    model.coarse = [_cuts(x[:, j], pair_bins) for j in range(width)]
    rough = [np.searchsorted(model.coarse[j], x[:, j], side="right") for j in range(width)]

    def grid(a: int, b: int):
        shape = (model.coarse[a].size + 1, model.coarse[b].size + 1)
        at = rough[a] * shape[1] + rough[b]
        p = 1.0 / (1.0 + np.exp(-total))
        g, h = _sums(at, shape[0] * shape[1], y - p, p * (1 - p))
        return at, g.reshape(shape), h.reshape(shape)

    gains = []
    for a, b in combinations(range(width), 2):
        _, g, h = grid(a, b)
        gains.append((_cross_tree(g, h)[1], a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:n_pairs]]
    model.pair_tables = [np.zeros((model.coarse[a].size + 1, model.coarse[b].size + 1))
                         for a, b in model.pairs]
    for _ in range(pair_rounds):
        for n_pair, (a, b) in enumerate(model.pairs):
            at, g, h = grid(a, b)
            step = rate * np.clip(_cross_tree(g, h)[0], -4, 4)
            model.pair_tables[n_pair] += step
            total += step.ravel()[at]
    return model


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(id_col.cast("string").cast("binary")) % HELD_OUT_FOLDS


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on labelled rows outside the held-out fold.

    At most ``sample_rows`` labelled ids are used, those with the smallest
    hash; null labels and ids labelled both ways are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    clear = (labels.where("doc_id is not null and quality in (0, 1)")
             .groupBy(F.col("doc_id").alias("label_id"))
             .agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
             .where("label = other").where(fold(F.col("label_id")) != 0)
             .select("label_id", F.col("label").cast("double").alias("label"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scores_of(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.tolist(), pa.list_(pa.float64()))],
                ["id", "label", "x"])

    # The sample is bounded by its parameter, so it may be broadcast.
    picked = docs.select(F.col("doc_id").alias("id"), "text").join(
        F.broadcast(clear), F.col("id") == F.col("label_id")).select(
        F.col("id").cast("long"), "label", F.col("text").cast("string"))
    # One row per id (the smallest vector), however often a document is repeated.
    rows = (picked.mapInArrow(run, "id long, label double, x array<double>")
            .groupBy("id", "label").agg(F.min("x").alias("x")).orderBy("id").collect())
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["label"] for r in rows], dtype=np.float64))


def score(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with score, held_out and predicted.

    Null and empty texts are scored as the vector of zeros; a null id is not
    held out.  Repeated rows repeat; existing columns of these names are
    replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("score", "held_out", "predicted")
    keep = docs.columns if keep is None else keep
    ddl = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    docs = docs.select(*keep, F.col("text").cast("string").alias("_scored_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(_scores_of(batch.columns[-1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.float64())], [*keep, "score"])

    scored = docs.mapInArrow(run, f"{ddl}, score double")
    return (scored
            .withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
