"""Exact top-k by inner product over a pivot-distance index.

One more coordinate, sqrt(M - |x|^2) with M the largest squared norm, turns
the largest inner product into the smallest Euclidean distance.  Every vector
is keyed by its nearest pivot and its distance to it; a pivot's vectors are
cut at distance quantiles into sorted annuli and these into blocks of bounded
size.  A query first visits the annulus it falls into, which gives a distance
it has to beat, then expands to the annuli with the next lower bounds, more of
them in every round.  The triangle inequality bounds each annulus from below;
a query stops when the next bound exceeds its k-th best distance.

Pivots are a bounded sample, the annuli a bounded table: these alone reach
the driver.  Every vector is indexed, every query runs to its proven end.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylake.llm.common import ship, stored

MAX_PIVOTS = 256
ANNULI = 4
BLOCK_ROWS = 1024
QUERY_ROWS = 4096
FIRST_ROUNDS = (1, 4)  # annuli that a query visits in the first rounds; then all left
MAX_ANNULI = 64
LOWEST = -(1 << 63)  # of a long
SLACK = 1e-9  # of the squared scale: covers rounding in the bounds


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 64) -> DataFrame:
    """(vid, dim, norm, vec): floor(scale * x) of every usable vector.

    Null ids, null or empty vectors and vectors with a null or non-finite
    component are left out.  A component beyond the range of a long takes its
    nearest end.  ``norm``, the squared norm, is a double: it only serves bounds.
    """
    x = F.col(vec_col).cast("array<double>")
    usable = (F.col(id_col).isNotNull() & (F.size(x) > 0)
              & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)
                         & (F.abs(v) < F.lit(float("inf")))))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vid"),
        F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("vec"))
    return rows.select("vid", F.size("vec").alias("dim"), F.aggregate(
        "vec", F.lit(0.0), lambda t, v: t + v.cast("double") * v.cast("double")).alias("norm"),
        "vec")


def _integers(column) -> np.ndarray:
    """Vectors of one dimension as rows of longs."""
    if isinstance(column, pa.ListArray):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(column), -1).astype(np.int64) if len(column) else flat
    return np.array(list(column), dtype=np.int64)


def _matrix(column) -> np.ndarray:
    """The same as doubles, for bounds."""
    return _integers(column).astype(np.float64)


def _lifted(matrix: np.ndarray, norms: np.ndarray, largest: float) -> np.ndarray:
    return np.hstack([matrix, np.sqrt(np.maximum(largest - norms, 0.0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(square, 0.0))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of longs; one beyond a long takes its nearest end."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    bound = np.abs(x).max(initial=0.0) * np.abs(y).max(initial=0.0) * a.shape[1]
    if bound < 2**53:  # doubles are exact
        return (x @ y.T).astype(np.int64)
    if bound < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), LOWEST, -LOWEST - 1).astype(np.int64)


def _best(query, vid, score, k):
    """Rows of each query's k best, ties to the smaller id."""
    order = np.lexsort((vid, -score, query))
    query, vid, score = query[order], vid[order], score[order]
    first = np.concatenate([[0], np.flatnonzero(query[1:] != query[:-1]) + 1])
    rank = np.arange(query.size) - np.repeat(first, np.diff([*first, query.size]))
    return query[rank < k], vid[rank < k], score[rank < k]


def _asked_blocks(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """A copy of each block for every part of the queries that visits it."""
    visits = asked.select(F.col("annulus").alias("at"), F.col("piece").alias("of"),
                          F.col("part").alias("by")).distinct()
    same = (F.col("annulus") == F.col("at")) & (F.col("piece") == F.col("of"))
    return blocks.join(visits, same).select(*blocks.columns, F.col("by").alias("part"))


def _search_dimension(base: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vid, score) candidates that hold every query's k best."""
    spark = base.sparkSession
    stats = base.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("m")).first()
    total, largest = stats["n"], float(stats["m"] or 0)
    n_pivots = max(1, min(MAX_PIVOTS, max(16, math.isqrt(total) // 8)))
    # thinner annuli for a larger table, which leave the bounds less room
    annuli = max(ANNULI, min(MAX_ANNULI, total // (n_pivots * BLOCK_ROWS)))
    sample = base.orderBy(F.xxhash64("vid"), "vid").limit(n_pivots).select("norm", "vec").collect()
    points = np.array([r["vec"] for r in sample], dtype=np.float64)
    pivots = np.unique(_lifted(points, np.array([r["norm"] for r in sample], float), largest),
                       axis=0)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                norms = batch.column(1).to_numpy().astype(np.float64)
                far = _distances(_lifted(_matrix(batch.column(2)), norms, largest), pivots)
                near = far.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(near.astype(np.int32)),
                     pa.array(far[np.arange(len(near)), near])],
                    ["vid", "norm", "vec", "pivot", "far"])

    placed = stored(base.select("vid", "norm", "vec").mapInArrow(
        place, "vid long, norm double, vec array<long>, pivot int, far double"), "topk-placed")
    edges = placed.groupBy("pivot").agg(F.percentile_approx(
        "far", [n / annuli for n in range(1, annuli)], 1000).alias("edges"))
    ringed = stored(placed.join(edges, "pivot").select(
        "vid", "norm", "vec", "pivot", "far",
        F.size(F.filter("edges", lambda e: F.col("far") > e)).alias("ring")), "topk-rings")
    rings = (ringed.groupBy("pivot", "ring").agg(
        F.min("far").alias("low"), F.max("far").alias("high"), F.count(F.lit(1)).alias("n"))
        .orderBy("pivot", "ring").collect())  # at most pivots x annuli rows
    of_ring = np.array([r["pivot"] for r in rings])
    low = np.array([r["low"] for r in rings])
    high = np.array([r["high"] for r in rings])
    pieces = [max(1, -(-r["n"] // BLOCK_ROWS)) for r in rings]
    table = spark.createDataFrame(
        [(r["pivot"], r["ring"], n, pieces[n]) for n, r in enumerate(rings)],
        "pivot int, ring int, annulus int, pieces int")
    blocks = stored(ringed.join(F.broadcast(table), ["pivot", "ring"]).select(
        "annulus", F.pmod(F.xxhash64("vid"), "pieces").cast("int").alias("piece"), "vid", "vec"),
        "topk-blocks")
    groups = max(1, -(-queries.count() // QUERY_ROWS))
    waiting = stored(queries.select(
        F.col("vid").alias("query_id"), "norm", "vec",
        F.pmod(F.xxhash64("vid"), F.lit(groups)).cast("int").alias("part")), "topk-queries")
    slack = SLACK * (1.0 + largest)

    def bounds(vec_column, norms):
        """Lower bound of the distance from each query to each annulus."""
        lifted = np.hstack([_matrix(vec_column), np.zeros((len(norms), 1))])
        to = _distances(lifted, pivots)[:, of_ring]
        return np.maximum(np.maximum(to - high, low - to), 0.0)

    def plan(visited: int, more: int | None):
        """Annuli of every query from the ``visited``-th on, by lower bound."""

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                norms = batch.column(1).to_numpy().astype(np.float64)
                bound = bounds(batch.column(2), norms)
                order = np.argsort(bound, axis=1, kind="stable")
                stop = len(rings) if more is None else visited + more
                worst = batch.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
                worst = np.where(worst <= LOWEST, np.nan, worst)  # cut: says nothing
                # squared distance of the k-th best; none yet: no bound
                limit = np.where(np.isnan(worst), np.inf, largest + norms - 2.0 * worst)
                at, which = [], []
                for row in range(len(norms)):
                    for a in order[row, visited:stop]:
                        if bound[row, a] ** 2 > limit[row] + slack:
                            break
                        at.append(row)
                        which.append(a)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(at, pa.int64())) for c in
                       (batch.column(0), batch.column(2), batch.column(3), batch.column(4))),
                     pa.array(which, pa.int32())],
                    ["query_id", "vec", "part", "worst", "annulus"])

        return run

    def compare(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vid": [], "score": []}
        if len(vectors) and len(asked):
            q, v = asked["query_id"].to_numpy(), vectors["vid"].to_numpy()
            score = _products(_integers(asked["vec"]), _integers(vectors["vec"]))
            worst = asked["worst"].to_numpy(dtype=np.float64, na_value=np.nan)
            good = np.where(np.isnan(worst)[:, None], True, score >= worst[:, None])
            good &= q[:, None] != v[None, :]
            i, j = np.nonzero(good)
            if i.size:
                out = dict(zip(out, _best(q[i], v[j], score[i, j], k)))
        return pd.DataFrame(out).astype("int64")

    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vid")
    found = spark.createDataFrame([], "query_id long, vid long, score long")
    visited = 0
    for more in (*FIRST_ROUNDS, None):
        if visited >= len(rings):
            break
        kth = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"),
                                            F.min("score").alias("s"))
        kth = kth.where(F.col("n") >= k).select("query_id", F.col("s").cast("double").alias(
            "worst"))
        asked = stored(waiting.join(kth, "query_id", "left")
                 .select("query_id", "norm", "vec", "part", "worst")
                 .mapInArrow(plan(visited, more), "query_id long, vec array<long>, part int, "
                                                  "worst double, annulus int")
                 .join(F.broadcast(table.select("annulus", "pieces")), "annulus")
                 .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))),
                       "topk-visits")
        keys = ["annulus", "piece", "part"]
        compared = _asked_blocks(blocks, asked).groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
            compare, "query_id long, vid long, score long")
        found = stored(found.unionByName(compared).distinct().withColumn(
            "rank", F.row_number().over(by_query)).where(F.col("rank") <= k).drop("rank"),
            "topk-found")
        visited += more or 0
    return found


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query.

    Both inputs are as :func:`integer_vectors` gives them.  Candidates are all
    vectors of the query's dimension except those of its own id; score is the
    integer inner product, ties go to the smaller id; one beyond the range of a
    long takes its nearest end and ties with others there.  Repeated rows of an id
    count once per distinct score; a query with fewer candidates gets all of
    them, one without any gets no row.
    """
    spark = vectors.sparkSession
    ship(spark)
    vectors, queries = stored(vectors, "topk-vectors"), stored(queries, "topk-asked")
    found = spark.createDataFrame([], "query_id long, vid long, score long")
    # one index per dimension in use by queries
    for row in queries.groupBy("dim").count().orderBy("dim").collect():
        same = F.col("dim") == row["dim"]
        found = found.unionByName(_search_dimension(vectors.where(same), queries.where(same), k))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vid")
    return (found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("vid").alias("vec_id"), "score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))
         AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""
