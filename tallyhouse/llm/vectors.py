"""Exact inner-product search with multi-resolution segment statistics.

A vector's components become floor(scale * x). For segments of a vector, the inner product
of two vectors is the sum of l * mean * mean plus the product of the deviations from the
means, and the latter is at most the product of their norms (that is, the distance is at
least what means and deviations say). So a few numbers per vector bound a score. Bounds
are taken with 1, 4, 16 and 32 segments; after each level the best candidates by bound are
scored, which raises what a candidate must reach, and the others are dropped for good.
Rows that survive for some query are scored exactly, in one matrix product.

The stated queries meet all rows in blocks: queries in blocks of `query_block`, rows dealt
into parts of about `row_block`; each pair of blocks is one group, which returns its best k
per query. No block grows with the input.

Defined results: vectors that are null or hold a null or non-finite component take no
part; vectors of other lengths never meet; rows with the query's own id are not its
candidates; ties go to the smaller id, a null id comes last and is never a query; repeated
rows are candidates each on their own; an empty table gives an empty one; other columns
are not read. Scaled components are taken to stay below 2^26, so that scores are exact longs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, with_row_key

LEVELS = (1, 4, 16, 32)
#: After each level so many times k candidates are scored to raise what the others must reach.
PROBES = 16
RESULT = f"{FILE} long, {ROW} long, query_id long, vec_id long, score long"


def _matrix(table: pa.Table, scale: int) -> np.ndarray:
    lists = table.column("vector").combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(table.num_rows, -1)


def _features(x: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviation norms of each segment; their inner product bounds a score."""
    edges = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    sizes = np.diff(edges)
    values = x.astype(np.float64)
    means = np.add.reduceat(values, edges[:-1], axis=1) / sizes
    off = values - np.repeat(means, sizes, axis=1)
    norms = np.sqrt(np.add.reduceat(off * off, edges[:-1], axis=1))
    return np.concatenate([means * np.sqrt(sizes), norms], axis=1)


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, exactly: in doubles where every sum stays below 2^53."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * rows.shape[1]
    if most < 1 << 53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def best(
    queries: np.ndarray,
    query_ids: np.ndarray,
    rows: np.ndarray,
    ids: np.ndarray,
    k: int,
    shares: list[float] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of every candidate that may be among a query's k best.

    A level looks only at rows that are alive for some query. shares collects the share of
    all pairs that is alive after each level.
    """
    alive = query_ids[:, None] != ids[None, :]
    least = np.full(len(queries), -np.inf)
    for segments in LEVELS if rows.shape[1] and rows.shape[0] else ():
        left = np.flatnonzero(alive.any(axis=0))
        if len(left) < k:
            break
        some, mask = rows[left], alive[:, left]
        fq, fx = _features(queries, segments), _features(some, segments)
        # Room for rounding: the bound is never below the true score.
        slack = 1e-9 * np.linalg.norm(fq, axis=1) * np.linalg.norm(fx, axis=1).max() + 1e-6
        bound = fq @ fx.T + slack[:, None]
        bound[~mask] = -np.inf
        tried = min(len(left), PROBES * k)
        top = np.argpartition(-bound, tried - 1, axis=1)[:, :tried]
        scored = np.einsum("qd,qkd->qk", queries, some[top]).astype(np.float64)
        scored[~np.take_along_axis(mask, top, axis=1)] = -np.inf
        least = np.maximum(least, -np.partition(-scored, k - 1, axis=1)[:, k - 1])
        alive[:, left] = mask & (bound >= least[:, None])
        if shares is not None:
            shares.append(float(alive.mean()))
    left = np.flatnonzero(alive.any(axis=0))
    products = _products(queries, rows[left])
    q, at = np.nonzero(alive[:, left])
    r, score = left[at], products[q, at]
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    first = np.searchsorted(q, q)
    chosen = np.arange(len(q)) - first < k
    return q[chosen], r[chosen], score[chosen]


def _search(scale: int, k: int):
    last = np.iinfo(np.int64).max

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = [FILE, ROW, "query_id", "vec_id", "score"]
        if not queries.num_rows or not rows.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        given = rows.column("vec_id").combine_chunks()
        ids = given.fill_null(last).to_numpy(zero_copy_only=False)
        query_ids = queries.column("vec_id").to_numpy()
        q, r, score = best(_matrix(queries, scale), query_ids, _matrix(rows, scale), ids, k)
        columns = [queries.column(n).combine_chunks().take(pa.array(q)) for n in (FILE, ROW, "vec_id")]
        return pa.table([*columns, given.take(pa.array(r)), pa.array(score)], names=names)

    return search


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    query_block: int = 1024,
    row_block: int = 4096,
) -> DataFrame:
    """Each query's k highest scores: query_id, rank, vec_id, score.

    is_query is a condition on the vectors' own columns.
    """
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    asked = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    )
    usable = F.col("vector").isNotNull() & F.forall("vector", finite)
    rows = with_row_key(asked).where(usable).withColumn("dim", F.size("vector"))
    asking = rows.where(F.col("asked") & F.col("vec_id").isNotNull())
    n_rows, n_queries = rows.count(), asking.count()
    parts = max(1, -(-n_rows // row_block))
    blocks = max(1, -(-n_queries // query_block))
    deal = F.xxhash64(FILE, ROW)
    each = F.sequence(F.lit(0), F.lit(parts - 1))
    # Every query meets every part and every row every block, once.
    left = asking.withColumn("block", F.pmod(deal, F.lit(blocks)).cast("int")).withColumn("part", F.explode(each))
    right = rows.withColumn("part", F.pmod(deal, F.lit(parts)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    keys = ["dim", "block", "part"]
    found = (
        left.select(*keys, FILE, ROW, "vec_id", "vector")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "vec_id", "vector").groupBy(*keys))
        .applyInArrow(_search(scale, k), RESULT)
    )
    order = Window.partitionBy(FILE, ROW, "query_id").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH vectors AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, q.v AS a, c.v AS b
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
),
scores AS (
    SELECT query_id, vec_id,
           CAST(list_sum([a[i] * b[i] FOR i IN range(1, len(a) + 1)]) AS BIGINT) AS score
    FROM pairs
),
ranked AS (
    SELECT query_id, vec_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
