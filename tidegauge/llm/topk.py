"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation over blocks.

A vector is a sparse row of integer weights, one term per component that is not zero. Candidates and queries are cut into
blocks by a hash of their row; every pair of blocks meets in one group. There each term of a query row scatters its
weight times the term's postings into a dense array of scores, one score per candidate; a partition selection keeps the k
best of the block, and a window merges the blocks. All pairs are scored, only k rows per query and block leave a task, and
a block's arrays have a fixed size at any size of the table.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without an id, take no part; rows with
the same id are queries and candidates of their own, each leaving out itself alone; a vector without components scores 0;
components missing at the end of a shorter vector count as 0; equal scores go to the smaller id; an empty table gives no rows; extra
columns are ignored. Scores are 64-bit integers; components so large that a sum could pass 2^63 are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scale import stage
from .workers import ship_package

# Rows of a block: 16,384 candidates of 64 components are 8 MB, their scores for 128 queries 16 MB.
CANDIDATE_ROWS = 16_384
QUERY_ROWS = 8_192
QUERIES_AT_ONCE = 128


def integer_vectors(table: DataFrame, scale: float = 256.0) -> DataFrame:
    """`row`, `vec_id` and `v`, the components as floor(scale * x); rows that take no part are left out. Written once."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    usable = table.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
    scaled = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")))
    large = F.coalesce(F.array_max(F.transform(x, lambda c: F.abs(F.lit(scale) * c.cast("double")))) + 1, F.lit(0.0))
    rows = stage(
        usable.select(F.monotonically_increasing_id().alias("row"), "vec_id", scaled.cast("array<bigint>").alias("v"), large.alias("large")),
        "vectors",
    )
    bound = rows.agg(F.max("large").alias("large"), F.max(F.size("v")).alias("terms")).first()
    if bound.large and bound.large**2 * bound.terms >= 2.0**63:
        raise ValueError("components are too large for 64-bit scores")
    return rows.drop("large")


def _postings(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per term the rows that hold it, ascending, and their weights."""
    rows = pa.concat_arrays([c for c in column.chunks]) if column.num_chunks else pa.array([], column.type)
    offsets = rows.offsets.to_numpy()
    flat = rows.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    flat = flat[offsets[0] : offsets[-1]]
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    held = flat != 0
    row, term, weight = row[held], term[held], flat[held]
    order = np.argsort(term, kind="stable")
    terms, begin = np.unique(term[order], return_index=True)
    cuts = [*begin, len(order)]
    return {int(t): (row[order[a:b]], weight[order[a:b]]) for t, a, b in zip(terms, cuts[:-1], cuts[1:], strict=True)}


def _best(ids: np.ndarray, scores: np.ndarray, at: int, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id (ids ascend), the query's own row `at` (-1: elsewhere) left out."""
    if at >= 0:
        scores[at] = np.iinfo(np.int64).min
        usable = len(ids) - 1
    else:
        usable = len(ids)
    k = min(k, usable)
    if k <= 0:
        return np.empty(0, np.int64)
    bar = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > bar)
    level = np.flatnonzero(scores == bar)[: k - len(above)]
    kept = np.concatenate([above, level])
    return kept[np.lexsort((ids[kept], -scores[kept]))]


OUT = "query long, query_id long, vec_id long, score long"


def _block_search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        """Scores of one block of queries against one block of candidates."""
        queries, candidates = left.sort_by("query"), right.sort_by("vec_id")
        ids, own, own_ids = candidates["vec_id"].to_numpy(), queries["query"].to_numpy(), queries["query_id"].to_numpy()
        place = {row: i for i, row in enumerate(candidates["row"].to_pylist())}
        found: list[tuple[np.ndarray, ...]] = []
        if len(ids) and len(own):
            postings = _postings(candidates["v"])
            query_terms = _postings(queries["q"])
            for start in range(0, len(own), QUERIES_AT_ONCE):
                size = min(QUERIES_AT_ONCE, len(own) - start)
                scores = np.zeros((size, len(ids)), np.int64)
                for term, (rows, weights) in query_terms.items():
                    a, b = np.searchsorted(rows, [start, start + size])
                    if a == b or term not in postings:
                        continue
                    at, held = postings[term]
                    whole = len(at) == len(ids)
                    for row, weight in zip(rows[a:b] - start, weights[a:b], strict=True):
                        if whole:  # every candidate holds the term: its postings are the array itself
                            scores[row] += weight * held
                        else:
                            scores[row, at] += weight * held
                for row in range(size):
                    best = _best(ids, scores[row], place.get(int(own[start + row]), -1), k)
                    same = lambda value: np.full(len(best), value)  # noqa: B023, E731
                    found.append((same(own[start + row]), same(own_ids[start + row]), ids[best], scores[row, best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "query_id", "vec_id", "score"])

    return search


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    *,
    candidate_rows: int = CANDIDATE_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k best candidates of each query: `query_id`, `rank` from 1, `vec_id`, `score`. Both sides as (row, vec_id, v) of one table."""
    candidate_blocks = max(1, -(-candidates.count() // candidate_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))
    block = lambda blocks: F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    right = candidates.select("row", "vec_id", "v", block(candidate_blocks).alias("cb"), each(query_blocks).alias("qb"))
    left = queries.select(
        F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), block(query_blocks).alias("qb"),
        each(candidate_blocks).alias("cb"),
    )
    ship_package(queries.sparkSession)
    scored = (
        left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInArrow(_block_search(k), OUT)
    )
    order = Window.partitionBy("query", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return scored.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def search_report(table: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """Query of the operator: rows whose id is divisible by `every` against all rows."""
    vectors = integer_vectors(table)
    return top_k(vectors.filter(F.col("vec_id") % every == 0), vectors, k)


SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::BIGINT AS score
  FROM usable q JOIN usable c ON q.row <> c.row WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY row, query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
