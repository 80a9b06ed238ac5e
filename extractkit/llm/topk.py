"""Exact top-k inner products by columnar branch and bound.

Vectors are cut into blocks of rows, and each block of queries meets each block of candidates
in one task, so no task holds more than two blocks and nothing is broadcast.  There the
candidates lie dimension by dimension.  Dimensions are taken in blocks, those with most mass
first; after each, a candidate's score lies between its partial sum minus and plus the product of
what is left of the two norms.  The k-th best lower bound is the bar of a query, and
candidates whose upper bound stays below it are dropped from its columns.  Those left at the
end have exact scores.  The best k of each block go on, and the best k of all blocks are the
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from extractkit.llm.common import stored

QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 16_384
DIMENSIONS = 8
#: Whole numbers up to this are exact as doubles.
_EXACT = 2.0**52


def quantised(vector: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of each component as long; null for a null vector or one with a null or non-finite component."""
    values = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(values, lambda x: F.floor(x * scale)))


def search_block(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """``(query_id, vec_id, score)`` of each query's best ``k`` in this block, ties to the smaller id.

    Sums are whole numbers in doubles, exact below 2 ** 52; larger ones are kept as Python
    integers.
    """
    columns = np.ascontiguousarray(candidates.T)
    order = np.argsort(-(columns.astype(float) ** 2).sum(axis=1), kind="stable")
    columns, queries = columns[order], queries[:, order]
    starts = range(0, len(columns), DIMENSIONS)
    mass = (columns.astype(float) ** 2, queries.astype(float).T ** 2)
    left, own = (np.sqrt(np.vstack([m[s:].sum(axis=0) for s in starts] + [np.zeros(m.shape[1])])) for m in mass)
    exact = left.max(initial=0) * own.max(initial=0) < _EXACT if len(columns) else True
    if exact:
        columns, queries = columns.astype(float), queries.astype(float)
    else:
        columns, queries = columns.astype(object), queries.astype(object)
    found = []
    first = queries[:, :DIMENSIONS] @ columns[:DIMENSIONS] if len(columns) else np.zeros((len(queries), candidates.shape[0]))
    for q, (row, query_id) in enumerate(zip(queries, query_ids)):
        at = np.flatnonzero(ids != query_id)
        sums = first[q][at]
        for block, start in enumerate(starts):
            if block:
                sums = sums + row[start : start + DIMENSIONS] @ columns[start : start + DIMENSIONS, at]
            if at.size > k:
                slack = left[block + 1][at] * own[block + 1][q] * (1 + 1e-9) + (1 if exact else abs(float(sums.max())) * 1e-9 + 1)
                lower = sums.astype(float) - slack
                bar = np.partition(lower, at.size - k)[at.size - k]
                stays = sums.astype(float) + slack >= bar
                at, sums = at[stays], sums[stays]
        best = sorted(zip((-sums).tolist(), ids[at].tolist()))[:k] if at.size <= 4 * k else _best(sums, ids[at], k)
        found += [(int(query_id), vec_id, int(-score)) for score, vec_id in best]
    return found


def _best(sums: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    order = np.lexsort((ids, -sums))[:k] if sums.dtype != object else sorted(range(len(ids)), key=lambda i: (-sums[i], ids[i]))[:k]
    return [(-sums[i], int(ids[i])) for i in order]


def _meet(k: int):
    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        ids = group.column("vec_id").to_numpy()
        column = group.column("values").combine_chunks()
        values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        asks, ids, values = asks[order], ids[order], values[order]
        found = search_block(values[asks], ids[asks], values[~asks], ids[~asks], k)
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best integer inner products of each query row.

    ``vectors`` has ``vec_id`` and ``values`` (longs).  Rows with a null id or null values take
    no part.  Only vectors of the query's length are its candidates, and never a row of its
    own id.  Every row of a repeated id counts, as a candidate and as a query; queries of one id share
    their ranks.  Equal scores go to the smaller id.  No rows or no queries give no rows; other columns are ignored.
    """
    rows = vectors.where("vec_id is not null and values is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "values", F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")  # rows of one id are dealt apart
    counted = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks = [max(1, -(-n // size)) for n, size in zip(counted, (CANDIDATE_BLOCK, QUERY_BLOCK))]
    sized = rows.withColumn("dims", F.size("values"))

    def dealt(mine: int, others: int, own: str, other: str) -> list[Column]:
        place = F.pmod(F.xxhash64("row", F.lit(mine)), F.lit(mine)).alias(own)
        return ["dims", "vec_id", "values", place, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other)]

    asking = sized.where("asks").select(*dealt(blocks[1], blocks[0], "q", "c"), F.lit(True).alias("asks"))
    asked = sized.select(*dealt(blocks[0], blocks[1], "c", "q"), F.lit(False).alias("asks"))
    met = asking.unionByName(asked).groupBy("dims", "q", "c").applyInArrow(_meet(k), "query_id long, vec_id long, score long")
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
