"""Exact search of the largest inner products by pivot-table elimination.

The vectors hold whole numbers. Each has a row in the pivot table: its distances to ``PIVOTS`` pivots, written once.
By the triangle inequality the largest difference of two rows of the table is a lower bound of the distance of their
vectors, and as 2 <q, x> = |q|^2 + |x|^2 - |q - x|^2, an upper bound of their inner product. A query takes candidates
in the order of that bound and stops as soon as the next bound is below its k-th best score: nothing left can
enter. The scores of the pivots themselves, known beforehand, keep most blocks from starting at nothing.

Candidates are dealt to blocks by a hash of their id and queries to batches, both of bounded size, and each
block meets each batch in one task: the stated queries against all rows, in blocks. A block returns its k best for
each query, so the result is the same for any number of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from appmetrics.functions.scratch import stage
from appmetrics.llm.vectors import floored, whole_matrix

PIVOTS = 32
#: Pivots are chosen among this many vectors, those with the least hash of their id. Any choice gives the same result.
SAMPLE = 4096
#: Bytes of the vectors and pivot distances of a block, and of a batch of queries.
BLOCK_BYTES = 8 << 20
#: Squared lengths stay below this, so that scores and squared distances fit 64 bits.
LONGEST = 1 << 60
EXACT = 1 << 53


def far_apart(rows: np.ndarray, count: int) -> np.ndarray:
    """Places of ``count`` rows, each as far as can be from those before it; the first is the longest."""
    points = rows.astype(np.float64)
    places, nearest = [], np.full(len(rows), np.inf)
    at = int(np.argmax((points**2).sum(axis=1)))
    while len(places) < min(count, len(rows)):
        places.append(at)
        nearest = np.minimum(nearest, ((points - points[at]) ** 2).sum(axis=1))
        nearest[places] = -1.0
        at = int(np.argmax(nearest))
    return np.array(places, np.int64)


def squares(rows: np.ndarray) -> np.ndarray:
    """Squared lengths; an error where they or scores could pass 64 bits."""
    if len(rows) and (rows.astype(np.float64) ** 2).sum(axis=1).max() >= LONGEST:
        raise ValueError("components are too large: squared lengths must be below 2^60")
    return (rows * rows).sum(axis=1)


def products(rows: np.ndarray, query: np.ndarray, longest: int) -> np.ndarray:
    """Exact inner products: in doubles where no sum can pass 2^53, else in 64-bit integers."""
    if longest < EXACT:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return rows @ query


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(row, pivot) -> distance; the squared distance is exact."""
    own, theirs = squares(rows), squares(pivots)
    if max(own.max(initial=0), theirs.max(initial=0)) < EXACT:
        product = (rows.astype(np.float64) @ pivots.astype(np.float64).T).astype(np.int64)
    else:
        product = rows @ pivots.T
    return np.sqrt(own[:, None] + theirs - 2 * product)


def best_of_block(query_id, query, query_row, ids, rows, lengths, table, pivot_ids, pivots, k):
    """(places, scores, measured): the block's ``k`` best rows for a query, best first; how many were measured."""
    length = int(query @ query)
    longest = max(length, int(lengths.max(initial=0)), 1)
    own = products(pivots, query, max(longest, int(squares(pivots).max(initial=0))))[pivot_ids != query_id]
    least = int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else None
    lower = np.abs(table - query_row[:, None]).max(axis=0)
    sums = length + lengths.astype(np.float64)
    # The slack is far above the rounding of distances, so no bound is below its score.
    bound = (sums - lower * lower) / 2 + 1e-9 * (sums + query_row.max() ** 2) + 1
    open_ = ids != query_id
    if least is not None:
        open_ &= bound >= least
    left = np.flatnonzero(open_)
    left = left[np.argsort(-bound[left], kind="stable")]
    found, scores, at, step = left[:0], np.zeros(0, np.int64), 0, max(64, 4 * k)
    while at < len(left):
        if len(scores) == k:
            worst = int(scores[-1])
            if bound[left[at]] < worst:
                break
        part = left[at : at + step]
        at, step = at + len(part), 2 * step
        found = np.concatenate((found, part))
        scores = np.concatenate((scores, products(rows[part], query, longest)))
        best = np.lexsort((ids[found], -scores))[:k]
        found, scores = found[best], scores[best]
    return found, scores, at


def search(
    table: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products of floor(scale * vector).

    The result is exact; equal scores go to the smaller id. Vectors that are null, empty or hold null or non-finite
    components take no part, on either side; nor do null ids; zero vectors do. Rows that share an id count as one,
    the least vector. A query never finds its own id, and finds only vectors of its own length. With fewer than ``k``
    candidates it finds all; an empty table gives no rows. Ids are whole numbers. Components so large that a squared
    length passes 2^60 raise an error.
    """
    spark = table.sparkSession

    def one_by_id(rows):
        rows = floored(rows, vector_col, scale, id=id_col).filter("id IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
        return rows.withColumn("length", F.size("vector"))

    rows, asked = stage(one_by_id(table), "vectors"), stage(one_by_id(queries), "queries")

    def sizes(part):
        return {r["length"]: r["n"] for r in part.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}

    stored, wanted = sizes(rows), sizes(asked)
    found = spark.range(0).selectExpr("id AS query_id", "id AS vec_id", "id AS score")
    for length in sorted(set(stored) & set(wanted)):
        most = max(1, block_bytes // (8 * (length + pivots)))
        blocks, batches = -(-stored[length] // most), -(-wanted[length] // most)
        of_length = F.col("length") == length
        found = found.unionAll(_searched(rows.filter(of_length), asked.filter(of_length), length, blocks, batches, k, pivots))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searched(rows: DataFrame, asked: DataFrame, length: int, blocks: int, batches: int, k: int, count: int) -> DataFrame:
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "vector").collect()
    points = np.array([r["vector"] for r in sample], np.int64)
    places = far_apart(points, count)
    pivot_ids, pivots = np.array([sample[i]["id"] for i in places], np.int64), points[places]

    def measure(batches):
        for batch in batches:
            made = distances(whole_matrix(batch.column("vector"), length), pivots)
            offsets = np.arange(0, made.size + 1, len(pivots), dtype=np.int32)
            row = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), row], ["id", "vector", "row"])

    def with_row(part, name):
        return stage(part.select("id", "vector").mapInArrow(measure, "id bigint, vector array<bigint>, row array<double>"), name)

    both = with_row(rows, "pivot-table").selectExpr(
        "id", "vector", "row", "false AS asks", f"cast(pmod(xxhash64(id), {blocks}) AS int) AS block", f"explode(sequence(0, {batches - 1})) AS batch"
    ).unionAll(
        with_row(asked, "asked").selectExpr(
            "id", "vector", "row", "true AS asks", f"cast(pmod(xxhash64(id, 1), {batches}) AS int) AS batch", f"explode(sequence(0, {blocks - 1})) AS block"
        ).select("id", "vector", "row", "asks", "block", "batch")
    )

    def run(group: pa.Table) -> pa.Table:
        asks, ids = np.asarray(group["asks"]), np.asarray(group["id"])
        vectors = whole_matrix(group["vector"], length)
        table = np.asarray(group["row"].combine_chunks().flatten(), np.float64).reshape(len(ids), -1)
        stored, held, across = ids[~asks], vectors[~asks], np.ascontiguousarray(table[~asks].T)
        lengths = squares(held)
        made = [(np.zeros(0, np.int64),) * 3]
        for q in np.flatnonzero(asks):
            at, scores, _ = best_of_block(ids[q], vectors[q], table[q], stored, held, lengths, across, pivot_ids, pivots, k)
            made.append((np.full(len(at), ids[q]), stored[at], scores))
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*made)], names=["query_id", "vec_id", "score"])

    return both.groupBy("block", "batch").applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
