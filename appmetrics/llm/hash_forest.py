"""Approximate nearest neighbours with a forest of hash prefixes.

Each tree gives a vector a long string of bits: on which side of random planes it lies. A tree is the array of its
strings in order, so the vectors that share a prefix with a query stand in a row. A search descends in every
tree to the longest prefix that any vector shares with the query, then ascends in all trees at once, one bit
at a time, until the vectors met are enough, the query's own id apart; these are measured exactly.

The vectors are dealt to blocks by a hash of their id, a forest over each, so the index of all rows is built
and searched in parallel with bounded memory, whatever is alike in them. Queries go to all blocks, in batches; a
block returns its nearest few for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from appmetrics.functions.scratch import stage
from appmetrics.llm.vectors import directions, matrix, usable

TREES = 64
BITS = 32
#: Vectors met before the ascent ends, as a share of the block: counted in each tree, so one may count often. So
#: many different ones as are asked for, or all of the block, are met in any case.
SHARE = 0.8
#: The planes go through the middle of a sample of this many vectors, those with the least hash of their id.
SAMPLE = 4096
#: Vectors of a block and queries of a batch, fewer where these many would pass ``BLOCK_BYTES``. They depend on nothing
#: else, so neither do the neighbours found.
BLOCK_ROWS = 2048
QUERY_ROWS = 4096
BLOCK_BYTES = 32 << 20
SEED = 1


class Forest:
    """Sorted arrays of hash strings over some vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, planes: np.ndarray, middles: np.ndarray, trees: int):
        self.ids, self.rows, self.planes, self.middles, self.trees = ids, rows, planes, middles, trees
        self.bits = len(planes) // trees
        codes = self.strings(rows)
        self.codes = codes
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def strings(self, rows: np.ndarray) -> np.ndarray:
        """(tree, row) -> bits, the first one highest."""
        places = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        made = np.empty((self.trees, len(rows)), np.uint64)
        for t in range(self.trees):
            part = slice(t * self.bits, (t + 1) * self.bits)
            made[t] = (rows @ self.planes[part].T > self.middles[part]) @ places
        return made

    def intervals(
        self, queries: np.ndarray, enough: int, query_ids: np.ndarray | None = None, k: int = 0
    ) -> tuple[np.ndarray, np.ndarray]:
        """(tree, query) -> first and end place of what shares the query's prefix, all trees at one length.

        The length is the greatest at which ``enough`` entries of ``k`` different vectors are met in all trees
        together, or all there are. A vector with the query's id counts as neither.
        """
        codes = self.strings(queries)
        low, high = np.zeros(codes.shape, np.int64), np.zeros(codes.shape, np.int64)
        own = np.full(len(queries), -1) if query_ids is None else self.places(query_ids)
        others = len(self.ids) - (own >= 0)
        entries, different = np.minimum(enough, others * self.trees), np.minimum(k, others)
        open_ = np.arange(len(queries))
        for cut in range(self.bits + 1):  # bits not compared: the descent's end first
            prefix = codes[:, open_] >> np.uint64(cut) << np.uint64(cut)
            beyond = prefix + (np.uint64(1) << np.uint64(cut))
            for t in range(self.trees):
                low[t, open_] = np.searchsorted(self.sorted[t], prefix[t])
                high[t, open_] = np.searchsorted(self.sorted[t], beyond[t])
            met = (high[:, open_] - low[:, open_]).sum(axis=0)
            mine = self.codes[:, own[open_]]
            met -= ((own[open_] >= 0) & (mine >= prefix) & (mine < beyond)).sum(axis=0)
            short = met < entries[open_]
            # A vector has one entry in a tree at most, so more entries need no count of vectors.
            for i in np.flatnonzero(~short & (met <= (different[open_] - 1) * self.trees)):
                found = self.met(low[:, open_[i]], high[:, open_[i]], own[open_[i]])
                short[i] = found.sum() < different[open_[i]]
            open_ = open_[short]
            if not len(open_):
                break
        return low, high

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The row of each id, -1 if it has none."""
        order = np.argsort(self.ids, kind="stable")
        at = np.minimum(np.searchsorted(self.ids[order], ids), len(order) - 1)
        return np.where(self.ids[order[at]] == ids, order[at], -1)

    def met(self, low: np.ndarray, high: np.ndarray, own: int) -> np.ndarray:
        """Which rows stand between the places of each tree, without the row ``own``."""
        met = np.zeros(len(self.ids), bool)
        for t in range(self.trees):
            met[self.order[t, low[t] : high[t]]] = True
        if own >= 0:
            met[own] = False
        return met

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float):
        """(query id, id, distance) of the nearest found, by exact distance, ties to the smaller id."""
        enough = max(int(np.ceil(share * len(self.ids))), 4 * k)
        low, high = self.intervals(queries, enough, query_ids, k)
        own = self.places(query_ids)
        for q in range(len(queries)):
            found = np.flatnonzero(self.met(low[:, q], high[:, q], own[q]))
            distance = np.sqrt(((self.rows[found] - queries[q]) ** 2).sum(axis=1))
            best = np.lexsort((self.ids[found], distance))[:k]
            yield from ((query_ids[q], self.ids[found[b]], distance[b]) for b in best)


def search(
    table: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    share: float = SHARE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest vectors found, by Euclidean distance.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, on either side; nor
    do null ids. Rows that share an id count as one. A query never finds its own id, and finds only vectors of its own
    length. With ``k`` candidates or fewer it finds all; an empty table gives no rows. Ids are whole numbers.
    """
    spark = table.sparkSession
    rows = stage(usable(table, id_col, vector_col).withColumn("length", F.size("vector")), "vectors")
    asked = stage(usable(queries, id_col, vector_col).withColumn("length", F.size("vector")), "queries")
    lengths = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {r["length"]: r["n"] for r in asked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "query_id bigint, vec_id bigint, score double"
    found = None
    for length in sorted(set(lengths) & set(wanted)):
        most = max(BLOCK_BYTES // (8 * length), 1)
        blocks = -(-lengths[length] // min(block_rows, most))
        batches = -(-wanted[length] // min(QUERY_ROWS, most))
        near = _search_blocks(rows.filter(F.col("length") == length), asked.filter(F.col("length") == length), length, blocks, batches, k, trees, share, schema)
        found = near if found is None else found.unionAll(near)
    if found is None:
        found = spark.range(0).selectExpr("id AS query_id", "id AS vec_id", "0D AS score")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search_blocks(rows, asked, length, blocks, batches, k, trees, share, schema) -> DataFrame:
    planes = directions(length, trees * BITS, SEED)
    sample = np.array([r["vector"] for r in rows.orderBy(F.xxhash64("id")).limit(SAMPLE).select("vector").collect()], float)
    middles = np.median(sample @ planes.T, axis=0)
    deal = f"cast(pmod(xxhash64(id), {blocks}) AS int)"
    both = rows.selectExpr("id", "vector", "false AS asks", f"{deal} AS block", f"explode(sequence(0, {batches - 1})) AS batch").unionAll(
        asked.selectExpr("id", "vector", "true AS asks", f"cast(pmod(xxhash64(id, 1), {batches}) AS int) AS batch", f"explode(sequence(0, {blocks - 1})) AS block")
        .select("id", "vector", "asks", "block", "batch")
    )

    def run(group: pa.Table) -> pa.Table:
        asks = np.asarray(group["asks"])
        ids, points = np.asarray(group["id"]), matrix(group["vector"])
        made = []
        if asks.any() and not asks.all():
            forest = Forest(ids[~asks], points[~asks], planes, middles, trees)
            made = list(forest.nearest(ids[asks], points[asks], k, share))
        q, v, s = zip(*made) if made else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    return both.groupBy("block", "batch").applyInArrow(run, schema)
