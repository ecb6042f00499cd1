"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on many directions. Vectors whose cosine reaches the threshold lie within a distance
t of each other, so their places on most directions are near: a pair collides in a direction if one lies in
the window around the other. Pairs that collide often enough are verified by their exact cosine. With as many
orthonormal directions as dimensions and windows of t / 4 to either side the number of misses is bounded by
15 (their squares add up to t squared), so no link is lost; with fewer directions the count is set so that
a pair at the threshold is missed once in ten million.

The first projection is sorted and cut into blocks of equal size, whatever is alike. Blocks further apart on it
than t cannot link; the others are compared two at a time. A block is one packed row, and a task pairs the blocks of
two parts of their table as it reads them: nothing is copied for a pair, so what is written and shuffled grows with the
vectors alone, while the comparisons grow with their square. Collisions are counted in bits, 64 vectors to a word. What a
task returns is the number of links of each vector and one edge per vector to its group, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from appmetrics.functions.scratch import stage
from appmetrics.llm.batches import bound_batches
from appmetrics.llm.components import components
from appmetrics.llm.vectors import directions, matrix, usable

DIRECTIONS = 64
WINDOW_STEPS = 20  # a window's half width in steps of the rounded projections
BLOCK_ROWS = 2048
CHUNK_ROWS = 256
MISSED = 1e-7
SEED = 9


def calibration(dimension: int, threshold: float, count: int = DIRECTIONS) -> tuple[int, float, int]:
    """(directions, half width of a window, collisions needed) for pairs with a cosine of ``threshold`` or more."""
    reach = sqrt(max(2 - 2 * threshold, 1e-12))
    used = min(dimension, count)
    width = 2 * reach / sqrt(used) if used == dimension else 2 * reach / sqrt(dimension)
    if used == dimension:
        # Misses are above the width, their squares sum to reach squared at most.
        return used, width, used - (floor(reach**2 / width**2 + 1e-9) - 1 if used > 4 else used)
    hit, total, need = 0.9545, 0.0, 0
    for n in range(used + 1):
        total += comb(used, n) * hit**n * (1 - hit) ** (used - n)
        if total > MISSED:
            need = n
            break
    return used, width, need


def places(unit: np.ndarray, planes: np.ndarray, width: float) -> np.ndarray:
    """Rounded projections of unit vectors, modulo 256."""
    return np.floor((unit @ planes.T + 1) * (WINDOW_STEPS / width)).astype(np.int64).astype(np.uint8)


def missed_by(at: np.ndarray) -> np.ndarray:
    """For each direction and each place, a bit for each row of ``at``: whether the two are not in each other's windows."""
    reach, every = WINDOW_STEPS + 1, np.arange(256, dtype=np.uint8)[:, None]
    bits = np.zeros((at.shape[1], 256, -(-len(at) // 64) * 8), np.uint8)
    for j in range(at.shape[1]):
        bits[j, :, : -(-len(at) // 8)] = np.packbits((every + np.uint8(reach) - at[None, :, j]) > 2 * reach, axis=1, bitorder="little")
    return bits.view(np.uint64)


def often(table: np.ndarray, at: np.ndarray, misses: int) -> np.ndarray:
    """A bit for each row of ``at`` and each of ``table`` (``missed_by``): whether they miss in ``misses`` directions at most.

    Each level of ``sums`` is a binary digit of the counts of all pairs; a level adds two rows of bits at a time and
    hands on what it carries. Counts start so that one miss too many carries out of the last level.
    """
    levels, shape = max(1, misses.bit_length()), (len(at), table.shape[2])
    start, full = 2**levels - 1 - misses, ~np.uint64(0)
    sums = [np.full(shape, full if start >> k & 1 else np.uint64(0)) for k in range(levels)]
    held: list[np.ndarray | None] = [None] * levels
    over, spare = np.zeros(shape, np.uint64), np.empty(shape, np.uint64)
    for j in range(len(table)):
        bits = table[j].take(at[:, j], axis=0)
        for k in range(levels):
            if held[k] is None:
                held[k] = bits
                break
            total, other, held[k] = sums[k], held[k], None
            np.bitwise_xor(total, other, out=spare)
            total &= other
            np.bitwise_and(spare, bits, out=other)
            total |= other
            spare ^= bits
            sums[k], bits, spare = spare, total, other
        else:
            over |= bits
    carried: list[np.ndarray] = []
    for k in range(levels):
        adding, carried = [*carried, *([] if held[k] is None else [held[k]])], []
        for bits in adding:
            carried.append(sums[k] & bits)
            sums[k] = sums[k] ^ bits
    for bits in carried:
        over |= bits
    return ~over


def linked(a: np.ndarray, b: np.ndarray, planes: np.ndarray, width: float, need: int, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (unit vectors) have a cosine of ``threshold`` or more."""
    return _linked(a, b, missed_by(places(a, planes, width)), places(b, planes, width), len(planes) - need, threshold)


def _linked(a: np.ndarray, b: np.ndarray, table: np.ndarray, at_b: np.ndarray, misses: int, threshold: float) -> np.ndarray:
    found = np.zeros((len(a), len(b)), bool)
    for at in range(0, len(b), CHUNK_ROWS):
        near = often(table, at_b[at : at + CHUNK_ROWS], misses)
        some = np.flatnonzero(near.any(axis=1))
        if len(some):
            met = np.unpackbits(near[some].view(np.uint8), axis=1, count=len(a), bitorder="little").view(bool)
            rows = np.flatnonzero(met.any(axis=0))
            inside = np.ix_(rows, at + some)
            found[inside] = (a[rows] @ b[at + some].T >= threshold) & met[:, rows].T
    return found


def groups(found: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Smallest row number reachable, for rows and columns of a table of links.

    Columns are the rows themselves if ``same`` (the table is symmetric then), else they count on after the rows.
    """
    n = len(found)
    rows, columns = np.arange(n), np.arange(found.shape[1]) + (0 if same else n)
    used_rows, used_columns = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
    part = found[np.ix_(used_rows, used_columns)]
    if part.size:
        most = n + found.shape[1]
        while True:
            new_columns = np.minimum(columns[used_columns], np.where(part, rows[used_rows][:, None], most).min(axis=0))
            new_rows = np.minimum(rows[used_rows], np.where(part, new_columns[None, :], most).min(axis=1))
            if same:
                new_rows = new_columns = np.minimum(new_rows, new_columns)
            if (new_columns == columns[used_columns]).all() and (new_rows == rows[used_rows]).all():
                break
            columns[used_columns], rows[used_rows] = new_columns, new_rows
    return rows, columns


def vector_links(
    table: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, n_links, component, kept) for every id of ``table``.

    ``n_links``: other vectors whose cosine with this one, in double precision, is at least ``threshold``;
    ``component``: the smallest id reachable by links; ``kept``: whether that is the id itself.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors of
    different lengths do not link. Rows that share an id count as one vector (the least usable one); a null id has a
    row of its own with null component. An empty table gives no rows.
    """
    # Vectors of floats stay floats in the folder, at half the size.
    kind = table.schema[vector_col].dataType
    kept = "array<float>" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "array<double>"
    rows = stage(usable(table, id_col, vector_col).selectExpr("id", f"cast(vector AS {kept}) AS vector", "size(vector) AS length"), "vectors")
    lengths = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    edges = None
    for length, count in sorted(lengths.items()):
        part = _block_links(rows.filter(F.col("length") == length).drop("length"), length, count, threshold, block_rows)
        edges = part if edges is None else edges.unionAll(part)
    ids = table.select(F.col(id_col).cast("bigint").alias("id")).distinct()
    if edges is None:
        return ids.selectExpr("id", "0L AS n_links", "id AS component", "id IS NOT NULL AS kept")
    edges = stage(edges, "links")
    counts = stage(edges.groupBy("id").agg(F.sum("links").alias("links")), "counts")
    roots = stage(components(edges, "id", "root"), "roots")
    return (
        ids.join(counts, "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .selectExpr("id", "coalesce(links, 0L) AS n_links", "coalesce(root, id) AS component")
        .selectExpr("id", "n_links", "component", "coalesce(id = component, false) AS kept")
    )


def _block_links(rows: DataFrame, length: int, count: int, threshold: float, block_rows: int) -> DataFrame:
    """(id, links, root): links found in each comparison of two blocks, and a member of the same group."""
    used, width, need = calibration(length, threshold)
    planes = directions(length, used, SEED)
    kind = np.float32 if isinstance(rows.schema["vector"].dataType.elementType, FloatType) else np.float64

    def units(vectors: np.ndarray) -> np.ndarray:
        doubles = vectors.astype(np.float64)
        return doubles / np.sqrt((doubles**2).sum(axis=1))[:, None]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of ``along`` as blocks; the first id names a block."""
        held: list[tuple[np.ndarray, ...]] = []

        def packed(ids, vectors, along):
            at = places(units(vectors), planes, width)
            cells = [[ids[0]], [along.min()], [along.max()], *([x.tobytes()] for x in (ids, vectors, at))]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["block", "low", "high", "ids", "vectors", "places"])

        for batch in batches:
            held.append((np.asarray(batch["id"]), matrix(batch["vector"]).astype(kind), np.asarray(batch["along"])))
            if sum(len(h[0]) for h in held) >= block_rows:
                whole = [np.concatenate(c) for c in zip(*held)]
                full = len(whole[0]) // block_rows * block_rows
                for i in range(0, full, block_rows):
                    yield packed(*[c[i : i + block_rows] for c in whole])
                held = [tuple(c[full:] for c in whole)]
        if sum(len(h[0]) for h in held):
            yield packed(*[np.concatenate(c) for c in zip(*held)])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, unit_a, table = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                ids = [np.frombuffer(r[f"ids_{s}"], np.int64) for s in "ab"]
                vectors = [np.frombuffer(r[f"vectors_{s}"], kind).reshape(-1, length) for s in "ab"]
                if r["block_a"] != last:  # a task's pairs come with the same first block one after the other
                    last, unit_a = r["block_a"], units(vectors[0])
                    table = missed_by(np.frombuffer(r["places_a"], np.uint8).reshape(-1, used))
                same = r["block_a"] == r["block_b"]
                unit_b = unit_a if same else units(vectors[1])
                found = _linked(unit_a, unit_b, table, np.frombuffer(r["places_b"], np.uint8).reshape(-1, used), used - need, threshold)
                if same:
                    found |= found.T
                    np.fill_diagonal(found, False)
                if not found.any():
                    continue
                at_rows, at_columns = groups(found, same)
                both = ids[0] if same else np.concatenate(ids)
                parts = [(ids[0], found.sum(axis=1), both[at_rows])]
                if not same:
                    parts.append((ids[1], found.sum(axis=0), both[at_columns]))
                got = [np.concatenate([p[i][p[1] > 0] for p in parts]).astype(np.int64) for i in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(g) for g in got], ["id", "links", "root"])

    norm = "sqrt(aggregate(double_, 0D, (s, x) -> s + x * x))"
    first = ", ".join(f"{w!r}D" for w in planes[0].tolist())
    along = f"aggregate(zip_with(double_, array({first}), (x, w) -> x * w), 0D, (s, x) -> s + x) / {norm}"
    placed = rows.selectExpr("id", "vector", "cast(vector AS array<double>) AS double_").selectExpr("id", "vector", f"{along} AS along")
    # As many parts as tasks can take side by side, but with several blocks in each where there are many.
    side_by_side = 2 * rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-count // block_rows), max(side_by_side, count // (8 * block_rows))))
    sorted_ = placed.repartitionByRange(parts, "along", "id").sortWithinPartitions("along", "id")
    bound_batches(rows.sparkSession)
    blocks = stage(sorted_.mapInArrow(pack, "block bigint, low double, high double, ids binary, vectors binary, places binary"), "blocks")
    # Blocks further apart than the reach cannot link. Pairs are formed where the two parts are read, without a shuffle.
    reach = sqrt(2 - 2 * threshold) + 1e-6
    a, b = (blocks.select(*[F.col(c).alias(f"{c}_{s}") for c in blocks.columns]) for s in "ab")
    near = f"block_a <= block_b AND low_b <= high_a + {reach!r}D AND low_a <= high_b + {reach!r}D"
    pairs = a.join(b, F.expr(near)).select("block_a", "ids_a", "vectors_a", "places_a", "block_b", "ids_b", "vectors_b", "places_b")
    return pairs.mapInArrow(compare, "id bigint, links bigint, root bigint")
