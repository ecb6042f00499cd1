"""Vector compression by codebooks of whole numbers, with exact distances.

A vector of whole numbers is cut into equal parts, and each part is replaced by the index of the nearest entry of that
part's codebook. The products that distances need are made by the floating-point matrix product, exactly: integers
are split into limbs so small that no sum of products of limbs reaches 2^53, and the products of limbs are put
together again in 64-bit integers. The first least distance wins.

The rows are read once for every round. What a task returns, and what travels to the driver, is one sum for each entry
of the codebooks (``ENTRIES`` by parts), whatever the number of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from appmetrics.functions.scratch import stage
from appmetrics.llm.vectors import floored, whole_matrix

ENTRIES = 256
PARTS = 4
ROUNDS = 4
#: Rows whose distances to all entries are held at once.
SLICE = 4096


def limb_bits(width: int) -> int:
    """Bits of a balanced limb (from -2^(b-1) to 2^(b-1)): ``width`` products of two stay below 2^53 in sum."""
    return (52 - (max(width, 1) - 1).bit_length()) // 2 + 1


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Doubles l0, l1, ... with values = l0 + l1 * 2^bits + ...; as many as the largest value needs."""
    half, out = 1 << (bits - 1), []
    rest = values
    while not out or rest.any():
        low = ((rest + half) & ((1 << bits) - 1)) - half
        out.append(low.astype(np.float64))
        rest = (rest - low) >> bits
    return out


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y.T of integers, exactly, by products of doubles. The caller sees to it that sums fit 64 bits."""
    bits = limb_bits(x.shape[1])
    total = np.zeros((len(x), len(y)), np.int64)
    others = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(others):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def squares(rows: np.ndarray) -> np.ndarray:
    """Squared lengths; an error where distances could pass 64 bits."""
    if len(rows) and (rows.astype(np.float64) ** 2).sum(axis=1).max() >= 2.0**60:
        raise ValueError("components are too large: squared lengths must be below 2^60")
    return (rows * rows).sum(axis=1)


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of each row's nearest entry, the first of equals, and the squared distance."""
    found, least = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    theirs = squares(entries)
    for at in range(0, len(part), SLICE):
        rows = part[at : at + SLICE]
        distance = squares(rows)[:, None] + theirs - 2 * exact_products(rows, entries)
        found[at : at + SLICE] = np.argmin(distance, axis=1)
        least[at : at + SLICE] = distance.min(axis=1)
    return found, least


def _sums(part: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Used entries, the rows of each and the sums of their components."""
    order = np.argsort(entry, kind="stable")
    used, first, n = np.unique(entry[order], return_index=True, return_counts=True)
    return used, n, np.add.reduceat(part[order], first, axis=0)


class Codebooks:
    """(part, entry, position) whole numbers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def cut(self, column) -> np.ndarray:
        """(part, row, position) of an Arrow column of vectors."""
        parts = len(self.entries)
        return whole_matrix(column, parts * self.width).reshape(-1, parts, self.width).transpose(1, 0, 2)

    def digest(self) -> str:
        """SHA-256 of all components, by part, entry and position, in decimal and joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def improved(self, rows: DataFrame) -> Codebooks:
        """Each entry replaced by the componentwise floor of the mean of the parts nearest to it."""

        def run(batches):
            totals: dict[tuple[int, int], list] = {}
            for batch in batches:
                for p, part in enumerate(self.cut(batch.column("vector"))):
                    for e, n, s in zip(*_sums(part, nearest(part, self.entries[p])[0])) if len(part) else ():
                        held = totals.setdefault((p, int(e)), [0, 0])
                        held[0], held[1] = held[0] + int(n), held[1] + s.astype(object)
            if totals:
                yield pa.RecordBatch.from_pylist(
                    [{"part": p, "entry": e, "n": n, "sums": [str(v) for v in s]} for (p, e), (n, s) in totals.items()],
                    pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))]),
                )

        made = rows.select("vector").mapInArrow(run, "part int, entry int, n bigint, sums array<string>")
        components = [F.expr(f"sum(cast(sums[{j}] AS decimal(38, 0)))").alias(f"s{j}") for j in range(self.width)]
        after = self.entries.copy()
        for r in made.groupBy("part", "entry").agg(F.sum("n").alias("n"), *components).collect():
            after[r["part"], r["entry"]] = [int(r[f"s{j}"]) // r["n"] for j in range(self.width)]
        return Codebooks(after)

    def encode(self, rows: DataFrame) -> DataFrame:
        """(id, label, code, error) of rows (id, label, vector)."""
        kept = [f for f in rows.schema.fields if f.name in ("id", "label")]

        def run(batches):
            for batch in batches:
                found = [nearest(part, entries) for part, entries in zip(self.cut(batch.column("vector")), self.entries)]
                digits = np.stack([f for f, _ in found], axis=1).astype(np.uint8)
                codes = pa.array([d.tobytes().hex() for d in digits], pa.string())
                errors = pa.array(sum(e for _, e in found), pa.int64())
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], codes, errors], [*[f.name for f in kept], "code", "error"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
        return rows.select(*[f.name for f in kept], "vector").mapInArrow(run, f"{schema}, code string, error bigint")


def compress(
    table: DataFrame,
    scale: int = 1024,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code, error, label_error), one row per usable row of ``table``, and the codebooks.

    Components become floor(scale * x). Vectors that are null, empty or hold null or non-finite components are left
    out; so are those of another length than the usable vector with the least id, whose length ``parts`` must divide.
    Rows that share an id are separate. The codebooks start as the ``entries`` (256 at most) first vectors by id, then
    by vector, null ids last; a table with fewer has smaller codebooks. ``code`` has two hex digits for each part;
    ``label_error`` is the sum of ``error`` over equal labels, nulls together. An empty table gives no rows and no
    codebooks. Components so large that a squared length passes 2^60 raise an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    rows = stage(floored(table, vector_col, scale, id=id_col, label=label_col), "whole")
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").select("vector")
    least = first.limit(1).collect()
    if not least:
        return rows.selectExpr("id", "label", "cast(NULL AS string) AS code", "0L AS error", "0L AS label_error"), None
    length = len(least[0]["vector"])
    if length % parts:
        raise ValueError(f"vectors of {length} components have no {parts} equal parts")
    even = F.size("vector") == length
    start = np.array([r["vector"] for r in first.filter(even).limit(entries).collect()], np.int64)
    books = Codebooks(start.reshape(len(start), parts, -1).transpose(1, 0, 2))
    rows = rows.filter(even)
    for _ in range(rounds):
        books = books.improved(rows)
    coded = stage(books.encode(rows), "coded")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # Both sides are plain: a label that very many rows share is split by the adaptive join.
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books
