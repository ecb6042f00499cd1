"""Near-duplicates by SimHash.

Fingerprints are linked through a segment-popcount embedding: a fingerprint becomes the vector of bit
counts of its 16 four-bit segments. Two fingerprints at Hamming distance d have vectors at Manhattan
distance d at most, so only fingerprints whose vectors are that near can link.

The range join on the grid goes through the cell half way: two vectors at Manhattan distance 2 or less share a
cell within distance 1 of both. The exact check is made bit by bit in the same manner: two fingerprints at Hamming
distance 2 or less share a 64-bit value at distance 1 or less of both, and that value lies in a shared cell. So a
fingerprint is dealt, with each of the 65 values around it, to the value's own cell, and cells are cut by value.
Every distinct fingerprint has 65 rows at any size of the table, a value is near 65 fingerprints at most, no pairs
within a group are formed, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from appmetrics.functions.scratch import stage
from appmetrics.llm.batches import bound_batches
from appmetrics.llm.components import components

SEED = 42


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text in UTF-8, A-Z lower-cased.

    A bit is 1 if it is set in more than half the shingles' hashes, repeats included. A text with fewer words
    than a shingle is one shingle; a null text or one without words has fingerprint 0.
    """
    words = text.lower().split() if text else []  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle_words] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle_words - 1 :].tolist())), np.uint64, len(starts)
    )
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """(id, fingerprint bigint), one row per row of ``docs``; the bits of the fingerprint as a signed number."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            signed = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["id", "fingerprint"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint bigint")


def _counts(half: str) -> str:
    """Bit counts of the eight four-bit segments of a 32-bit number, four bits each."""
    pairs = f"(({half} & 1431655765L) + (shiftright({half}, 1) & 1431655765L))"
    return f"(({pairs} & 858993459L) + (shiftright({pairs}, 2) & 858993459L))"


def cell(value: str) -> str:
    """SQL of the segment bit counts of a 64-bit value, packed into one bigint."""
    return f"(shiftleft({_counts(f'shiftrightunsigned({value}, 32)')}, 32) | {_counts(f'({value} & 4294967295L)')})"


VALUES_AROUND = "concat(array(fingerprint), transform(sequence(0, 63), i -> fingerprint ^ shiftleft(1L, i)))"


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): enough pairs of fingerprints at Hamming distance 2 or less to connect all that are.

    ``distinct`` holds distinct values in a column ``fingerprint``.
    """
    dealt = distinct.selectExpr("fingerprint", f"explode({VALUES_AROUND}) AS value")
    cells = dealt.selectExpr("fingerprint", "value", f"{cell('value')} AS cell")
    # A value has 65 fingerprints around it at most.
    least = F.min("fingerprint").over(Window.partitionBy("cell", "value"))
    return cells.select(F.col("fingerprint").alias("a"), least.alias("b")).filter("a <> b")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """(id, fingerprint bigint, component) for every row of ``docs``.

    Rows whose fingerprints differ in 2 bits or fewer are linked; ``component`` is the smallest id reachable
    by links. Null and empty texts have fingerprint 0 and link like any other. Repeated rows stay and share
    their component; a null id never is a component's smallest id, unless all its ids are null. An empty table
    gives no rows.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    # Copies meet here, pre-aggregated in each task.
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("id").alias("first")), "distinct")
    roots = components(links(distinct))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").selectExpr(
        "fingerprint", "first", "coalesce(root, fingerprint) AS root"
    )
    rooted = stage(rooted, "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("first").alias("component")), "least")
    named = stage(rooted.join(least, "root").select("fingerprint", "component"), "named")
    # Both sides are plain scans, so a fingerprint that very many rows share is split by the adaptive join.
    return prints.join(named, "fingerprint").select("id", "fingerprint", "component")
