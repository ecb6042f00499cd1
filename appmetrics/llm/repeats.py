"""Substring dedup: word passages that occur more than once, over all documents.

Seeds are winnowed anchors: of every window of ``window`` consecutive words, the shingle of ``anchor`` words
with the least hash (the last of equals). Equal windows choose the same anchor at the same place, so documents
that share a passage of window length share an anchor in it, and an anchor that occurs once is no part of a
repeat.

Seeds are extended both ways to the run of all windows that chose the anchor: the longest passage around it
whose repetition can show here. Runs that are equal as a whole are repeated in full, and need one row and one
hash each. Where an anchor also has runs that are like no other, at the ends of repeats, the windows of one
run of each kind are compared one by one. Repeated windows that overlap or touch join to maximal repeats.

Occurrences are grouped and counted, never paired: a passage shared by a third of all documents is one
pre-aggregated row per task, and its occurrences are marked by a join of two plain scans, which adaptive
execution splits. Words are compared by 64-bit hashes, windows by 128 bits (anchor and window).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from appmetrics.functions.scratch import stage
from appmetrics.llm.batches import bound_batches

WINDOW = 35
ANCHOR = 8
CHUNK_WORDS = 100_000
KNOWN_WORDS = 100_000
ANCHOR_BASE, WINDOW_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
KEYS = ("anchor", "span", "shift", "length")


class WordHashes(dict):
    """Word -> XXH64, computed at first use; kept small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Passages:
    """The windows of some documents whose word hashes lie end to end in one array."""

    def __init__(self, hashes: list[np.ndarray], window: int, anchor: int):
        lengths = np.array([len(h) for h in hashes], np.int64)
        self.first = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        self.words = np.concatenate(hashes)
        self.window, self.anchor = window, anchor
        # Starts of windows that lie within one document, and the document of each.
        counts = np.maximum(lengths - window + 1, 0)
        self.doc = np.repeat(np.arange(len(lengths)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        self.start = self.first[self.doc] + offset
        self.shingles = self._shingles()
        self.chosen = self._least(window - anchor + 1)[self.start]

    def _shingles(self) -> np.ndarray:
        n = len(self.words) - self.anchor + 1
        total = np.zeros(n, np.uint64)
        for j in range(self.anchor):
            total = total * np.uint64(ANCHOR_BASE) + self.words[j : j + n]
        return mixed(total)

    def _least(self, width: int) -> np.ndarray:
        """For every place, where the least of the next ``width`` shingles is; the last of equals."""
        g, n, size = self.shingles, len(self.shingles), 1
        at = np.arange(n)

        def better(left, right):
            return np.where(g[right] <= g[left], right, left)

        while 2 * size <= width:
            at = better(at[: n - 2 * size + 1], at[size : n - size + 1])
            size *= 2
        return better(at[: n - width + 1], at[width - size : n - size + 1])

    def _powers(self, base: int) -> np.ndarray:
        factors = np.full(len(self.words) + 1, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)

    def anchors(self):
        """(document, place of an anchor in it, hash), each anchor once. There are windows."""
        new = np.concatenate(([True], (self.chosen[1:] != self.chosen[:-1]) | (self.doc[1:] != self.doc[:-1])))
        doc, place = self.doc[new], self.chosen[new]
        return doc, place - self.first[doc], self.shingles[place]

    def runs(self, wanted: list[np.ndarray]):
        """Runs of windows around the wanted anchors (places by document), with their hashes. There are windows."""
        seed = np.zeros(len(self.words), bool)
        for first, places in zip(self.first, wanted):
            seed[first + places] = True
        new = np.flatnonzero(np.concatenate(([True], (self.chosen[1:] != self.chosen[:-1]) | (self.doc[1:] != self.doc[:-1]))))
        length = np.diff(np.append(new, len(self.chosen)))
        use = seed[self.chosen[new]]
        new, length = new[use], length[use]
        start, place, doc = self.start[new], self.chosen[new], self.doc[new]
        # Hash of words a to b: weighted prefix sums, moved to the same weights everywhere.
        power, inverse = (self._powers(base) for base in (WINDOW_BASE, pow(WINDOW_BASE, -1, 1 << 64)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.words * power[:-1])))
        span = mixed((sums[start + length + self.window - 1] - sums[start]) * inverse[start])
        each = mixed((sums[self.start + self.window] - sums[self.start]) * inverse[self.start]).astype("<u8").tobytes()
        windows = [each[8 * a : 8 * (a + n)] for a, n in zip(new.tolist(), length.tolist())]
        return doc, start - self.first[doc], place - start, length, self.shingles[place], span, windows


def _chunks(batches, known: WordHashes, least: int, read=lambda text: text):
    """(rows, word hashes) of some documents at a time; documents with fewer than ``least`` words are left out."""
    for batch in batches:
        rows, hashes, size = [], [], 0
        for i in range(batch.num_rows):
            words = read(batch.column(2)[i].as_py()).split()
            if len(words) >= least:
                rows.append(i)
                hashes.append(known.of(words))
                size += len(words)
            if rows and (size >= CHUNK_WORDS or i == batch.num_rows - 1):
                yield batch.take(pa.array(rows)), hashes
                rows, hashes, size = [], [], 0
        if rows:
            yield batch.take(pa.array(rows)), hashes


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def zipped(text: Column) -> Column:
    """Text in UTF-8, compressed for the way through a shuffle; null counts as empty."""

    def run(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=3)
        return pa.array([press.compress(t.as_py() or b"") for t in texts], pa.binary())

    return F.arrow_udf(run, "binary")(text.cast("binary"))


def _unzip(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """(id, text_hash, spans array<struct<start, windows>>): runs of repeated windows of the documents that have any.

    A window is repeated if its words start anywhere else in ``docs``, in the same document included.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor has 1 to `window` words")
    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))

    def find_anchors(batches):
        known = WordHashes()
        for batch, hashes in _chunks(batches, known, window):
            doc, place, value = Passages(hashes, window, anchor).anchors()
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(place.astype(np.int32)), _signed(value)],
                ["id", "text_hash", "place", "anchor"],
            )

    found = stage(rows.mapInArrow(find_anchors, f"id {kind}, text_hash bigint, place int, anchor bigint"), "anchors")
    again = stage(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "again")
    seeds = stage(
        found.join(again, "anchor").groupBy("id", "text_hash").agg(F.collect_set("place").alias("places")), "seeds"
    )

    packed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), zipped(F.col(text_col)).alias("packed"))
    seeded = packed.join(
        seeds.withColumnsRenamed({"id": "seed_id", "text_hash": "seed_hash"}),
        F.expr("id <=> seed_id AND text_hash = seed_hash"),
    ).select("id", "text_hash", "packed", "places")

    def extend(batches):
        known = WordHashes()
        for part, hashes in _chunks(batches, known, window, _unzip):
            wanted = [np.asarray(p.values) for p in part.column(3)]
            doc, start, shift, length, value, span, windows = Passages(hashes, window, anchor).runs(wanted)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(at), part.column(1).take(at)]
                + [pa.array(x.astype(np.int32)) for x in (start, shift, length)]
                + [_signed(value), _signed(span), pa.array(windows, pa.binary())],
                ["id", "text_hash", "start", "shift", "length", "anchor", "span", "windows"],
            )

    runs = stage(
        seeded.mapInArrow(
            extend,
            f"id {kind}, text_hash bigint, start int, shift int, length int, anchor bigint, span bigint, windows binary",
        ),
        "runs",
    )
    kinds = stage(runs.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), "kinds")
    whole = stage(kinds.filter("n > 1").drop("n"), "whole")
    in_full = runs.select("id", "text_hash", "start", *KEYS).join(whole, list(KEYS)).selectExpr(
        "id", "text_hash", "start", "length AS windows"
    )

    # Anchors with a run like no other beside runs of other kinds.
    mixed_anchors = stage(
        kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
        .filter("kinds > 1 AND single > 0").select("anchor"),
        "mixed",
    )
    sample = stage(
        runs.join(mixed_anchors, "anchor")
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.first(c).alias(c) for c in ("id", "text_hash", "start", "windows")],
        ),
        "sample",
    )
    one_by_one = sample.selectExpr(
        "id", "text_hash", "start", "anchor", "n",
        "posexplode(transform(sequence(0, length - 1), i -> substring(windows, 8 * i + 1, 8))) AS (i, window)",
    )
    shared = stage(
        one_by_one.groupBy("anchor", "window").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor", "window"), "shared"
    )
    at_ends = one_by_one.filter("n = 1").join(shared, ["anchor", "window"]).selectExpr(
        "id", "text_hash", "start + i AS start", "1 AS windows"
    )
    return in_full.unionAll(at_ends).groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    verbatim: bool = False,
) -> DataFrame:
    """(row, text, n_words, n_removed, repeats) for every row of ``docs``; ``row`` holds its other columns.

    ``text``: the words outside repeated windows, joined by one space (with ``verbatim``, a text that loses
    nothing stays as it is); ``repeats``: the maximal repeats as word ranges, end exclusive.

    Windows are judged on ``docs`` as given. Null and empty texts have no words and become empty; a text shorter
    than a window keeps all its words; repeated rows repeat each other's windows; rows with one id and
    different texts are separate documents; a null id is allowed; an empty table gives no rows.
    """
    spans = stage(repeated_spans(docs, id_col, text_col, window, anchor), "spans")
    others = [c for c in docs.columns if c != text_col]
    base = docs.select(
        F.struct(*others).alias("row"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        zipped(F.col(text_col)).alias("packed"),
    )
    joined = base.join(
        spans.withColumnsRenamed({"id": "span_id", "text_hash": "span_hash"}),
        F.col(f"row.`{id_col}`").eqNullSafe(F.col("span_id")) & (F.col("text_hash") == F.col("span_hash")),
        "left",
    )
    kind = pa.struct(
        [
            ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
            ("repeats", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
        ]
    )

    def cut(packed: pa.Array, spans: pa.Array) -> pa.Array:
        left_over: list[bytes] = []
        counted: list[tuple[int, int]] = []
        found_ranges: list[list[dict]] = []
        for p, s in zip(packed, spans):
            text = _unzip(p.as_py())
            words = text.split()
            found = s.as_py() or []
            change = np.zeros(len(words) + 1, np.int64)
            for x in found:
                change[x["start"]] += 1
                change[x["start"] + x["windows"] + window - 1] -= 1
            inside = np.concatenate(([False], np.cumsum(change[:-1]) > 0, [False]))
            edges = np.flatnonzero(inside[1:] != inside[:-1]).tolist()
            ranges = list(zip(edges[::2], edges[1::2]))
            kept, at = [], 0
            for begin, end in ranges:
                kept += words[at:begin]
                at = end
            kept += words[at:]
            left_over.append(text if verbatim and not ranges else b" ".join(kept))
            counted.append((len(words), len(words) - len(kept)))
            found_ranges.append([{"begin": b, "end": e} for b, e in ranges])
        n_words, n_removed = (pa.array([n[i] for n in counted], pa.int64()) for i in (0, 1))
        return pa.StructArray.from_arrays(
            [pa.array(left_over, pa.string()), n_words, n_removed, pa.array(found_ranges, kind.field("repeats").type)], fields=list(kind)
        )

    shape = "struct<text: string, n_words: bigint, n_removed: bigint, repeats: array<struct<begin: int, end: int>>>"
    return joined.select("row", F.arrow_udf(cut, shape)("packed", "spans").alias("cut")).select("row", "cut.*")
