"""Language identification with Bloom filters of letter n-grams by language, bit-sliced.

All filters have the same size and hash functions. A slot of the one table holds a byte of bits for each language: the
masks at an n-gram's slots, and-ed, name all languages that contain it at once. Every n-gram that a language's texts hold
is in its first filter, however rare. Where labels are wrong or texts quote, nearly every n-gram is somewhere in every
language; so a language has a filter for each of ``LEVELS`` levels, the higher ones for the n-grams with at least a certain
share of its n-grams, and the bits of its byte say how common the n-gram is there. The bits of a text's n-grams are
counted per language, corrected for the filters' known rates of false positives, and the most bits decide.

The filters' size follows from the distinct n-grams of the language that has most, so that none fills up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from appmetrics.functions.scratch import stage
from appmetrics.llm.batches import bound_batches

#: Slots for each distinct n-gram of the language that has most: about one n-gram in 80 is a false positive then.
#: The table is a model's only part that travels to every task: a byte for each slot and language.
ROOM = 10
#: A byte of bits. Level 0 has all n-grams, level j those with a share of ``STEP ** (j - LEVELS - 2)`` or more.
LEVELS = 8
STEP = 4.0
HASHES = 4
CHUNK_CHARS = 2_000_000
KEPT_GRAMS = 1_000_000
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all letter trigrams and how many each text has: one for each letter, with its neighbours.

    Letters are lower-cased; anything else is a word's edge.
    """
    lowered = [t.lower() for t in texts]
    # A zero ends each text, so that no n-gram reaches into the next.
    codes = np.frombuffer("\0".join([*lowered, ""]).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in lowered]) - 1
    letter = _letters()[codes]
    padded = np.concatenate(([0], np.where(letter, codes, 0), [0])).astype(np.uint64)
    at = np.flatnonzero(letter)
    made = padded[at] << np.uint64(42) | padded[at + 1] << np.uint64(21) | padded[at + 2]
    counts = np.diff(np.concatenate(([0], np.cumsum(letter)[ends]))) if len(texts) else np.zeros(0, np.int64)
    return made, counts


def slots(codes: np.ndarray, size: int, hashes: int = HASHES) -> list[np.ndarray]:
    """The slots of each n-gram, one array per hash function."""
    out = []
    for i in range(hashes):
        x = (codes + np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out.append((x ^ (x >> np.uint64(32))) % np.uint64(size))
    return out


def _texts(batch, column: int):
    """(first row, texts) of about CHUNK_CHARS characters; null counts as empty."""
    part, chars, first = [], 0, 0
    for i, t in enumerate(batch.column(column)):
        part.append(t.as_py() or "")
        chars += len(part[-1])
        if chars >= CHUNK_CHARS:
            yield first, part
            part, chars, first = [], 0, i + 1
    if part:
        yield first, part


@dataclass(frozen=True)
class Filters:
    """Languages in code point order, the table (slots, languages), false positives by (language, level)."""

    languages: list[str]
    table: np.ndarray
    false_positives: np.ndarray
    commonest: str | None
    hashes: int = HASHES

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """(n-gram, language) -> bits of the levels at which the language holds it."""
        first, *others = slots(codes, len(self.table), self.hashes)
        masks = self.table[first.astype(np.int64)]
        for s in others:
            masks &= self.table[s.astype(np.int64)]
        return masks

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of each text, and (text, language) -> bits for each of them, corrected, as a share of all."""
        codes, counts = grams(texts)
        masks = self.masks(codes)
        starts = np.cumsum(counts) - counts
        some = np.flatnonzero(counts)
        scores = np.zeros((len(texts), len(self.languages)))
        bits = np.arange(256)[:, None] >> np.arange(LEVELS) & 1
        for at in range(len(self.languages) if len(some) else 0):
            false = np.minimum(self.false_positives[at], 0.999)
            found = np.add.reduceat((bits @ (1 / (1 - false)))[masks[:, at]], starts[some])
            scores[some, at] = np.clip((found / counts[some] - (false / (1 - false)).sum()) / LEVELS, 0, 1)
        return counts, scores

    def decide(self, texts: list[str]) -> tuple[list[str], list[float]]:
        counts, scores = self.counts(texts)
        best = scores.argmax(axis=1) if self.languages else np.zeros(len(texts), int)
        names, values = [], []
        for i, b in enumerate(best.tolist()):
            if not counts[i] or not self.languages:
                names.append(UNDETERMINED)
                values.append(0.0)
            else:
                values.append(float(scores[i, b]))
                names.append(self.languages[b] if values[-1] else self.commonest)
        return names, values


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", room: int = ROOM, hashes: int = HASHES) -> Filters:
    """Filters from all rows of ``docs`` whose language is not null; no such row gives filters without languages.

    Null and empty texts, and texts without a letter, add no n-gram; a language that has only such texts is
    not learned. Repeated rows count as often as they stand. Texts of any length are read whole.
    """
    bound_batches(docs.sparkSession)
    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches):
        held: dict[str, list] = {}
        n_held = 0

        def flush():
            for lang, parts in held.items():
                codes, n = _summed(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, texts in _texts(batch, 1):
                here = langs[first : first + len(texts)]
                for lang in sorted(set(here)):
                    codes, n = np.unique(grams([t for t, x in zip(texts, here) if x == lang])[0], return_counts=True)
                    held.setdefault(lang, []).append((codes, n))
                    n_held += len(codes)
                if n_held > KEPT_GRAMS:
                    held = {lang: [_summed(parts)] for lang, parts in held.items()}
                    n_held = sum(len(p[0][0]) for p in held.values())
                    if n_held > KEPT_GRAMS // 2:
                        yield from flush()
                        n_held = 0
        yield from flush()

    counted = stage(
        rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams"
    )
    # One row per language.
    sums = counted.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("grams")).collect()
    totals = {r["lang"]: r["n"] for r in sums}
    languages = sorted(totals)
    size = 1 << (room * max((r["grams"] for r in sums), default=1) - 1).bit_length()
    if not languages:
        return Filters([], np.zeros((size, 0), np.uint8), np.zeros((0, LEVELS)), None, hashes)
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    total = F.create_map(*[F.lit(x) for lang in languages for x in (lang, float(totals[lang]))])
    known = counted.select("gram", number[F.col("lang")].alias("at"), (F.col("n") / total[F.col("lang")]).alias("share"))
    least = STEP ** (np.arange(1, LEVELS) - LEVELS - 2)

    def set_bits(batches):
        for batch in batches:
            codes = np.asarray(batch.column(0)).view(np.uint64)
            levels = np.searchsorted(least, np.asarray(batch.column(2)), side="right") + 1
            mask = pa.array(((1 << levels) - 1).astype(np.int32))
            for s in slots(codes, size, hashes):
                yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int64)), batch.column(1), mask], ["slot", "at", "mask"])

    # As many rows as the table has bytes at most.
    filled = known.mapInArrow(set_bits, "slot bigint, at int, mask int").groupBy("slot", "at").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros((size, len(languages)), np.uint8)
    table[filled["slot"].to_numpy(), filled["at"].to_numpy()] = filled["mask"].to_numpy()
    full = np.stack([(table >> level & 1).mean(axis=0) for level in range(LEVELS)], axis=1)
    return Filters(languages, table, full**hashes, max(languages, key=lambda x: (totals[x], x)), hashes)


def _summed(parts) -> tuple[np.ndarray, np.ndarray]:
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(place, weights=np.concatenate([n for _, n in parts]).astype(float), minlength=len(codes)).astype(np.int64)


def identify(filters: Filters, text: Column) -> Column:
    """struct<lang, score> of a text: a learned language, and its bits for the text's n-grams as a share of all levels.

    A text that is null or has no letter, and any text when no language was learned, is ``und`` with score 0. Equal
    counts go to the language first in code point order; if no language holds any n-gram of a text, it is the
    commonest one, with score 0. Each row has its own result, so equal texts have equal ones; a text of any length is
    judged whole, and a table without rows gives none.
    """
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def run(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for _, part in _texts(pa.RecordBatch.from_arrays([texts], ["text"]), 0):
            n, s = filters.decide(part)
            names += n
            scores += s
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    return F.arrow_udf(run, "struct<lang: string, score: double>")(text)
