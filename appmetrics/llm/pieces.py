"""SentencePiece encoding and decoding with the source of every piece.

Text is normalised by the model's compiled character map: at each place the longest source text in its trie is
replaced, anything else is kept character by character, and every byte of the result remembers the source
bytes it came from. Pieces are runs of normalised text, so their lengths project each one to a byte span of the
original text.

Ids are those of the sentencepiece library. Where no piece crosses a space and the model leaves text as it is,
a text is encoded word by word, and each task asks the library once for a word: merges cannot cross from one
word to the next, so the ids are the same, at a fraction of the cost.
"""

from __future__ import annotations

import re
import struct
from array import array
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from appmetrics.llm.batches import bound_batches

SPACE = "▁"  # stands for a space within pieces
SPACE_BYTES = SPACE.encode()
KNOWN_WORDS = 150_000
CHUNK_CHARS = 1_000_000


def _fields(message: bytes):
    """(number, value) of a protocol buffer message; a value is a whole number or bytes."""
    at = 0

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, message[at : at + size]
            at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled character map: the size of a double-array trie, the trie, and
    the replacements, each ended by a zero byte. Without a map every character stays."""

    def __init__(self, compiled: bytes = b""):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest source text at a place."""
        if not self.units:
            return None
        found, unit, node = None, self.units[0], 0
        node = self._offset(unit)
        for end in range(at, len(text)):
            byte = text[end]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & (1 << 31 | 255) != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, self.units[node] & (1 << 31) - 1
        if found is None:
            return None
        length, place = found
        return length, self.replacements[place : self.replacements.index(0, place)]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


class Model:
    """A sentencepiece model: the library's encoder, the sizes of its pieces and its normalisation rules."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        rules = dict(_fields(next((v for n, v in parts if n == 3), b"")))
        self.map = CharacterMap(rules.get(2, b""))
        self.dummy_prefix, self.trims, self.escapes = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        silent = {i for i in range(len(pieces)) if self.library.is_control(i)}
        byte = {i for i in range(len(pieces)) if self.library.is_byte(i)}
        self.sizes = np.array([0 if i in silent else 1 if i in byte else len(p.encode()) for i, p in enumerate(pieces)], np.int64)
        crossing = any(SPACE in p.lstrip(SPACE) for p in pieces)
        # Pieces of types that are matched before merging (4: defined by the user) may hold anything.
        special = any(dict(_fields(v)).get(3) == 4 for n, v in parts if n == 1)
        plain = not (self.map.units or self.trims or crossing or special)
        self.by_word = plain and self.dummy_prefix and self.escapes and bool(byte)
        self.known: dict[str, bytes] = {}

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word and the space before it; the library is asked once for all new words."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        self.known.setdefault("", array("I", [self.library.piece_to_id(SPACE)]).tobytes())
        found = list(map(self.known.get, words))
        new = list({w for w, f in zip(words, found) if f is None})
        if new:
            self.known.update(zip(new, (array("I", ids).tobytes() for ids in self.library.encode(new, num_threads=1))))
            found = list(map(self.known.__getitem__, words))
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with the ids of begin and end."""
        begin, end = (array("I", [i]).tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        if self.by_word:
            split = list(map(_words, texts))
            ids = self._word_ids(list(chain.from_iterable(split)))
            upto = [0, *accumulate(map(len, split))]
            bodies = (b"".join(ids[a:b]) for a, b in zip(upto, upto[1:]))
        else:
            bodies = (array("I", ids).tobytes() for ids in self.library.encode(texts, num_threads=1))
        return [np.frombuffer(begin + body + end, "<u4") for body in bodies]

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())

    def alignment(self, text: bytes) -> np.ndarray:
        """For every byte of the normalised text, and its end, the place in ``text`` it came from."""
        if not text:
            return np.zeros(1, np.int64)
        if not self.map.units and not self.trims:
            widths = np.where(np.frombuffer(text, np.uint8) == 32, len(SPACE_BYTES) if self.escapes else 1, 1)
            body = np.repeat(np.arange(len(text)), widths)
        else:
            body = np.array(self._mapped(text), np.int64)
        front = np.zeros(len(SPACE_BYTES) if self.escapes else 1, np.int64) if self.dummy_prefix else np.zeros(0, np.int64)
        if self.trims and len(body):
            front += body[0]
        return np.concatenate((front, body, [len(text) if not self.trims or not len(body) else self._end]))

    def _mapped(self, text: bytes) -> list[int]:
        """Sources of the normalised bytes, spaces trimmed and in a row taken once where the model says so."""
        out: list[int] = []
        at, after_space = 0, self.trims
        self._end = len(text)
        last = 0
        while at < len(text):
            hit = self.map.longest(text, at)
            length, new = hit if hit else (_width(text[at]), text[at : at + _width(text[at])])
            if self.trims:
                while after_space and new.startswith(b" "):
                    new = new[1:]
            if new:
                for byte in new:
                    out += [at] * (len(SPACE_BYTES) if byte == 32 and self.escapes else 1)
                after_space = self.trims and new.endswith(b" ")
                if not after_space:
                    last, self._end = len(out), at + length
            at += length
        return out[:last] if self.trims else out

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end, in bytes of the text in UTF-8, of every piece; begin and end ids have empty spans.

        A byte piece spans its byte. A piece that starts within what one replacement made begins where that
        replacement's source does; the leading space that the model adds has no source.
        """
        source = self.alignment(text.encode())
        ends = np.minimum(np.cumsum(self.sizes[ids]), len(source) - 1)
        begins = np.concatenate(([0], ends[:-1]))
        return source[begins], np.maximum(source[ends], source[begins])


def _width(first: int) -> int:
    """Bytes of a UTF-8 character by its first byte."""
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


def _words(text: str) -> list[str]:
    """Words of a text, each standing for itself and one space before it."""
    if not text:
        return []
    plain = text.replace(SPACE, " ")
    if "  " in plain or plain[0] == " " or plain[-1] == " ":
        # Spaces in a row merge with each other: all but one go with the word after them.
        return [m[1] or m[2] or "" for m in re.finditer(" ( *[^ ]+)| ( *)$", " " + plain)]
    return plain.split(" ")


def _some(texts, size: int):
    """Lists of texts with about ``size`` characters."""
    part, chars = [], 0
    for t in texts:
        part.append(t.as_py() or "")
        chars += len(part[-1])
        if chars >= size:
            yield part
            part, chars = [], 0
    if part:
        yield part


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model at a path, read once in each Python process."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", parts: tuple[str, ...] = ("ids", "begins", "ends")) -> DataFrame:
    """(id, n_tokens, parts...) for every row of ``docs``.

    Parts: ``ids``, an array of token ids with begin and end; ``begins`` and ``ends``, each token's byte span in
    the text; ``packed``, the ids as little-endian unsigned 32-bit numbers; ``decoded``, the text that the ids
    decode to; ``covered``, the bytes of the text inside spans.

    ``path`` names the model file on every executor. A null text counts as empty and has the begin and end ids
    only; a text is encoded whole whatever its length; repeated rows and null ids are kept; an empty table gives no
    rows.
    """
    kinds = {
        "ids": ("array<int>", pa.list_(pa.int32())), "begins": ("array<int>", pa.list_(pa.int32())),
        "ends": ("array<int>", pa.list_(pa.int32())), "packed": ("binary", pa.binary()),
        "decoded": ("string", pa.string()), "covered": ("bigint", pa.int64()),
    }
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        own = model(path)
        for batch in batches:
            n, out = [], {p: [] for p in parts}
            for text, ids in ((t, i) for some in _some(batch.column(1), CHUNK_CHARS) for t, i in zip(some, own.encode(some))):
                n.append(len(ids))
                if {"begins", "ends", "covered"} & out.keys():
                    begins, ends = own.spans(text, ids)
                made = {
                    "ids": lambda: ids.astype(np.int32), "begins": lambda: begins.astype(np.int32), "ends": lambda: ends.astype(np.int32),
                    "packed": ids.tobytes, "decoded": lambda: own.decode(ids), "covered": lambda: int((ends - begins).sum()),
                }
                for p in parts:
                    out[p].append(made[p]())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *[pa.array(out[p], kinds[p][1]) for p in parts]], ["id", "n_tokens", *parts]
            )
        # The worker lives on and runs other tasks.
        own.known.clear()

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_tokens bigint" + "".join(f", {p} {kinds[p][0]}" for p in parts))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of an array of ids; null ids give null."""

    def run(ids: pa.Array) -> pa.Array:
        own = model(path)
        return pa.array([None if x.as_py() is None else own.decode(np.array(x.as_py(), "<u4")) for x in ids], pa.string())

    return encoded.withColumn("decoded", F.arrow_udf(run, "string")(F.col(ids_col)))
