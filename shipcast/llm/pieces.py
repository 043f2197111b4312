"""SentencePiece encoding and decoding (byte-pair models with byte fallback)
by vectorised merge rounds.

A text is cut before every run of word marks, a cut that no piece of the
model crosses, so each unit is merged alone and equal units are merged once.
All new units of a batch lie in one flat numpy symbol array. Pieces of marks
alone share the least score, so a run of marks is merged last, from the left,
by a rule on its length. A round looks up the rank of every adjacent pair, takes the least rank of each unit (a
segmented minimum), merges all its occurrences from left to right at the same
time, and compacts the array; units without a mergeable pair leave. The model
file is a parameter; only its piece list is read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
NO_RANK = np.int64(2**40)
#: Units remembered by a task; beyond it the memory is emptied.
UNITS = 200_000
#: Symbols merged at a time, but for a longer single unit.
FLAT = 250_000


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        x = b[i]
        i += 1
        value |= (x & 127) << shift
        if x < 128:
            return value, i
        shift += 7


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a protocol-buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind == 2:
            n, i = _varint(b, i)
            value, i = b[i:i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = b[i:i + n], i + n
        yield tag >> 3, value


class Pieces:
    """Piece list and pair table of a model.

    Raises ``ValueError`` for models that this operator cannot reproduce
    (other than byte-pair, other than the identity normaliser with a word
    mark before the text, or with pieces that cross a word mark)."""

    def __init__(self, data: bytes):
        pieces, kinds, scores = [], [], []
        trainer: dict = {}
        norm: dict = {}
        for field, value in _fields(data):
            if field == 1:
                got = dict(_fields(value))
                pieces.append(got[1].decode())
                kinds.append(got.get(3, NORMAL))
                scores.append(struct.unpack("<f", got.get(2, bytes(4)))[0])
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                norm = dict(_fields(value))
        if trainer.get(3) != 2 or norm.get(2) or not norm.get(3, 1) or norm.get(4, 1) or not trainer.get(35):
            raise ValueError("only byte-pair models with byte fallback, an identity normaliser, a leading word mark and kept white space")
        normal = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
        marks = {len(p): i for p, i in normal.items() if not p.strip(MARK)}
        rest = [i for p, i in normal.items() if len(p) > 1 and p.strip(MARK)]
        if USER in kinds or UNUSED in kinds or any(MARK in p.lstrip(MARK) or p[:2] == MARK * 2 and p.strip(MARK) for p in normal):
            raise ValueError("a piece crosses a word mark or is user-defined")
        if any(scores[a] <= scores[b] for a, b in zip(rest, rest[1:])) or any(scores[i] >= min(scores[r] for r in rest) for n, i in marks.items() if n > 1):
            raise ValueError("pieces are not in the order of their scores, those of marks alone last")
        self.mark = marks.get(1, -1)
        self.marks = marks
        self.size = len(pieces)
        self.byte_id = [0] * 256
        for i, (p, k) in enumerate(zip(pieces, kinds)):
            if k == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
        #: What each id decodes to, before the text's leading space goes.
        self.bytes_of = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() if k == NORMAL else " ⁇ ".encode() if k == UNKNOWN else b""
                         for p, k in zip(pieces, kinds)]
        #: Symbols: ids for pieces, then numbers for characters that are only parts of pieces.
        symbol = dict(normal)
        for p in normal:
            for c in p:
                symbol.setdefault(c, self.size + len(symbol))
        self.char = {p: i for p, i in symbol.items() if len(p) == 1}
        self.other = 1 << 24
        self.symbol_of = np.full(0x110000, self.other, dtype=np.int32)
        for c, i in self.char.items():
            self.symbol_of[ord(c)] = i
        keys, ranks = [], []
        for p, i in normal.items():
            for cut in range(1, len(p) if p.strip(MARK) else 0):
                a, b = symbol.get(p[:cut]), symbol.get(p[cut:])
                if a is not None and b is not None:
                    keys.append((a << 25) | b)
                    ranks.append(i)
        order = np.argsort(keys)
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array(ranks, dtype=np.int64)[order]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank (the id of the merged piece) of each pair, NO_RANK if none."""
        want = (a << 25) | b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], NO_RANK)

    def run(self, n: int) -> list[int]:
        """Ids of ``n`` word marks in a row: they merge from the left, and a
        piece of the greatest length is final."""
        long = max(self.marks)
        whole = max(0, n // long - 2)
        sizes = [1] * (n - whole * long)
        k = 0
        while k < len(sizes) - 1:
            if sizes[k] + sizes[k + 1] in self.marks:
                sizes[k:k + 2] = [sizes[k] + sizes[k + 1]]
                k = max(k - 1, 0)
            else:
                k += 1
        return [self.marks[long]] * whole + [self.marks[x] for x in sizes]

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit: word marks, then other characters (or none)."""
        bare = [u.lstrip(MARK) for u in units]
        out = self.merge([MARK + b for b in bare])
        for k, (u, b, ids) in enumerate(zip(units, bare, out)):
            n = len(u) - len(b)
            if n > 1:
                out[k] = self.run(n) + ids[1:] if ids[0] == self.mark else self.run(n - 1) + ids
        return out

    def merge(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit with no pair of marks, by rounds."""
        out: list[list[int]] = [[]] * len(units)
        begin = 0
        while begin < len(units):
            end, room = begin, FLAT
            while end < len(units) and (end == begin or len(units[end]) <= room):
                room -= len(units[end])
                end += 1
            self._merge(units, begin, end, out)
            begin = end
        return out

    def _merge(self, units: list[str], begin: int, end: int, out: list) -> None:
        point = np.frombuffer("".join(units[begin:end]).encode("utf-32-le"), dtype=np.uint32)
        # Characters outside the model are no part of any pair; their code points are kept beside.
        sym = self.symbol_of[point].astype(np.int64)
        word = np.repeat(np.arange(begin, end), [len(u) for u in units[begin:end]])
        rank = np.full(len(sym), NO_RANK)  # of the pair that starts here
        same = np.flatnonzero(word[1:] == word[:-1])
        rank[same] = self.rank(sym[same], sym[same + 1])
        while len(sym):
            # The least rank of each unit.
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            at = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            done = at == NO_RANK
            if done.any():
                self._emit(sym[done], point[done], word[done], out)
                live = ~done
                sym, point, word, rank, at = sym[live], point[live], word[live], rank[live], at[live]
                if not len(sym):
                    return
            # Overlapping occurrences: from left to right, every second of a run.
            spot = np.flatnonzero(rank == at)
            k = np.arange(len(spot))
            fresh = np.concatenate(([True], np.diff(spot) != 1))
            spot = spot[(k - np.maximum.accumulate(np.where(fresh, k, 0))) % 2 == 0]
            new = self._merged(sym, point, word, rank, at, spot)
            if new[4].any():
                # A merge that makes a pair of lesser rank comes before its unit's other merges: there only the first one counts now.
                w = word[spot]
                again = np.concatenate(([False], w[1:] == w[:-1])) & np.isin(w, w[new[4]])
                if again.any():
                    new = self._merged(sym, point, word, rank, at, spot[~again])
            sym, point, word, rank, _ = new

    def _merged(self, sym, point, word, rank, at, spot) -> tuple[np.ndarray, ...]:
        """Arrays after the merges at ``spot``, and which of them made a pair of lesser rank."""
        keep = np.ones(len(sym), dtype=bool)
        keep[spot + 1] = False
        fused = sym.copy()
        fused[spot] = at[spot]
        fused, point, word, rank = fused[keep], point[keep], word[keep], rank[keep]
        here = spot - np.arange(len(spot))
        lesser = np.zeros(len(spot), dtype=bool)
        for left in (here - 1, here):
            inside = (left >= 0) & (left + 1 < len(fused))
            inside[inside] = word[left[inside]] == word[left[inside] + 1]
            got = np.full(len(left), NO_RANK)
            got[inside] = self.rank(fused[left[inside]], fused[left[inside] + 1])
            lesser |= got < at[spot]
            if left is here:
                rank[here] = got
            else:
                rank[left[inside]] = got[inside]
        return fused, point, word, rank, lesser

    def _emit(self, sym: np.ndarray, point: np.ndarray, word: np.ndarray, out: list) -> None:
        cut = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1], [True])))
        ids, points, size = sym.tolist(), point.tolist(), self.size
        for w, a, b in zip(word[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist()):
            got = ids[a:b]
            if max(got) >= size:
                flat: list[int] = []
                for k in range(a, b):
                    if ids[k] < size:
                        flat.append(ids[k])
                    else:
                        c = chr(points[k]) if ids[k] == self.other else next(p for p, i in self.char.items() if i == ids[k])
                        flat.extend(self.byte_id[x] for x in c.encode())
                got = flat
            out[w] = got

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``; the leading space that encoding put in front goes."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _units(text: str) -> list[str]:
    return re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK)) if text else []


class Coder:
    """Encodes and decodes texts, remembering the units seen before."""

    def __init__(self, data: bytes):
        self.model = Pieces(data)
        self.known: dict[str, tuple[str, int, str]] = {}

    def batch(self, texts: list[str | None]) -> Iterator[tuple[list[str], int, str]]:
        """For each text: joined ids of its units, number of ids, decoded text."""
        cut = [_units(t or "") for t in texts]
        if len(self.known) > UNITS:
            self.known.clear()
        new = list({u for us in cut for u in us if u not in self.known})
        model = self.model
        for u, ids in zip(new, model.encode_units(new)):
            # Units end between characters, so each decodes by itself.
            self.known[u] = (",".join(map(str, ids)), len(ids), b"".join(map(model.bytes_of.__getitem__, ids)).decode("utf-8", "replace"))
        for us in cut:
            got = [self.known[u] for u in us]
            text = "".join([g[2] for g in got])
            yield [g[0] for g in got], sum([g[1] for g in got]), text[1:] if text[:1] == " " else text


def _slices(texts: list) -> Iterator[list]:
    """Parts of a batch with a bounded number of characters (a longer text alone)."""
    part: list = []
    room = FLAT
    for t in texts:
        n = len(t or "")
        if part and n > room:
            yield part
            part, room = [], FLAT
        part.append(t)
        room -= n
    if part:
        yield part


def _model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file's bytes (a bounded file: a piece list)."""
    with open(path, "rb") as f:
        return f.read()


def encode(spark: SparkSession, text: Column, model_path: str) -> Column:
    """Array of the ids of each text; null gives an empty array."""
    held = spark.sparkContext.broadcast(_model_bytes(spark, model_path))

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = Coder(held.value)
        for s in batches:
            yield pd.Series([[int(x) for u in joined for x in u.split(",")] for part in _slices(s.tolist()) for joined, _, _ in coder.batch(part)], dtype=object)

    return ids(text)


def decode(spark: SparkSession, ids: Column, model_path: str) -> Column:
    """Text of each array of ids; null gives an empty text, and ids outside
    the model raise an error in the task."""
    held = spark.sparkContext.broadcast(_model_bytes(spark, model_path))

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Pieces(held.value)
        for s in batches:
            yield pd.Series([model.decode([int(i) for i in x]) if x is not None else "" for x in s], dtype=object)

    return text(ids)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of the decimal ids joined
    by commas), decoded_sha256 (of the decoded text in UTF-8).

    Null and empty texts have no ids and decode to the empty text. Repeated
    rows and null doc_ids stay as they are. Other columns are not read."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(_model_bytes(spark, model_path))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = Coder(held.value)
        for s in batches:
            rows = [(n, hashlib.sha256(",".join(joined).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
                    for part in _slices(s.tolist()) for joined, n, text in coder.batch(part)]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", digest("text").alias("_r")).select("doc_id", "_r.*")
