"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader updates and scored as sparse dot products.

Features of a text are the hashed words, word pairs and the same for word
shapes (runs of lower-case, upper-case, digits and other signs), with the
square root of their counts, scaled to unit length. Training deals the
labelled rows to replicas of at most ``rows_each`` rows on average, by a hash
of their id and text; each replica passes over its rows in a seeded order,
and the replicas' weights are averaged. So no task holds more than a share of
the rows, and every labelled row up to ``max_rows`` counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Feature space: 2**BITS weights, so a model has at most 2 MB.
BITS = 18
#: Labelled rows that one replica learns from.
ROWS_EACH = 5_000
#: Bound on the labelled rows that training reads: those with the least hash of their id.
MAX_LABELLED = 40_000
#: Words hashed at a time; a longer text is taken in several parts.
WORDS = 1 << 18
EMPTY = 1
#: Word hashes that a task remembers, and rows whose features it hands on at a time.
KNOWN, PIECE = 200_000, 512


def _mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


def _shape_table() -> bytes:
    kind = bytearray(range(256))
    for c in range(256):
        ch = chr(c)
        kind[c] = ord("a") if "a" <= ch <= "z" or c >= 128 else ord("A") if "A" <= ch <= "Z" else ord("0") if ch.isdigit() else c
    return bytes(kind)


class Features:
    """Turns texts into (indices, values); remembers word hashes of a task."""

    def __init__(self, bits: int = BITS):
        import xxhash
        self.digest = xxhash.xxh64_intdigest
        self.bits, self.known, self.table = bits, {}, _shape_table()

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known, digest = self.known, self.digest
        if len(known) > KNOWN:
            known.clear()
        for w in set(words).difference(known):
            shape = w.translate(self.table)
            short = bytes(c for k, c in enumerate(shape) if k == 0 or c != shape[k - 1])
            known[w] = (digest(w, 7), digest(short, 11))
        return np.array([known[w] for w in words], dtype=np.uint64).reshape(-1, 2)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.encode().split() if text else []
        shift = np.uint64(64 - self.bits)
        if not words:
            return np.array([EMPTY], dtype=np.int64), np.ones(1)
        total = np.zeros(0)
        parts, last = [], None
        for at in range(0, len(words), WORDS):
            h = self._hashes(words[at:at + WORDS])
            if last is not None:
                h = np.concatenate([last, h])
            pair = _mix(h[1:] + np.uint64(3) * _mix(h[:-1]))
            same = h[1:, 0] == h[:-1, 0]
            pair[same] = np.uint64(0xD1B54A32D192ED03)  # one feature for any word twice in a row
            new = h if last is None else h[1:]
            parts.append(np.concatenate([_mix(new).ravel(), pair.ravel()]) >> shift)
            last = h[-1:]
        index, total = np.unique(np.concatenate(parts).astype(np.int64), return_counts=True)
        value = np.sqrt(total.astype(np.float64))
        return index, value / np.sqrt(np.dot(value, value))


def train(rows: DataFrame, label_col: str = "label", text_col: str = "text", id_col: str = "doc_id", bits: int = BITS, rows_each: int = ROWS_EACH,
          epochs: int = 5, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.05, max_rows: int = MAX_LABELLED) -> np.ndarray:
    """Weights (2**bits values and the bias) learnt from the rows' 0/1 labels.

    At most ``max_rows`` rows are read, those with the least hash of their
    id and text. Rows with a null label are ignored. No rows: weights zero, so every
    score is 0.5."""
    ranked = rows.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text"),
                                                            F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h"))
    count = ranked.count()
    share = F.lit(float(max_rows)) / F.lit(float(max(count, max_rows)))
    replicas = -(-min(count, max_rows) // rows_each) or 1
    # The least hashes, cut by value: a hash is uniform, so the share of its range is the share of rows.
    kept = ranked.where((F.col("h") / F.lit(2.0 ** 64) + 0.5) < share).withColumn("replica", F.pmod(F.xxhash64("h"), F.lit(replicas)).cast("int"))
    size = 1 << bits

    @F.pandas_udf("i array<int>, x array<float>")
    def featured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        make = Features(bits)
        for texts in batches:
            for at in range(0, len(texts), PIECE):
                got = [make.of(t) for t in texts[at:at + PIECE]]
                yield pd.DataFrame({"i": [i.astype(np.int32) for i, _ in got], "x": [x.astype(np.float32) for _, x in got]})

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "label"], kind="stable")
        z, n = np.zeros(size + 1), np.zeros(size + 1)
        data = [(np.append(np.asarray(i, dtype=np.int64), size), np.append(np.asarray(x, dtype=np.float64), 1.0)) for i, x in zip(frame["i"], frame["x"])]
        order = np.random.default_rng(17)
        labels = frame["label"].to_numpy()
        keep_l1 = np.full(size + 1, l1)
        keep_l1[size] = 0.0
        for _ in range(epochs):
            for k in order.permutation(len(data)):
                i, x = data[k]
                zi, ni, bound = z[i], n[i], keep_l1[i]
                w = np.where(np.abs(zi) <= bound, 0.0, (np.sign(zi) * bound - zi) / ((beta + np.sqrt(ni)) / alpha + l2))
                g = (1.0 / (1.0 + np.exp(-np.clip(np.dot(w, x), -35, 35))) - labels[k]) * x
                step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
                z[i] = zi + g - step * w
                n[i] = ni + g * g
        w = np.where(np.abs(z) <= keep_l1, 0.0, (np.sign(z) * keep_l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
        some = np.flatnonzero(w)
        return pd.DataFrame({"i": some, "w": w[some]})

    learnt = (kept.select("replica", "h", "label", featured("text").alias("f")).select("replica", "h", "label", "f.i", "f.x")
              .groupBy("replica").applyInPandas(learn, "i long, w double"))
    # Exact decimal sums: the average does not depend on the order of tasks. At most 2**bits rows.
    mean = learnt.groupBy("i").agg(F.sum(F.col("w").cast("decimal(28,14)")).alias("w")).toPandas()
    out = np.zeros(size + 1)
    out[mean["i"].to_numpy(dtype=np.int64)] = mean["w"].astype(float).to_numpy() / replicas
    return out


def score_column(df: DataFrame, text: Column, weights: np.ndarray) -> Column:
    """Probability of label 1 of each text (null and empty texts as well)."""
    held = df.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    bits = int(len(weights) - 1).bit_length() - 1

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = held.value
        make = Features(bits)
        for texts in batches:
            got = []
            for t in texts:
                i, x = make.of(t)
                got.append(1.0 / (1.0 + np.exp(-np.clip(np.dot(w[i], x) + w[-1], -35, 35))))
            yield pd.Series(got, dtype="float64")

    return score(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no training reads: crc32 of the id as text, mod 3, is 1.
    A null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_weights(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights for ``labels.quality``, learnt from the rows not held out.

    The labels are cut to ``MAX_LABELLED`` (by the hash of their id) before
    the texts are read, so that a bounded table is broadcast and the texts
    of other documents are never shuffled."""
    own = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label")).where("label is not null and doc_id is not null").distinct()
    share = MAX_LABELLED / max(own.count(), MAX_LABELLED)
    cut = own.where((F.xxhash64(F.col("doc_id").cast("string")) / F.lit(2.0 ** 64) + 0.5) < F.lit(share))
    return train(docs.select("doc_id", "text").join(F.broadcast(cut), "doc_id"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (score >= 0.5).

    Every row of ``docs`` is scored: null texts as empty ones, repeated rows
    each by itself; extra columns are not read."""
    weights = quality_weights(docs, labels)
    got = docs.select("doc_id", held_out().alias("held_out"), score_column(docs, F.col("text"), weights).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
