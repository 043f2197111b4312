"""Spelling variants grouped over a frequency-vector trie.

A word's frequency vector counts its letters by group. One inserted letter
raises one count by one, a deleted one lowers one, a replaced one does both
or neither; so words one edit apart have vectors whose surplus and deficit are
at most one each. Words are arranged in a trie by their counts of one group
after the other. A depth-first search carries the query words down the trie,
spends a budget of one surplus and one deficit, and verifies the words of the
leaves it reaches.

The top of the trie deals the work: its first counts, as deep as it takes for
no cell to hold too many words, name the cell of a word, and a word also asks
the cells that its budget reaches. A task holds the trie of one cell. Of two
cells only one asks the other, so each pair of words is found once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import ascii_lower, saved, skew_join

#: Letters as the contract defines them; all of them are one byte in Latin-1.
RUN = r"[A-Za-zÀ-ÿ]+"
MIN_CHARS, MIN_COUNT, CUT_OUT_OF = 5, 3, 97
#: Letter groups: code point modulo GROUPS.
GROUPS = 16
#: The groups in the order of the trie's levels: those of the commonest letters first.
LEVELS = (5, 1, 9, 14, 4, 3, 15, 8, 2, 12, 13, 6, 0, 7, 11, 10)
#: Words of a cell, and levels that may deal out cells. A cell of more words at the last of them is dealt in blocks.
CELL, DEPTH = 20_000, 8
#: Candidate pairs that are verified at a time, and the longest words that are verified as a matrix.
PAIRS, WIDE = 1 << 17, 64
#: Odd multipliers of the counts in a cell's name: powers, so that no two budgets lead to one name.
MULTIPLIERS = np.cumprod(np.full(GROUPS, 0x9E3779B97F4A7C15, dtype=np.uint64))


def counted_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, out_of: int = CUT_OUT_OF) -> DataFrame:
    """(word, n) of the words of at least ``min_chars`` letters and
    ``min_count`` occurrences, where one run in about ``out_of`` of a document
    has lost the letter that its hash names."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(name.alias("d"), F.explode(F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("d", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % out_of == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def vectors(words) -> np.ndarray:
    """The counts of each word by letter group, in the order of the levels."""
    raw = [w.encode("latin-1") for w in words]
    letters = np.frombuffer(b"".join(raw), dtype=np.uint8)
    of = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    flat = np.bincount(of * GROUPS + letters % GROUPS, minlength=len(raw) * GROUPS)
    return flat.reshape(len(raw), GROUPS)[:, list(LEVELS)]


def cell_names(counts: np.ndarray, depth: int) -> np.ndarray:
    """The names of the cells of vectors at a depth, as one number each."""
    return (counts[:, :depth].astype(np.uint64) * MULTIPLIERS[:depth]).sum(axis=1, dtype=np.uint64).view(np.int64)


def asked_cells(counts: np.ndarray, depth: int) -> list[np.ndarray]:
    """The names of the other cells that each word asks: one surplus, or one
    surplus and a deficit at a later level. The cells that reach a word's own
    by a deficit first ask it in their turn."""
    own, times = cell_names(counts, depth).view(np.uint64), MULTIPLIERS
    ways = [(i, j) for i in range(depth) for j in range(i, depth)]
    if not ways:
        return [np.zeros(0, dtype=np.int64)] * len(counts)
    names = np.stack([own + times[i] - (times[j] if j > i else np.uint64(0)) for i, j in ways], axis=1).view(np.int64)
    there = np.stack([counts[:, j] > 0 if j > i else np.ones(len(counts), dtype=bool) for i, j in ways], axis=1)
    return [row[ok] for row, ok in zip(names, there)]


def _depths(words: Column) -> Column:
    @F.pandas_udf("array<long>")
    def names(batch: pd.Series) -> pd.Series:
        counts = vectors(batch)
        return pd.Series(list(np.stack([cell_names(counts, d) for d in range(DEPTH + 1)], axis=1)))

    return names(words)


def _asked(words: Column, depth: int) -> Column:
    @F.pandas_udf("array<long>")
    def names(batch: pd.Series) -> pd.Series:
        return pd.Series(asked_cells(vectors(batch), depth))

    return names(words)


def near(a: bytes, b: bytes) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def verified(words: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (a[k], b[k]) of words (Latin-1 bytes) are one edit apart."""
    ok = np.abs(sizes[a] - sizes[b]) <= 1
    long = ok & (np.maximum(sizes[a], sizes[b]) > WIDE)
    for k in np.flatnonzero(long):
        ok[k] = near(words[a[k]], words[b[k]])
    at = np.flatnonzero(ok & ~long)
    if len(at):
        swap = sizes[a[at]] > sizes[b[at]]
        short, tall = np.where(swap, b[at], a[at]), np.where(swap, a[at], b[at])
        width = int(sizes[tall].max()) + 1
        x, y = (np.array([words[k] for k in side], dtype=f"S{width}").view(np.uint8).reshape(-1, width) for side in (short, tall))
        apart = x != y
        first = np.argmax(apart, axis=1)
        shifted = x[:, :-1] != y[:, 1:]
        last = np.where(shifted.any(axis=1), width - 2 - np.argmax(shifted[:, ::-1], axis=1), -1)
        same = sizes[short] == sizes[tall]
        ok[at] = np.where(same, apart.sum(axis=1) == 1, last < first)
    return ok


def search(words: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of places one edit apart, where b is a word of the trie
    (``own``) and a is any; pairs of two words of the trie come once."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    counts = vectors([w.decode("latin-1") for w in words]).astype(np.int64)
    members = np.flatnonzero(own)
    order = members[np.lexsort(counts[members].T[::-1])]
    trie = counts[order]
    found, held, waiting = [], [], 0

    def verify() -> None:
        nonlocal waiting
        if held:
            a, b = (np.concatenate(x) for x in zip(*held))
            hit = verified(words, sizes, a, b)
            found.append(np.stack([a[hit], b[hit]]))
            held.clear()
        waiting = 0

    def leaf(lo: int, hi: int, asking: np.ndarray) -> None:
        """All words of a leaf have one vector: pair them with those that reach it, in blocks."""
        nonlocal waiting
        for at in range(lo, hi, PAIRS):
            block = order[at:min(hi, at + PAIRS)]
            per = max(1, PAIRS // len(block))
            for k in range(0, len(asking), per):
                a = np.repeat(asking[k:k + per], len(block))
                b = np.tile(block, len(asking[k:k + per]))
                once = ~own[a] | (a < b)
                once &= np.abs(sizes[a] - sizes[b]) <= 1
                held.append((a[once], b[once]))
                waiting += int(once.sum())
                if waiting >= PAIRS:
                    verify()

    todo = [(0, len(order), 0, np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64))] if len(order) else []
    while todo:
        lo, hi, level, asking, surplus, deficit = todo.pop()
        if hi - lo == 1 or (trie[lo, level:] == trie[hi - 1, level:]).all():
            rest = trie[lo, level:] - counts[asking, level:]
            reach = (surplus + np.maximum(rest, 0).sum(axis=1) <= 1) & (deficit + np.maximum(-rest, 0).sum(axis=1) <= 1)
            if reach.any():
                leaf(lo, hi, asking[reach])
            continue
        column, query = trie[lo:hi, level], counts[asking, level]
        cuts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [hi - lo]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            rest = column[a] - query
            more, less = surplus + np.maximum(rest, 0), deficit + np.maximum(-rest, 0)
            go = (more <= 1) & (less <= 1)
            if go.any():
                todo.append((lo + a, lo + b, level + 1, asking[go], more[go], less[go]))
    verify()
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(found, axis=1))


NEAR = "word string, n_near long, best_n long, best string"


def _searched(frame: pd.DataFrame) -> pd.DataFrame:
    """Of each word of a cell, or that asks it: its near words found here,
    how many, and the best of them (largest n, then the smallest)."""
    if not frame["own"].any():  # a cell that is asked and has no words
        frame = frame.iloc[:0]
    text, n = frame["word"].to_numpy(), frame["n"].to_numpy()
    words = np.array([w.encode("latin-1") for w in text], dtype=object)
    a, b = search(words, frame["own"].to_numpy(dtype=bool))
    who, other = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(text), dtype=np.int64)
    rank[np.argsort(text, kind="stable")] = np.arange(len(text))
    order = np.lexsort((rank[other], -n[other], who))
    who, other = who[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1]))) if len(who) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(who)))
    return pd.DataFrame({"word": text[who[first]], "n_near": size, "best_n": n[other[first]], "best": text[other[first]]})


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n; distinct) that have
    a word one edit apart among them."""
    depths = words.select(F.posexplode(_depths(F.col("word"))).alias("depth", "cell")).groupBy("depth", "cell").agg(F.count("*").alias("n"))
    widest = {r["depth"]: r["n"] for r in depths.groupBy("depth").agg(F.max("n").alias("n")).collect()}
    depth = next((d for d in range(DEPTH) if widest.get(d, 0) <= cell), DEPTH)
    own = words.select("word", "n", F.element_at(_depths(F.col("word")), depth + 1).alias("cell"), F.lit(True).alias("own"))
    asks = words.select("word", "n", F.explode(_asked(F.col("word"), depth)).alias("cell"), F.lit(False).alias("own"))
    dealt = own.unionByName(asks).withColumn("block", F.lit(0))
    if widest.get(depth, 0) > cell:
        # Cells that no further level divides are dealt in blocks, and of two blocks the lower asks the higher.
        cells = depths.where(F.col("depth") == depth).select("cell", F.ceil(F.col("n") / cell).cast("int").alias("blocks"))
        home = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
        begin = F.when(F.col("own"), home).otherwise(F.lit(0))
        dealt = (dealt.drop("block").join(cells, "cell").withColumn("block", F.explode(F.sequence(begin, F.col("blocks") - 1)))
                 .withColumn("own", F.col("own") & (F.col("block") == home)).repartition("cell", "block"))
    found = dealt.select("cell", "block", "word", "n", "own").groupBy("cell", "block").applyInPandas(_searched, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of ``forms`` (word, form) along the forms
    to the last. Each round doubles the way that is known; a form has at least
    twice the occurrences of its word, so six rounds are enough for any table."""
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        crowd = now.groupBy("root").agg(F.count("*").alias("k"))
        hops = saved(now.select(F.col("word").alias("root"), F.col("root").alias("next")).join(crowd, "root"), "hops")
        if hops.isEmpty():
            return now
        moved = skew_join(now, hops, "root", "k", now.count(), "left")
        now = saved(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(words: DataFrame, ratio: int = 2, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near and form_n of each row of ``words`` (word,
    n; words are distinct and made of Latin-1 letters).

    Two words are near if they differ by exactly one inserted, deleted or
    replaced letter. A word's form is its near word of the largest n (of equal
    ones the smallest word in code-point order) if that is at least ``ratio``
    times its own n, else null; its root is where the forms end. An empty table
    gives no rows; words of any length are compared whole."""
    if ratio < 2:
        raise ValueError("forms must grow on the way to the root: ratio >= 2")
    words = saved(words.select("word", "n"), "words")
    found = near_words(words, cell)
    formed = F.col("best_n") >= ratio * F.col("n")
    joined = saved(words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "formed")
    ends = roots(joined.where("form is not null"))
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
