"""Quality rules on repetition within a text, by suffix arrays of words.

The words of a batch of texts lie in one flat array whose symbols belong to
one text each, so no repeat crosses texts. Prefix doubling sorts the suffixes
(only those still tied take part in later rounds); the ranks of each round
give the longest common prefix of neighbours by descending powers of two. Each
interval of suffixes that share a prefix is a repeat that no word to the right
extends; where the words before its suffixes differ, none to the left does
either, and the repeat is maximal. The union of the spans of the maximal
repeats and the longest of them are limited.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import SPACE

#: Words of a repeat that counts (a power of two).
MIN_WORDS = 8
#: Limits of the verdict: share of words inside repeats, and words of the longest.
#: A word of such a repeat also counts for the base rule, so only a share below
#: MAX_REPEAT_PERCENT can decide: half of it here, and a paragraph of 50 words.
MAX_COVERED, MAX_LONGEST = 0.25, 50
WINDOW = 3
#: Fixed values of the contract's base rules.
SYMBOLS = b"#*$%&|<>"
MIN_N_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Words taken at a time; a longer text is taken alone, as a whole.
FLAT = 400_000


def intervals(place: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common-prefix intervals of a suffix array: neighbours ``place`` (the
    second's place, ascending) share ``common`` words. For each pair of
    neighbours the deepest interval that holds both, and for each interval its
    first and last pair. Every pair is pushed and popped once."""
    own, first, last = np.zeros(len(place), dtype=np.int64), [], []
    open_: list[tuple[int, int]] = []  # (words, number) of the intervals around the pair before, the deepest last
    before = -1
    for t, (k, words) in enumerate(zip(place.tolist(), common.tolist())):
        if k != before + 1:
            for _, i in open_:
                last[i] = t - 1
            open_.clear()
        before, begun = k, t
        while open_ and open_[-1][0] > words:
            i = open_.pop()[1]
            last[i], begun = t - 1, first[i]
        if not open_ or open_[-1][0] < words:
            open_.append((words, len(first)))
            first.append(begun)
            last.append(t)
        own[t] = open_[-1][1]
    for _, i in open_:
        last[i] = len(place) - 1
    return own, np.array(first, dtype=np.int64), np.array(last, dtype=np.int64)


def repeats(symbols: np.ndarray, end: np.ndarray, min_words: int = MIN_WORDS, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each position: words of the longest repeat that starts there (0
    below ``min_words``), whether that repeat is maximal, and whether the
    position lies in a ``window``-word window found twice; and a position of
    each maximal repeat. ``end``: where the text of each position ends."""
    n = len(symbols)
    longest, windowed = np.zeros(n, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    whole, found = np.zeros(n, dtype=bool), np.zeros(0, dtype=np.int64)
    if not n:
        return longest, whole, windowed[:0].astype(bool), found
    order = np.argsort(symbols, kind="stable")
    fresh = np.concatenate(([True], symbols[order][1:] != symbols[order][:-1]))
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int32)
    rank[order] = start
    tied = np.bincount(start, minlength=n)
    ranks, h = [rank], 1
    live = np.flatnonzero(tied[rank] > 1)
    while len(live):
        ahead = live + h
        second = np.where(ahead < end[live], rank[np.minimum(ahead, n - 1)], -1)
        order = np.lexsort((second, rank[live]))
        a, first, second = live[order], rank[live][order], second[order]
        new_first = np.concatenate(([True], first[1:] != first[:-1]))
        new = new_first | np.concatenate(([True], second[1:] != second[:-1]))
        at = np.arange(len(a))
        group = np.maximum.accumulate(np.where(new_first, at, 0))
        own = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[a] = first + (own - group)
        ranks.append(rank)
        h *= 2
        if h == 2:
            _windows(rank, end, a, window, windowed)
        size = np.bincount(own, minlength=len(a))
        live = np.sort(a[size[own] > 1])
    sa = np.empty(n, dtype=np.int64)
    sa[rank] = np.arange(n)
    level = min_words.bit_length() - 1
    if level < len(ranks):
        # Neighbours that agree in min_words words, then by descending powers in more.
        x, y = sa[:-1], sa[1:]
        both = ranks[level][x] == ranks[level][y]
        x, y = x[both], y[both]
        common = np.full(len(x), min_words, dtype=np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            i, j = x + common, y + common
            inside = (i < end[x]) & (j < end[y])
            same = inside.copy()
            same[inside] = ranks[k][i[inside]] == ranks[k][j[inside]]
            common += same * (1 << k)
        np.maximum.at(longest, x, common)
        np.maximum.at(longest, y, common)
        own, first, last = intervals(np.flatnonzero(both), common)
        # The word before each position; only one suffix of a text has none.
        left = np.concatenate(([-1], np.where(end[1:] == end[:-1], symbols[:-1], -1)))
        changes = np.concatenate(([0], np.cumsum(left[x] != left[y])))
        maximal = changes[last + 1] > changes[first]
        for some in (x, y):
            deepest = common == longest[some]
            whole[some[deepest]] = maximal[own[deepest]]
        found = x[first[maximal]]
    return longest, whole, np.cumsum(windowed)[:-1] > 0, found


def _windows(rank: np.ndarray, end: np.ndarray, some: np.ndarray, window: int, out: np.ndarray) -> None:
    """Mark (as a difference array) the windows of three words found twice; ``rank`` is that of word pairs."""
    if window != 3:
        raise ValueError("windows of three words only")
    some = some[some + window <= end[some]]
    joint = rank[some].astype(np.int64) * (len(rank) + 1) + rank[some + 1]
    order = np.argsort(joint, kind="stable")
    same = joint[order][1:] == joint[order][:-1]
    twice = np.zeros(len(some), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    np.add.at(out, some[twice], 1)
    np.add.at(out, some[twice] + window, -1)


def fresh_starts(longest: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where a longest repeat starts that is not the rest of the one a word before."""
    before = np.concatenate(([0], longest[:-1]))
    before[begin == np.arange(len(begin))] = 0
    return np.flatnonzero((longest > 0) & (before != longest + 1))


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, longest_repeat long, n_repeats long, n_maximal long"
_NO_WORD_CHARS = SPACE.encode() + bytes(range(0x80, 0xC0))


def _plain(text: str, raw: bytes) -> tuple[int, int, int]:
    seen: set = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            if line in seen:
                again += 1
            seen.add(line)
    return len(raw.translate(None, _NO_WORD_CHARS)), len(raw) - len(raw.translate(None, SYMBOLS)), again


def _measured(texts: list, min_words: int) -> list[tuple]:
    number: dict = {}
    codes, plain, sizes = [], [], []
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        words = raw.split()
        plain.append(_plain(t or "", raw))
        sizes.append(len(words))
        codes.extend([number.setdefault(w, len(number)) for w in words])
    size = np.array(sizes, dtype=np.int64)
    stop = np.cumsum(size)
    doc = np.repeat(np.arange(len(texts)), size)
    symbols = doc * (len(number) + 1) + np.array(codes, dtype=np.int64)
    end, begin = stop[doc], (stop - size)[doc]
    longest, whole, windowed, found = repeats(symbols, end, min_words)
    starts = np.flatnonzero(whole)
    reach = np.zeros(len(symbols), dtype=np.int64)
    reach[starts] = starts + longest[starts]
    covered = np.maximum.accumulate(reach) > np.arange(len(reach)) if len(reach) else reach.astype(bool)
    k = len(texts)
    most = np.zeros(k, dtype=np.int64)
    np.maximum.at(most, doc[starts], longest[starts])
    count = lambda flags: np.bincount(doc, weights=flags, minlength=k).astype(np.int64)
    number_of, n_maximal = (np.bincount(doc[at], minlength=k) for at in (fresh_starts(longest, begin), found))
    return [(int(size[i]), *plain[i], int(w), int(c), int(most[i]), int(r), int(m)) for i, (w, c, r, m) in enumerate(zip(count(windowed), count(covered), number_of, n_maximal))]


def measures(text: Column, min_words: int = MIN_WORDS) -> Column:
    """Struct of the counts of each text (null and empty: all zero); see
    MEASURES. ``n_covered`` and ``longest_repeat`` are of the maximal repeats,
    ``n_maximal`` is their number, and ``n_repeats`` that of places where a
    longest repeat starts which is not the rest of the one before."""
    if min_words & (min_words - 1) or min_words < 4:
        raise ValueError("min_words must be a power of two, 4 at least")

    @F.pandas_udf(MEASURES)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEASURES.split(", ")]
        for texts in batches:
            rows: list[tuple] = []
            part: list = []
            chars = 0
            for t in texts:
                n = len(t or "")
                if part and chars + n > 6 * FLAT:
                    rows += _measured(part, min_words)
                    part, chars = [], 0
                part.append(t)
                chars += n
            if part:
                rows += _measured(part, min_words)
            yield pd.DataFrame(rows, columns=names)

    return measured(text)


def judged(docs: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, the measures, base_failed, kept.

    ``base_failed``: fewer than 50 words, or over half of them in repeated
    three-word windows. ``kept``: not base_failed, at most the share
    ``max_covered`` of the words in repeats of ``min_words`` words or more, and no repeat over
    ``max_longest`` words. Null and empty texts have no words and fail.
    Repeated rows are judged each by itself; other columns are not read."""
    m = docs.select("doc_id", measures(F.col("text"), min_words).alias("_m")).select("doc_id", "_m.*")
    failed = (F.col("n_words") < MIN_N_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    fine = (F.col("n_covered") <= F.lit(max_covered) * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return m.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fine)
