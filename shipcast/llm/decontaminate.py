"""Benchmark decontamination by a generalised suffix automaton of the test
items' words.

The automaton is built from the items (a table whose size is checked; beyond
the bound the items form several blocks, each with its automaton). Documents
stream their words through it: the state holds the longest suffix of the
words read that occurs in an item, and its length. Where that length reaches
a window, or the state's suffixes include a whole short item, the words
covered are hit. Runs of word pairs that no item has cannot hold a window,
so only other runs are walked.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import removed, saved

#: A word is a run of letters and digits of ASCII, and of all other characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: Words of the items in one automaton; more items form further blocks.
BLOCK_WORDS = 400_000

_word = re.compile(WORD)
_gap = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Every character that is in no word becomes a space; A-Z become lower case.
_spaced = {c: " " for c in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))} | {k: chr(v) for k, v in _lower.items()}
_spaced_bytes = bytes(ord(_spaced.get(c, chr(c))) if c < 128 else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8. A text is translated once, so no pattern runs over it."""
    return text.encode().translate(_spaced_bytes).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences.

    ``items``: (item id, words). A window is ``window`` consecutive words of
    an item, or a whole shorter item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        number = self.vocabulary
        coded = [(name, [number.setdefault(w, len(number) + 1) for w in words]) for name, words in items if words]
        ends = []
        for name, code in coded:
            last, path = 0, []
            for w in code:
                last = self._extend(last, w)
                path.append(last)
            ends.append((name, code))
        #: Items whose words reach a state; those of a short item as a whole, by state.
        self.names: list[set] = [set() for _ in self.next]
        self.short: dict[int, list[tuple[int, str]]] = {}
        pairs = set()
        for name, code in ends:
            state = 0
            for w in code:
                state = self.next[state][w]
                up = state
                while up > 0 and name not in self.names[up]:
                    self.names[up].add(name)
                    up = self.link[up]
            if len(code) < window:
                self.short.setdefault(state, []).append((len(code), name))
            pairs.update(zip(code, code[1:]))
        base = len(number) + 1
        self.pairs = np.array(sorted(a * base + b for a, b in pairs), dtype=np.int64)
        self.base = base
        self.least = min((min(window, len(c)) for _, c in coded), default=0)
        self.single = np.array(sorted({c[0] for _, c in coded if len(c) == 1}), dtype=np.int64)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        if w in nxt[last]:
            q = nxt[last][w]
            return q if size[q] == size[last] + 1 else self._split(last, q, w)
        new = len(nxt)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def longest(self, code: list[int]) -> Iterator[tuple[int, int]]:
        """For each word: the state and the length of the longest match that ends there."""
        nxt, link, size = self.next, self.link, self.size
        state = length = 0
        for w in code:
            while state and w not in nxt[state]:
                state = link[state]
                length = size[state]
            if w in nxt[state]:
                state = nxt[state][w]
                length += 1
            yield state, length

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans [a, b) of a document's words, and the items found."""
        get = self.vocabulary.get
        code = np.array([get(w, 0) for w in words], dtype=np.int64)
        found: list[tuple[int, int]] = []
        names: set = set()
        if not len(code) or not self.least:
            return found, names
        joint = code[:-1] * self.base + code[1:]
        at = np.searchsorted(self.pairs, joint)
        linked = np.zeros(len(joint), dtype=bool)
        inside = at < len(self.pairs)
        linked[inside] = (self.pairs[at[inside]] == joint[inside]) & (code[:-1][inside] > 0) & (code[1:][inside] > 0)
        edge = np.diff(np.concatenate(([0], linked.astype(np.int8), [0])))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        if self.least == 1:
            lone = np.flatnonzero(np.isin(code, self.single) & (code > 0))
            begins, ends = np.concatenate([begins, lone]), np.concatenate([ends, lone + 1])
        else:
            long = ends - begins >= self.least
            begins, ends = begins[long], ends[long]
        for a, b in zip(begins.tolist(), ends.tolist()):
            for k, (state, length) in enumerate(self.longest(code[a:b].tolist())):
                if length >= self.window:
                    found.append((a + k + 1 - length, a + k + 1))
                    whole = state
                    while self.size[self.link[whole]] >= self.window:
                        whole = self.link[whole]
                    names |= self.names[whole]
                up = state
                while self.short and up > 0:
                    for n, name in self.short.get(up, ()):
                        if n <= length:
                            found.append((a + k + 1 - n, a + k + 1))
                            names.add(name)
                    up = self.link[up]
        return found, names


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The items in blocks of a bounded number of words (by a hash of the item)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text")).where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // (2 * block_words)) or 1  # a word and its gap take two characters at least
    return [items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k) for k in range(n)] if n > 1 else [items]


HITS = "n_words long, spans array<struct<a: int, b: int>>, items array<string>"


def without(text: str, spans: list) -> str:
    """The text without spans [a, b) of its words, from the first character of
    a span's first word to the last of its last."""
    at = [m.span() for m in _word.finditer(text.translate(_lower))]  # as long as the text
    for a, b in reversed(spans):
        text = text[:at[a][0]] + text[at[b - 1][1]:]
    return text


def hits_column(text: Column, automaton, cut: bool = False) -> Column:
    """Struct of each text: n_words, merged hit spans of words, items found;
    with ``cut`` also ``kept``, the text without its spans where it has some.
    ``automaton`` is what ``_built`` made, as a broadcast."""
    columns = ["n_words", "spans", "items"] + ["kept"] * cut

    @F.pandas_udf(HITS + ", kept string" * cut)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Automaton.__new__(Automaton)
        own.__dict__ = pickle.loads(automaton.value)
        for texts in batches:
            rows = []
            for t in texts:
                words = words_of(t)
                found, names = own.spans(words)
                merged: list[list[int]] = []
                for a, b in sorted(found):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                row = (len(words), [{"a": a, "b": b} for a, b in merged], sorted(names))
                rows.append((*row, without(t, merged) if merged else None) if cut else row)
            yield pd.DataFrame(rows, columns=columns)

    # Else a filter on the hits would be pushed below them and find them twice.
    return hits.asNondeterministic()(text)


def _built(block: DataFrame, window: int) -> bytes:
    """The automaton of a block of items, built in a task; what comes back is
    bounded by the words of a block."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = {(name, text) for frame in batches for name, text in zip(frame["name"], frame["text"])}
        own = Automaton([(name, words_of(text)) for name, text in sorted(items)], window)
        yield pd.DataFrame({"automaton": [pickle.dumps(own.__dict__)]})

    made = block.coalesce(1).mapInPandas(build, "automaton binary").first()
    return bytes(made[0]) if made else pickle.dumps(Automaton([], window).__dict__)  # no partition at all


def with_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, cut: bool = False) -> DataFrame:
    """``docs`` with a further column ``_hits`` (n_words, spans, items; with
    ``cut`` and one block of items also ``kept``).

    One pass over the documents for each block of items, each with the one
    automaton of its block; between passes the documents and the hits so far
    are a saved table. Null and empty texts have no words; items without words
    have no windows; null item ids count as the empty id. An empty benchmark
    hits nothing. Columns named ``_hits`` or ``_more`` are taken."""
    spark, out = docs.sparkSession, docs
    blocks = _blocks(benchmark, block_words)
    for k, block in enumerate(blocks):
        held = spark.sparkContext.broadcast(_built(block, window))
        if not k:
            out = out.withColumn("_hits", hits_column(F.col("text"), held, cut and len(blocks) == 1))
        else:
            both = out.withColumn("_more", hits_column(F.col("text"), held))
            spans, items = (F.concat(F.col("_hits")[c], F.col("_more")[c]) for c in ("spans", "items"))
            out = both.withColumn("_hits", F.struct(F.col("_hits")["n_words"].alias("n_words"), merged_spans(spans).alias("spans"), F.array_sort(F.array_distinct(items)).alias("items"))).drop("_more")
        if k < len(blocks) - 1:
            now = saved(out, "hits")
            held.destroy()
            if k:
                removed(before)
            out = before = now
    return out


def merged_spans(spans: Column) -> Column:
    """Sorted spans without overlap that cover the same words."""
    start = F.expr("cast(array() as array<struct<a: int, b: int>>)")

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b"))))
        return F.when(F.size(done) == 0, F.array(s)).when(s["a"] <= last["b"], joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), start, step)


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + (s["b"] - s["a"]))


def is_contaminated(hit: Column, words: Column, coverage: float = 0.05) -> Column:
    """Some words are hit, and at least the share ``coverage`` of all."""
    return (hit > 0) & (hit * F.lit(round(1 / coverage)) >= words)


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = 0.05, cut_spans: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the documents over the coverage limit.

    ``cut_spans``: of the others, spans that reach the length limit are cut
    out of the text (from the first character of their first word to the last
    of their last); n_chars, if there, follows. Columns stay as they are."""
    own = with_hits(docs, benchmark, window, block_words, cut_spans)
    kept = own.where(~is_contaminated(n_hit(F.col("_hits")), F.col("_hits")["n_words"], coverage))
    if cut_spans:
        if "kept" in own.schema["_hits"].dataType.names:
            text = F.coalesce(F.col("_hits")["kept"], F.col("text"))
        else:  # the spans of several blocks are cut together
            @F.pandas_udf("string")
            def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
                return pd.Series([without(t, [(s["a"], s["b"]) for s in found]) if t and len(found) else t for t, found in zip(texts, spans)], dtype=object)

            text = cut("text", "_hits.spans")
        kept = kept.withColumn("text", text)
        if "n_chars" in docs.columns:
            kept = kept.withColumn("n_chars", F.when(F.size("_hits.spans") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated. Rows stay one to one; other columns are not read."""
    hits = F.col("_hits")
    own = with_hits(docs.select("doc_id", "text"), benchmark)
    return own.select("doc_id", hits["n_words"].alias("n_words"), n_hit(hits).alias("n_hit"), F.size(hits["items"]).cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort(hits["items"]), ","), 256).alias("items_sha256")).withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))
