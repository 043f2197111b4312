"""Line deduplication that can be undone: sharded cuckoo filters in front of
exact reference counts.

The index of a corpus has three tables: ``refs`` (one row for each distinct
line key of each row of a document), ``counts`` (key, number of references, first and
last document) and ``filters`` (one cuckoo filter for each shard of the
keys; when the keys outgrow the shards, there are more shards from then on).
Inserting documents asks the filters which keys may be known; keys
that a filter does not hold are surely new and are appended without a look at
``counts``, the others are merged with it exactly. Every key without a row in
``counts`` then gets a print of its own, also one that the filter only seemed
to hold: else deleting one of two such keys would hide the other. Deleting documents takes
their references back; keys with none left leave both counts and filter, so a
line that was dropped as a copy comes back when its keeper goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.llm.common import LOWER, SPACE, UPPER, ascii_lower, saved, skew_join

MIN_CHARS = 10
#: Keys of a shard when the filters are dealt out; at twice as many they are dealt out anew.
SHARD_KEYS = 1 << 17
SLOTS = 4
#: Batches in which a whole table is inserted: each but the first asks the filters of those before.
BATCHES = 2


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def line_refs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(did, row, key): the distinct line keys of each row, as 16-byte
    digests. ``did`` is the doc_id; with ``row``, a hash of the text, it names
    the row."""
    keys = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), _key), lambda k: F.char_length(k) >= min_chars)
    digests = F.transform(F.array_distinct(keys), lambda k: F.unhex(F.md5(k)))
    return docs.select(F.col("doc_id").alias("did"), F.xxhash64("text").alias("row"), F.explode(digests).alias("key"))


def counted(refs: DataFrame) -> DataFrame:
    """(key, n, first, last) of the references of documents that have an id."""
    return refs.where("did is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("did").alias("first"), F.max("did").alias("last"))


class Cuckoo:
    """A cuckoo filter over 64-bit hashes: 16-bit prints, two buckets of four
    slots for each, in numpy. All methods take arrays."""

    def __init__(self, buckets: int, table: bytes | None = None):
        self.buckets = buckets
        self.table = np.frombuffer(table, dtype=np.uint16).reshape(buckets, SLOTS).copy() if table else np.zeros((buckets, SLOTS), dtype=np.uint16)

    def _spots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = (h & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = ((h >> np.uint64(20)) & np.uint64(self.buckets - 1)).astype(np.int64)
        return prints, first, self._other(prints, first)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ ((prints.astype(np.int64) * 0x5BD1E995 >> 7) & (self.buckets - 1))

    def holds(self, h: np.ndarray) -> np.ndarray:
        prints, a, b = self._spots(h)
        return (self.table[a] == prints[:, None]).any(axis=1) | (self.table[b] == prints[:, None]).any(axis=1)

    def insert(self, h: np.ndarray) -> bool:
        """Insert each hash; false if the table is too full (then rebuild)."""
        prints, at, _ = self._spots(h)
        for turn in range(500):
            if not len(prints):
                return True
            order = np.argsort(at, kind="stable")
            prints, at = prints[order], at[order]
            fresh = np.concatenate(([True], at[1:] != at[:-1]))
            place = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            free = self.table[at] == 0
            nth = np.cumsum(free, axis=1)
            fits = place < nth[:, -1]
            slot = np.argmax(free & (nth == place[:, None] + 1), axis=1)
            self.table[at[fits], slot[fits]] = prints[fits]
            prints, at, fresh = prints[~fits], at[~fits], fresh[~fits]
            if turn % 2 and len(prints):
                # One print of each full bucket makes room and moves to its other bucket.
                one = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                s = turn // 2 % SLOTS
                out = self.table[at[one], s].copy()
                full = out != 0
                one, out = one[full], out[full]
                self.table[at[one], s] = prints[one]
                prints[one] = out
            at = self._other(prints, at)
        return False

    def delete(self, h: np.ndarray) -> None:
        """Take one print of each hash out (only hashes that were inserted)."""
        prints, a, b = self._spots(h)
        missed = self._take(prints, a)
        self._take(prints[missed], b[missed])

    def _take(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Clear a slot with each print in its bucket; which were not there."""
        missed, todo = np.zeros(len(at), dtype=bool), np.arange(len(at))
        while len(todo):
            _, one = np.unique(at[todo], return_index=True)  # one print of each bucket at a time
            now, todo = todo[one], np.delete(todo, one)
            hit = self.table[at[now]] == prints[now, None]
            found = hit.any(axis=1)
            self.table[at[now][found], hit.argmax(axis=1)[found]] = 0
            missed[now[~found]] = True
        return missed


def built(h: np.ndarray, least: int = 64) -> Cuckoo:
    """A filter that holds ``h``, at most about three quarters full."""
    buckets = max(least, 1 << max(0, int(len(h) / SLOTS / 0.75)).bit_length())
    while True:
        out = Cuckoo(buckets)
        if out.insert(h):
            return out
        buckets *= 2


def _hashes(keys) -> np.ndarray:
    """The second half of each digest as a 64-bit hash (the first half deals the shards)."""
    return np.frombuffer(b"".join(bytes(k)[8:] for k in keys), dtype=np.uint64).copy()


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.substring(key, 1, 8)), F.lit(shards)).cast("int")


FILTER = "shard int, buckets long, slots binary, n long"
ASKED = "key binary, known boolean"


def _asked(keys: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """(key, known): whether the filter of its shard holds each key."""
    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known = np.zeros(len(left), dtype=bool)
        if len(left) and len(right):
            known = Cuckoo(int(right["buckets"].iloc[0]), right["slots"].iloc[0]).holds(_hashes(left["key"]))
        return pd.DataFrame({"key": left["key"], "known": known})

    dealt = keys.select("key", shard_of(F.col("key"), shards).alias("shard"))
    return dealt.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(one, ASKED)


def _updated(delta: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The filters brought up to date; buckets -1: too full, to be rebuilt.

    ``delta``: key, gone. A key that is gone had a print, which is taken out;
    any other has no row in the counts yet and gets one, held or not."""
    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        shard = int((left if len(left) else right)["shard"].iloc[0])
        h, gone = _hashes(left["key"]), left["gone"].to_numpy(dtype=bool)
        n = len(h) - 2 * int(gone.sum())
        if len(right):
            f, n = Cuckoo(int(right["buckets"].iloc[0]), right["slots"].iloc[0]), n + int(right["n"].iloc[0])
            f.delete(h[gone])
            if not f.insert(h[~gone]):
                f = None
        else:
            f = built(h[~gone])
        return pd.DataFrame({"shard": [shard], "buckets": [f.buckets if f else -1], "slots": [f.table.tobytes() if f else None], "n": [n]})

    dealt = delta.withColumn("shard", shard_of(F.col("key"), shards))
    return dealt.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(one, FILTER)


def _rebuilt(keys: DataFrame, shards: int) -> DataFrame:
    def one(frame: pd.DataFrame) -> pd.DataFrame:
        f = built(_hashes(frame["key"]))
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])], "buckets": [f.buckets], "slots": [f.table.tobytes()], "n": [len(frame)]})

    return keys.withColumn("shard", shard_of(F.col("key"), shards)).groupBy("shard").applyInPandas(one, FILTER)


@dataclass
class LineIndex:
    """Reference table, exact counts and filters of the documents inserted."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    rows: int
    shard_keys: int = SHARD_KEYS

    @staticmethod
    def empty(spark: SparkSession, id_type: str = "long", shard_keys: int = SHARD_KEYS) -> LineIndex:
        """``id_type``: the type of the documents' doc_id."""
        return LineIndex(spark.createDataFrame([], f"did {id_type}, row long, key binary"), spark.createDataFrame([], f"key binary, n long, first {id_type}, last {id_type}"),
                         spark.createDataFrame([], FILTER), 1, 0, shard_keys)

    def insert(self, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineIndex:
        """The index with ``docs`` (doc_id, text) added. Rows of a doc_id that
        is there already are further rows of the same document."""
        return self.insert_refs(saved(line_refs(docs, min_chars), "refs"))

    def insert_refs(self, refs: DataFrame) -> LineIndex:
        """The index with the references of ``line_refs`` added."""
        delta = saved(counted(refs), "delta")
        rows = refs.count()
        if not rows:
            return self
        new = delta.select("key")
        if self.rows:
            known = saved(_asked(new, self.filters, self.shards).where("known").select("key"), "known")
            fresh, again = delta.join(known, "key", "left_anti"), delta.join(known, "key", "left_semi")
            met = saved(self.counts.join(known, "key", "left_semi"), "met")
            merged = met.unionByName(again).groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
            counts = saved(self.counts.join(met, "key", "left_anti").unionByName(merged).unionByName(fresh), "counts")
            new = new.join(met, "key", "left_anti")
        else:
            counts = delta
        grown = LineIndex(self.refs.unionByName(refs) if self.rows else refs, counts, self.filters, self.shards, self.rows + rows, self.shard_keys)
        return grown._with_filters(new.withColumn("gone", F.lit(False)))

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of ``ids`` (a column doc_id)."""
        gone = ids.select(F.col("doc_id").alias("did")).distinct()
        same = F.col("r.did").eqNullSafe(F.col("g.did"))
        own, lost = self.refs.alias("r"), gone.alias("g")
        keys = saved(own.join(lost, same, "left_semi").select("key").distinct(), "touched")
        refs = saved(own.join(lost, same, "left_anti"), "refs")
        counts = saved(self.counts.join(keys, "key", "left_anti").unionByName(counted(refs.join(keys, "key", "left_semi"))), "counts")
        out = keys.join(self.counts, "key", "left_semi").join(counts, "key", "left_anti")
        shrunk = LineIndex(refs, counts, self.filters, self.shards, refs.count(), self.shard_keys)
        return shrunk._with_filters(out.withColumn("gone", F.lit(True)))

    def _with_filters(self, delta: DataFrame) -> LineIndex:
        """The filters brought up to date, in more shards if the keys have
        outgrown them; a filter that is too full is built anew."""
        keys = self.counts.count()
        if keys > 2 * self.shards * self.shard_keys or not self.filters.head(1):
            shards = max(1, -(-keys // self.shard_keys))
            return replace(self, filters=saved(_rebuilt(self.counts.select("key"), shards), "filters"), shards=shards)
        updated = saved(_updated(delta, self.filters, self.shards), "updated")
        fit, full = updated.where("buckets > 0"), updated.where("buckets < 0").select("shard")
        if full.isEmpty():
            return replace(self, filters=fit)
        own = self.counts.withColumn("shard", shard_of(F.col("key"), self.shards)).join(full, "shard", "left_semi").select("key")
        return replace(self, filters=saved(fit.unionByName(_rebuilt(own, self.shards)), "filters"))

    def holds(self, keys: DataFrame) -> DataFrame:
        """``keys`` (16-byte digests, distinct) with ``known``: false surely means that no document with an id has the line."""
        return _asked(keys, self.filters, self.shards)

    def dropped(self) -> DataFrame:
        """(did, row, keys): for each row the line keys that it loses: those
        that a smaller doc_id holds too, and for a row without an id those that
        any document with an id holds."""
        held = self.counts.where("first < last").select("key", "n", "first")
        lost = skew_join(self.refs.where("did is not null"), held, "key", "n", self.rows).where("did > first")
        bare = self.refs.where("did is null")
        if not bare.isEmpty():
            crowd = bare.groupBy("key").agg(F.count("*").alias("n"))
            lost = lost.unionByName(skew_join(bare, crowd.join(self.counts.select("key", "first"), "key"), "key", "n", self.rows))
        return lost.groupBy("did", "row").agg(F.collect_set("key").alias("keys"))


def _without(text: Column, keys: Column, min_chars: int) -> Column:
    """Struct n_lines, n_dropped, kept of a text without the lines of ``keys``."""
    lower = str.maketrans(UPPER, LOWER)

    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drops in batches:
            rows = []
            for text, drop in zip(texts, drops):
                text = text or ""
                if drop is None or not len(drop):
                    rows.append((text.count("\n") + 1, 0, text))
                    continue
                gone, lines = {bytes(k) for k in drop}, text.split("\n")
                kept = []
                for line in lines:
                    key = line.strip(SPACE).translate(lower)
                    if len(key) < min_chars or hashlib.md5(key.encode()).digest() not in gone:
                        kept.append(line)
                rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
            yield pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])

    return cut(text, keys)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the further column ``lines`` (n_lines, n_dropped, kept).

    The text is split at \\n (null or empty: one empty line). A line's key is
    the line without ASCII white space at its ends and with A-Z lower-cased.
    Keys of at least ``min_chars`` code points that at least two documents
    hold lose all their lines, except in the smallest doc_id. A doc_id may be
    of any type that is ordered. Rows with one doc_id are one document and keep
    or lose their lines together. A row without a doc_id is never the one that
    keeps a line: it loses the lines that documents with an id hold. Other
    columns pass through; one named ``lines`` is replaced, and names that begin
    with ``_line_`` are taken.

    The documents are inserted into an empty index in batches. Long texts are
    split by rows of lines; a row is named by its doc_id and a hash of its text,
    so that many rows of one id are not gathered."""
    spark = docs.sparkSession
    refs = saved(line_refs(docs, min_chars), "refs")
    index = LineIndex.empty(spark, docs.schema["doc_id"].dataType.simpleString())
    for k in range(batches):
        index = index.insert_refs(refs.where(F.pmod(F.xxhash64("did"), F.lit(batches)) == k))
    lost = saved(index.dropped(), "dropped").select(F.col("did").alias("_line_did"), F.col("row").alias("_line_row"), F.col("keys").alias("_line_keys"))
    own = docs.withColumn("_line_hash", F.xxhash64("text"))
    same = own["doc_id"].eqNullSafe(lost["_line_did"]) & (own["_line_hash"] == lost["_line_row"])
    return own.join(lost, same, "left").withColumn("lines", _without(F.col("text"), F.col("_line_keys"), min_chars)).drop("_line_did", "_line_row", "_line_hash", "_line_keys")
