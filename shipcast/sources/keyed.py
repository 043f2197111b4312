"""Key index of a table: exact duplicate checks that open little of it (S5,
R1, R3).

A table that only ever takes rows of new keys (the operational store, the
predictions) must be asked, for each small batch, which keys it holds. The
index answers from narrow files of its own: the keys, dealt into buckets by
their hash, and a Bloom filter for each bucket. A batch reads the filters of
the buckets that its keys fall into, and then opens only the buckets in which
a filter holds one of them; so a batch of new keys opens next to none.

The table is the truth: ``sync`` covers the data files that the index has not
seen, so a writer that died between the table and the index does no harm, and
a table without an index gets one. Newly covered keys are small parts beside
the buckets and are merged into them when they are many. A state of the index
is a list of folders, published through a small file; one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.sources.layers import data_files, hadoop_path, publish, published

#: Keys of a bucket when buckets are dealt out; bits of the filter for each key and bits set by a key.
BUCKET_KEYS, BITS, HITS = 1 << 18, 10, 5
#: Parts beside the buckets, and their keys as a share of all, that are read as they are.
PARTS, PART_SHARE, PART_KEYS = 16, 0.1, 1 << 16
FILTER = "_bucket int, bits binary"


def spots(h: np.ndarray, size: int) -> np.ndarray:
    """The bits of a filter of ``size`` bytes that each hash sets, one row each."""
    h = h.astype(np.int64, copy=False).view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h + np.arange(HITS, dtype=np.uint64)[:, None] * step) % np.uint64(8 * size)).astype(np.int64)


def _filter(frame: pd.DataFrame) -> pd.DataFrame:
    size = max(64, -(-len(frame) * BITS // 8))
    at = spots(frame["_hash"].to_numpy(), size).ravel()
    bits = np.zeros(size, np.uint8)
    np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    return pd.DataFrame({"_bucket": [int(frame["_bucket"].iloc[0])], "bits": [bits.tobytes()]})


def _held(asked: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(asked) or not len(filters):
        return asked.iloc[:0]
    bits = np.frombuffer(filters["bits"].iloc[0], np.uint8)
    at = spots(asked["_hash"].to_numpy(), len(bits))
    return asked[((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1).all(axis=0)]


class KeyIndex:
    """The keys of the Parquet table at ``table``; ``opened`` says which
    buckets the last question read, ``touched`` into which its keys fell."""

    def __init__(self, spark: SparkSession, table: str, key: str = "order_id", path: str | None = None, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.table, self.key, self.bucket_keys = spark, table.rstrip("/"), key, bucket_keys
        self.path = path or f"{self.table}_keys"
        self.opened: list[int] = []
        self.touched: list[int] = []

    # -- states ---------------------------------------------------------------

    def _state(self) -> tuple[int, int, list[str]]:
        """(version, buckets, folders) of the newest state; the first folder
        has the buckets."""
        root, fs = hadoop_path(self.spark, f"{self.path}/states")
        versions = [int(f.getPath().getName()) for f in fs.listStatus(root) if f.getPath().getName().isdigit()] if fs.exists(root) else []
        if not versions:
            return 0, 0, []
        buckets, *folders = published(self.spark, f"{self.path}/states/{max(versions)}").split("\n")
        return max(versions), int(buckets), folders

    def _read(self, folder: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{folder}/{name}")

    def _covered(self, folders: list[str]) -> set[str]:
        return {r[0] for f in folders for r in self._read(f, "files").collect()}

    def _write_files(self, folder: str, files: set[str]) -> None:
        self.spark.createDataFrame([(f,) for f in sorted(files)], "file string").coalesce(1).write.parquet(f"{self.path}/{folder}/files")

    def sync(self, skip: str | None = None) -> None:
        """Cover the table's data files that the index has not seen, but for
        those with ``skip`` in their path (what a retried batch replaces)."""
        version, buckets, folders = self._state()
        covered = self._covered(folders)
        new = {f for f in data_files(self.spark, self.table) if not (skip and skip in f)} - covered
        if not new:
            return
        rows = self.spark.read.parquet(*[f"{self.table}/{f}" for f in sorted(new)]).select(self.key)
        part = f"part-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{part}/keys")
        self._write_files(part, new)
        folders = [*folders, part]
        beside = sum(self._read(f, "keys").count() for f in folders[1:])
        if not buckets or len(folders) > PARTS or beside > max(PART_KEYS, PART_SHARE * self._read(folders[0], "keys").count()):
            buckets, folders = self._merged(folders, covered | new)
        publish(self.spark, "\n".join([str(buckets), *folders]), f"{self.path}/states/{version + 1}")

    def _merged(self, folders: list[str], files: set[str]) -> tuple[int, list[str]]:
        """All keys in one folder of buckets with a filter each."""
        keys = self._read(folders[0], "keys").select(self.key)
        for f in folders[1:]:
            keys = keys.unionByName(self._read(f, "keys").select(self.key))
        buckets = max(1, -(-keys.count() // self.bucket_keys))
        base = f"buckets-{uuid.uuid4().hex}"
        # One shuffle of the keys alone; a bucket's copies meet in its task, and hashes are told again from the keys.
        dealt = self._bucketed(keys, buckets).repartition("_bucket").distinct()
        dealt.write.partitionBy("_bucket").parquet(f"{self.path}/{base}/keys")
        hashes = self._read(base, "keys").select("_bucket", F.xxhash64(self.key).alias("_hash"))
        hashes.groupBy("_bucket").applyInPandas(_filter, FILTER).write.partitionBy("_bucket").parquet(f"{self.path}/{base}/filters")
        self._write_files(base, files)
        return buckets, [base]

    def _bucketed(self, keys: DataFrame, buckets: int) -> DataFrame:
        return keys.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int"))

    # -- questions --------------------------------------------------------------

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (a column of the key) that the covered files hold."""
        version, buckets, folders = self._state()
        self.opened, self.touched = [], []
        asked = keys.select(self.key).where(F.col(self.key).isNotNull())
        if not folders:
            return asked.where("false")
        dealt = self._bucketed(asked, buckets)
        self.touched = _numbers(dealt)
        dealt = dealt.repartition("_bucket").distinct().withColumn("_hash", F.xxhash64(self.key))
        filters = self._read(folders[0], "filters").where(F.col("_bucket").isin(self.touched))
        maybe = dealt.groupBy("_bucket").cogroup(filters.groupBy("_bucket")).applyInPandas(_held, dealt.schema).persist()
        self.opened = _numbers(maybe)
        found = maybe.join(self._read(folders[0], "keys").where(F.col("_bucket").isin(self.opened)).select(self.key), self.key, "left_semi").select(self.key)
        for f in folders[1:]:
            found = found.unionByName(asked.join(self._read(f, "keys"), self.key, "left_semi"))
        return found.distinct()

    def missing(self, rows: DataFrame) -> DataFrame:
        """Those ``rows`` whose key the covered files do not hold."""
        return rows.join(self.known(rows), self.key, "left_anti")

    def drop_old_states(self) -> int:
        """Delete folders that the newest state does not name; how many. For a
        clean-up job: a running question of an older state would lose files."""
        _, _, folders = self._state()
        root, fs = hadoop_path(self.spark, self.path)
        old = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName() not in (*folders, "states")] if fs.exists(root) else []
        return sum(bool(fs.delete(p, True)) for p in old)


def _numbers(rows: DataFrame) -> list[int]:
    """The buckets of the rows: no more than there are buckets."""
    return sorted(r[0] for r in rows.select("_bucket").distinct().collect())
