"""Exact duplicates by two passes over a Bloom filter of text digests.

The first pass counts, in cells of a filter, how often each cell is hit: not
at all, once, or more often. Tasks count for themselves; their counts are
added cell by cell. A digest that occurs twice has hit all its cells twice, so
a row with a cell that was hit only once is surely alone. The second pass asks
the cells for every row: rows that are surely alone pass straight through,
only the others are shuffled, grouped by digest and judged exactly.

The filter that is broadcast has a fixed greatest size. Where the rows need
more cells, the hashes are dealt into ranges and each range has its own round
of both passes over the narrow table of digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import SPACE, saved, scratch_path, skew_join

#: Cells of the filter for each row and cells that a digest hits: about 1 in 40 lone rows is asked for nothing.
CELLS_PER_ROW, HITS = 8, 4
#: Greatest size of the filter that is broadcast; it covers 134 million rows, and more rows take more rounds.
MAX_FILTER_BYTES = 1 << 27
#: Bytes of a piece of the filter, as tasks hand it on.
PIECE = 1 << 16


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def cells(h: np.ndarray, bits: int) -> np.ndarray:
    """The cells (of 2 ** bits) that each 64-bit hash hits, one row each."""
    h = h.astype(np.int64, copy=False).view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[None, :] + np.arange(HITS, dtype=np.uint64)[:, None] * step[None, :]) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def _get(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def repeated_cells(hashes: DataFrame, bits: int, partitions: int) -> np.ndarray:
    """Bitmap of the cells that the hashes (column ``h``) hit more than once."""
    size = 1 << (bits - 3)
    piece = min(PIECE, size)
    schema = "piece int, once binary, more binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more, any_row = np.zeros(size, np.uint8), np.zeros(size, np.uint8), False
        for batch in batches:
            at = np.sort(cells(batch.column(0).to_numpy(), bits).ravel())
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = at[1:] != at[:-1]
            _set(more, at[~fresh])
            at = at[fresh]
            _set(more, at[_get(once, at)])
            _set(once, at)
            any_row |= bool(len(at))
        for k in range(size // piece if any_row else 0):
            cut = slice(k * piece, (k + 1) * piece)
            if once[cut].any():
                yield pa.RecordBatch.from_pydict({"piece": pa.array([k], pa.int32()), "once": [once[cut].tobytes()], "more": [more[cut].tobytes()]})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if k in sums:
                    once, more = sums[k]
                    more |= b | (once & a)
                    once |= a
                else:
                    sums[k] = a.copy(), b.copy()
        for k, (_, more) in sums.items():
            if more.any():
                yield pa.RecordBatch.from_pydict({"piece": pa.array([k], pa.int32()), "more": [more.tobytes()]})

    counted = hashes.select("h").mapInArrow(count, schema)
    found = counted.repartition(max(1, min(partitions, size // piece)), "piece").mapInArrow(added, "piece int, more binary")
    whole = np.zeros(size, np.uint8)
    for row in found.toLocalIterator():
        whole[row["piece"] * piece:(row["piece"] + 1) * piece] = np.frombuffer(row["more"], np.uint8)
    return whole


def possibly_repeated(digests: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``digests`` (with a column ``h`` of 64-bit hashes) and ``suspect``:
    false only where no other row has the same hash."""
    spark = digests.sparkSession
    rows = digests.count()
    if not rows:
        return digests.withColumn("suspect", F.lit(False))
    rounds = -(-rows * CELLS_PER_ROW // (max_filter_bytes * 8))
    bits = max(10, min((rows * CELLS_PER_ROW // rounds).bit_length(), (max_filter_bytes * 8).bit_length() - 1))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "marked")
    for k in range(rounds):
        own = digests.where(F.pmod(F.shiftrightunsigned("h", 17), F.lit(rounds)) == k) if rounds > 1 else digests
        sent = spark.sparkContext.broadcast(repeated_cells(own, bits, partitions))

        @F.pandas_udf("boolean")
        def suspect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            bitmap = sent.value
            for h in batches:
                yield pd.Series(_get(bitmap, cells(h.to_numpy(), bits)).all(axis=0), dtype=bool)

        own.withColumn("suspect", suspect("h")).write.mode("append").parquet(path)
        sent.unpersist()
    return spark.read.schema(digests.schema.add("suspect", "boolean")).parquet(path)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without ASCII white space; null
    and empty texts, and texts of white space alone, are equal. Of equal texts
    the row with the most code points in its whole text stays, then that of
    the smallest id (a null id comes last); of rows that tie in all of that
    exactly one stays. ``keep_id`` is the id of the row that stays (null if it
    has none), ``text_sha256`` that of the normalised text. Texts are held
    equal by their SHA-256. Long texts are read whole; other columns are not
    read, whatever their names; an empty table gives no rows."""
    text = F.col(f"`{text_col}`")
    digests = saved(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.char_length(text), F.lit(0)).alias("chars"),
                                F.unhex(F.sha2(normalised(text), 256)).alias("digest")).withColumn("h", F.xxhash64("digest")), "digests")
    marked = possibly_repeated(digests, max_filter_bytes)
    alone = marked.where("not suspect").select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    some = marked.where("suspect")
    first = F.min(F.struct((-F.col("chars")).alias("size"), F.col("doc_id").isNull().alias("bare"), "doc_id", "row"))
    groups = saved(some.groupBy("digest").agg(first.alias("keep"), F.count("*").alias("group_size")), "groups")
    judged = skew_join(some, groups.withColumn("n", F.col("group_size")), "digest", "n", digests.count())
    ruled = judged.select("doc_id", "digest", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"))
    return alone.unionByName(ruled).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
