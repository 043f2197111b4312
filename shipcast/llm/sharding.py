"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; a row's fractional rank
is its place in that order divided by the rows of its source. Sorted by it,
any stretch holds every source in proportion, so equal cuts give shards that
match the mixture. Both orders are computed without a sort of everything in
one task: the hash order within a source by ranges of the hash, the final
order by ranges of the fractional rank (which is uniform), each with running
totals over the bounded table of range counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the hash and of the fractional rank; each is a window of its own.
RANGES = 4096
SEED = "shard-1"


def interleaved(rows: DataFrame, shards: int, id_col: str = "doc_id", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``rows`` with the further columns ``shard`` and ``slot``.

    Law ``rows``: the counts of shards differ by one at most, and each holds
    its share of every source. Null sources are one source; rows that agree
    in id, source and all of their other columns' hash are interchangeable.
    Slots run from 0 without gaps. An empty table gives no rows."""
    tie = F.xxhash64(*rows.columns)
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("-"), tie.cast("string")))).cast("binary"))
    base = (rows.withColumn("_key", key).withColumn("_tie", tie).withColumn("_from", F.coalesce(F.col(source_col).cast("string"), F.lit("\u0000")))
            .withColumn("_range", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int")))
    counts = base.groupBy("_from", "_range").agg(F.count("*").alias("_n"))
    before = counts.select("_from", "_range", (F.sum("_n").over(Window.partitionBy("_from").orderBy("_range")) - F.col("_n")).alias("_before"),
                           F.sum("_n").over(Window.partitionBy("_from")).alias("_size"))
    place = F.row_number().over(Window.partitionBy("_from", "_range").orderBy("_key", id_col, "_tie"))
    ranked = (base.withColumn("_place", place).join(before, ["_from", "_range"])
              .withColumn("_at", (F.col("_before") + F.col("_place") - F.lit(0.5)) / F.col("_size")))
    cut = ranked.withColumn("_range", F.least(F.floor(F.col("_at") * RANGES), F.lit(RANGES - 1)).cast("int"))
    totals = cut.groupBy("_range").agg(F.count("*").alias("_n"))
    # At most RANGES rows: one for each range.
    whole = Window.orderBy("_range")
    offsets = F.broadcast(totals.select("_range", (F.sum("_n").over(whole) - F.col("_n")).alias("_offset"), F.sum("_n").over(Window.partitionBy()).alias("_total")))
    order = F.row_number().over(Window.partitionBy("_range").orderBy("_at", "_from", "_key", id_col, "_tie"))
    placed = cut.withColumn("_order", order).join(offsets, "_range").withColumn("_index", F.col("_offset") + F.col("_order") - 1)
    shard = F.expr(f"_index * {shards} div _total").cast("int")
    first = F.expr(f"(({shards} - 1) + cast(shard as bigint) * _total) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("_index") - first).select(*rows.columns, "shard", "slot")


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes of the text, null none, plus 1),
    text_crc32 (null as the empty text), law, shard, slot, grown_shard (null
    under this law), source. Texts themselves are not moved."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = interleaved(narrow, shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
