"""SimHash near-duplicate detection with pigeonring filtering.

Fingerprints of 64 bits lie on a ring of ``segments`` parts. If two differ in
at most ``limit`` bits, some segment starts a chain whose first l segments
differ in at most ``l * limit / segments`` bits in total, for every l. The
first two conditions of the chain (the start segment agrees up to its budget
of zero, the next one differs in one bit at most) give the candidate keys:
the start segment with either half of the next. A key that is crowded gets a
second part: the bits outside it are cut into ``limit + 1`` parts, of which a
pair within the limit shares one. Within a key, pairs are pruned by the rest
of the chain before the Hamming check. Only the links of a spanning forest of
each block are written, so a dense group never yields all its pairs, and
blocks of a key that stays crowded are bounded in rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.common import removed, saved, skew_join

#: Distinct fingerprints of a key that are compared in one piece.
BLOCK = 1024
#: Shingles whose bits are counted at a time.
SHINGLES = 1 << 18


def fingerprint_column(text: Column, shingle_words: int = 4, seed: int = 42) -> Column:
    """64-bit fingerprint (as long) of each text.

    A-Z are lower-cased; words are runs of other than ASCII white space;
    shingles of ``shingle_words`` words joined by one space, repeats
    included; fewer words form one shingle; no words (or null) give zero. A
    bit is set if it is set in over half of the XXH64 values."""
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import xxhash
        digest = xxhash.xxh64_intdigest

        def one(value) -> int:
            words = value.encode().lower().split() if value else []
            if not words:
                return 0
            flat = b" ".join(words)
            starts = np.zeros(len(words), dtype=np.int64)
            sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            np.cumsum(sizes[:-1] + 1, out=starts[1:])
            k = min(shingle_words, len(words))
            begin, end = starts[:len(words) - k + 1].tolist(), (starts + sizes)[k - 1:].tolist()
            count = np.zeros(64, dtype=np.int64)
            for at in range(0, len(begin), SHINGLES):
                h = np.array([digest(flat[a:b], seed) for a, b in zip(begin[at:at + SHINGLES], end[at:at + SHINGLES])], dtype=">u8")
                count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            return int(np.packbits(2 * count > len(begin)).view(">i8")[0])

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="int64")

    return fingerprints(text)


def bounds(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment of 64 bits."""
    cuts = [64 * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def candidate_keys(fp: Column, segments: int) -> Column:
    """The candidate keys of a fingerprint: start segment, half, their bits."""
    def bits(shift: int, width: int) -> Column:
        return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))

    parts = bounds(segments)
    keys = []
    for k, (shift, width) in enumerate(parts):
        s, w = parts[(k + 1) % segments]
        for half, (a, b) in enumerate(((s, w // 2), (s + w // 2, w - w // 2))):
            tag = (2 * k + half) << 56
            keys.append(F.lit(tag).bitwiseOR(F.shiftleft(bits(shift, width), 28)).bitwiseOR(bits(a, b)))
    return F.array(*keys)


def second_parts(segments: int, limit: int) -> list[list[int]]:
    """For each kind of candidate key (start segment and half), masks of
    ``limit + 1`` parts of the bits that the key leaves out, dealt in turn."""
    parts, out = bounds(segments), []
    for k, (shift, width) in enumerate(parts):
        s, w = parts[(k + 1) % segments]
        for a, b in ((s, w // 2), (s + w // 2, w - w // 2)):
            taken = set(range(shift, shift + width)) | set(range(a, a + b))
            free = [bit for bit in range(64) if bit not in taken]
            out.append([sum(1 << bit for bit in free[j::limit + 1]) for j in range(limit + 1)])
    return out


def _dealt(keyed: DataFrame, limit: int, segments: int) -> DataFrame:
    """(key, fps) with at most two blocks of fingerprints in each row, so that
    every two fingerprints that share a key and may be linked meet in a row."""
    crowd = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    few = (keyed.join(crowd.where(F.col("n") <= BLOCK), "key").groupBy("key").agg(F.collect_list("fp").alias("fps")))
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    masks = F.array(*[F.array(*[F.lit(signed(m)).cast("long") for m in kind]) for kind in second_parts(segments, limit)])
    second = F.transform(F.get(masks, F.shiftrightunsigned("key", 56).cast("int")), lambda mask, j: F.struct(j.alias("part"), F.col("fp").bitwiseAND(mask).alias("bits")))
    finer = keyed.join(crowd.where(F.col("n") > BLOCK), "key").select("key", "fp", F.explode(second).alias("s")).select("key", "fp", "s.*")
    name = ["key", "part", "bits"]
    blocks = finer.groupBy(*name).agg(F.count("*").alias("n")).where("n > 1").select(*name, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    many = (finer.join(blocks, name).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .groupBy(*name, F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"))
            .agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("key", "fps"))
    return few.unionByName(many)


def links(fps: DataFrame, limit: int = 4, segments: int = 5) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints (column ``fp``)
    that differ in at most ``limit`` bits: each pair within the limit is
    joined by a path of links, and every link is within the limit."""
    if limit >= segments:
        raise ValueError("a chain must start with an equal segment: limit < segments")
    dealt = _dealt(fps.select("fp", F.explode(candidate_keys(F.col("fp"), segments)).alias("key")), limit, segments)
    parts = bounds(segments)

    def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        masks = [np.uint64(((1 << w) - 1) << s) for s, w in parts]

        def near(x: np.ndarray, start) -> np.ndarray:
            """Which differences pass the chain from segment ``start`` and the Hamming check."""
            ok = np.ones(len(x), dtype=bool)
            total = np.zeros(len(x), dtype=np.int64)
            for step in range(segments):
                mask = np.take(masks, (start + step) % segments)
                total += np.bitwise_count(x & mask)
                ok &= total * segments <= (step + 1) * limit
            return ok & (np.bitwise_count(x) <= limit)

        for frame in batches:
            small_a, small_b, small_start, found = [], [], [], []
            for key, fps in zip(frame["key"].to_numpy(), frame["fps"]):
                fps = np.asarray(fps, dtype=np.int64).view(np.uint64)
                start = int(key) >> 57
                if len(fps) <= 24:
                    i, j = np.triu_indices(len(fps), 1)
                    small_a.append(fps[i])
                    small_b.append(fps[j])
                    small_start.append(np.full(len(i), start))
                    continue
                todo = fps
                while len(todo):
                    ring, todo = [todo[0]], todo[1:]
                    while ring and len(todo):
                        a = ring.pop()
                        hit = near(todo ^ a, start)
                        got = todo[hit]
                        if len(got):
                            found.append(np.stack([np.full(len(got), a), got]))
                            ring.extend(got)
                            todo = todo[~hit]
            if small_a:
                a, b = np.concatenate(small_a), np.concatenate(small_b)
                hit = near(a ^ b, np.concatenate(small_start))
                found.append(np.stack([a[hit], b[hit]]))
            if found:
                a, b = np.concatenate(found, axis=1).view(np.int64)
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    return dealt.mapInPandas(forests, "a long, b long").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): ``root`` is the least
    node of its connected component. Large-star and small-star steps
    alternate until no link changes; each round is a saved table."""
    now = saved(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    seal = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(floor, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("s"))
                 .select("s.*").where("u <> v").distinct())
        new = saved(small, "links")
        mark = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        removed(now)
        now = new
        if mark == seal:
            break
        seal = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _grouped(docs: DataFrame, limit: int, shingle_words: int, segments: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, fp) of each row, ``row`` a hash of its text; and (fp, n,
    root, component_id) of each fingerprint."""
    text = F.col(text_col)
    prints = saved(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"), fingerprint_column(text, shingle_words).alias("fp")), "prints")
    fps = saved(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")), "fps")
    nodes = saved(components(links(fps.select("fp"), limit, segments)), "nodes")
    rooted = fps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "n", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("k"))
    return prints, saved(skew_join(rooted.select("fp", "n", "root"), least, "root", "k", fps.count()).select("fp", "n", "root", "component_id"), "named")


def near_duplicates(docs: DataFrame, limit: int = 4, shingle_words: int = 4, segments: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``limit`` differing bits. Null and empty texts have fingerprint zero and
    link like any other. Repeated rows are kept; a null doc_id keeps its row
    but names a component only if no other id is in it. Other columns are not
    read; an empty table gives no rows."""
    prints, named = _grouped(docs, limit, shingle_words, segments, id_col, text_col)
    out = skew_join(prints, named.drop("root"), "fp", "n", prints.count())
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def distinct_documents(docs: DataFrame, limit: int = 4, shingle_words: int = 4, segments: int = 5) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) without near
    duplicates: one row of each component stays.

    That is the row of the smallest doc_id (a null one comes last); of rows of
    one id, the one of the least fingerprint, then of the least hash of its
    text; of rows with the same id and text, any one. Null and empty texts form
    one component. Rows are told apart by doc_id and a hash of the text, and
    the rows to drop are anti-joined, so that texts are shuffled only where
    these are too many to broadcast. Names that begin with ``_near_`` are
    taken."""
    prints, named = _grouped(docs, limit, shingle_words, segments, "doc_id", "text")
    rows = saved(skew_join(prints, named.select("fp", "n", "root"), "fp", "n", prints.count()), "rows")
    place = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "fp", "row")
    best = rows.groupBy("root").agg(F.min(place).alias("keep")).select("root", "keep.doc_id", "keep.fp", "keep.row")
    marked = saved(rows.groupBy("root", "doc_id", "fp", "row").agg(F.count("*").alias("n")).alias("r")
                   .join(best.withColumn("stays", F.lit(True)).alias("b"), (F.col("r.root") == F.col("b.root")) & (F.col("r.row") == F.col("b.row")) & (F.col("r.fp") == F.col("b.fp")) & F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")), "left")
                   .select(F.col("r.doc_id").alias("_near_id"), F.col("r.row").alias("_near_row"), "n", F.coalesce("stays", F.lit(False)).alias("stays")), "marked")
    own = docs.withColumn("_near_hash", F.xxhash64("text"))

    def among(names: DataFrame, how: str) -> DataFrame:
        return own.join(names, own["doc_id"].eqNullSafe(names["_near_id"]) & (own["_near_hash"] == names["_near_row"]), how)

    # Rows that are repeated whole go like the others; one of each that stays comes back.
    out = among(marked.where("not stays or n > 1").select("_near_id", "_near_row"), "left_anti")
    again = marked.where("stays and n > 1").select("_near_id", "_near_row")
    if not again.isEmpty():
        out = out.unionByName(among(again, "left_semi").dropDuplicates(["doc_id", "_near_hash"]))
    return out.drop("_near_hash")
