"""Line dedup, decontamination, repetition rules and shards against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shipcast.llm import decontaminate, line_dedup, quality_rules, sharding
from shipcast.llm.line_dedup import Cuckoo, LineIndex, built

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _key(line):
    return line.strip(SPACE).translate(LOWER)


def _kept_lines(rows):
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(_key(line)) >= 10 and i is not None:
                held[_key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (own := held.get(_key(x), ())) or i is not None and min(own) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def _lines(df):
    return sorted(((r["doc_id"], r["lines"]["n_lines"], r["lines"]["n_dropped"], r["lines"]["kept"]) for r in line_dedup.dedup_lines(df).collect()), key=str)


def test_line_dedup(spark, docs_rows, odd_rows, odd_docs, no_docs):
    assert _lines(odd_docs) == _kept_lines(odd_rows)
    real = spark.createDataFrame(docs_rows, "doc_id long, text string")
    assert _lines(real) == _kept_lines(docs_rows)
    assert _lines(no_docs) == []
    named = [(None if i is None else f"d{i:04}", t) for i, t in odd_rows]
    assert _lines(spark.createDataFrame(named, "doc_id string, text string")) == _kept_lines(named)
    last = [(2**63 - 1, "the very last line"), (None, "the very last line"), (None, "only without an id"), (None, "only without an id"), (7, "x\nthe very last line"), (7, "the very last line")]
    assert _lines(spark.createDataFrame(last, "doc_id long, text string")) == _kept_lines(last)


def test_lines_are_met_through_the_filters(spark, monkeypatch):
    """The second batch meets the counts of the first only by its filters."""
    rows = [(k, f"own line of document {k}\nshared line number {k % 30}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _lines(df) == _kept_lines(rows)
    monkeypatch.setattr(line_dedup.Cuckoo, "holds", lambda self, h: line_dedup.np.zeros(len(h), dtype=bool))
    assert _lines(df) != _kept_lines(rows)


def test_filters_are_dealt_anew_when_keys_outgrow_them(spark):
    line = lambda k: f"a line of number {k:06}"
    docs = lambda a, b: spark.createDataFrame([(k, f"{line(k)}\n{line(k // 2)}") for k in range(a, b)], "doc_id long, text string")
    index = LineIndex.empty(spark, shard_keys=50).insert(docs(0, 30))
    assert index.shards == 1
    index = index.insert(docs(30, 900))
    assert index.shards == 18 and index.filters.count() == 18 and index.filters.agg(F.max("n")).first()[0] < 100
    assert index.holds(index.counts.select("key")).where("not known").count() == 0
    back = index.insert(docs(900, 950)).delete(spark.range(30, 900).select(F.col("id").alias("doc_id"))).insert(docs(30, 900))
    whole = LineIndex.empty(spark).insert(docs(0, 950))
    drops = lambda index: sorted((r["did"], sorted(map(bytes, r["keys"]))) for r in index.dropped().collect())
    assert drops(back) == drops(whole) and back.counts.count() == whole.counts.count()


def test_line_index_is_reversible(spark, docs_rows):
    df = spark.createDataFrame(docs_rows, "doc_id long, text string")
    first, second = df.where("doc_id % 2 = 0"), df.where("doc_id % 2 = 1")
    content = lambda index: sorted(map(tuple, index.counts.select(F.hex("key"), "n", "first", "last").collect()))
    half = LineIndex.empty(spark).insert(first)
    whole = half.insert(second)
    assert content(whole) == content(LineIndex.empty(spark).insert(df))
    back = whole.delete(second.select("doc_id"))
    assert content(back) == content(half)
    # Known lines are always found; lines that have gone mostly are not.
    known = lambda index, keys: {bytes(r["key"]): r["known"] for r in index.holds(keys).collect()}
    assert all(known(back, half.counts.select("key")).values())
    gone = whole.counts.select("key").join(half.counts.select("key"), "key", "left_anti")
    found = known(back, gone)
    assert len(found) > 50 and sum(found.values()) < 0.05 * len(found)
    drops = lambda index: sorted((r["did"], sorted(map(bytes, r["keys"]))) for r in index.dropped().collect())
    assert drops(back) == drops(half) and drops(back) != drops(whole)


def test_keys_that_share_a_print_do_not_hide_each_other(spark):
    spots = {}
    for k in range(100_000):
        line = f"planted line {k}"
        h = line_dedup._hashes([hashlib.md5(line.encode()).digest()])
        print_, a, b = Cuckoo(64)._spots(h)
        other = spots.setdefault((int(print_[0]), *sorted((int(a[0]), int(b[0])))), line)
        if other != line:
            break
    one = lambda i, t: spark.createDataFrame([(i, t)], "doc_id long, text string")
    gone = lambda i: spark.createDataFrame([(i,)], "doc_id long")
    both = LineIndex.empty(spark).insert(one(1, other)).insert(one(2, line))
    assert both.filters.agg(F.sum("n")).first()[0] == 2
    for first, second, text in ((1, 2, line), (2, 1, other)):
        left = both.delete(gone(first))
        assert [r["known"] for r in left.holds(left.counts.select("key")).collect()] == [True]
        again = left.insert(one(3, text))
        assert [(r["n"], r["first"], r["last"]) for r in again.counts.collect()] == [(2, second, 3)]
        assert [r["did"] for r in again.dropped().collect()] == [3]


def test_cuckoo_filter():
    import numpy as np

    h = np.random.default_rng(1).integers(0, 2**63, 60_000, dtype=np.uint64)
    f = built(h[:40_000])
    assert f.holds(h[:40_000]).all() and f.holds(h[40_000:]).mean() < 0.01
    f.delete(h[:20_000])
    assert f.holds(h[20_000:40_000]).all() and f.holds(h[:20_000]).mean() < 0.01
    assert Cuckoo(f.buckets, f.table.tobytes()).holds(h[20_000:40_000]).all()
    assert not Cuckoo(64).insert(h[:1000])


WORDS = re.compile(decontaminate.WORD)


def _hits(rows, items):
    low = lambda t: WORDS.findall((t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for name, t in items:
        w = low(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k:k + 13])].add("" if name is None else str(name))
    out = []
    for i, t in rows:
        w, hit, found = low(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                got = windows.get(tuple(w[k:k + n]))
                if got:
                    hit |= set(range(k, k + n))
                    found |= got
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def _report(docs, bench):
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in decontaminate.report(docs, bench).select(*names).collect()), key=str)


def test_decontamination(spark, docs_rows, odd_rows, odd_docs, no_docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    docs = spark.createDataFrame(docs_rows, "doc_id long, text string")
    assert _report(docs, bench) == _hits(docs_rows, items)
    long = next(t for _, t in odd_rows if t and len(t) > 50_000)
    short = [(1, "alpha beta"), (2, "zeta"), (3, None), (None, "x1 x1 gamma"), (4, " .. "), (4, " ".join(long.split()[100:140])), (5, " ".join(long.split()[120:150])), (6, "Épsilon")]
    own = spark.createDataFrame(short, "item_id long, text string")
    assert _report(odd_docs, own) == _hits(odd_rows, short)
    assert _report(odd_docs, own.where("false")) == _hits(odd_rows, [])
    assert _report(no_docs, own) == []


def test_decontamination_in_blocks(spark, odd_docs, odd_rows):
    long = next(t for _, t in odd_rows if t and len(t) > 50_000).split()
    items = [(k, " ".join(long[40 * k:40 * k + 30])) for k in range(40)] + [(99, "alpha beta gamma")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.with_hits(odd_docs.select("doc_id", "text"), bench, block_words=200)
    hits = F.col("_hits")
    got = sorted(((r[0], r[1], r[2], r[3]) for r in out.select("doc_id", hits["n_words"], decontaminate.n_hit(hits), F.size(hits["items"])).collect()), key=str)
    assert got == sorted((x[:4] for x in _hits(odd_rows, items)), key=str)


def test_decontaminated_documents(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rest = " ".join(f"w{k}" for k in range(400))
    docs = spark.createDataFrame([(1, item, 0), (2, f"{rest} {item}. {rest}", 5), (3, rest, 5)], "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = {r["doc_id"]: r for r in decontaminate.decontaminated(docs, bench).collect()}
    assert set(same) == {2, 3} and item in same[2]["text"]
    cut = {r["doc_id"]: r for r in decontaminate.decontaminated(docs, bench, cut_spans=True).collect()}
    assert cut[2]["text"] == f"{rest} . {rest}" and cut[2]["n_chars"] == len(cut[2]["text"]) and cut[3]["n_chars"] == 5
    odd = [(4, f"NATO É. {rest.upper()} ONE Two {item[8:]}! THE End {rest}"), (5, "A B-C d_E " * 300 + f"({item.title()})" + " x" * 300)]
    left = {r["doc_id"]: r["text"] for r in decontaminate.decontaminated(spark.createDataFrame(odd, "doc_id long, text string"), bench, cut_spans=True).collect()}
    assert left == {4: f"NATO É. {rest.upper()} ! THE End {rest}", 5: "A B-C d_E " * 300 + "()" + " x" * 300}
    plan = decontaminate.decontaminated(docs, bench, cut_spans=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    more = bench.unionByName(spark.createDataFrame([(2, " ".join(f"w{k}" for k in range(10, 30)))], "item_id long, text string"))
    one, many = ({r["doc_id"]: tuple(r) for r in decontaminate.decontaminated(docs.where("doc_id <> 3"), more, coverage=0.5, cut_spans=True, block_words=n).collect()} for n in (400_000, 10))
    assert one == many and "w9 w30" in " ".join(one[2][1].split()) and "fourteen" not in one[2][1]


def _measures(t):
    w = (t or "").encode().split()
    n = len(w)
    tri = collections.Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    windowed = {j for i in range(n - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    covered, most = set(), 0
    places = collections.defaultdict(list)
    for i in range(n - 7):
        places[tuple(w[i:i + 8])].append(i)
    for at in places.values():
        if len(at) > 1:
            covered |= {j for i in at for j in range(i, i + 8)}
            at.sort(key=lambda i: w[i:])
            for a, b in zip(at, at[1:]):
                k = 8
                while max(a, b) + k < n and w[a + k] == w[b + k]:
                    k += 1
                most = max(most, k)
    lines = [x for x in (t or "").split("\n") if x.strip(SPACE)]
    return (n, len("".join(re.split(f"[{SPACE}]+", t or ""))), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(windowed), len(covered), most)


def test_quality_rules(spark, docs_rows, odd_rows, odd_docs, no_docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]
    rows = [r for r in odd_rows + docs_rows[:80] if len(r[1] or "") < 40_000]
    for df, src in ((spark.createDataFrame(rows, "doc_id long, text string"), rows), (no_docs, [])):
        got = quality_rules.judged(df).collect()
        assert sorted(([r["doc_id"], *(r[c] for c in names)] for r in got), key=str) == sorted(([i, *_measures(t)] for i, t in src), key=str)
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
            assert r["kept"] == (not r["base_failed"] and 4 * r["n_covered"] <= r["n_words"] and r["longest_repeat"] <= 50)
    assert quality_rules.judged(odd_docs).count() == len(odd_rows)


def _maximal(w, least=8):
    """(words covered, words of the longest, number) of the maximal repeats, by trying every run of words."""
    n, places = len(w), collections.defaultdict(list)
    for i in range(n):
        for j in range(i + least, n + 1):
            places[tuple(w[i:j])].append(i)
    found = [(at, len(run)) for run, at in places.items() if len(at) > 1
             and len({w[i - 1] if i else None for i in at}) > 1 and len({w[i + len(run)] if i + len(run) < n else None for i in at}) > 1]
    return len({j for at, k in found for i in at for j in range(i, i + k)}), max((k for _, k in found), default=0), len(found)


def test_maximal_repeats_by_every_run_of_words():
    pick = np.random.default_rng(5)
    texts = ["", " ", "a " * 70, "a b " * 30, "a b c d e f g h i " * 5, "x " + "a b c d e f g h " * 2 + "y " + "a b c d e f g h z " * 2]
    for letters in (1, 2, 3, 5):
        for _ in range(25):
            some = [list(map(str, pick.integers(0, letters, pick.integers(1, 20)))) for _ in range(3)]
            texts.append(" ".join(x for _ in range(pick.integers(1, 8)) for x in some[pick.integers(0, 3)]))
    texts += [None, texts[7], "a " * 8]
    names = [c.split()[0] for c in quality_rules.MEASURES.split(", ")]
    at = [names.index(c) for c in ("n_covered", "longest_repeat", "n_maximal")]
    want = [_maximal((t or "").split()) for t in texts]
    assert [tuple(r[k] for k in at) for r in quality_rules._measured(texts, 8)] == want
    assert sum(m > 1 for _, _, m in want) > 20


def test_each_repeat_limit_decides_alone(spark):
    own = [f"w{k}" for k in range(600)]
    short = [w for k in range(0, 120, 12) for w in own[k:k + 12]]
    texts = [own,  # nothing repeated
             own[:360] + [w for k in range(0, 120, 12) for w in (f"x{k}", *short[k:k + 12])],  # ten passages of 12 words twice
             own[:500] + own[:60],  # one passage of 60 words twice
             own[:500] + own[:40]]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.judged(docs).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [(got[k]["n_covered"], got[k]["longest_repeat"]) for k in range(4)] == [(0, 0), (240, 12), (120, 60), (80, 40)]
    assert [got[k]["kept"] for k in range(4)] == [True, False, False, True]


@pytest.mark.parametrize("shards", [16, 7])
def test_shards_match_the_mixture(spark, shards, odd_docs, no_docs):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 50).cast("string")).alias("text"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 11).cast("string"))).alias("source"))
    rows = sharding.sharded(docs, shards).collect()
    assert len(rows) == 5000 and {r["doc_id"] for r in rows} == set(range(5000))
    count = collections.Counter(r["shard"] for r in rows)
    assert set(count) == set(range(shards)) and max(count.values()) - min(count.values()) <= 1
    for k, n in count.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(n))
    size, each = collections.Counter(r["source"] for r in rows), collections.Counter((r["source"], r["shard"]) for r in rows)
    # A cut lies off its place by half a row of each source at most; a source gets its share of that, and rounds its own.
    assert all(abs(each[s, k] - n / shards) <= 2 * (len(size) / 2 * n / 5000 + 1) for s, n in size.items() for k in range(shards))
    for r in rows[:200]:
        text = f"text {r['doc_id'] % 50}".encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.sharded(docs.repartition(5), shards).collect())) if shards == 7 else True
    odd = sharding.sharded(odd_docs, shards).collect()
    assert len(odd) == odd_docs.count() and [r["size"] for r in odd if r["doc_id"] == 1] == [1]
    assert sharding.sharded(no_docs, shards).collect() == []
