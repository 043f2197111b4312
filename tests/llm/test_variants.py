"""Spelling variants, conversation repair and exact dedup against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shipcast.llm import conversations as C
from shipcast.llm import exact_dedup, spelling

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- spelling variants ----------------------------------------------------------

def _words(rows):
    out = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            out[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def _edits(w, letters):
    cut = {w[:k] + w[k + 1:] for k in range(len(w))}
    put = {w[:k] + x + w[k:] for k in range(len(w) + 1) for x in letters}
    new = {w[:k] + x + w[k + 1:] for k in range(len(w)) for x in letters}
    return (cut | put | new) - {w}


def _variants(words):
    letters = {x for w in words for x in w}
    near = {w: [v for v in _edits(w, letters) if v in words] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words[form[w]] if form[w] else -1) for w, n in words.items())


def _found(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in df.collect())


def test_counted_words(spark, odd_rows, odd_docs, no_docs, docs_rows):
    accents = [(700, "Élève élève ÉLÈVE été×été Straße straße straße " * 3), (701, "a" * 300_000), (702, "abcdefgh " * 200_000)]
    docs = odd_docs.select("doc_id", "text", "n").unionByName(spark.createDataFrame(accents, "doc_id long, text string").withColumn("n", F.lit(1)))
    for df, rows in ((docs, odd_rows + accents), (spark.createDataFrame(docs_rows, "doc_id long, text string"), docs_rows), (no_docs, [])):
        assert {r["word"]: r["n"] for r in spelling.counted_words(df).collect()} == _words(rows)


@pytest.mark.parametrize("cell", [20_000, 60, 5])
def test_spelling_variants(spark, cell):
    pick = random.Random(4)
    base = ["".join(pick.choice("abcdeghioé") for _ in range(pick.randint(5, 9))) for _ in range(120)]
    words = {w: pick.randint(3, 4000) for w in base}
    for w in base[:60]:  # chains of variants
        for _ in range(6):
            k = pick.randrange(len(w))
            w = pick.choice([w[:k] + w[k + 1:], w[:k] + "s" + w[k:], w[:k] + "t" + w[k + 1:]])
            if len(w) >= 5:
                words.setdefault(w, pick.randint(3, 900))
    words |= {"".join(p): 5 + k % 7 for k, p in enumerate(itertools.permutations("abcde"))}  # one vector for all
    long = "".join(pick.choice("abcdefgh") for _ in range(90))
    words |= {long: 100, long[:40] + long[41:]: 40, long[:70] + "z" + long[71:]: 9, long + long: 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _found(spelling.spelling_variants(df, cell=cell)) == _variants(words)


def test_spelling_of_empty_tables(spark, no_docs):
    assert spelling.spelling_variants(spelling.counted_words(no_docs)).collect() == []
    one = spark.createDataFrame([("alone", 3)], "word string, n long")
    assert _found(spelling.spelling_variants(one)) == [("alone", "", "alone", 3, 0, -1)]


def test_long_ways_to_the_root(spark):
    chain = [("a" * k, 3 * 2 ** k) for k in range(5, 40)]
    got = {r["word"]: r["root"] for r in spelling.spelling_variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 39}


def test_edits_are_verified():
    pick = random.Random(9)
    words = sorted({"".join(pick.choice("ab") for _ in range(pick.randint(5, 8))) for _ in range(150)})
    raw = np.array([w.encode("latin-1") for w in words], dtype=object)
    sizes = np.array([len(w) for w in words])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    want = [words[y] in _edits(words[x], "ab") for x, y in zip(a, b)]
    assert spelling.verified(raw, sizes, a, b).tolist() == want
    assert [spelling.near(raw[x], raw[y]) for x, y in zip(a, b)] == want


# -- conversations ---------------------------------------------------------------

def _harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def _cheapest(turns):
    """Least (cost, audit, lines) over all edits, by states of the grammar:
    0 nothing, 1 system, 2 open user turn, 3 whole pairs."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def relax(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                for x, role in C.ROLES.items():
                    if (s, x) in step:
                        new = (cost + 5, audit + "I", lines + [f"{role}:"])
                        if step[s, x] not in best or new[:2] < best[step[s, x]][:2]:
                            best[step[s, x]] = new
        return best

    best = {0: (0, "", [])}
    for role, text, fault in turns:
        now = {}
        for s, (cost, audit, lines) in relax(dict(best)).items():
            edits = [(s, 2, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                edits += [(step[s, role[:1]], more, "K", [f"{role}:{text}"])] if (s, role[:1]) in step else []
                edits += [(step[s, x], more + 1, "R", [f"{name}:{text}"]) for x, name in C.ROLES.items() if (s, x) in step and x != role[:1]]
            for to, paid, edit, line in edits:
                new = (cost + paid, audit + edit, lines + line)
                if to not in now or new[:2] < now[to][:2]:
                    now[to] = new
        best = now
    return min(v for s, v in relax(best).items() if s in (0, 3))


def _repairs(rows):
    convs = collections.defaultdict(list)
    for conv, *_ in rows:
        convs[conv]
    for conv, turn, role, text in _harmed(rows):
        convs[conv].append((turn, role, text))
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        seen, turns, count = set(), [], collections.Counter()
        for turn, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            turns.append((role, text, fault))
        at = {t for t, _, _ in own if t is not None}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = _cheapest(turns)
        gaps = max(at) - min(at) + 1 - len(at) if at else 0
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def _odd_conversations():
    pick = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u2"]
    texts = ["Yes.", "No!", "And so on", "", " \t", None, "Why? ", "Étude.", "x.  ", "long words. " * 9000]
    rows = [(c, pick.choice([None, pick.randrange(14), pick.randrange(14)]), pick.choice(roles), pick.choice(texts)) for c in range(150) for _ in range(pick.randint(1, 14))]
    rows += [(c, t, pick.choice(["user", "assistant"]), f"Turn {pick.randrange(5)}{pick.choice(['.', ''])}") for c in range(200, 300) for t in range(pick.randint(1, 9))]
    rows += [(None, t, "user", f"{t}.") for t in range(6)] + rows[:12]
    return rows + [(900, t, pick.choice(["user", "assistant", "tool"]), f"{t}.") for t in range(3000)]


def _got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("present", F.lit("x")).withColumn("fault", F.lit(3))
    return df, C.repaired(C.damaged(df), F.col("present"))


def test_repairs(spark):
    rows = _odd_conversations()
    df, out = _got(spark, rows)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str)
    assert got == _repairs(rows)
    # The repaired turns are those of the digest, and follow the grammar.
    turns = collections.defaultdict(list)
    for r in C.repaired_turns(C.damaged(df), out, F.col("present")).collect():
        turns[r["conv_id"]].append((r["place"], r["role"], r["text"], r["edit"]))
    for conv, *_, audit, sha in got:
        own = sorted(turns[conv])
        assert [p for p, *_ in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for _, role, _, _ in own))
        assert "".join(e for *_, e in own) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text, _ in own).encode()).hexdigest() == sha


def test_conversations_without_rows(spark):
    assert _got(spark, [])[1].collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    _, out = _got(spark, [(gone, 0, "user", "Hi.")])
    assert [tuple(r) for r in out.collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    bare = C.repaired(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect()
    assert [tuple(r)[:8] for r in bare] == [(1, 0, 1, 0, 0, 0, 2, "D")]


def test_stacks_of_another_grammar():
    """The tables follow from the grammar: an ambiguous one keeps all stacks."""
    stacks = C.Stacks((("E", ("E", "E")), ("E", ("x",))))
    tops = {0}
    for _ in range(4):
        tops = {new for top in tops for new in stacks.after(top, "x")}
    assert len(tops) > 1 and all(stacks.after(top, C.END) for top in tops)
    assert C.Stacks().after(0, "a") == () and C.Stacks().after(0, C.END) == (0,)


def test_few_tops_live(spark):
    own = C.Conversation(C.Stacks(), {})
    for k in range(20_000):
        own.read(k, "tool", "x.", 0)
        assert len(own.tops) <= 9
    assert len(own.memo) < 60 and len(own.result()[6]) >= 20_000


# -- exact dedup -----------------------------------------------------------------

def _groups(rows):
    groups = collections.defaultdict(list)
    for k, (i, t) in enumerate(rows):
        bare = (t or "").translate({ord(x): None for x in SPACE})
        groups[bare].append((-len(t or ""), i is None, i or 0, k, i))
    out = []
    for bare, own in groups.items():
        keep = min(own)
        out += [(i, keep[4], len(own), (size, none, i or 0) == keep[:3], hashlib.sha256(bare.encode()).hexdigest()) for size, none, _, _, i in own]
    return out


def _dups(df, **kw):
    return [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_duplicates(df, **kw).collect()]


def _check(got, rows):
    want = _groups(rows)
    assert sorted((r[0:3] + r[4:] for r in got), key=str) == sorted((r[0:3] + r[4:] for r in want), key=str)
    kept = collections.Counter(r[4] for r in got if r[3])
    assert set(kept) == {r[4] for r in want} and set(kept.values()) <= {1}  # one row of each group stays
    assert {r[:3] + r[4:] for r in got if r[3]} <= {r[:3] + r[4:] for r in want if r[3]}


def test_exact_duplicates(spark, odd_rows, odd_docs, no_docs, docs_rows):
    _check(_dups(odd_docs), odd_rows)
    _check(_dups(spark.createDataFrame(docs_rows, "doc_id long, text string")), docs_rows)
    assert _dups(no_docs) == []
    text = [("b", "x y"), ("a", "xy "), ("c", "xyz"), (None, "x  y")]
    got = _dups(spark.createDataFrame(text, "doc_id string, text string"))
    assert sorted((i or "-", keep or "-", n, kept) for i, keep, n, kept, _ in got) == [("-", "-", 3, True), ("a", "-", 3, False), ("b", "-", 3, False), ("c", "c", 1, True)]


@pytest.mark.parametrize("size", [64, 256, 1 << 20])
def test_rounds_of_small_filters(spark, size):
    rows = [(k, f"text {k % 900} {'x' * (k % 7)}") for k in range(2500)] + [(k, "hot") for k in range(5000, 5400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    _check(_dups(df, max_filter_bytes=size), rows)


def test_lone_rows_pass_straight_through(spark):
    ids = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    both = ids.unionByName(ids.where("h % 10 = 0"))
    marked = exact_dedup.possibly_repeated(both.repartition(5))
    again = marked.groupBy("h").agg(F.count("*").alias("n"), F.min("suspect").alias("suspect"))
    assert again.where("n > 1 and not suspect").count() == 0
    assert again.where("n = 1 and suspect").count() < 0.06 * 20_000
