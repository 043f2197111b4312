"""Pseudonyms, the classifier and page trees against plain Python versions."""

import collections
import datetime
import hashlib
import itertools
import math
import random
import re
import types

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shipcast.llm import boosting, classifier, html_extract, pii

KEY = "a key of this test"
WORD = (1 << 64) - 1


def _feistel(symbols, radix, kind):
    half = len(symbols) // 2
    for k in range(10):
        front = k % 2 == 0
        other = symbols[half:] if front else symbols[:half]
        digest = hashlib.sha512("|".join([KEY, kind, str(k), ",".join(map(str, radix)), ",".join(map(str, other))]).encode()).hexdigest()
        symbols = [(v + int(digest[j % 32 * 4:j % 32 * 4 + 4], 16)) % radix[j] if (j < half) == front else v for j, v in enumerate(symbols)]
    return symbols


def _bare(value):
    return re.sub("[^0-9A-Za-z]", "", value)


def _base(c):
    return 48 if c.isdigit() else 65 if c.isupper() else 97


def _refilled(value, keep, symbols):
    out, at = "", 0
    for c in value:
        if not c.isalnum():
            out += c
            continue
        out += c if at < keep else chr(symbols[at - keep] + _base(c))
        at += 1
    return out


def _turned(chars, kind):
    return _feistel([ord(c) - _base(c) for c in chars], [10 if c.isdigit() else 26 for c in chars], kind)


def _luhn(digits):
    return sum(sum(divmod(int(d) * 2, 10)) if j % 2 else int(d) for j, d in enumerate(reversed(digits)))


def _rest(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _card(v):
    body = _turned(_bare(v)[:-1], "card")
    return _refilled(v, 0, body + [-_luhn("".join(map(str, body)) + "0") % 10])


def _iban(v):
    bare = _bare(v)
    body = _turned(bare[4:], "iban")
    draft = _refilled(bare, 4, body)
    check = 98 - _rest(draft[:2] + "00" + draft[4:])
    return _refilled(v, 2, [check // 10, check % 10] + body)


def _ip(v):
    return ".".join(map(str, _feistel([int(o) for o in v.split(".")], [256] * 4, "ip")))


def _ssn(v):
    while True:
        v = _refilled(v, 0, _turned(_bare(v), "ssn"))
        if not re.match(r"(000|666|9)", v) and "-00-" not in v and not v.endswith("-0000"):
            return v


def _phone(v):
    keep = 1 if v.startswith("+1") else 2 if v.startswith("+4") else 0
    return _refilled(v, keep, _turned(_bare(v)[keep:], "phone"))


def _email(v):
    own, domain = v.split("@")
    return _refilled(own, 0, _turned(_bare(own), "email")) + "@" + domain


def _date(v):
    day = datetime.date(*map(int, v.split("-"))).toordinal() - 1
    first, days, a, b = (0, 693595, 833, 833) if day < 693595 else (693595, 73049, 271, 270) if day < 766644 else (766644, 2885415, 1699, 1699)
    state = [(day - first) // b, (day - first) % b]
    while True:
        state = _feistel(state, [a, b], "date")
        if state[0] * b + state[1] < days:
            return datetime.date.fromordinal(first + state[0] * b + state[1] + 1).isoformat()


def _values():
    pick = random.Random(11)
    digits = lambda n: "".join(pick.choice("0123456789") for _ in range(n))
    for k in range(25):
        body = "4" + digits(14)
        card = body + str(-_luhn(body + "0") % 10)
        yield "card", card if k % 2 else "-".join(card[j:j + 4] for j in range(0, 16, 4)), _card
        account = digits(18)
        iban = f"DE{98 - _rest('DE00' + account):02}{account}"
        yield "iban", iban, _iban
        yield "ip", ".".join(str(pick.randint(0, 255)) for _ in range(4)), _ip
        yield "ssn", f"{pick.randint(100, 665)}-{pick.randint(1, 99):02}-{pick.randint(1, 9999):04}", _ssn
        yield "phone", (f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"+49{digits(9)}")[k % 3], _phone
        yield "email", f"Jo.{digits(2)}{pick.choice('abcXYZ')}@mail{k}.example.com", _email
        yield "date", datetime.date(pick.choice((850, 1950, 2050, 5000)) + k, pick.randint(1, 12), pick.randint(1, 28)).isoformat(), _date


def test_pseudonyms_are_those_of_a_plain_network(spark):
    values = list(_values())
    docs = spark.createDataFrame([(k, f"so {v} it is") for k, (_, v, _) in enumerate(values)], "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r for r in pii.pseudonymised(docs, KEY).collect()}
    for k, (kind, v, make) in enumerate(values):
        assert got[k]["pii_kinds"] == [kind] and got[k]["text"] == f"so {make(v)} it is", (kind, v, got[k]["text"])


def test_pseudonyms_of_odd_tables(spark, no_docs, odd_docs, odd_rows):
    assert pii.pseudonymised(no_docs).collect() == []
    got = pii.pseudonymised(odd_docs)
    assert sorted(((r["doc_id"], r["text"], r["n_replaced"]) for r in got.collect()), key=str) == sorted(((i, t, 0) for i, t in odd_rows), key=str)
    assert set(odd_docs.columns) < set(got.columns)
    long = " and ".join(["10.1.2.3", "word"] * 300)
    out = pii.pseudonymised(spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string"), KEY).collect()
    assert {r["text"] for r in out} == {long.replace("10.1.2.3", _ip("10.1.2.3"))} and [r["n_replaced"] for r in out] == [300, 300]


def _mixed(a):
    a = (a ^ (a >> 31)) * 0x9E3779B97F4A7C15 & WORD
    return a ^ (a >> 29)


def _features(text, bits):
    words = (text or "").encode().split()
    if not words:
        return {1: 1.0}

    def shape(w):
        kinds = ["a" if 97 <= c <= 122 or c >= 128 else "A" if 65 <= c <= 90 else "0" if 48 <= c <= 57 else chr(c) for c in w]
        return "".join(k for k, _ in itertools.groupby(kinds)).encode("latin-1")

    hashes = [(xxhash.xxh64_intdigest(w, 7), xxhash.xxh64_intdigest(shape(w), 11)) for w in words]
    count = collections.Counter()
    for pair in hashes:
        count.update(_mixed(h) >> (64 - bits) for h in pair)
    for a, b in zip(hashes, hashes[1:]):
        count.update((0xD1B54A32D192ED03 if a[0] == b[0] else _mixed((y + 3 * _mixed(x)) & WORD)) >> (64 - bits) for x, y in zip(a, b))
    size = math.sqrt(sum(count.values()))
    return {i: math.sqrt(c) / size for i, c in count.items()}


def _ftrl(rows, bits, epochs=5, alpha=2.0, beta=1.0, l1=0.01, l2=0.05):
    """Weights as a dict; the bias has the key -1 and no L1 term."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)
    data = [({i: float(np.float32(x)) for i, x in _features(t, bits).items()} | {-1: 1.0}, y) for t, y in rows]

    def weight(i):
        bound = 0.0 if i == -1 else l1
        return 0.0 if abs(z[i]) <= bound else (math.copysign(bound, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(17)
    for _ in range(epochs):
        for k in order.permutation(len(data)):
            x, y = data[k]
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - y) * x[i]
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in list(z)}


def test_weights_and_scores_are_those_of_plain_updates(spark, docs_rows, odd_rows):
    rows = [(i, t, k % 2) for k, (i, t) in enumerate(docs_rows[:80])] + [(10_000 + k, t, k % 2) for k, (_, t) in enumerate(odd_rows) if t is not None]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int")
    weights = classifier.train(frame, bits=12)
    ranked = sorted(frame.select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"), "text", "label").collect())
    plain = _ftrl([(r["text"], r["label"]) for r in ranked], 12)
    want = np.array([plain.get(i, 0.0) for i in range(1 << 12)] + [plain[-1]])
    np.testing.assert_allclose(weights, want, atol=1e-8)
    assert np.count_nonzero(want) > 100
    for r in frame.select("text", classifier.score_column(frame, F.col("text"), weights).alias("score")).collect():
        dot = sum(want[i] * x for i, x in _features(r["text"], 12).items()) + want[-1]
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-dot)), abs=1e-6)


def test_tree_scores_and_splits_are_those_of_plain_search():
    draw = np.random.default_rng(3)
    x = np.round(draw.random((300, 4)), 1)
    y = (x[:, 2] + 0.3 * x[:, 0] + 0.2 * draw.random(300) > 0.8).astype(float)
    model = boosting.Boosted(trees=7, depth=3).fit(x, y)
    for row, score in zip(x, model.score(x)):
        total = model.base
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
            k = 0
            while k < 7:
                k = 2 * k + (2 if row[feature[k]] > cut[k] else 1)
            total += leaf[k - 7]
        assert score == pytest.approx(total, abs=1e-12)
    stump = boosting.Boosted(trees=1, depth=1).fit(x, y)
    p = y.mean()

    def value(rows):
        return (y[rows] - p).sum() ** 2 / (p * (1 - p) * rows.sum() + 1)

    best = max(((value(x[:, f] <= c) + value(x[:, f] > c), f, c) for f in range(4) for c in np.unique(x[:, f])
                if min((x[:, f] <= c).sum(), (x[:, f] > c).sum()) * p * (1 - p) >= 5))
    at, f, c = best
    own = x[:, stump.feature[0][0]] <= stump.cut[0][0]
    assert stump.feature[0][0] == f and value(own) + value(~own) == pytest.approx(at)
    for rows, leaf in zip((own, ~own), stump.leaf[0]):
        assert leaf == pytest.approx(0.2 * (y[rows] - p).sum() / (p * (1 - p) * rows.sum() + 1))


def _context(tree, score):
    gain = [0.0]
    cut = lambda v: min(max(v, -4.0), 4.0)
    for k in range(1, len(score)):
        mates = [score[j] for j in range(1, len(score)) if tree.parent[j] == tree.parent[k]]
        gain.append(score[k] + 0.5 * cut(sum(mates) / len(mates)) + 0.6 * cut(gain[tree.parent[k]]))
    return gain


def test_the_best_part_of_a_tree_is_kept():
    pick = random.Random(4)
    for _ in range(40):
        n = pick.randint(3, 11)
        parent = [-1, 0] + [pick.randint(0, k - 1) for k in range(2, n)]
        inner = set(parent) | {1}
        tree = types.SimpleNamespace(parent=parent, tag=["#root"] + ["div" if k in inner else "#text" for k in range(1, n)], text=[f"t{k}" for k in range(n)])
        score = np.array([pick.gauss(0, 3) for _ in range(n)])
        gain = _context(tree, score)
        best = (-1.0, ())
        for some in itertools.product((0, 1), repeat=n - 1):
            keep = (1, *some)
            if all(keep[parent[k]] >= keep[k] for k in range(1, n)):
                best = max(best, (sum(g for g, on in zip(gain, keep) if on), keep))
        want = "\n".join(t for t, on, tag in zip(tree.text, best[1], tree.tag) if on and tag == "#text")
        assert html_extract.decoded(tree, score) == want
