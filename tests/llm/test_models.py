"""SimHash components, encoding, classifier, pages and personal data."""

import collections
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shipcast.llm import classifier, html_extract, pieces, pii, simhash, url_filters
from shipcast.llm.queries import model_path

SF = "/root/testdata/sf0.001"


def _print(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(fps, limit=4):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            root[f] = root[root[f]]
            f = root[f]
        return f

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= limit:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def _expected(rows):
    fp = [_print(t) for _, t in rows]
    comp = _components(set(fp))
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    return sorted(((i, f"{f:016x}", least.get(comp[f])) for (i, _), f in zip(rows, fp)), key=str)


def test_near_duplicates(spark, docs_rows, odd_rows, odd_docs, no_docs):
    got = lambda df: sorted(map(tuple, simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert got(odd_docs) == _expected(odd_rows)
    assert got(spark.createDataFrame(docs_rows, "doc_id long, text string")) == _expected(docs_rows)
    assert got(no_docs) == []


def test_links_find_every_pair_through_crowded_keys(spark):
    pick = random.Random(5)
    centres = [pick.getrandbits(64) for _ in range(3)]
    fps = set(centres)
    for c in centres:
        for _ in range(900):
            f = c
            for b in pick.sample(range(64), pick.randint(1, 5)):
                f ^= 1 << b
            fps.add(f)
    fps |= {pick.getrandbits(64) for _ in range(500)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    block, simhash.BLOCK = simhash.BLOCK, 64
    try:
        pairs = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    finally:
        simhash.BLOCK = block
    mask = (1 << 64) - 1
    assert all(((r["a"] & mask) ^ (r["b"] & mask)).bit_count() <= 4 for r in pairs)
    want = _components(fps)
    found = spark.createDataFrame(pairs, "a long, b long")
    root = {r["node"] & mask: r["root"] for r in simhash.components(found).collect()}
    group = collections.defaultdict(set)
    for f in fps:
        group[want[f]].add(root.get(f, f - (1 << 64) if f >> 63 else f))
    assert all(len(g) == 1 for g in group.values()) and len({next(iter(g)) for g in group.values()}) == len(group)
    with pytest.raises(ValueError):
        simhash.links(found.select(F.col("a").alias("fp")), limit=5)


def test_second_parts_cover_the_bits_outside_a_key():
    kinds = simhash.second_parts(5, 4)
    assert len(kinds) == 10
    for k, kind in enumerate(kinds):
        assert len(kind) == 5 and all(8 <= m.bit_count() <= 10 for m in kind)
        union = 0
        for m in kind:
            assert union & m == 0
            union |= m
        shift, width = simhash.bounds(5)[k // 2]
        assert union & (((1 << width) - 1) << shift) == 0


def test_a_crowded_key_is_not_compared_whole(spark, monkeypatch):
    # 3,000 fingerprints share the first 26 bits, so some keys, and are else at random.
    pick = random.Random(6)
    far = {(pick.getrandbits(38) << 26) | 5 for _ in range(3000)}
    near = {f ^ (1 << pick.randint(26, 63)) ^ (1 << pick.randint(26, 63)) for f in sorted(far)[:40]}
    fps = [(f - (1 << 64) if f >> 63 else f,) for f in far | near]
    monkeypatch.setattr(simhash, "BLOCK", 256)
    frame = spark.createDataFrame(fps, "fp long")
    keyed = frame.select("fp", F.explode(simhash.candidate_keys(F.col("fp"), 5)).alias("key"))
    widest = keyed.groupBy("key").count().agg(F.max("count")).first()[0]
    pairs = simhash._dealt(keyed, 4, 5).agg(F.sum(F.expr("size(fps) * (size(fps) - 1) / 2"))).first()[0]
    assert widest == len(fps)
    assert pairs < 0.2 * widest * (widest - 1) / 2
    mask = (1 << 64) - 1
    want = _components({f & mask for f, in fps})
    root = {r["node"] & mask: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
    for f, in fps:
        mates = {root.get(g, g) for g in want if want[g] == want[f & mask]}
        assert len(mates) == 1


def test_components_of_a_long_path(spark):
    pairs = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(100, 101), (7, 7)], "a long, b long"))
    assert sorted(map(tuple, simhash.components(pairs).collect())) == [(k, 0) for k in range(61)] + [(100, 100), (101, 100)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def test_encoding_is_that_of_the_library(library, docs_rows):
    pick = random.Random(2)
    signs = list("aabbcc eetthh  in\n\t▁0123456789") + ["日", "本", "ﾱ", "é", "\U0001F600", "<0x0A>", "<s>", "▁▁", "\x00"]
    texts = [t for _, t in docs_rows] + ["".join(pick.choice(signs) for _ in range(pick.randint(0, 60))) for _ in range(3000)]
    texts += [" " * n + end for n in (*range(1, 70), 777) for end in ("", "7", "a", "the")] + ["a" * 3000, "ab" * 2000, "▁" * 50, "x " * 3000, "the" * 2000]
    texts.append("".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)))
    with open(model_path(), "rb") as f:
        coder = pieces.Coder(f.read())
    for t, (joined, n, text) in zip(texts, coder.batch(texts)):
        ids = library.encode(t)
        assert [int(x) for u in joined for x in u.split(",")] == ids and n == len(ids)
        assert text == coder.model.decode(ids) == library.decode(ids)


def test_round_trip_columns(spark, library, odd_rows, odd_docs, no_docs):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in odd_rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, pieces.round_trip(odd_docs, model_path()).collect()), key=str) == sorted(want, key=str)
    assert pieces.round_trip(no_docs, model_path()).collect() == []
    coded = odd_docs.select("text", pieces.encode(spark, F.col("text"), model_path()).alias("ids"))
    for r in coded.withColumn("back", pieces.decode(spark, F.col("ids"), model_path())).collect():
        assert r["ids"] == library.encode(r["text"] or "") and r["back"] == library.decode(r["ids"])


def test_classifier_separates_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = classifier.scored(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    out = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.97 * len(out)


def test_classifier_on_odd_tables(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(k, int(k % 2), 0) for k in range(100, 160)] + [(5, None, None), (None, 1, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    got = classifier.scored(odd_docs, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    again = {(r["doc_id"], r["score"]) for r in classifier.scored(odd_docs.repartition(3), labels).collect()}
    assert again == {(r["doc_id"], r["score"]) for r in got}
    assert {r["score"] for r in classifier.scored(odd_docs, labels.where("false")).collect()} == {0.5}
    assert classifier.scored(no_docs, labels).collect() == []


def _article(page):
    a = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1|ul|li)\b[^>]*>", a)]
    return "\n".join(p for p in parts if p)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    page = {r["page_id"]: r["html"] for r in pages.collect()}
    got = html_extract.extracted(pages).collect()
    assert len(got) == len(page) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert sum(r["text"] == _article(page[r["page_id"]]) for r in got) >= 0.99 * len(got)
    model = html_extract.fit(pages)
    other = [('<html><body><div id="hd">Site name <a href=x>Home</a> <a>News</a></div><div class="main-x"><h2>Title here</h2><p>This is a long sentence about things. It goes on and on, and says much &amp; more.'
              "<p>Second paragraph, with <b>bold</b> text and\n more of it. Indeed it is long enough.</div><div class=footer>copyright 2020</div></body></html>",
              "Title here\nThis is a long sentence about things. It goes on and on, and says much & more.\nSecond paragraph, with bold text and more of it. Indeed it is long enough."),
             ("<main><p>One &lt;two&gt; three.</p><aside>rel</aside><div class='cookie-notice'>We use cookies</div><ul><li>item one is here.<li>item two.</ul></main>", "One <two> three.\nitem one is here.\nitem two."),
             ("just  text", "just text"), ("", ""), (None, ""), ("<div><div><", ""), ("<script>var a='<p>x</p>'</script>", "")]
    odd = spark.createDataFrame([(k, "u", h, "x") for k, (h, _) in enumerate(other)], "page_id long, url string, html string, text string")
    assert [r["t"] for r in odd.select("page_id", html_extract.main_text(odd, F.col("html"), model).alias("t")).orderBy("page_id").collect()] == [t for _, t in other]
    assert html_extract.extracted(odd).count() == len(other)
    assert html_extract.extracted(pages.where("false")).collect() == []


@pytest.mark.parametrize("page, texts", [
    ("<head><title>T</title><article><p>One.</p></article>", ["One."]),
    ("<head><meta charset=x>One.<p>Two.", ["One.", "Two."]),
    ("<html><head><noscript><img src=x><p>off</p></noscript><title>T</title><body><p>One.", ["One."]),
    *[(f"<body><p>One.</p><{x}/><p>Two.</p><{x}>gone</{x}><p>Three.</p></body>", ["One.", "Two.", "Three."]) for x in ("svg", "math", "iframe", "script")],
    ("<head><script src=x /><title>T</title></head><body><p>One.</p></body>", ["One."]),
    *[(f"<body><div><p>One.</p><{x}>gone</div><p>Two.</p></body>", ["One.", "Two."]) for x in ("button", "select", "noscript", "object", "video")],
    # The end tag of a block inside a silent element is not that of the block around it.
    ("<div><p>One.</p><button><div>gone</div>gone too</button><p>Two.</p></div>", ["One.", "Two."]),
    ("<div><textarea></div>gone</textarea><p>One.</p></div>", ["One."]),
    ("<div><script>'</div>'</script><p>One.</p></div>", ["One."]),
])
def test_silent_elements_without_end_tags(page, texts):
    assert [t for t in html_extract.Tree(page).text if t] == texts


def test_training_finds_the_few_pages_that_name_their_article(spark):
    named = "<nav><a href=x>Home</a></nav><ARTICLE class=x><p>This is a long sentence number {}. It says much.</p><p>More of it.</p></ARTICLE><footer>copyright</footer>"
    few = spark.range(4000).select(F.lit("u").alias("url"), F.concat(F.lit("<div><p>Page "), "id", F.lit("</p></div>")).alias("html"))
    pages = few.unionByName(spark.createDataFrame([("u", named.format(k)) for k in range(6)], "url string, html string"))
    assert html_extract.fit(pages, sample_pages=20) is not None
    assert html_extract.fit(few, sample_pages=20) is None


def test_upper_case_share_of_a_whole_block():
    x = html_extract.features(html_extract.Tree("<p>" + "a" * 400 + "B" * 400 + "</p>"))
    assert x[-1, 30] == 0.5


def test_url_rules_and_hosts(spark):
    urls = ["http://Example.ORG/es/1", "https://a.example.org/en/12", "https://a.example.org/en/2", "x://notexample.org/es/", "http://b.com/fr/x?y", "http://b.com/de/", "http://b.com/de", "http://com/fr/", "http://b.com?u=http://c.org/", "no url", "", None, "http://h.net#//x.org/", "http://org", "://z.org/a"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filters.judged(pages, none).collect()}
    want = [("example.org", "/es/1", "example.org/es/", "block"), ("a.example.org", "/en/12", "example.org/en/1", "block"), ("a.example.org", "/en/2", "org/", "allow"), ("notexample.org", "/es/", "org/", "allow"),
            ("b.com", "/fr/x", "com/fr/", "allow"), ("b.com", "/de/", "com/de/", "block"), ("b.com", "/de", None, "allow"), ("com", "/fr/", "com/fr/", "allow"), ("b.com", "", None, "allow"), ("", "", None, "allow"),
            ("", "", None, "allow"), ("", "", None, "allow"), ("h.net", "", None, "allow"), ("org", "", None, "allow"), ("z.org", "/a", "org/", "allow")]
    assert got == dict(enumerate(want))


def test_host_reputation(spark):
    bad = {"bad.spam.net": (60, 58), "also.spam.net": (40, 37), "few.spam.net": (1, 1), "good.site.net": (80, 2), "one.site.net": (1, 1), "big.com": (3000, 200)}
    rows, k = [], 0
    for host, (n, b) in bad.items():
        for j in range(n):
            rows.append((k, f"http://{host}/p{j}", int(j >= b)))
            k += 1
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows] + [(9999, "http://bad.spam.net/new"), (9998, "http://new.net/")], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    got = collections.defaultdict(set)
    for r in url_filters.judged(pages, labels).collect():
        got[r["host"]].add(r["verdict"])
    assert got["bad.spam.net"] == got["also.spam.net"] == {"block"}
    assert got["good.site.net"] == got["one.site.net"] == got["big.com"] == got["new.net"] == {"allow"}
    means = {r["host"]: r["mean"] for r in url_filters.host_reputation(url_filters.judged(pages, labels).join(labels, F.col("page_id") == F.col("doc_id")).select("host", (1 - F.col("quality")).alias("bad"))).collect()}
    # One bad page weighs as much as its domain lets it.
    assert means["few.spam.net"] > means["one.site.net"] > means["good.site.net"]


def _beta_below(a, b, x):
    """P(rate <= x) by Simpson's rule over the density, in the logit."""
    import math
    n, lo, hi = 40_000, -60.0, math.log(x / (1 - x))
    norm = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    f = lambda t: math.exp(norm - a * math.log1p(math.exp(-t)) - b * (t + math.log1p(math.exp(-t)) if t > -700 else 0))
    step = (hi - lo) / n
    return step / 3 * sum(f(lo + k * step) * (1 if k in (0, n) else 4 if k % 2 else 2) for k in range(n + 1))


def test_beta_distribution(spark):
    cases = [(0.3, 0.7, 0.5), (1.0, 1.0, 0.5), (6.3, 3.7, 0.5), (2.0, 90.0, 0.5), (5200.0, 4800.0, 0.5), (9000.0, 1000.0, 0.5), (60.0, 40.0, 0.5), (0.01, 5.0, 0.5)]
    df = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(cases)], "k int, a double, b double")
    got = {r["k"]: r for r in df.select("k", url_filters.beta_below(F.col("a"), F.col("b"), 0.5).alias("p"), url_filters.log_gamma(F.col("a")).alias("g")).collect()}
    import math
    for k, (a, b, x) in enumerate(cases):
        assert got[k]["g"] == pytest.approx(math.lgamma(a), abs=1e-8)
        if min(a, b) >= 0.3:
            assert got[k]["p"] == pytest.approx(_beta_below(a, b, x), abs=1e-6), (a, b)
    assert got[7]["p"] == pytest.approx(1, abs=2e-3)


def _reputation(hosts, guess=(0.1, 20.0)):
    """Posterior (a, b) of each host ({host: (n, bad)}), in plain Python."""
    total, bad = sum(n for n, _ in hosts.values()), sum(b for _, b in hosts.values())
    whole = (bad + 1) / (total + 2)
    groups = lambda cut: {g: (sum(hosts[h][0] for h in hosts if cut(h) == g), sum(hosts[h][1] for h in hosts if cut(h) == g)) for g in {cut(h) for h in hosts}}
    ip = lambda h: h.replace(".", "").isdigit()
    domain, suffix = lambda h: h if ip(h) else ".".join(h.split(".")[-2:]), lambda h: "ip" if ip(h) else h.split(".")[-1]
    mean = {g: (whole, total + 2) for g in groups(suffix)}
    for rows, up in ((groups(suffix), lambda g: g), (groups(domain), suffix), (hosts, domain)):
        level = {g: (n, b, *mean[up(g)]) for g, (n, b) in rows.items()}
        weight = guess[1] * whole * (1 - whole)
        over = sum(n * (b / n - m) ** 2 - m * (1 - m) for n, b, m, _ in level.values())
        room = sum(m * (1 - m) * (n - 1) for n, b, m, _ in level.values())
        rho = min(max((over + guess[0] * weight) / (room + weight), 0.001), 0.5)
        ab = {}
        for g, (n, b, m, sure) in level.items():
            k = 1 / (1 - (1 - rho) * (1 - 1 / (sure + 1))) - 1
            ab[g] = (b + k * m, n - b + k * (1 - m))
        mean = {g: (a / (a + b), a + b) for g, (a, b) in ab.items()}
    return ab


def test_reputation_against_plain_python(spark):
    hosts = {"bad.spam.net": (60, 58), "also.spam.net": (40, 37), "few.spam.net": (1, 1), "fine.spam.net": (3, 0), "good.site.net": (80, 2), "one.site.net": (1, 1), "big.com": (3000, 200),
             "10.0.0.1": (30, 29), "11.0.0.1": (20, 0), "a.mill.org": (2, 2), "b.mill.org": (2, 2)}
    rows = [(h, int(k < b)) for h, (n, b) in hosts.items() for k in range(n)]
    got = {r["host"]: r for r in url_filters.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    want = _reputation(hosts)
    for h, (a, b) in want.items():
        assert got[h]["mean"] == pytest.approx(a / (a + b)), h
        assert got[h]["below"] == pytest.approx(_beta_below(a, b, 0.5), abs=1e-6), h
    assert got["10.0.0.1"]["below"] < 0.05 < got["11.0.0.1"]["below"]


@pytest.mark.parametrize("more", [0, 1, 500])
def test_a_host_without_bad_pages_is_never_blocked(spark, more):
    """Also where the table is tiny and everything else in it is bad."""
    urls = [f"http://bad{k % 3}.spam.net/{k}" for k in range(3 + more)] + ["http://good.spam.net/"]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(k, int(u.startswith("http://good")), 0) for k, u in enumerate(urls)], "doc_id long, quality int, toxic int")
    got = {r["host"]: r["verdict"] for r in url_filters.judged(pages, labels).collect()}
    assert got["good.spam.net"] == "allow" and (more < 500 or got["bad0.spam.net"] == "block")
    none = pages.where("false")
    assert url_filters.judged(none, labels).collect() == []


def test_blocked_hosts_match_the_sql(spark, tmp_path):
    import duckdb

    from shipcast.llm.oracle import ORACLE

    hosts = {"bad.spam.net": (60, 58), "also.spam.net": (40, 37), "few.spam.net": (1, 1), "good.site.net": (80, 2), "big.com": (300, 200), "10.0.0.1": (30, 29), "x.co.uk": (9, 9), "y.co.uk": (3, 0)}
    urls = [(f"http://{h}/{k}", int(k >= b)) for h, (n, b) in hosts.items() for k in range(n)]
    spark.createDataFrame([(k, u) for k, (u, _) in enumerate(urls)] + [(None, "http://bad.spam.net/"), (90_000, None)], "page_id long, url string").write.parquet(str(tmp_path / "pages"))
    spark.createDataFrame([(k, q, 0) for k, (_, q) in enumerate(urls)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels"))
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}/*.parquet')")
    said = sorted(map(str, con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLE['op3_url_filters']})").fetchall()))
    got = url_filters.judged(spark.read.parquet(str(tmp_path / "pages")), spark.read.parquet(str(tmp_path / "labels"))).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(str, map(tuple, got.collect()))) == said and sum("block" in r for r in said) > 100


def _luhn(x):
    d = [int(c) for c in x if c.isdigit()][::-1]
    return sum(d[0::2] + [v * 2 - 9 * (v > 4) for v in d[1::2]]) % 10 == 0


def _iban(x):
    x = re.sub(r"\s", "", x)
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_pseudonyms(spark):
    import datetime

    texts = ["card 4111111111111111, 4111-1111-1111-1111!", "no card 4111111111111112 id 123456", "call +1 (017) 555-7713 or 212-555-1234", "on 2020-02-29, 29/02/2021 and 01.12.1999.", "ip 10.0.0.255 or 300.1.1.1",
             "mail Jo.99@mail9.example.com.", "iban DE89370400440532013000 and GB82 WEST 1234 5698 7654 32 ok", "ssn 123-45-6789 000-12-1234", "", None, "hex a4111111111111111b 3ff2ca8fb1", "4111111111111111", "Jo.99@mail9.example.com"]
    docs = spark.createDataFrame([(k, t, 7, "z") for k, t in enumerate(texts)], "doc_id long, text string, n_chars long, pii_kinds string")
    got = {r["doc_id"]: r for r in pii.pseudonymised(docs).collect()}
    assert len(got) == len(texts)
    kinds = [["card"] * 2, [], ["phone"] * 2, ["date"] * 2, ["ip"], ["email"], ["iban"] * 2, ["ssn"], [], [], [], ["card"], ["email"]]
    assert [got[k]["pii_kinds"] for k in range(len(texts))] == kinds
    for k in (1, 8, 9, 10):
        assert got[k]["text"] == texts[k] and got[k]["n_chars"] == 7
    for k, said in enumerate(kinds):
        if said:
            assert got[k]["text"] != texts[k] and got[k]["n_chars"] == len(got[k]["text"]) and got[k]["n_replaced"] == len(said)
        if said and said[0] not in ("ip",):
            assert [re.sub("[0-9]", "9", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", got[k]["text"]))).count(c) for c in "9-/.@ "] == [re.sub("[0-9]", "9", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", texts[k]))).count(c) for c in "9-/.@ "]
    a, b = re.findall(r"\d[\d-]+\d", got[0]["text"])
    assert _luhn(a) and a == b.replace("-", "") == got[11]["text"]
    assert got[5]["text"][5:-1] == got[12]["text"] and got[12]["text"].endswith("@mail9.example.com")
    assert all(_iban(x) for x in re.findall(r"[A-Z]{2}\d\d[\dA-Z ]*\d", got[6]["text"]))
    iso, tail = re.search(r"\d{4}-\d\d-\d\d", got[3]["text"])[0], re.search(r"(\d\d)\.(\d\d)\.(\d{4})\.$", got[3]["text"])
    assert datetime.date.fromisoformat(iso) and datetime.date(int(tail[3]), int(tail[2]), int(tail[1])) and "29/02/2021" in got[3]["text"]
    assert all(int(o) < 256 for o in re.search(r"ip (\S+) or", got[4]["text"])[1].split(".")) and "300.1.1.1" in got[4]["text"]
    assert "000-12-1234" in got[7]["text"]
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymised(docs, key="another").collect()}
    assert other[11] != got[11]["text"]


def test_dates_and_phones_of_other_formats(spark):
    import datetime

    shapes = {"2024-01-05T10:00": r"\d{4}-\d\d-\d\dT10:00", "12/31/1999": r"\d\d/\d\d/\d{4}", "1/2/1999": r"\d/\d/\d{4}", "5.11.2020": r"\d\.\d\d\.\d{4}", "2024/01/05": r"\d{4}/\d\d/\d\d", "2024-1-5": r"\d{4}-\d-\d",
              "1850-03-04": r"1[0-8]\d\d-\d\d-\d\d|0\d{3}-\d\d-\d\d", "2150-03-04": r"[2-9]\d{3}-\d\d-\d\d", "743 555 3824": r"\d{3} \d{3} \d{4}", "+44 20 7946 0958": r"\+44 \d\d \d{4} \d{4}", "+33 1 23 45 67 89": r"\+33 \d \d\d \d\d \d\d \d\d",
              "+4930123456": r"\+49\d{8}", "+44.20.7946.0958": r"\+44\.\d\d\.\d{4}\.\d{4}", "+44 (0)20 7946 0958": r"\+44 \(\d\)\d\d \d{4} \d{4}"}
    left = ["2024-13-05T10:00", "13/13/1999", "0000-01-01", "2024-01-05x", "+1.2.3.4", "1/2/19999"]
    docs = spark.createDataFrame([(k, f"at {v}, so") for k, v in enumerate([*shapes, *left])], "doc_id long, text string")
    got = [r["text"] for r in pii.pseudonymised(docs).orderBy("doc_id").collect()]
    for (v, shape), t in zip(shapes.items(), got):
        assert t != f"at {v}, so" and re.fullmatch(f"at (?:{shape}), so", t), (v, t)
    assert got[len(shapes):] == [f"at {v}, so" for v in left]
    month, day, _ = map(int, re.findall(r"\d+", got[1]))
    assert month <= 12 < day
    # The same number stays the same in every way of writing it.
    assert re.sub(r"\D", "", got[9]) == re.sub(r"\D", "", got[12])
    # One to one within a format, and always a date of it.
    days = [datetime.date(1990, 1, 1) + datetime.timedelta(k) for k in range(500)]
    for write, mine in ((lambda d: f"{d.month:02}/{d.day:02}/{d.year}", lambda d: d.day > 12), (lambda d: f"{d.day}/{d.month}/{d.year}", lambda d: d.day < 10 and d.month < 10)):
        own = [write(d) for d in days if mine(d)]
        new = [r["text"] for r in pii.pseudonymised(spark.createDataFrame([(k, v) for k, v in enumerate(own)], "doc_id long, text string")).collect()]
        assert len(set(new)) == len(own) and all(len(a) == len(b) for a, b in zip(own, new))
        for v in new:
            a, b, y = map(int, v.split("/"))
            assert (b > 12 and datetime.date(y, a, b)) if len(v) == 10 else datetime.date(y, b, a)


def test_feistel_is_a_permutation(spark):
    two = spark.range(900).select(F.array((F.col("id") / 30).cast("int"), (F.col("id") % 30).cast("int")).alias("s"))
    out = two.select(pii.feistel(F.col("s"), F.array(F.lit(30), F.lit(30)), "k", "t").alias("p"), "s").collect()
    assert len({tuple(r["p"]) for r in out}) == 900 and all(0 <= v < 30 for r in out for v in r["p"])
    assert np.mean([r["p"] == r["s"] for r in out]) < 0.02
