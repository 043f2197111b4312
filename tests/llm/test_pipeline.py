"""The stages of the corpus pipeline against brute force on odd tables."""

import corpus_pipeline as P
from shipcast.llm import decontaminate
from shipcast.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark, odd_docs, odd_rows):
    columns = odd_docs.columns
    good = P.quality(spark, odd_docs, SF)
    assert good.columns == columns and good.count() <= len(odd_rows)
    cut = saved(P.lines(spark, odd_docs, SF), "test")
    assert cut.columns == columns and cut.count() == len(odd_rows)
    shared = next(t for i, t in odd_rows if i == 4)
    texts = {}
    for r in cut.collect():
        texts.setdefault(r["doc_id"], []).append(r)
    assert texts[1][0]["text"] is None and texts[4][0]["text"] == shared
    assert [r["text"] for r in texts[5]] == ["", ""] and texts[5][0]["n_chars"] == 0
    assert shared not in texts[6][0]["text"] and texts[6][0]["n_chars"] == len(texts[6][0]["text"])
    assert all(r["lines"] for rows in texts.values() for r in rows)
    one = P.near_duplicates(spark, cut, SF)
    ids = [r["doc_id"] for r in one.collect()]
    assert one.columns == columns and len(ids) == len(set(ids)) and 1 in ids and not {2, 3, 5} & set(ids)
    clean = P.benchmark(spark, odd_docs, SF)
    assert clean.columns == columns and clean.count() == len(odd_rows)
    coded = P.encoded(spark, odd_docs, SF)
    assert coded.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and coded.count() == len(odd_rows)


def test_one_row_of_each_near_duplicate_stays(spark):
    z, w, y = (" ".join(f"{x}{k}" for k in range(120)) for x in "zwy")
    rows = [(0, z, 1), (1, w, 2), (1, z, 3), (None, w, 4), (None, y, 5), (None, y, 6), (5, z, 7), (5, z, 8), (None, None, 9), (None, "", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root long")
    got = sorted((str(r["doc_id"]), r["text"] or "", ) for r in P.near_duplicates(spark, docs, SF).collect())
    assert got == sorted([("0", z), ("1", w), ("None", y), ("None", "")])
    same = spark.createDataFrame([(3, z), (3, z), (3, z), (4, w), (3, w)], "doc_id long, text string")
    assert sorted(map(tuple, P.near_duplicates(spark, same, SF).collect())) == sorted([(3, z), (3, w)])


def test_spans_of_benchmark_items_are_cut(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rest = " ".join(f"w{k}" for k in range(3000))
    docs = spark.createDataFrame([(1, item), (2, f"{rest} {item} {rest}"), (3, rest)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in P.benchmark(spark, docs, SF).collect()}
    assert set(got) == {2, 3} and got[3] == rest and len(got[2]) < 2 * len(rest) + 12


def test_stages_on_an_empty_table(spark, no_docs):
    for _, stage in P.STAGES:
        assert stage(spark, no_docs, SF).collect() == []


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.run(spark, SF).collect()
    ids = [r["doc_id"] for r in rows]
    assert len(ids) == len(set(ids)) and 0.5 * docs.count() < len(ids) < docs.count()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    dirty = {r["doc_id"] for r in decontaminate.report(P.lines(spark, docs, SF), bench).where("contaminated").collect()}
    assert dirty and not dirty & set(ids)
