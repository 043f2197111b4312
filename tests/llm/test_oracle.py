"""The queries of this subpackage that SQL can express, against DuckDB."""

import duckdb
import pytest

from shipcast.llm.oracle import ORACLE
from shipcast.llm.queries import QUERIES

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def _both(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    found = QUERIES[name](spark, folder)
    columns = sorted(found.columns)
    said = con.execute(ORACLE[name])
    at = [c[0] for c in said.description]
    assert sorted(at) == columns
    order = [at.index(c) for c in columns]
    return sorted(map(repr, (tuple(r[c] for c in columns) for r in found.collect()))), sorted(repr(tuple(r[k] for k in order)) for r in said.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    mine, sql = _both(spark, SF_SMALL, name)
    assert mine and mine == sql


@pytest.mark.parametrize("name", ["op2_quality_rules", "op6_decontamination"])
def test_odd_rows_match_sql(spark, tmp_path, odd_docs, docs_rows, name):
    """Nulls, repeated rows, long texts; items shorter than a window, repeated and without words."""
    words = " ".join(docs_rows[0][1].split()[:20])
    items = [(1, words), (2, "gamma delta zeta"), (2, "gamma delta zeta"), (3, None), (4, " ,;"), (None, "Épsilon x1"), (10, "日本 日本"), (11, "word " * 13), (12, words)]
    odd = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900, f"before {words} after"), (901, words.upper())], "doc_id long, text string"))
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    found = QUERIES[name](spark, str(tmp_path))
    columns = sorted(found.columns)
    sql = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(repr, sql))
