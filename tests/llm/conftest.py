import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    pick = random.Random(3)
    words = ["alpha", "Beta", "gamma,", "delta.", "Épsilon", "日本", "zeta", "x1"]
    text = lambda n: " ".join(pick.choice(words) for _ in range(n))
    shared = "This very line is in many documents, as it happens."
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, shared), (5, shared), (5, shared), (6, f"{shared}\n{text(30)}\n{shared.upper()}"), (7, text(20_000)), (8, "word " * 300),
            (None, text(12)), (None, shared), (9, text(60)), (10, "a\n\n\nb"), (11, "\n".join(text(12) for _ in range(40)))]
    return rows + [(100 + k, text(pick.randint(1, 200))) for k in range(60)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The same as a table with further columns, some with clashing names."""
    rows = [(i, t, None if k % 3 else "src", k, [k], "x", 1) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, lines array<int>, shard string, n long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
