from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "labels", "benchmark")


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def texts() -> dict:
    """doc_id -> text of the smallest documents table."""
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and ids,
    and extra columns whose names operators use inside."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "b", 66),
        (2, "The quick brown fox jumps over the lazy dog again and again today", "en", "a", 66),
        (2, "The quick brown fox jumps over the lazy dog again and again today", "en", "a", 66),
        (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \t\n ", "en", None, 4),
        (6, "one two", "en", "\U0001f600", 7), (7, "ONE two", None, "z", 7),
        (None, "no id here but words enough to make more than one shingle", "de", "b", 1),
        (8, long_text, "en", "b", len(long_text)), (9, long_text + " tail", "fr", "b", None),
        (10, "12345 67890 !!!", "en", "a", 15), (11, "naïve 漢字 €\U0001d11e\x00 end", "fr", "a", 9),
        (11, "another text of the same id", "fr", "a", 9),
    ]
    extra = ("signature string, digest int, key string, cell string, n long, group string, weight int, "
             "size int, nth int, shard string, slot int, join_digest string, mix_digest int, mix_copies int, "
             "mix_copy int, copies int, copy string, n_words int, host string, numbers string, vector string")
    own = ("s", 1, None, "c", 2, "g", 3, 4, 5, "t", 6, None, 7, 8, 9, 10, "u", 11, "v", None, "w")
    return spark.createDataFrame([(*r, *own) for r in rows], f"{DOCUMENT}, {extra}")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENT)
