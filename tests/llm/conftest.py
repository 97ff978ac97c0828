import os
import re
import zlib

import pytest

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """The small documents table as Python rows."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


@pytest.fixture()
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    long_text = " ".join(f"w{i % 7001}" for i in range(60_000)) + "."
    rows = [
        (1, "One small text.", "en", "a", 15),
        (1, "One small text.", "en", "a", 15),
        (2, None, None, None, None),
        (None, "A text without an id, then.", "en", None, 3),
        (None, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \n\t ", "en", "b", 4),
        (5, long_text, "en", "a", len(long_text)),
        (6, long_text, "en", "c", len(long_text)),
        (7, "zero\0byte \u00c9t\u00e9 \U0001f600 \u4e2d\u6587", "fr", "c", 9),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.selectExpr("*", "1 AS n", "'x' AS row", "2 AS size", "'y' AS component", "3 AS score", "0 AS start", "'z' AS label")


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
