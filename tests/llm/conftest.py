import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"
#: Columns that an operator might use inside; they must not clash.
SCHEMA = "doc_id bigint, text string, key int, label string, row string, digest string, id int, ids string, bucket int, n int, best int"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def given_rows(spark):
    """(doc_id, text) of the smallest given table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, white space of all kinds, ties, special strings, near copies, passages."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage, long = text(300), text(60), text(30_000)
    near = base.split()
    near[150] = "changed"
    rows = [
        (10, None), (11, ""), (12, "  \t\n "), (13, "one"), (14, "one"), (15, "ONE two"), (16, base), (17, base),
        (18, " ".join(near)), (19, base + " " + passage), (20, text(40) + "\n" + passage + "  " + text(20)),
        (21, passage), (22, long), (23, long + " tail"), (24, "a  b\n\n c \u00a0 d\r\n<|endoftext|> x  <|endoftext|>  "),
        (25, "日本語のテキスト 🎉🎉 don't we'll   "), (26, "x" * 5000), (27, " lead"), (28, "\u2003 \u2003 gap"), (30, "a \nb"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


def frame(spark, rows):
    full = [(k, t, 1, "l", "r", "d", 2, "i", 3, 4, 5) for k, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
