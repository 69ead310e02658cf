import os

import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ["score", "key", "size", "id", "no_id", "text_hash", "row", "number", "passes", "h", "rid"]
LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(50))


@pytest.fixture(scope="session")
def small_dir():
    return os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.01")


@pytest.fixture
def documents(spark):
    """Builds documents from (doc_id, text[, lang[, source]]) rows."""

    def build(*rows, clashing=False):
        full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
        full = [(*r, None if r[1] is None else len(r[1])) for r in full]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clashing:
            df = df.selectExpr("*", *(f"'x' AS {c}" for c in CLASHING))
        return df

    return build


@pytest.fixture
def odd(documents):
    """Null ids and texts, empty and very long texts, ties, repeated rows, clashing columns."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, base, "en", "a"),
        (1, base, "en", "a"),
        (1, "another text of the same id, with quite other words in it", "en", "a"),
        (2, base, "fr", None),
        (None, base, None, "b"),
        (None, None, None, None),
        (3, None, "en", "a"),
        (4, "", "en", "a"),
        (5, " \t\n ", "en", "b"),
        (6, LONG, "en", "b"),
        (7, "solo", "fr", "b"),
        (8, f"start {PASSAGE} end", "fr", "a"),
        (9, f"{PASSAGE}\nand a line of its own here", "fr", "a"),
        (-1, "12 34 ... !!", "en", "a"),
    ]
    return documents(*rows, clashing=True), rows


@pytest.fixture
def labels(spark):
    schema = T.StructType.fromDDL("doc_id long, quality int, toxic int")

    def build(*rows):
        return spark.createDataFrame([(d, None, t) for d, t in rows], schema)

    return build
