import hashlib
import re

import pytest
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
                     T.StructField("row", T.IntegerType())])


def odd_rows():
    """Nulls, empty and blank texts, a very long text, ties, repeated rows,
    near copies, and two extra columns whose names clash with results."""
    base = " ".join(f"w{i * 7 % 101}x{i}" for i in range(220))
    near = base.replace("w7x1 ", "changed ").replace("w14x2 ", "other ")
    long = " ".join(f"l{i % 977}y{i % 31}" for i in range(40_000))
    texts = [(1, "Hello World one two three four"), (2, "hello world one two three four"), (3, None), (4, ""),
             (5, " \t\n "), (6, base), (7, near), (8, base.upper()), (9, "one"), (9, "one"), (9, "two words"),
             (None, "no id here at all but some words"), (None, None), (10, long), (11, "To " * 300),
             (12, "line\nline\nother\n\n\nline"), (13, "äöü ß 日本語 emoji 😀 <|endoftext|> it's  two\n\n spaces "),
             (14, base + " tail " + base), (15, "x" * 5000), (16, "a\x0bb\x0cc\rd"), (17, "one")]
    return [(i, t, None if k % 3 else "en", "s" if k % 2 else None, None if t is None else len(t),
             "clash", k) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
