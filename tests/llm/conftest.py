import datetime

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators also use for columns of their own.
CLASHING = "shard int, slot long, kept boolean, keep_id long, text_digest string, component_id long, host string"

SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards brew tea near a cold river"


def _rows():
    long_text = " ".join(f"word{i}" for i in range(30_000)) + "\n" + "x" * 50_000
    rows = [
        (0, None),
        (1, ""),
        (2, " \t\n "),
        (3, SENTENCE),
        (4, SENTENCE.replace(" ", "  ")),
        (4, SENTENCE.replace(" ", "  ")),  # a repeated row
        (5, SENTENCE + " today"),
        (6, "Short line\nshared by several texts\nshort line\n"),
        (7, "shared by several texts \nOther"),
        (8, "SHARED BY SEVERAL TEXTS\r\nother\n\n"),
        (9, long_text),
        (10, long_text + " end"),
        (11, "12345 !!! ..."),
        (12, "naïve café — ÄÖÜ 中文 😀 <|endoftext|> end"),
        (None, "a row without an id"),
        (None, SENTENCE),
        (2**60, "only"),
    ]
    return [(d, t, "en" if t else None, "s", len(t) if t else None) for d, t in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, ties and ids beyond doubles."""
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def edge_rows():
    return _rows()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    from pyspark.sql import functions as F

    wider = edge_docs
    for column in CLASHING.split(", "):
        name, kind = column.split(" ")
        wider = wider.withColumn(name, F.lit(None).cast(kind))
    return wider.withColumn("seen", F.lit(datetime.datetime(2024, 1, 1)))
