from __future__ import annotations

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # Names that operators use for columns of their own.
        T.StructField("bucket", T.StringType()),
        T.StructField("digest", T.IntegerType()),
        T.StructField("kept", T.IntegerType()),
        T.StructField("_range", T.IntegerType()),
        T.StructField("starts", T.IntegerType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("rank", T.IntegerType()),
    ]
)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with clashing columns."""

    def make(rows):
        full = [(*r, *[None] * (3 - len(r)), "x", 1, 1, 1, 1, 1, 1) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Nulls, empty and long texts, ties and repeated rows.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "One sentence alone."),
    (4, "One sentence alone."),
    (None, "A row without an id, of which there are two."),
    (None, None),
    (5, "word " * 30_000),
    (6, "x" * 20_000),
    (7, "naïve ßtraße 中文 🙂 \x00 é ▁ a  b"),
    (-(2**62), "a negative id"),
]
