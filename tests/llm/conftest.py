from __future__ import annotations

import pytest
from pyspark.sql import types as T

#: Texts that every operator must take: null, empty, blank, tiny, odd, long.
ODD_TEXTS = [
    None, "", " ", "\n\n \t ", "a", "A b", "x  y \n z ", " lead", "trail ", "ümlaut Größe 漢字 😀", "\x00\x1c  　 b",
    "it's we'll <|endoftext|> <s> ▁x ▁▁", "word " * 30_000, "same text of a few words", "same text of a few words",
]


@pytest.fixture()
def odd_docs(spark):
    """Odd texts, nulls in every column, a repeated row and clashing columns."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
        T.StructField("ids", T.StringType()), T.StructField("key", T.StringType()),
        T.StructField("part", T.StringType()), T.StructField("_row", T.StringType())])
    rows = [(i, t, "en" if i % 2 else None, None, len(t or ""), "s", "i", "k", "p", "r") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], (None, "no id", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.where("false")
