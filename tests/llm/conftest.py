from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("fp", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("gone", T.StringType()),
        T.StructField("taken", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("tree", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) with extra columns of clashing names."""

    def make(rows):
        full = [(i, t, lang, source, len(t or ""), "x", "y", "z", "t", "s", "w") for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"wort{n % 977}" for n in range(30_000)) + "\n" + "x" * 50_000
    return make_docs(
        [
            (None, None, None, None), (None, "", "en", "a"), (1, "", "en", "a"), (2, " \t\n", "en", None), (3, long_text, "de", "b"),
            (4, "one two three", "en", "a"), (4, "one two three", "en", "a"), (4, "another text under the same id", "en", "a"),
            (5, "1234 !!! ###", "en", "b"), (None, "one two three", "en", "c"), (6, "été ça \U0001f30d", "fr", "c"),
        ]
    )
