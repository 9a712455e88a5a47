"""Small tables for the training-data operators."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"

#: Null, empty, blank, short and repeated texts, odd white space, a long word, a tie.
TEXTS = [
    None, "", " ", "a", "a b c", "The  quick\t brown\n\nfox 's don't 12345 über x\x1cy ",
    "same text twice with a few words more", "same text twice with a few words more",
    "x" * 3000, "<|endoftext|> in a text", "line one\nline two\n\n  line three.  ", "\n",
    "İstanbul ǅ ﬁ é 中文 字 🙂🙂", "tail space ", "\x00 nul \x01 mark",
    "ends. With, stops. and, commas.", " ".join(f"w{i}" for i in range(3000)),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts with clashing extra columns; one row is repeated, one has no id."""
    rows = [(i, text, "en", "src0", len(text or ""), 1, 0.5) for i, text in enumerate(TEXTS)]
    rows += [rows[6], (None, "no id here", None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "label int, score double").repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(os.path.join(SF, "documents.parquet"))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(os.path.join(SF, "labels.parquet"))
