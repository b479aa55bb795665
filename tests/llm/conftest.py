from __future__ import annotations

import pytest

#: Rows of every documents table in these tests: nulls, empty, long, repeated and clashing.
VOCABULARY = "the of and quick brown lorem ipsum dolor sit amet zug été bleu rapide stone river token cloud paper window".split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    long = " ".join(VOCABULARY[(i * 7 + i // 5) % 20] for i in range(6000))
    rows = [
        (1, "the quick brown stone of the river"), (1, "the quick brown stone of the river"), (2, "the quick brown stone of the river"),
        (3, None), (4, ""), (5, " \t\n "), (None, "a row without an id"), (None, None), (6, "x"), (7, "été été été"), (8, long), (9, long + " end"),
        (10, "😀 emoji 𝔘nicode ﬁ"), (11, "a" * 5000),
    ]
    # Names that operators use inside, as extra columns.
    return spark.createDataFrame([(i, t, "fp", 0, [1]) for i, t in rows], "doc_id long, text string, fp string, chunk int, ids array<int>")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
