import random

import pytest

CLASHING = "doc_id bigint, text string, source string, id bigint, rid string, key int, cls string, n bigint, size string, level int, _sha string, kept string, group string, shard string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names the operators use inside."""
    def make(pairs, sources=None):
        rows = [
            (i, t, sources[n] if sources else "s", n, "r", 1, "c", 2, "z", 3, "h", "k", "g", "d") for n, (i, t) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, CLASHING)

    return make


@pytest.fixture
def tricky():
    """Nulls, empty and blank texts, repeated rows, ties, copies that differ in white space, a very long text."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "the", "gamma", "of", "delta", "über", "日本", "e", "and", "zeta", "x1"]
    long = " ".join(rng.choice(words) for _ in range(6000))
    return [
        (7, "the alpha of beta and gamma"), (3, "the  alpha of\tbeta and gamma"), (5, "the alpha of beta and gamma"),
        (5, "the alpha of beta and gamma"), (None, "the alpha of beta and gamma "), (9, None), (10, ""), (11, " \n\t\x0b\x0c\r"),
        (12, "\u00a0"), (13, long), (14, long + " tail"), (15, long.replace(" ", "")), (None, None), (16, "one"), (17, "One"),
        (18, "a b\U0001F600c"), (19, "!!! ???"), (20, "日本語テキスト"),
    ]
