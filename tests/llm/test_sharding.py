import random
import zlib

import pytest

from netloom.llm.sharding import Interval, START, shard_texts


def check(rows, pairs, shards, slack):
    assert len(rows) == len(pairs)
    size = lambda t: len((t or "").encode()) + 1
    want = sorted(((i, size(t), zlib.crc32((t or "").encode())) for i, t in pairs), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == want
    total, largest = sum(x[1] for x in want), max(x[1] for x in want)
    for s in range(shards):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= 2 * largest + slack * total / shards
    assert {r.shard for r in rows} <= set(range(shards))


def test_near_equal_bytes(documents):
    rng = random.Random(2)
    pairs = [(n, "x" * rng.randint(0, 80) + str(n)) for n in range(600)]
    check(shard_texts(documents(pairs), 16).collect(), pairs, 16, 0.01)


def test_a_third_of_all_rows_are_copies(documents):
    pairs = [(n, "hot" * 20) for n in range(200)] + [(1000 + n, f"text {n}" * 8) for n in range(400)]
    rows = shard_texts(documents(pairs), 8).collect()
    check(rows, pairs, 8, 0.01)
    hot = sorted((r.shard, r.slot, r.doc_id) for r in rows if r.doc_id < 1000)
    assert [d for _, _, d in hot] == list(range(200))  # cut by id, in order
    assert len({s for s, _, _ in hot}) < 6


def test_rows_that_repeat_in_full(documents):
    pairs = [(1, "same text")] * 64
    check(shard_texts(documents(pairs), 4).collect(), pairs, 4, 0.01)


def test_tricky_rows(documents, tricky):
    check(shard_texts(documents(tricky), 4).collect(), tricky, 4, 8)


def test_empty_table(documents):
    assert shard_texts(documents([]), 4).count() == 0


@pytest.mark.parametrize("value", [-(1 << 63), -1, 0, 5, (1 << 63) - 1])
def test_intervals_hold_their_values(spark, value):
    rows = spark.createDataFrame([(value,)], "k bigint")
    assert rows.where(START.holds(["k"])).count() == 1
    inner = Interval((), value >> 10 << 10, 10)
    assert rows.where(inner.holds(["k"])).count() == 1
