import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from netloom.llm import queries, vector_codes
from netloom.llm.vector_codes import choose_pivots, compress_vectors, nearest, pivot_distances, squared

SCHEMA = "vec_id bigint, embedding array<float>, label int, id int, vec string, code string, far double, entry int, error string, `of` string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "v", "c", 0.5, 3, "e", "o") for i, v, label in rows], SCHEMA)


def by_hand(rows, parts=4, entries=256, rounds=4):
    """Loops over rows, entries and components in plain integers; (id, code, error, label error) and all final entries."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts if kept else 0
    cut = [(i, [v[p * width : (p + 1) * width] for p in range(parts)], label) for i, v, label in kept]
    start = sorted((i, vec) for i, vec, _ in cut if i is not None)[:entries]
    books = [[vec[p] for _, vec in start] for p in range(parts)]

    def assign(vec, p):
        return min((sum((a - b) ** 2 for a, b in zip(vec, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        owners = [{} for _ in range(parts)]
        for _, vec, _ in cut:
            for p in range(parts):
                owners[p].setdefault(assign(vec[p], p)[1], []).append(vec[p])
        for p in range(parts):
            for n, own in owners[p].items():
                books[p][n] = [sum(c) // len(own) for c in zip(*own)]
    out = []
    for i, vec, label in cut:
        found = [assign(vec[p], p) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), label))
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return sorted([(i, c, e, total[label]) for i, c, e, label in out], key=repr), hashlib.sha256(flat.encode()).hexdigest()


def vectors(rng, n, width=8, spread=1.0):
    """Some clusters, ties and repeated vectors, as floats that a float column holds exactly."""
    centres = [[rng.randint(-40, 40) / 16 for _ in range(width)] for _ in range(6)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, [x + rng.randint(-3, 3) * spread / 32 for x in c], rng.choice([None, 0, 1, 2])))
    return out


@pytest.mark.parametrize("seed, n, entries", [(1, 300, 256), (2, 120, 16), (3, 40, 256)])
def test_equals_loops(spark, rows, seed, n, entries):
    rng = random.Random(seed)
    data = vectors(rng, n)
    data += [(data[5][0], data[5][1], 1), (n + 1, None, 0), (n + 2, [], 0), (n + 3, [1.0] * 7 + [None], 0),
             (n + 4, [1.0] * 7 + [math.nan], 0), (n + 5, [math.inf] + [0.0] * 7, 0), (None, data[3][1], None)]
    rng.shuffle(data)
    found, books = compress_vectors(frame(spark, data).repartition(5), entries=entries)
    want, digest = by_hand(data, entries=entries)
    empty = [(n + 2, None, None)]
    assert rows(found.where("code is not null")) == want
    assert rows(found.where("code is null"), "vec_id", "code", "error") == empty
    assert books.digest() == digest


def test_a_third_of_all_vectors_are_equal(spark, rows):
    rng = random.Random(7)
    data = vectors(rng, 200) + [(1000 + n, [0.25] * 8, 1) for n in range(100)]
    found, books = compress_vectors(frame(spark, data), entries=32)
    want, digest = by_hand(data, entries=32)
    assert rows(found) == want and books.digest() == digest


def test_search_visits_no_more_than_it_must_and_is_exact():
    rng = np.random.default_rng(4)
    for width, size in ((16, 256), (4, 30), (1, 1), (3, 7)):
        book = rng.integers(-1000, 1000, (size, width))
        book[-1] = book[0]  # a tie
        parts = np.concatenate([rng.integers(-1000, 1000, (200, width)), book])
        pivots = choose_pivots(book)
        index, best = nearest(parts, book, pivot_distances(parts, pivots), pivot_distances(book, pivots))
        far = squared(parts[:, None, :], book[None, :, :])
        assert (best == far.min(axis=1)).all() and (index == far.argmin(axis=1)).all()


def test_far_entries_are_passed_over(monkeypatch):
    rng = np.random.default_rng(5)
    book = np.concatenate([rng.integers(-10, 10, (8, 8)) + 5000 * n for n in range(32)])
    parts = np.concatenate([book + 1, book - 1])
    pivots = choose_pivots(book)
    compared = []
    monkeypatch.setattr(vector_codes, "squared", lambda a, b: (compared.append(np.prod(np.broadcast_shapes(a.shape, b.shape)[:-1])), squared(a, b))[1])
    nearest(parts, book, np.sqrt(squared(parts[:, None], pivots[None])), np.sqrt(squared(book[:, None], pivots[None])))
    assert sum(compared) <= 24 * len(parts)


def test_odd_lengths_and_sizes(spark, rows):
    data = [(1, [0.5] * 8, 0), (2, [0.25] * 6, 0), (3, [0.5] * 4, 0), (4, [1e30] + [0.0] * 7, 1), (5, [0.5] * 8, None)]
    found, _ = compress_vectors(frame(spark, data))
    assert rows(found) == [(1, "00000000", 0, 0), (2, None, None, 0), (3, None, None, 0), (4, None, None, None), (5, "00000000", 0, 0)]


def test_nothing_to_encode(spark, rows):
    found, books = compress_vectors(frame(spark, []))
    assert rows(found) == [] and books is None
    found, books = compress_vectors(frame(spark, [(None, [0.5] * 8, 1), (3, None, 2)]))
    assert rows(found) == [(None, None, None, None)] and books is None


def test_query_equals_loops(spark, rows, tmp_path):
    rng = random.Random(11)
    data = [(i, v, label) for i, v, label in vectors(rng, 90, width=16)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, digest = by_hand(data)
    found = queries.QUERIES["op12_vector_codes"](spark, str(tmp_path))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows(found) == [(*w, digest) for w in want]
