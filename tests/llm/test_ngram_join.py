import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from netloom.llm import ngram_ranks, words as hashing
from netloom.llm.components import components
from netloom.llm.ngram_join import drop_near_copies, need, ngram_classes, ngram_join, suffix_bound
from netloom.session import Stages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[n : n + size]) for n in range(len(w) - size + 1)}


def brute(pairs, size, percent):
    """(sets, component number of each row)."""
    sets = [shingles(t, size) for _, t in pairs]
    root = list(range(len(pairs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(pairs)), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            root[max(top(a), top(b))] = min(top(a), top(b))
    return sets, [top(n) for n in range(len(pairs))]


def agree(rows, pairs, size, percent):
    sets, root = brute(pairs, size, percent)
    smallest = {}
    for (i, _), r in zip(pairs, root):
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    want = sorted(((i, len(s), smallest.get(r)) for (i, _), s, r in zip(pairs, sets, root)), key=repr)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == want
    return len(set(root))


def near_copies(rng, copies, length=60):
    base = [f"w{rng.randint(0, 500)}" for _ in range(length)]
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(length)] = f"w{rng.randint(0, 500)}"
        out.append(" ".join(own[: length - rng.randint(0, 3)]))
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(documents, size, percent):
    rng = random.Random(size)
    texts = [t for _ in range(8) for t in near_copies(rng, rng.randint(1, 9))] + near_copies(rng, 60, 40)
    rng.shuffle(texts)
    pairs = [(1000 - 3 * n, t) for n, t in enumerate(texts)]
    groups = agree(ngram_classes(documents(pairs), size, percent).collect(), pairs, size, percent)
    assert 8 < groups < len(pairs)


def test_tricky_rows(documents, tricky):
    rows = ngram_classes(documents(tricky), 3, 90).collect()
    agree(rows, tricky, 3, 90)


def test_one_row_of_each_component_stays(documents, tricky):
    docs = documents(tricky)
    out = drop_near_copies(docs, 3, 90)
    assert out.schema == docs.schema
    kept = sorted((r.doc_id for r in out.collect()), key=repr)
    sets, root = brute(tricky, 3, 90)
    # Texts without words are linked with nothing; those that are the same row but for that are one.
    alone = {(i, t) for (i, t), s in zip(tricky, sets) if not s}
    assert len(kept) == len({r for r, s in zip(root, sets) if s}) + len(alone)
    assert 3 in kept and 7 not in kept and kept.count(5) == 0


def test_empty_table(documents):
    assert ngram_classes(documents([]), 5, 80).count() == 0
    assert drop_near_copies(documents([])).count() == 0
    assert ngram_classes(documents([(1, None), (2, "")]), 5, 80).count() == 2


def test_words_of_a_batch():
    rng = random.Random(4)
    alphabet = "aBc \t\n\x0b  é日Z."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["w" * 5000 + " " + "w" * 4999]
    values, at = hashing.hashed_words(pa.array(texts))
    seen = {}
    for text, first, stop in zip(texts, at[:-1], at[1:]):
        found = WORD.findall(text.translate(LOWER))
        assert len(found) == stop - first
        for word, value in zip(found, values[first:stop]):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    sliced = hashing.hashed_words(pa.array(texts).slice(3, 9))[0]
    assert (sliced == values[at[3] : at[12]]).all()


def test_bounds():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(2))
        assert suffix_bound(a, b, 3) >= len(np.intersect1d(a, b))
    for n_a in range(1, 30):
        for n_b in range(1, 30):
            least = min(s for s in range(n_a + n_b + 1) if 100 * s >= 90 * (n_a + n_b - s))
            assert need(n_a, n_b, 90) == least


def test_components_of_a_path_and_a_hub(spark):
    path = [(b"%03d" % n, b"%03d" % (n + 1)) for n in range(60)]
    hub = [(b"900", b"%03d" % n) for n in range(901, 960)]
    links = spark.createDataFrame(path + hub, "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in components(links, Stages(spark, "t")).collect()}
    assert set(got.values()) == {b"000", b"900"}
    assert len(got) == 61 + 60


def test_components_store_two_tables_a_turn_and_none_for_stars(spark):
    class Counted(Stages):
        def store(self, name, df):
            seen.append(name)
            return super().store(name, df)

    seen = []
    star = spark.createDataFrame([(b"1", b"%d" % n) for n in range(2, 9)], "a binary, b binary")
    assert {bytes(r.root) for r in components(star, Counted(spark, "t")).collect()} == {b"1"}
    assert seen == ["edges0"]
    seen.clear()
    both = star.unionByName(spark.createDataFrame([(b"8", b"9"), (b"5", b"4")], "a binary, b binary"))
    got = {bytes(r.node): bytes(r.root) for r in components(both, Counted(spark, "t")).collect()}
    assert got == {b"%d" % n: b"1" for n in range(1, 10)}
    assert seen == ["edges0", "large", "edges1"]


def linked(pairs, size, percent):
    """Places of all pairs of rows that link."""
    sets = [shingles(t, size) for _, t in pairs]
    return {
        (a, b) for a, b in combinations(range(len(pairs)), 2)
        if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    }


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_all_links_equal_brute_force(documents, size, percent):
    rng = random.Random(size)
    texts = [t for _ in range(4) for t in near_copies(rng, rng.randint(2, 9))] + near_copies(rng, 50, 40)
    pairs = list(enumerate([*texts, *texts[:3], texts[-1], "", None, "one", "one"]))
    links, rows = ngram_join(documents(pairs), size, percent)
    links, rows = [(bytes(r.a), bytes(r.b)) for r in links.collect()], rows.collect()
    agree(rows, pairs, size, percent)
    assert len(set(links)) == len(links) and all(a < b for a, b in links)
    cls = {r.doc_id: r["class"] and bytes(r["class"]) for r in rows}
    got = {(a, b) for a, b in combinations(sorted(cls), 2) if cls[a] and (cls[a] == cls[b] or tuple(sorted((cls[a], cls[b] or b""))) in set(links))}
    want = linked(pairs, size, percent)
    assert got == want and len(want) > len(pairs)
    assert all(r.n_links == sum(r.doc_id in p for p in want) for r in rows)


def test_the_query_counts_every_link(spark, tmp_path):
    """Also those inside a component that holds together without them."""
    from netloom.llm.queries import QUERIES

    rng = random.Random(9)
    texts = [t for _ in range(3) for t in near_copies(rng, rng.randint(2, 6))] + near_copies(rng, 30, 60)
    pairs = list(enumerate([*texts, texts[-1], "", None, "one"]))
    spark.createDataFrame(pairs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op4_ngram_join"](spark, str(tmp_path)).collect()
    agree(rows, pairs, 3, 90)
    want = linked(pairs, 3, 90)
    assert {r.doc_id: r.n_links for r in rows} == {n: sum(n in p for p in want) for n, _ in pairs}
    assert len(want) > 2 * len(pairs)
    cls = {r.doc_id: r["class"] for r in rows}
    for r in rows:
        others = [cls[b if r.doc_id == a else a] for a, b in want if r.doc_id in (a, b)]
        assert r.linked == min((c for c in others if c != cls[r.doc_id]), default=None)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_components_hang_together_by_verified_links(documents, size, percent):
    rng = random.Random(size + 1)
    texts = [t for _ in range(6) for t in near_copies(rng, rng.randint(2, 30), 40)]
    pairs = list(enumerate([*texts, *texts[:4], "", "one two"]))
    rows = {r.doc_id: r for r in ngram_classes(documents(pairs), size, percent).collect()}
    sets = {i: frozenset(shingles(t, size)) for i, t in pairs}
    by_class = {r["class"]: sets[i] for i, r in rows.items() if r["class"]}
    assert len(by_class) == len({s for s in sets.values() if s})
    alone = 0
    for i, r in rows.items():
        others = [j for j in rows if j != i and rows[j].component_id == r.component_id and rows[j]["class"] != r["class"]]
        if not others:
            assert r.linked is None
            alone += 1
            continue
        a, b = sets[i], by_class[r.linked]
        assert a != b and 100 * len(a & b) >= percent * len(a | b)
    assert alone < len(rows)


def test_ranks_are_exact_however_sets_are_blocked(monkeypatch):
    """Prefixes by the exchange of blocks equal those by plain counting, with tiny blocks and frequent n-grams sent apart."""
    from collections import Counter

    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 1 << 62, 400).astype(np.uint64) << np.uint64(2))
    sets = [np.unique(rng.choice(pool[: rng.choice([20, 400])], rng.integers(1, 40))) for _ in range(150)]
    sets += [np.unique(rng.integers(0, 1 << 62, 30).astype(np.uint64) << np.uint64(2)) for _ in range(5)]
    monkeypatch.setattr(ngram_ranks, "LOCAL", 6)
    classes, ranges, sent = [hashing.set_digest(s) for s in sets], 7, []
    for n, start in enumerate(range(0, len(sets), 40)):
        sent += ngram_ranks._block_rows(n, classes[start : start + 40], sets[start : start + 40], ranges)
    answered = [a for r in range(ranges) for a in ngram_ranks._answers([s for s in sent if s[1] == r])]
    got = {}
    for n in range(4):
        found = ngram_ranks._block_prefixes([a for a in answered if a[0] == n], 80)
        for token, cls, size, s, pos in zip(*[found[k] for k in ("token", "cls", "n", "s", "pos")]):
            got.setdefault(cls, []).append((int(pos), int(token), int(size), int(s)))

    def name(v):
        top = int(v) >> 16
        return (top * ranges >> 48) << 32 | (top & 0xFFFFFFFF)

    counts = Counter(name(v) for s in sets for v in s)
    for cls, values in zip(classes, sets):
        shared = sorted((counts[name(v)], name(v)) for v in values if counts[name(v)] > 1)
        room = ngram_ranks.prefix_length(len(values), 80) - (len(values) - len(shared))
        want = [(p, t, len(values), len(shared)) for p, (_, t) in enumerate(shared[: max(room, 0)])]
        assert sorted(got.get(cls, [])) == want


def test_codes_grow_with_counts():
    counts = np.concatenate([np.arange(1, 5000), 2 ** np.arange(13, 40)])
    codes = ngram_ranks.code_of(counts).astype(int)
    assert (np.diff(codes) >= 0).all() and (codes[:127] == counts[:127]).all()
    assert (ngram_ranks.count_of(ngram_ranks.code_of(counts)) <= counts).all()
    assert (ngram_ranks.count_of(ngram_ranks.code_of(counts[:4999])) * 1.2 > counts[:4999]).all()


def test_a_pair_meets_about_once_in_the_last_round(spark):
    import itertools
    import random

    from netloom.llm import ngram_join as module
    from netloom.session import Stages

    draw = random.Random(3)
    sets = {bytes([n]) * 16: sorted(draw.sample(range(60), 40)) for n in range(30)}
    shared = spark.createDataFrame(
        [(t, cls, len(s), len(s), pos) for cls, s in sets.items() for pos, t in enumerate(s)],
        "token bigint, cls binary, n bigint, s bigint, pos bigint",
    )
    masks = spark.createDataFrame([(cls, [0] * 16) for cls in sets], "cls binary, mask array<bigint>")
    roots = spark.createDataFrame([(cls, bytes([cls[0] % 7]) * 16) for cls in sets], "node binary, root binary")
    stages = Stages(spark, "test")
    found = [(bytes(r.a), bytes(r.b)) for r in module._rest(shared, roots, masks, 50, stages).select("a", "b").collect()]
    apart = [p for p in itertools.combinations(sorted(sets), 2) if p[0][0] % 7 != p[1][0] % 7]
    least = module.need(40, 40, 50)
    assert {p for p in apart if len(set(sets[p[0]]) & set(sets[p[1]])) >= least} <= set(found) <= set(apart)
    assert len(found) < 4 * len(set(found))
    every = [(bytes(r.a), bytes(r.b)) for r in module._all(shared, masks, 50, stages).select("a", "b").collect()]
    both = {p for p in itertools.combinations(sorted(sets), 2) if len(set(sets[p[0]]) & set(sets[p[1]])) >= least}
    assert both <= set(every) and len(every) < 4 * len(set(every))
