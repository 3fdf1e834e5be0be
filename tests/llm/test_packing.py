import random

from netloom.llm.packing import Bins, best_fit, pack, pack_documents


def brute(lengths, sources, clusters, capacity):
    bins, out = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        length = max(length, 1)
        fitting = [
            (b["left"], n) for n, b in enumerate(bins)
            if b["left"] >= length and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])
        ]
        if fitting:
            left = min(fitting)[0]
        else:
            bins.append({"left": capacity, "sources": set(), "clusters": set()})
            left = capacity
        out.append(left)
        # Of equally tight bins the operator may take any; the first compatible one stands for them here.
        n = min(fitting)[1] if fitting else len(bins) - 1
        bins[n]["left"] -= length
        bins[n]["sources"].add(source)
        bins[n]["clusters"].add(cluster)
    return out


def test_the_tightest_compatible_bin_is_taken():
    rng = random.Random(3)
    for _ in range(30):
        n = 80
        lengths = sorted((rng.randint(0, 50) for _ in range(n)), reverse=True)
        sources = [rng.choice([None, "hot", "hot", "a", "b", "c"]) for _ in range(n)]
        clusters = [rng.choice([None, *range(40)]) for _ in range(n)]
        bins: dict[int, list] = {}
        for (number, offset), length, source, cluster in zip(best_fit(lengths, sources, clusters, 100), lengths, sources, clusters):
            inside = bins.setdefault(number, [])
            room = 100 - sum(x[0] for x in inside)
            assert offset == 100 - room and max(length, 1) <= room
            assert not any(s == source and s is not None or c == cluster and c is not None for _, s, c in inside)
            for other, held in bins.items():  # no tighter bin would have taken it
                free = 100 - sum(x[0] for x in held)
                fits = max(length, 1) <= free < room and other != number
                clash = any(s == source and s is not None or c == cluster and c is not None for _, s, c in held)
                assert not fits or clash
            inside.append((max(length, 1), source, cluster))


def test_without_conflicts_it_is_best_fit():
    rng = random.Random(4)
    lengths = sorted((rng.randint(1, 60) for _ in range(150)), reverse=True)
    none = [None] * len(lengths)
    assert [100 - o for _, o in best_fit(lengths, none, none, 100)] == brute(lengths, none, none, 100)


def test_successor_of_a_residual():
    bins = Bins(10)
    assert bins.place(4, 1, 1) == (0, 0)
    assert bins.place(7, 1, 2) == (1, 0)
    assert bins.place(3, 1, 4) == (2, 0)  # both bins hold the source
    assert bins.place(3, 2, 1) == (1, 7)  # the tightest
    assert bins._successor(4) == 6 and bins._successor(8) == 0


def whole(rows, lengths, capacity):
    """All of every sequence is in the result, once, and no bin is too full."""
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_bin.setdefault(r.bin, []).append((r.offset, max(r.length, 1), r.doc_id))
    for doc, length in lengths.items():
        parts = sorted(by_doc[doc])
        assert sum(x for _, x in parts) == length
        assert [s for s, _ in parts] == list(range(0, max(length, 1), capacity))
    for held in by_bin.values():
        at = 0
        for offset, length, _ in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return by_bin


def test_pack_on_spark(spark):
    rng = random.Random(6)
    lengths = {n: rng.choice([0, 5, 40, 99, 100, 101, 250, 300]) for n in range(300)}
    sources = {n: "hot" if n % 3 == 0 else f"s{n % 7}" for n in lengths}
    rows = [(n, lengths[n], sources[n], n // 2, "x") for n in lengths]
    df = spark.createDataFrame(rows, "doc_id bigint, total bigint, s string, c bigint, bin string")
    got = pack(df, "total", "s", "c", capacity=100, group_rows=64).collect()
    for held in whole(got, lengths, 100).values():
        docs = [d for _, _, d in held]
        assert len({sources[d] for d in docs}) == len(docs) and len({d // 2 for d in docs}) == len(docs)
    again = pack(df, "total", "s", "c", capacity=100, group_rows=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_tricky_rows(documents, tricky):
    rows = pack_documents(documents(tricky, [None if n % 4 == 0 else f"s{n % 3}" for n in range(len(tricky))]), 512).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in tricky}
    assert sum(r.piece == 0 for r in rows) == len(tricky)
    assert pack_documents(documents([]), 512).count() == 0
