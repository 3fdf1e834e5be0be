import hashlib
import random
import zlib

import pytest

from netloom.llm import conversation_trie, queries
from netloom.llm.conversation_trie import NOBODY, TernaryTree, borders, by_medians, prefix_trie, shard_nodes

SCHEMA = "conv_id bigint, turn bigint, role string, text string, id bigint, conv string, nth int, ids string, shard int, head string, ends string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, "i", 3, "h", "e") for r in rows], SCHEMA)


def read(rows):
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def by_hand(convs):
    """Every node as a row, from sets of members and plain scans over all nodes."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children), len(leaves), saved, digest))
    return sorted(out, key=repr)


def conversations(rng, n, words=4, longest=6, step=1):
    rows = []
    for c in range(0, n * step, step):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant", None, ""]), rng.choice(["", None, "a", "ab", "é\U0001F600", "x" * 9][:words])))
    return rows


@pytest.mark.parametrize("seed, shard_turns, words", [(1, 500_000, 4), (2, 3, 3), (3, 1, 2), (4, 10, 6)])
def test_equals_brute_force(spark, rows, seed, shard_turns, words):
    data = conversations(random.Random(seed), 60, words)
    random.Random(seed).shuffle(data)
    assert rows(prefix_trie(frame(spark, data), shard_turns=shard_turns)) == by_hand(read(data))


def test_ties_repeated_rows_and_nulls(spark, rows):
    data = [(5, None, "user", "n"), (5, 1, "user", "n"), (5, 1, "user", "n"), (None, 1, "user", "lost"), (7, 0, "user", "n"), (7, 3, None, "n"),
            (-3, 2, "user", "n"), (9, None, None, None)]
    assert rows(prefix_trie(frame(spark, data))) == by_hand(read(data))
    tied = [(1, 0, "a", "x"), (1, 0, "b", "y"), (2, 0, "b", "y"), (2, 0, "a", "x")]
    assert [r.n_convs for r in prefix_trie(frame(spark, tied)).collect()] == [2, 2, 2]


def test_a_third_of_all_conversations_are_equal(spark, rows, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK_BYTES", 64)
    data = conversations(random.Random(8), 60)
    data += [(1000 + c, t, "user", f"hot {t}") for c in range(40) for t in range(3)] + [(2000, t, "user", f"hot {t}") for t in range(5)]
    assert rows(prefix_trie(frame(spark, data), shard_turns=20)) == by_hand(read(data))


def test_one_very_long_conversation(spark, rows):
    data = [(c, t, "user", str(t % 7)) for c in (1, 2) for t in range(600)] + [(3, 0, "user", "0")]
    found = prefix_trie(frame(spark, data))
    assert found.count() == 601
    deep = found.where("depth = 600").first()
    assert (deep.n_convs, deep.parent_conv_id, deep.ends_sha256) == (2, 1, hashlib.sha256(b"1,2").hexdigest())


def test_no_conversations(spark):
    assert prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_tree_is_balanced():
    tree = TernaryTree()
    for at in by_medians(1023):
        tree.insert([at], [1], 1, at, "")
    depth = [0] * len(tree.turn)
    deepest, open_ = 0, [(tree.middle[0], 1)]
    while open_:
        here, depth = open_.pop()
        deepest = max(deepest, depth)
        open_ += [(k, depth + 1) for k in (tree.low[here], tree.high[here]) if k >= 0]
    assert deepest == 10 and sorted(by_medians(57)) == list(range(57))


@pytest.mark.parametrize("seed", range(20))
def test_shards_cut_anywhere_add_up(seed):
    """The rows of all shards, added by (head, depth), are those of one shard."""
    rng = random.Random(seed)
    distinct = sorted({tuple(rng.randint(0, 1 + seed % 3) for _ in range(rng.randint(0, 6))) for _ in range(60)})
    rows = [(list(s), [t + 2 for t in s], n, rng.randint(1, 3), f"e{n}") for n, s in enumerate(distinct)]
    cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, 12)))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]

    def agree(a, b):
        return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    facts = [(n, agree(p[0][0], p[-1][0]), agree(p[-1][0], parts[n + 1][0][0]) if n + 1 < len(parts) else -1, len(p[-1][0])) for n, p in enumerate(parts)]
    edges, merged, found = borders(facts), {}, []
    for n, part in enumerate(parts):
        table = shard_nodes(n, edges[n], part)
        for row in zip(*table.values()):
            row = dict(zip(table, row))
            if row["head"] is None:
                found.append(row)
            else:
                merged.setdefault((row["head"], row["depth"]), []).append(row)
    for same in merged.values():
        row = dict(same[0], conv=min(r["conv"] for r in same), ends=max((r["ends"] for r in same if r["ends"]), default=None))
        row |= {c: sum(r[c] for r in same) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
        merged[(row["head"], row["depth"])] = row
        assert len({r["parent_head"] for r in same}) == 1
        found.append(row)
    for row in found:
        if row["parent_head"] is not None:
            row["parent_conv"] = merged[(row["parent_head"], row["depth"] - 1)]["conv"]
    names = ("conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    whole = shard_nodes(0, borders([(0, 0, -1, 0)])[0], rows)
    assert sorted((tuple(r[c] for c in names) for r in found), key=repr) == sorted(zip(*[whole[c] for c in names]), key=repr)


def test_query_rebuilds_conversations(spark, rows, tmp_path):
    rng = random.Random(3)
    data = conversations(rng, 80, step=7) + [(-250, 0, "user", "m"), (-200, 1, "user", "n"), (405, 0, "user", None)]
    spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op13_conversation_trie"](spark, str(tmp_path))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows(found) == by_hand(rebuilt(read(data)))
    assert any(r.ends_sha256 == NOBODY for r in found.collect())
