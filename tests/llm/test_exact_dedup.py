import hashlib
import random
import re

import pytest

from netloom.llm.exact_dedup import drop_copies, exact_groups

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(SPACE.sub("", t or ""), []).append((i, t or ""))
    out = []
    for norm, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        for i, _ in rows:
            out.append((i, best[0], len(rows), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("block", [3, 2048])
def test_groups_equal_brute_force(documents, tricky, block):
    got = exact_groups(documents(tricky), block=block).collect()
    want, groups = brute(tricky)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups
    # Equal identities are equal texts, and the other way round.
    assert len({(r.level, r.name) for r in got}) == len({r.text_sha256 for r in got}) == groups


def test_texts_that_share_most_blocks(documents):
    rng = random.Random(1)
    base = "".join(rng.choice("ab") for _ in range(64))
    pairs = [(n, base[:n] + "c" + base[n + 1 :]) for n in range(40)] + [(100 + n, base[:20]) for n in range(20)]
    got = exact_groups(documents(pairs), block=4).collect()
    assert sum(r.kept for r in got) == 41
    assert {r.group_size for r in got if r.doc_id >= 100} == {20}


def test_kept_rows_keep_their_columns(documents, tricky):
    docs = documents(tricky)
    out = drop_copies(docs)
    assert out.schema == docs.schema
    assert out.count() == brute(tricky)[1]


def test_empty_table(documents):
    assert exact_groups(documents([])).count() == 0
    assert drop_copies(documents([])).count() == 0
