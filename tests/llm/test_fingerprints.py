import hashlib
import re

import pytest

from netloom.llm.fingerprints import ANCHORS, CHAIN, STRETCH, edit_report, fingerprints

WORD = re.compile(r"[^\W_]+")


def spots(text):
    """Signatures as tuples of words."""
    w = WORD.findall(text.lower())
    content = [n for n, x in enumerate(w) if x not in ANCHORS]
    out = set()
    for k, p in enumerate(content):
        before = content[k - 1] if k else -1
        chain = tuple(w[q] for q in content[k : k + CHAIN])
        out |= {(w[a], *chain) for a in range(before + 1, p)}
    return out or {tuple(w[n : n + CHAIN + 1]) for n in range(len(w))} or {text}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def expected(pairs):
    order = sorted({(i, t or "") for i, t in pairs}, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(f"{'-' if r[0] is None else r[0]}:{r[1]}".encode()).hexdigest()))
    out = {}
    for n, (i, t) in enumerate(order):
        following, e = order[(n + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - e] + following[:e]
        out[i, len(t)] = (hashlib.sha256(edited.encode()).hexdigest(), jaccard(spots(t), spots(edited)), jaccard(spots(t), spots(following)))
    return out


def test_report_equals_brute_force(documents, tricky):
    pairs = [p for p in tricky if p[0] is None or p[0] != 15]
    got = edit_report(documents(pairs)).collect()
    assert len(got) == len(pairs)
    want = expected(pairs)
    for r in got:
        sha, edited, following = want[r.doc_id, r.n_chars]
        assert r.edited_sha256 == sha
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(following)


def test_equal_texts_have_equal_fingerprints(documents, tricky):
    rows = edit_report(documents(tricky)).collect()
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, r.fingerprint)
    assert texts[5] == texts[7] == texts[3]
    assert texts[20] != texts[19]


def test_the_set_of_a_text(documents):
    pairs = [(n, t) for n, t in enumerate(["The cat and the dog sat on a mat", "nothing common here now", "the", "", "the of", "the cat", "Cat_dog the x-y z"])]
    for r in fingerprints(documents(pairs)).collect():
        assert len(r.signatures) == len(spots(dict(pairs)[r.doc_id])), r.text
        assert r.signatures == sorted(set(r.signatures))


def test_empty_and_single(documents):
    assert edit_report(documents([])).count() == 0
    assert edit_report(documents([(4, "the cat sat on the mat")])).first().near_next == 1


def content(n, first=0):
    return " ".join(f"w{k}" for k in range(first, first + n))


def test_an_anchor_does_not_switch_the_rest_of_a_text(documents):
    plain, other = content(100), content(30, 500)
    texts = [plain, content(50) + " the " + content(50, 50), "the " + other + " of " + plain, plain + " the end", plain.replace("w50", "and")]
    pairs = list(enumerate(texts))
    sets = {r.doc_id: set(r.signatures) for r in fingerprints(documents(pairs)).collect()}
    runs = 100 - CHAIN
    assert len(sets[0]) == runs + CHAIN  # with the shorter runs at the end, as before
    assert len(sets[0] & sets[1]) == runs - CHAIN and len(sets[1]) == runs - CHAIN + 1
    assert len(sets[0] & sets[2]) == runs and len(sets[2]) == runs + 2
    assert len(sets[0] & sets[3]) == runs and len(sets[3]) == runs + 1
    assert len(sets[0] & sets[4]) == 48 + 47
    edited = edit_report(documents([(2, content(90) + " " + content(60, 300)), (1, "the " + other + " of the day " * 60)])).collect()
    assert next(r for r in edited if r.doc_id == 2).near_edited > 0.3


@pytest.mark.parametrize("n", [STRETCH - 1, STRETCH, STRETCH + 1, 3 * STRETCH])
def test_a_stretch_between_anchors(documents, n):
    (row,) = fingerprints(documents([(1, "of " + content(n) + " the " + content(5, 900))])).collect()
    assert len(row.signatures) == 2 + (n - CHAIN if n >= STRETCH else 0)
