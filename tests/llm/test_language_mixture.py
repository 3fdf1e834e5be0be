import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from netloom.llm import queries
from netloom.llm.language_mixture import (
    BACKGROUND, ORDERS, PENALTY, ROUNDS, RUN, Languages, fit, identify, learn, mixtures, proportions, read_words, training_side,
)

SYLLABLES = {
    "aa": ["ka", "lo", "mi", "tu", "sen", "dor"], "bb": ["sch", "ung", "keit", "ver", "zu", "ä"], "cc": ["éau", "qui", "ment", "ou", "ç", "ière"],
}


def sentence(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(rng, n, low=5, high=80):
    out = []
    for k in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        out.append((k, sentence(rng, lang, rng.randint(low, high)), lang))
    return out


@pytest.fixture(scope="module")
def known():
    rows = corpus(random.Random(1), 60)
    return fit([r[1] for r in rows], [r[2] for r in rows])


def words_by_hand(text):
    """N-gram cells of each word, byte by byte."""
    data = text.encode()
    x = [32] * 3 + [b if 97 <= b < 123 or b >= 128 else 32 for b in data] + [32] * 3
    out, run = [], 0
    for i, b in enumerate(x):
        if b == 32:
            run = 0
            continue
        if run % RUN == 0:
            out.append([])
        run += 1
        cells, base = [], 0
        for (before, after), bits in ORDERS:
            code = 0
            for step in range(-before, after + 1):
                code = (code << 8 | x[i + step]) & 0xFFFFFFFF
            cells.append(((code * 2654435761 & 0xFFFFFFFF) >> (32 - bits)) + base)
            base += 1 << bits
        out[-1].append(cells)
    return out


TEXTS = ["ka lo, mitu42sen", "", "x", "  ", "schung\tä" * 9, "日本語" * 30, "é", "1 2 3", "a" * 100 + " b"]


def test_words_equal_loops():
    batch = read_words(pa.array(TEXTS, pa.string()))
    ends = np.append(batch.at[1:], batch.cells.shape[1])
    for n, text in enumerate(TEXTS):
        words = range(batch.rows_at[n], batch.rows_at[n + 1])
        got = [batch.cells[:, batch.at[w] : ends[w]].T.tolist() for w in words]
        assert got == words_by_hand(text), text


def mixture_by_hand(known, text, penalty=PENALTY):
    """Expectation-maximisation for one text, word by word."""
    logs = [[sum(float(known.log_p[c, k]) for cells in word for c in cells) / len(ORDERS) for k in range(len(known.names))] for word in words_by_hand(text)]
    odds = [[max(math.exp(v - max(row)), 1e-12) for v in row] for row in logs]
    languages, n = range(len(known.names)), len(odds)

    def em(some):
        share = {k: 1 / len(some) for k in some}
        for _ in range(ROUNDS):
            total = dict.fromkeys(some, 0.0)
            for row in odds:
                mix = sum(share[k] * row[k] for k in some)
                for k in some:
                    total[k] += share[k] * row[k] / mix / n
            share = total
        return share, sum(math.log(sum(share[k] * row[k] for k in some)) for row in odds)

    full, _ = em(list(languages))
    alone = [sum(math.log(row[k]) for row in odds) for k in languages]
    first = max(languages, key=lambda k: (alone[k], -k))
    order = [first, *sorted((k for k in languages if k != first), key=lambda k: (-full[k], k))]
    best, score = {first: 1.0}, alone[first]
    for size in range(2, len(order) + 1):
        share, fit_ = em(order[:size])
        if fit_ - penalty * (size - 1) * math.log1p(n) <= score:
            break
        best, score = share, fit_ - penalty * (size - 1) * math.log1p(n)
    return [best.get(k, 0.0) for k in languages], [full[k] for k in languages]


def test_mixtures_equal_loops(known):
    rng = random.Random(2)
    texts = [" ".join(sentence(rng, lang, rng.randint(1, 30)) for lang in rng.sample(sorted(SYLLABLES), rng.randint(1, 3))) for _ in range(40)]
    texts += ["", "ka", "zzz qqq", "12"]
    words = read_words(pa.array(texts, pa.string()))
    chosen, full = mixtures(known.likelihoods(words), words.rows_at)
    sizes = set()
    for n, text in enumerate(texts):
        if words.rows_at[n] == words.rows_at[n + 1]:
            assert not chosen[n].any() and not full[n].any()
            continue
        want, want_full = mixture_by_hand(known, text)
        assert np.allclose(chosen[n], want, atol=2e-3) and np.allclose(full[n], want_full, atol=2e-3), text
        sizes.add(int((chosen[n] > 0).sum()))
    assert sizes == {1, 2, 3}


def test_rounds_never_lower_the_likelihood(known):
    words = read_words(pa.array([sentence(random.Random(3), "aa", 20) + " " + sentence(random.Random(4), "cc", 10)]))
    logs = known.likelihoods(words)
    odds = np.exp(logs - logs.max(axis=1, keepdims=True))
    fits = [proportions(odds, words.rows_at, np.ones((1, 3)), rounds)[1][0] for rounds in range(1, 10)]
    assert all(b >= a - 1e-5 for a, b in zip(fits, fits[1:]))


def test_probabilities_sum_to_one_and_keep_a_background():
    counts = np.zeros((2, sum(1 << bits for _, bits in ORDERS)))
    counts[0, 5], counts[1, 9], counts[1, 70000] = 10, 30, 1
    known = Languages(["x", "y"], counts)
    base = 0
    for _, bits in ORDERS:
        part = np.exp(known.log_p[base : base + (1 << bits)].astype(np.float64))
        base += 1 << bits
        unknown = np.isclose(part[:, 0], part[:, 1])
        assert unknown.sum() >= (1 << bits) - 2 and (part > 0).all()
    assert np.isclose(np.exp(known.log_p[5, 0]), 1 - BACKGROUND / 2, atol=1e-2)


def test_held_out_texts_and_mixtures(spark, documents):
    rng = random.Random(5)
    rows = corpus(rng, 200, 3, 60)
    docs = documents([(i, t) for i, t, _ in rows]).join(spark.createDataFrame([(i, lang) for i, _, lang in rows], "doc_id bigint, lang string"), "doc_id")
    learned = learn(docs)
    found = {r.doc_id: r for r in identify(docs, learned).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 30 and len(found) == len(rows)
    assert all(found[i].lang_pred == lang for i, _, lang in rows if i in set(held))
    both = sentence(rng, "bb", 40) + ". " + sentence(rng, "aa", 60)
    (r,) = identify(documents([(1, both)]), learned).collect()
    assert [x.lang for x in r.languages] == ["aa", "bb"] and abs(r.languages[0].share - 0.6) < 0.05 and r.lang_pred == "aa"
    assert 0.5 < r.score < 0.7


def test_labels_of_the_held_out_side_are_not_learned(spark):
    rows = [(i, "kalo mitu" if zlib.crc32(str(i).encode()) % 4 != 2 else "sch ung", "aa" if zlib.crc32(str(i).encode()) % 4 != 2 else "bb") for i in range(60)]
    rows += [(None, "zu", "none"), (1, "zu", None), (2, None, "null")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert learn(docs).names == ["aa"]
    assert {r[0] for r in docs.where(~training_side(docs.doc_id)).select("lang").collect()} == {"bb"}
    assert learn(docs, max_rows=3).names == ["aa"] and learn(docs.where("lang = 'bb'")) is None


def test_odd_texts(documents, tricky, known):
    found = identify(documents(tricky), known)
    rows = found.collect()
    assert found.columns == ["doc_id", "lang_pred", "score", "languages"] and len(rows) == len(tricky)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {9, 10, 11, 12, 19} <= und and not und & {7, 3, 13, 15, 16, 20}
    assert all(0 <= r.score <= 1 and (r.lang_pred == "und") == (not r.languages) for r in rows)
    equal = {(r.lang_pred, r.score) for r in rows if r.doc_id in (5, 7)}
    assert len(equal) == 1
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in identify(documents(tricky), None).collect())
    assert identify(documents([]), known).count() == 0


def test_a_text_is_read_whole_wherever_batches_are_cut(documents, known, monkeypatch):
    rng = random.Random(9)
    long = sentence(rng, "aa", 3000) + " " + sentence(rng, "bb", 4000)
    pairs = [(n, sentence(rng, rng.choice(sorted(SYLLABLES)), 20)) for n in range(30)] + [(99, long)]
    whole = {r.doc_id: r for r in identify(documents(pairs), known).collect()}
    alone = {r.doc_id: r for n in (0, 30) for r in identify(documents(pairs[n : n + 1]), known).collect()}
    assert whole[99].lang_pred == "bb" and all(whole[k] == alone[k] for k in alone)


def test_query(spark, tmp_path):
    rng = random.Random(12)
    rows = [(*r, "src", len(r[1])) for r in corpus(rng, 120)] + [(500, None, "aa", "src", 0), (501, "12", "aa", "src", 2), (None, "kalo", None, None, 4)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op11_language_id"](spark, str(tmp_path))
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    by_id = {r.doc_id: r for r in found.collect()}
    assert len(by_id) == len(rows)
    for i, r in by_id.items():
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
    assert by_id[500].lang_pred == by_id[501].lang_pred == "und"
    assert all(by_id[i].lang_pred == lang for i, _, lang, _, _ in rows[:120])
