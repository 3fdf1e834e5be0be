import random

import numpy as np
import pyarrow as pa

from netloom.llm import toxicity
from netloom.llm.toxicity import (
    Network, drop_toxic, fit, learn, read_words, score_texts, training_side, window_words, windows_of,
)


def test_windows_cover_every_text():
    rng = random.Random(0)
    lengths = [rng.choice([0, 1, 16, 17, 32, 33, 48, 49, 100]) for _ in range(50)]
    rows_at = np.concatenate([[0], np.cumsum(lengths)])
    text, first, length = windows_of(rows_at)
    for n, size in enumerate(lengths):
        own = [(f - rows_at[n], k) for t, f, k in zip(text, first, length) if t == n]
        covered = {p for f, k in own for p in range(f, f + k)}
        assert covered == set(range(size))
        assert [f for f, _ in own] == list(range(0, 16 * len(own), 16))


def test_words_without_their_punctuation():
    batch = read_words(pa.array(["Fool! (fool), fool### ***", "", "fool ***", None]))
    assert list(np.diff(batch.rows_at)) == [4, 0, 2, 0]
    assert len(set(batch.words[:3])) == 1 and batch.words[4] == batch.words[0]


def test_gradients():
    rng = np.random.default_rng(1)
    net = Network(3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    b = read_words(pa.array(["one two three one four", "five six", "two two"]))
    text, first, length = windows_of(b.rows_at)
    idx, wanted = window_words(b.words, first, length), np.array([1.0, 0.0, 1.0])

    def loss():
        x = net.forward(net.inputs(b).astype(np.float64), idx)
        return np.mean(np.log1p(np.exp(-x)) * wanted + np.log1p(np.exp(x)) * (1 - wanted))

    grads = net.gradients(b, net.inputs(b).astype(np.float64), idx, wanted)
    for name in ("out", "query", "attend", "in_f", "own_f", "bias_b", "own_b", "chars", "words"):
        rows, grad = grads[name] if isinstance(grads[name], tuple) else (slice(None), grads[name])
        at = tuple(rng.integers(0, n) for n in grad.shape)
        full = (rows[at[0]], *at[1:]) if isinstance(rows, np.ndarray) else at
        step, keep = 1e-3, net.w[name][full]
        net.w[name][full] = keep + step
        up = loss()
        net.w[name][full] = keep - step
        down = loss()
        net.w[name][full] = keep
        assert abs((up - down) / (2 * step) - grad[at]) < 2e-3 * max(1, abs(grad[at])), name


def corpus(rng, n):
    common = ["the", "of", "and", "river", "house", "green", "walk", "seven", "tree", "stone", "paper", "light"]
    out = []
    for k in range(n):
        words = [rng.choice(common) + rng.choice(["", "s", "."]) for _ in range(rng.randint(5, 150))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vilefool", "vilescum", "vilerat"])
        out.append((k, " ".join(words), toxic))
    return out


def test_held_out_rows_are_told_apart():
    rng = random.Random(2)
    rows = corpus(rng, 400)
    net = fit([t for _, t, _ in rows[:300]], [y for _, _, y in rows[:300]])
    scores = net.text_scores(pa.array([t for _, t, _ in rows[300:]]))
    labels = np.array([y for _, _, y in rows[300:]])
    assert ((scores >= 0.7) == labels).mean() > 0.95
    unseen = net.text_scores(pa.array(["the river " * 40 + "vilescums! " + "green tree " * 40, "the river " * 40]))
    assert unseen[0] > unseen[1]


def test_without_both_labels_nothing_is_toxic():
    assert fit([], []) is None
    assert fit(["a", "b"], [0, 0]) is None
    assert fit(["", " "], [0, 1]) is None


def test_on_spark(spark, documents, tricky):
    rows = corpus(random.Random(3), 150)
    pairs = [(i, t) for i, t, _ in rows]
    docs = documents(pairs + [(i and i + 1000, t) for i, t in tricky])
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows] + [(None, 0, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    net = learn(docs, labels)
    got = score_texts(docs, net).collect()
    assert len(got) == len(pairs) + len(tricky)
    assert all(0 <= r.score <= 1 for r in got)
    blank = [(r.doc_id, r.score) for r in got if r.doc_id in (1009, 1010, 1011)]
    assert {s for _, s in blank} == {0.0}, blank
    alone = {t: s for (_, t), s in zip(pairs, net.text_scores(pa.array([t for _, t in pairs])))}
    by_id = {r.doc_id: r.score for r in got}
    assert all(abs(by_id[i] - alone[t]) < 1e-4 for i, t in pairs)
    kept = drop_toxic(docs, net)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r.score < 0.7 for r in got)
    assert drop_toxic(documents([]), net).count() == 0 and score_texts(documents([]), None).count() == 0


def test_held_out_labels_are_not_learned(spark, documents):
    rows = corpus(random.Random(4), 60)
    docs = documents([(i, t) for i, t, _ in rows])
    sides = {r.doc_id: r.side for r in docs.select("doc_id", training_side(docs["doc_id"]).alias("side")).collect()}
    assert 0 < sum(sides.values()) < len(sides)
    labels = [(i, y if sides[i] else 1 - y) for i, _, y in rows]  # wrong where they must not be looked at
    one = learn(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    two = learn(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int"))
    assert all(np.array_equal(one.w[k], two.w[k]) for k in one.w)


def test_the_network_is_fitted_in_a_task(spark, monkeypatch):
    rows = corpus(random.Random(9), 60)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    before, here = toxicity.fit, []
    monkeypatch.setattr(toxicity, "fit", lambda *a: here.append(a) or before(*a))
    net = learn(docs, labels)
    assert net is not None and not here  # the task has a list of its own
    again = Network.restored(pa.Table.from_batches([net.stored()]))
    texts = pa.array([t for _, t, _ in rows])
    assert np.array_equal(again.text_scores(texts), net.text_scores(texts))
    assert learn(docs, labels.where("toxic = 1")) is None
