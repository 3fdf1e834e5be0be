import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from netloom.llm import piece_codec
from netloom.llm.piece_codec import MODEL, Pieces, border_states, combine, decode, encode, id_lists, load

model_file = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
TEXTS = ["", " ", "Hello  wörld\n\tx ", "日本語 ☃☃ é", "a" * 50, "the cat sat. " * 30, "no-spaces-" * 40, "▁ mark", "x\r\ny", "   ", "é"]


@pytest.fixture(scope="module")
def pieces():
    return load()


@pytest.fixture(scope="module")
def library(pieces):
    """The library's own best segmentation with the same pieces and scores."""
    proto = model_file.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for piece, score in zip(proto.pieces, pieces.scores):
        if score is not None:
            piece.score = score
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def ids_of(data):
    return np.frombuffer(data, dtype=np.int32).tolist()


def text_of(pieces, data):
    return pieces.decode(id_lists([data]))[0].as_py()


def score(pieces, ids):
    return sum(pieces.scores[i] or 0 for i in ids)


def test_segmentation_is_as_good_as_the_librarys(pieces, library):
    for text in TEXTS:
        own, other = ids_of(pieces.encode(text)), library.encode(text)
        assert own == other or score(pieces, own) == pytest.approx(score(pieces, other))


def test_round_trip(pieces):
    for text in TEXTS:
        assert text_of(pieces, pieces.encode(text)) == text.replace("▁", " ")


def brute(pieces, text):
    best = [0.0] + [-np.inf] * len(text)
    for at in range(len(text)):
        known = [k for k in range(1, pieces.longest + 1) if text[at : at + k] in pieces.texts[:-256] and at + k <= len(text)]
        for length in known:
            value = pieces.scores[pieces.texts.index(text[at : at + length])]
            best[at + length] = max(best[at + length], best[at] + value)
        if 1 not in known:
            best[at + 1] = max(best[at + 1], best[at] + pieces.unknown)
    return best[-1]


def chunked(pieces, text, size):
    text = pieces.marked(text)
    starts = range(0, len(text), size)
    parts = [(text[at : at + size + pieces.longest - 1], min(size, len(text) - at)) for at in starts]
    borders = border_states([pieces.transfer(t, n) for t, n in parts])
    return b"".join(pieces.traced(t, n, a, b) for (t, n), a, b in zip(parts, borders, borders[1:]))


@pytest.mark.parametrize("crossing", [False, True])
def test_chunks_change_no_score(crossing):
    rng = random.Random(int(crossing))
    for _ in range(150):
        texts = list({"".join(rng.choice("ab▁" if crossing else "abc") for _ in range(rng.randint(1, 5))) for _ in range(12)} | {"▁a", "▁b", "▁"})
        if not crossing:
            texts = sorted({t if rng.random() < 0.5 or t[0] == "▁" else "▁" + t for t in texts})
        vocabulary = Pieces(texts + [f"<{b}>" for b in range(256)], [-rng.random() * 9 for _ in texts] + [None] * 256, list(range(len(texts), len(texts) + 256)))
        text = "".join(rng.choice("abc  é") for _ in range(rng.randint(1, 60)))
        ids = chunked(vocabulary, text, vocabulary.longest + rng.randint(0, 9))
        assert text_of(vocabulary, ids) == text
        whole = vocabulary.encode(text)
        marked = vocabulary.marked(text)
        assert vocabulary.best(marked, 0, len(marked))[0][-1] == pytest.approx(brute(vocabulary, marked))
        assert score(vocabulary, ids_of(ids)) == pytest.approx(score(vocabulary, ids_of(whole)))


def test_combination_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = rng.random((3, 4, 4))
    assert np.allclose(combine(combine(a, b), c), combine(a, combine(b, c)))


def test_encode_on_spark(documents, tricky, pieces):
    docs = documents(tricky)
    rows = encode(docs, chunk=500)
    text = decode(rows)
    want = sorted(((i, (t or "")) for i, t in tricky), key=repr)
    assert sorted(((r.doc_id, r.text) for r in text.collect()), key=repr) == want
    for r in rows.where(F.col("doc_id").isin(13, 14, 15, 18)).collect():
        whole = ids_of(pieces.encode(dict(tricky)[r.doc_id]))
        assert r.ids == whole or score(pieces, r.ids) == pytest.approx(score(pieces, whole))
    assert encode(documents([])).count() == 0
    with pytest.raises(ValueError, match="chunk"):
        encode(docs, chunk=3)


def test_scores_of_the_file(pieces):
    own = load(scores="model")
    assert own.scores[pieces.byte_ids[0]] is None
    assert piece_codec.CHUNK > own.longest
