import random

import pytest
from tokenizers import models

from netloom.llm.token_counts import Automaton, _Counts, count_tokens, text_counts, vocabulary


def greedy(word, first, inner):
    """Number of pieces by trying all lengths; 0 if the word can't be cut."""
    n, at = 0, 0
    while at < len(word):
        known = inner if at else first
        length = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in known), 0)
        if not length:
            return 0
        at, n = at + length, n + 1
    return n


def test_counts_equal_greedy_matching_on_small_vocabularies():
    rng = random.Random(0)
    for _ in range(60):
        def pieces():
            return {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 9))}

        first, inner = pieces(), pieces()
        automaton = Automaton(sorted(first), sorted(inner))
        for _ in range(200):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
            assert automaton.count(word) == greedy(word, first, inner), (word, first, inner)


def test_counts_equal_the_library():
    first, inner = vocabulary()
    automaton = Automaton(first, inner)
    known = {"[UNK]": 0}
    for piece in [*first, *("##" + p for p in inner)]:
        known.setdefault(piece, len(known))
    library = models.WordPiece(vocab=known, unk_token="[UNK]", max_input_chars_per_word=1 << 30)
    for word in "The internationalisation of tokenisers übermäßig naïve 日本語 ☃ zz☃ don't a x=1;".split():
        cut = [t.value for t in library.tokenize(word)]
        assert automaton.count(word) == (0 if cut == ["[UNK]"] else len(cut))


def test_every_row_is_counted(documents, tricky):
    got = count_tokens(documents(tricky), keep=("doc_id", "size")).collect()
    counts = _Counts(Automaton(*vocabulary()))
    want = [(i, "z", *text_counts((t or "").encode(), counts)) for i, t in tricky]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert count_tokens(documents([])).count() == 0


@pytest.mark.parametrize("text", ["", " \n", "a" * 3_000_000, "ab " * 800_000])
def test_long_and_empty_texts(text):
    words, tokens, unknown = text_counts(text.encode(), _Counts(Automaton(["a", "ab"], ["a"])))
    assert (words, tokens, unknown) == (len(text.split()), text.count("a"), 0)


def spelling(word, first, inner, in_bytes):
    """Number of pieces by trying all lengths, the word-start mark and byte pieces included; 0 if the word can't be cut."""
    start = max((k for k in range(1, len(word) + 1) if word[:k] in first), default=0)
    at, n = start, 1
    while at < len(word):
        length = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in inner), 0)
        if not length and not in_bytes:
            return 0
        at, n = at + max(length, 1), n + (1 if length else len(word[at].encode()))
    return n


@pytest.mark.parametrize("in_bytes", [True, False])
def test_no_word_is_flattened_on_small_vocabularies(in_bytes):
    rng = random.Random(1)
    for _ in range(60):
        def pieces():
            return {"".join(rng.choice("abñ") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 7))}

        first, inner = pieces(), pieces()
        counts = _Counts(Automaton(["", *sorted(first)], [*sorted(inner), *(f" {b:02X}" for b in range(256 * in_bytes))]))
        for _ in range(200):
            word = "".join(rng.choice("abñ日") for _ in range(rng.randint(1, 12)))
            want = spelling(word, first, inner, in_bytes)
            assert text_counts(word.encode(), counts)[1] == (want or 1), (word, first, inner)


def test_words_without_a_start_piece_of_their_own():
    counts = _Counts(Automaton(*vocabulary()))
    first, inner = map(set, vocabulary())
    for word in ["ñandú", "çamlıca", "être", "ßtraße", "日本語", "☃", "\U0001F9FF", "a\U0001F9FFb", "ab"]:
        _, tokens, unknown = text_counts(word.encode(), counts)
        assert tokens == spelling(word, first, inner, True)
        assert unknown == any(c not in inner for c in word)
    assert text_counts("日本語".encode(), counts) == (1, 4, 0)
    assert text_counts("a\U0001F9FFb".encode(), counts) == (1, 6, 1)
