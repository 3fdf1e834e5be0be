"""Word-piece counts of texts by a longest-match automaton.

Greedy longest-match-first word pieces are counted without building them: a trie over the vocabulary carries, for every
node, a failure link (where matching goes on after the pieces that are then certain) and the number of those pieces. A word
is read once, character by character, whatever its length.

A word that the pieces alone can't cut is read once more by a second set of links: where no piece begins it, it begins with the bare
word-start piece, and a character that is in no piece is spelt in byte pieces. Such a word has no other counts, because a longest
match takes the bare piece only where no longer one fits.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from netloom.llm.columns import column, whole_text
from netloom.llm.words import small_batches

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_REMEMBERED = 1 << 20  # words whose counts a task remembers at a time
_SLICE = 1 << 20
_UNKNOWN = 1 << 40  # in a sum of counts, what an unknown word adds beside its tokens


def vocabulary(path: str = VOCABULARY) -> tuple[list[str], list[str]]:
    """(pieces that begin a word, pieces inside a word) of a sentence-piece vocabulary file.

    The bare word-start piece is an empty string among the first. Byte pieces are among the second, as a space and their two
    hexadecimal digits; no word has a space, so they match no text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    first, inner = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            inner.append(" " + piece[3:5])
        elif piece == "▁":
            first.append("")
        elif piece.strip("▁"):
            (first if piece.startswith("▁") else inner).append(piece.lstrip("▁"))
    return first, inner


class Automaton:
    """Nodes 0 and 1 are the roots of the pieces that begin a word and of those inside one."""

    def __init__(self, first: Iterable[str], inner: Iterable[str]):
        self.children: list[dict[str, int]] = [{}, {}]
        self.piece = [False, False]
        self.bare, self.bytes = False, set()
        for root, pieces in ((0, first), (1, inner)):
            for text in pieces:
                if not text:
                    self.bare = self.bare or root == 0
                    continue
                if text[0] == " ":
                    self.bytes.add(int(text, 16))
                    continue
                node = root
                for char in text:
                    following = self.children[node].get(char)
                    if following is None:
                        following = self.children[node][char] = len(self.children)
                        self.children.append({})
                        self.piece.append(False)
                    node = following
                self.piece[node] = True
        self.failure, self.popped = self._links(False)
        self.spelt_failure, self.spelt_popped = self._links(True)

    def _links(self, spelt: bool) -> tuple[list[int], list[int]]:
        """Node to go on from when no child matches (-1: the word can't be cut), and the pieces that are popped on the way.

        If ``spelt``, the bare piece begins words and characters that are no piece are popped as byte pieces.
        """
        children, failure, popped = self.children, [-1] * len(self.piece), [0] * len(self.piece)
        if spelt and (self.bare or self.bytes):
            failure[0], popped[0] = 1, 1 if self.bare else self._spelling("▁")
        open_nodes = deque([0, 1])
        while open_nodes:
            node = open_nodes.popleft()
            for char, child in children[node].items():
                open_nodes.append(child)
                if self.piece[child]:
                    failure[child], popped[child] = 1, 1
                    continue
                # A character that fails at the inner root itself is tried there no more.
                at, count = failure[node], popped[node]
                while at >= 0 and char not in children[at]:
                    count += popped[at]
                    at = failure[at]
                if at >= 0:
                    failure[child], popped[child] = children[at][char], count
                elif spelt and (node == 1 or failure[node] >= 0):
                    # The way ended at the inner root, where a character is spelt.
                    spelling = self._spelling(char)
                    if spelling:
                        failure[child], popped[child] = 1, count + spelling
        return failure, popped

    def _spelling(self, char: str) -> int:
        """Number of byte pieces of a character, with a mark that there are some; 0 if the vocabulary lacks one of them."""
        values = char.encode("utf-8", "replace")
        return _UNKNOWN + len(values) if self.bytes.issuperset(values) else 0

    def count(self, word: str) -> int:
        """Number of word pieces; 0 if the word can't be cut into pieces that are neither bare nor bytes."""
        children, failure, popped = self.children, self.failure, self.popped
        node = total = 0
        for char in word:
            while char not in children[node]:
                total += popped[node]
                node = failure[node]
                if node < 0:
                    return 0
            node = children[node][char]
        while node > 1:
            total += popped[node]
            node = failure[node]
        return total if node == 1 else 0

    def spelt(self, word: str) -> tuple[int, bool]:
        """Number of word pieces, the bare one and bytes included, and whether there are bytes; 0 if the word can't be cut."""
        children, failure, popped = self.children, self.spelt_failure, self.spelt_popped
        node = total = 0
        for char in word:
            while char not in children[node]:
                if node == 1:
                    spelling = self._spelling(char)
                    if not spelling:
                        return 0, False
                    total += spelling
                    break
                total += popped[node]
                node = failure[node]
                if node < 0:
                    return 0, False
            else:
                node = children[node][char]
        while node > 1:
            total += popped[node]
            node = failure[node]
        return (total % _UNKNOWN, total >= _UNKNOWN) if node == 1 else (0, False)


class _Counts(dict):
    """Count per word in UTF-8, worked out when first asked for."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        n = self.automaton.count(text)
        if not n:
            n, in_bytes = self.automaton.spelt(text)
            n = n + _UNKNOWN * in_bytes or _UNKNOWN + 1
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = n
        return n


def _word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, a slice of it at a time."""
    at = 0
    while at < len(text):
        stop = at + _SLICE
        while stop < len(text) and text[stop] not in b" \t\n\v\f\r":
            stop += 1
        yield text[at:stop].split()
        at = stop


def text_counts(text: bytes, counts: _Counts) -> tuple[int, int, int]:
    """(words, tokens, unknown words) of a text."""
    words = total = 0
    for part in _word_slices(text):
        words += len(part)
        total += sum(map(counts.__getitem__, part))
    return words, total % _UNKNOWN, total // _UNKNOWN


def count_tokens(docs: DataFrame, vocabulary_path: str = VOCABULARY, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` with ``n_words``, ``n_tokens`` and ``n_unknown``.

    Words are cut at ASCII white space. Unknown words have a character that is in no piece and are spelt there in byte pieces; only where
    a vocabulary lacks those does such a word count as one token. Null, empty and blank texts have
    no words. Rows are counted one by one: repeated rows and nulls need no care, an empty table gives an empty result.
    The vocabulary is read on the driver and has a fixed size.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = spark.sparkContext.broadcast(vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(Automaton(*pieces.value))
        for batch in batches:
            found = [text_counts(x, counts) for x in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
            numbers = np.array(found, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(numbers[:, n]) for n in range(3))],
                names=[*batch.schema.names[:-1], "n_words", "n_tokens", "n_unknown"],
            )

    rows = docs.select(
        *[column(docs, c).alias(f"k{n}") for n, c in enumerate(keep)],
        whole_text(docs, text_col).alias("text"),
    )
    numbers = [T.StructField(n, T.LongType()) for n in ("n_words", "n_tokens", "n_unknown")]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *numbers])).toDF(*keep, "n_words", "n_tokens", "n_unknown")
