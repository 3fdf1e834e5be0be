"""Sentence-piece encoding by a max-plus parallel scan, and decoding.

The best segmentation of a text maximises the sum of its pieces' log-probabilities. A text longer than a chunk is cut at fixed
places. What matters of a chunk's left side is how far the last piece before it reaches in, and of its right side how far
its own last piece reaches out: each chunk yields a matrix of the best scores from every entry state to every exit state. The
matrices are combined in the (max, +) algebra, which is associative, to find the states at all borders; then every
chunk is traced back on its own. A shorter text is one chunk with known borders.

Inside a chunk, no piece crosses from a word into the white space behind it, so whatever lies between two such places is
segmented on its own and remembered. Where a vocabulary has pieces that do cross, nothing is cut there and results stay right.

Pieces of a merge-ranked vocabulary have ranks, not probabilities; rank r is taken to have probability proportional to
1 / (r + 2.7), Zipf's law. A vocabulary with log-probabilities is used as it is (``scores="model"``). Characters that are no piece
are spelt in byte pieces, at the price of the worst piece less 10 for each character.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from netloom.llm.columns import column, whole_text
from netloom.llm.words import small_batches
from netloom.session import Stages

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
CHUNK = 32_768
_REMEMBERED = 1 << 19
_NEVER = -math.inf


class _Memo(dict):
    """Ids (as the bytes of 32-bit integers) of the stretches seen of late; ``scores`` has their scores.

    Two generations are kept: what is asked for again moves on to the younger one when the older is dropped.
    """

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.scores, self.older = pieces, {}, ({}, {})

    def __missing__(self, text: str) -> bytes:
        ids = self.older[0].get(text)
        if ids is None:
            scores, steps = self.pieces.best(text, 0, len(text))
            ids, score = np.array(self.pieces.trace(text, steps, 0, len(text)), dtype=np.int32).tobytes(), scores[-1]
        else:
            score = self.older[1][text]
        if len(self) >= _REMEMBERED:
            self.older = dict(self), self.scores
            self.clear()
            self.scores = {}
        self[text], self.scores[text] = ids, score
        return ids


@dataclass
class Pieces:
    """A vocabulary: trie of the pieces, their scores, and the byte pieces."""

    texts: list[str]
    scores: list[float]
    byte_ids: list[int]
    dummy_prefix: bool = True
    trie: dict = field(init=False)
    longest: int = field(init=False)
    unknown: float = field(init=False)
    splits: bool = field(init=False)
    memo: _Memo = field(init=False)
    stretch: re.Pattern = field(init=False)

    def __post_init__(self):
        self.trie, self.memo = {}, _Memo(self)
        self.stretch = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+\\Z")
        for i, (text, score) in enumerate(zip(self.texts, self.scores)):
            if score is None:
                continue
            node = self.trie
            for char in text:
                node = node.setdefault(char, {})
            node[""] = (i, score)
        known = [(t, s) for t, s in zip(self.texts, self.scores) if s is not None]
        self.longest = max(len(t) for t, _ in known)
        self.unknown = min(s for _, s in known) - 10
        self.splits = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", t) for t, _ in known)

    # --- one stretch ---------------------------------------------------------------------------

    def best(self, text: str, start: int, stop: int) -> tuple[list[float], list[tuple[int, int] | None]]:
        """Best scores and last steps (place, id) from ``start`` to every place up to the end; pieces begin before ``stop``.

        A character that is no piece is a step of id -1. Of equal scores the first found stays.
        """
        size, trie, unknown = len(text), self.trie, self.unknown
        scores: list[float] = [_NEVER] * (size + 1)
        steps: list[tuple[int, int] | None] = [None] * (size + 1)
        scores[start] = 0.0
        for at in range(start, stop):
            here = scores[at]
            if here == _NEVER:
                continue
            node, end, single = trie, at, False
            while end < size:
                node = node.get(text[end])
                if node is None:
                    break
                end += 1
                found = node.get("")
                if found:
                    if end == at + 1:
                        single = True
                    score = here + found[1]
                    if score > scores[end]:
                        scores[end], steps[end] = score, (at, found[0])
            if not single and here + unknown > scores[at + 1]:
                scores[at + 1], steps[at + 1] = here + unknown, (at, -1)
        return scores, steps

    def trace(self, text: str, steps: list, start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            at, i = steps[end]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.byte_ids[b] for b in reversed(text[at:end].encode()))
            end = at
        out.reverse()
        return out

    def stretches(self, text: str) -> list[str]:
        """The text cut where no piece crosses."""
        if not self.splits:
            return [text] if text else []
        return self.stretch.findall(text)

    def cuts(self, text: str, least: int, most: int) -> tuple[int, int] | None:
        """The first and the last place in [least, most] that no piece crosses."""
        if not self.splits:
            return None
        first = re.compile(f"(?<=[^{SPACE_MARK}])(?={SPACE_MARK})").search(text, least, min(most + 1, len(text)))
        if not first:
            return None
        last = first.start()
        for at in range(most, last, -1):
            if at < len(text) and text[at] == SPACE_MARK and text[at - 1] != SPACE_MARK:
                last = at
                break
        return first.start(), last

    # --- one chunk -----------------------------------------------------------------------------

    def inner(self, text: str) -> bytes:
        """Ids of a text whose borders no piece crosses."""
        return b"".join(map(self.memo.__getitem__, self.stretches(text)))

    def inner_score(self, text: str) -> float:
        total = 0.0
        for part in self.stretches(text):
            self.memo[part]  # noqa: B018 - works the stretch out if need be
            total += self.memo.scores[part]
        return total

    def transfer(self, text: str, length: int) -> np.ndarray:
        """Scores from entry state s (so many characters of the chunk are taken) to exit state t (so many behind it are).

        ``text`` is the chunk of ``length`` characters and the ``longest`` - 1 behind it, fewer at the end of the whole text.
        """
        states = self.longest
        out = np.full((states, states), _NEVER)
        exits = min(states - 1, len(text) - length)
        cut = self.cuts(text, min(states, length), length)
        if cut is None:
            for s in range(min(states, length + 1)):
                scores, _ = self.best(text, s, length)
                out[s, : exits + 1] = scores[length : length + exits + 1]
            return out
        first, last = cut
        middle = self.inner_score(text[first:last])
        tail, _ = self.best(text[last:], 0, length - last)
        after = np.array(tail[length - last : length - last + exits + 1])
        for s in range(min(states, first + 1)):
            scores, _ = self.best(text[:first], s, first)
            out[s, : exits + 1] = scores[first] + middle + after
        return out

    def traced(self, text: str, length: int, entry: int, leave: int) -> bytes:
        """Ids of the pieces that begin in the chunk, from its entry state to its exit state."""
        end = length + leave
        cut = self.cuts(text, min(self.longest, length), length)
        if cut is None or entry > cut[0]:
            _, steps = self.best(text, entry, length)
            return np.array(self.trace(text, steps, entry, end), dtype=np.int32).tobytes()
        first, last = cut
        _, steps = self.best(text[:first], entry, first)
        head = self.trace(text, steps, entry, first)
        _, steps = self.best(text[last:], 0, length - last)
        tail = self.trace(text[last:], steps, 0, end - last)
        return b"".join([np.array(head, dtype=np.int32).tobytes(), self.inner(text[first:last]), np.array(tail, dtype=np.int32).tobytes()])

    def marked(self, text: str) -> str:
        """The text as it is segmented: a space in front, and spaces as marks."""
        return ((" " if self.dummy_prefix and text else "") + text).replace(" ", SPACE_MARK)

    def encode(self, text: str) -> bytes:
        """Ids of a text's best segmentation."""
        return self.inner(self.marked(text))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of a column of ids, without the space put in front; null ids are an empty text."""
        table = [t.replace(SPACE_MARK, " ").encode() for t in self.texts]
        for value, i in enumerate(self.byte_ids):
            table[i] = bytes([value])
        at = ids.offsets.to_numpy()
        spelt = pa.array(table, pa.large_binary()).take(ids.values.slice(at[0], at[-1] - at[0]))
        # The spelt pieces lie one after the other, so a row's text is one stretch of their bytes.
        places = np.frombuffer(spelt.buffers()[1], dtype=np.int64)[spelt.offset : spelt.offset + len(spelt) + 1]
        data = memoryview(spelt.buffers()[2]) if len(spelt) and spelt.buffers()[2] is not None else b""
        out = []
        for first, stop in zip(places[at[:-1] - at[0]].tolist(), places[at[1:] - at[0]].tolist()):
            text = bytes(data[first:stop]).decode("utf-8", "replace")
            out.append(text[1:] if self.dummy_prefix and text.startswith(" ") else text)
        return pa.array(out, pa.string())


def id_lists(rows: list[bytes]) -> pa.ListArray:
    """A column of id lists from the bytes of their 32-bit integers."""
    at = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))


def load(path: str = MODEL, scores: str = "ranks") -> Pieces:
    """The vocabulary in a sentence-piece model file. ``scores``: "ranks" or "model" (see above)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    texts = [model.id_to_piece(i) for i in range(size)]
    plain = [
        i for i in range(size)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) and texts[i]
    ]
    values: list[float | None] = [None] * size
    if scores == "model":
        for i in plain:
            values[i] = model.get_score(i)
    else:
        total = math.log(math.fsum(1 / (r + 2.7) for r in range(len(plain))))
        for rank, i in enumerate(sorted(plain, key=lambda i: (-model.get_score(i), i))):
            values[i] = -math.log(rank + 2.7) - total
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Pieces(texts, values, byte_ids)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in the (max, +) algebra; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def border_states(matrices: list[np.ndarray]) -> list[int]:
    """States at the borders of all chunks of a text, 0 at both ends.

    The products of neighbouring runs are built up a tree; then each run's inner borders are settled between its known ends.
    """

    def settle(nodes: list, entry: int, leave: int) -> list[int]:
        if len(nodes) == 1:
            return []
        half = len(nodes) // 2
        left, right = product(nodes[:half]), product(nodes[half:])
        middle = int(np.argmax(left[entry] + right[:, leave]))
        return [*settle(nodes[:half], entry, middle), middle, *settle(nodes[half:], middle, leave)]

    known: dict[tuple[int, int], np.ndarray] = {}

    def product(nodes: list) -> np.ndarray:
        key = (nodes[0][0], nodes[-1][0])
        if key not in known:
            half = len(nodes) // 2
            known[key] = nodes[0][1] if len(nodes) == 1 else combine(product(nodes[:half]), product(nodes[half:]))
        return known[key]

    return [0, *settle(list(enumerate(matrices)), 0, 0), 0]


def _transfers(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces.value
        for batch in batches:
            out = [vocabulary.transfer(t, n).tobytes() for t, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["rid", "nth", "matrix"])

    return run


def _borders(states: int):
    def run(table: pa.Table) -> pa.Table:
        """Entry and exit states of the chunks of one text."""
        table = table.sort_by("nth")
        matrices = [np.frombuffer(m).reshape(states, states) for m in table["matrix"].to_pylist()]
        borders = border_states(matrices)
        return pa.table({
            "rid": table["rid"], "nth": table["nth"], "entry": pa.array(borders[:-1], pa.int32()), "leave": pa.array(borders[1:], pa.int32()),
        })

    return run


def _traced(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces.value
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in range(2, 6)))
            ids = id_lists([vocabulary.traced(*row) for row in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], names=["rid", "nth", "ids"])

    return run


def _encoded(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces.value
        for batch in batches:
            ids = id_lists([vocabulary.encode(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    return run


def encode(
    docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, scores: str = "ranks"
) -> DataFrame:
    """(``id_col``, ids) of every row of ``docs``: the ids of its best segmentation.

    Null and empty texts have no ids. Repeated rows and null ids are rows of their own, an empty table gives an empty result, other
    columns are not read. Of equally good segmentations a fixed one is taken. ``chunk`` (longer than any piece) changes no result
    but in such ties.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "pieces")
    vocabulary = load(model, scores)
    if chunk < vocabulary.longest:
        raise ValueError(f"a chunk needs {vocabulary.longest} characters")
    pieces = spark.sparkContext.broadcast(vocabulary)
    texts = docs.select(column(docs, id_col).alias("id"), whole_text(docs, text_col).alias("text"))
    kind = texts.schema["id"].dataType
    short = texts.where(F.char_length("text") <= chunk)
    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    plain = short.mapInArrow(_encoded(pieces), schema)

    marked = F.translate(F.concat(F.lit(" " if vocabulary.dummy_prefix else ""), F.col("text")), " ", SPACE_MARK)
    long = texts.where(F.char_length("text") > chunk).select(F.monotonically_increasing_id().alias("rid"), "id", marked.alias("text"))
    # Cut in one pass: whole chunks, each with the head of the next one as what lies behind it.
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    heads = long.select("rid", "id", parts.alias("parts")).select(
        "rid", "id",
        F.posexplode(
            F.transform(
                "parts",
                lambda p, n: F.struct(
                    F.concat(p, F.substring(F.coalesce(F.get("parts", n + 1), F.lit("")), 1, vocabulary.longest - 1)).alias("text"),
                    F.char_length(p).alias("length"),
                ),
            )
        ).alias("nth", "part"),
    )
    chunks = stages.store("chunks", heads.select("rid", "id", "nth", "part.text", "part.length"))
    matrices = stages.store(
        "matrices",
        chunks.select("rid", "nth", "text", "length").repartition(spark.sparkContext.defaultParallelism * 4, "rid", "nth")
        .mapInArrow(_transfers(pieces), "rid bigint, nth int, matrix binary"),
    )
    borders = stages.store(
        "borders", matrices.groupBy("rid").applyInArrow(_borders(vocabulary.longest), "rid bigint, nth int, entry int, leave int")
    )
    stages.drop("matrices")
    traced = (
        chunks.join(borders, ["rid", "nth"]).select("rid", "nth", "text", "length", "entry", "leave")
        .mapInArrow(_traced(pieces), "rid bigint, nth int, ids array<int>")
    )
    whole = traced.groupBy("rid").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("nth", "ids"))), lambda x: x["ids"])).alias("ids")
    )
    owners = chunks.where("nth = 0").select("rid", "id")
    return plain.unionByName(owners.join(whole, "rid").select("id", "ids")).select(F.col("id").alias(id_col), "ids")


def decode(encoded: DataFrame, model: str = MODEL, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """Columns ``keep`` of every row with the decoded ``text``; null ids decode to an empty text."""
    spark = encoded.sparkSession
    pieces = spark.sparkContext.broadcast(load(model))
    rows = encoded.select(*[column(encoded, c).alias(f"k{n}") for n, c in enumerate(keep)], column(encoded, ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces.value
        for batch in batches:
            texts = vocabulary.decode(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*batch.schema.names[:-1], "text"])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, schema).toDF(*keep, "text")
