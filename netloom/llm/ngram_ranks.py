"""How many sets have each n-gram, told to the sets themselves: exact counts without a table of all n-grams anywhere.

A task sends the n-grams of its sets in blocks, cut by hash range, each with its owner in the block. The task of a range counts them
and answers every block with the n-grams that more than one set has, and their counts. A block then knows for each of its sets
how many n-grams nobody else has, and the rank of the others, from which it makes the sets' prefixes. An n-gram that many sets
of one block have is sent once with their number, and its owners go straight to the end, so that no n-gram costs a range more than a bounded
number of entries a block.

N-grams go by 48 bits of their hash (a range and 32 bits within it). Two that agree by chance are taken for one, which adds a candidate
and loses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from netloom.llm.words import set_digest, shingle_sets

BLOCK = 1 << 21  # n-grams of one block
RANGE = 1 << 22  # n-grams of one range, on average
LOCAL = 64  # sets of one block with the same n-gram from which on it is sent once
# Rows of one frequent prefix n-gram that one task may hold before they are dealt to several.
HOT_ROWS = 4096
_U = np.uint64
_PARTS = ["a", "b", "c", "d", "e"]
SENT = "block bigint, range int, kind int, " + ", ".join(f"{p} binary" for p in _PARTS)
PREFIX = "token bigint, salt bigint, cls binary, n bigint, s bigint, pos bigint, hot boolean"


def code_of(counts: np.ndarray) -> np.ndarray:
    """One byte that grows with the count: exact below 128, quarters of a power of two from there."""
    high = 128 + np.floor(4 * np.log2(np.maximum(counts, 128) / 128))
    return np.where(counts < 128, counts, np.minimum(high, 255)).astype(np.uint8)


def count_of(codes: np.ndarray) -> np.ndarray:
    """The smallest count that has this byte, rounded down."""
    return np.where(codes < 128, codes, 128 * 2 ** ((codes.astype(np.float64) - 128) / 4)).astype(np.int64)


def prefix_length(n, percent: int):
    return n - -(-n * percent // 100) + 1


def _record(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
    names = ["block", "range", "kind", *_PARTS]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _block_rows(block: int, classes: list[bytes], sets: list[np.ndarray], ranges: int) -> list[tuple]:
    """What a block sends: per range its n-grams and their owners; and, as kind 1, its sets and the owners of its frequent n-grams."""
    sizes = np.array([len(s) for s in sets], dtype=np.uint32)
    tokens = np.concatenate(sets) >> _U(16)
    owners = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
    ids = (((tokens * _U(ranges)) >> _U(48)) << _U(32)) | (tokens & _U(0xFFFFFFFF))
    order = np.argsort(ids, kind="stable")
    ids, owners = ids[order], owners[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    many = np.diff(np.append(first, len(ids)))
    hot = many >= LOCAL
    plain = ~np.repeat(hot, many)
    hot_ids, hot_many = ids[first][hot], many[hot].astype(np.uint32)
    place_hot, place, low = (hot_ids >> _U(32)).astype(np.int64), (ids[plain] >> _U(32)).astype(np.int64), (ids[plain] & _U(0xFFFFFFFF)).astype(np.uint32)
    out = [(block, block % ranges, 1, b"".join(classes), sizes.tobytes(), hot_ids.tobytes(), hot_many.tobytes(), owners[~plain].tobytes())]
    owners = owners[plain]
    cut = np.searchsorted(place, np.arange(ranges + 1))
    cut_hot = np.searchsorted(place_hot, np.arange(ranges + 1))
    for r in np.flatnonzero((np.diff(cut) > 0) | (np.diff(cut_hot) > 0)).tolist():
        own, own_hot = slice(cut[r], cut[r + 1]), slice(cut_hot[r], cut_hot[r + 1])
        out.append((
            block, r, 0, low[own].tobytes(), owners[own].tobytes(), (hot_ids[own_hot] & _U(0xFFFFFFFF)).astype(np.uint32).tobytes(),
            hot_many[own_hot].tobytes(), None,
        ))
    return out


def _send(size: int, ranges: int):
    """Blocks of the distinct sets of each task, from its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done, classes, sets, held = TaskContext.get().partitionId() << 32, set(), [], [], 0
        for batch in batches:
            for values in shingle_sets(batch.column(0), size):
                if not len(values):
                    continue
                cls = set_digest(values)
                if cls in done:
                    continue
                if len(done) < 1 << 18:  # only saves repeated sets; the rest are dropped when prefixes meet
                    done.add(cls)
                classes.append(cls)
                sets.append(values)
                held += len(values)
                if held >= BLOCK:
                    yield _record(_block_rows(base, classes, sets, ranges))
                    base, classes, sets, held = base + 1, [], [], 0
        if sets:
            yield _record(_block_rows(base, classes, sets, ranges))

    return run


def _u32(value: bytes | None) -> np.ndarray:
    return np.frombuffer(value or b"", dtype=np.uint32)


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Rows of each value of column ``key``, in which they are sorted."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and row[key] != held[0][key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _answers(rows: list[tuple]) -> list[tuple]:
    """Answers of one range: (n-grams, owners, codes) of those that more than one set has, and (frequent n-grams, codes)."""
    out = [r for r in rows if r[2] == 1]
    letters = [r for r in rows if r[2] == 0]
    if not letters:
        return out
    tokens = np.concatenate([_u32(p) for r in letters for p in (r[3], r[5])])
    many = np.concatenate([m for r in letters for m in (np.ones(len(r[3]) // 4, dtype=np.int64), _u32(r[6]).astype(np.int64))])
    known, inverse = np.unique(tokens, return_inverse=True)
    codes = code_of(np.bincount(inverse, weights=many, minlength=len(known)).astype(np.int64))[inverse]
    at = 0
    for block, r, _, own, owners, hot, _, _ in letters:
        n, n_hot = len(own) // 4, len(hot) // 4
        mine, theirs = codes[at : at + n], codes[at + n : at + n + n_hot]
        at += n + n_hot
        shared = mine > 1
        if shared.any() or n_hot:
            out.append((block, r, 0, _u32(own)[shared].tobytes(), _u32(owners)[shared].tobytes(), mine[shared].tobytes(), hot, theirs.tobytes()))
    return out


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches, 1):
        yield _record(_answers(rows))


def _block_prefixes(rows: list[tuple], percent: int) -> dict[str, np.ndarray | list]:
    """Prefixes of the sets of one block, from its own row and the answers of all ranges."""
    (home,) = [r for r in rows if r[2] == 1]
    answers = [r for r in rows if r[2] == 0]
    n = np.frombuffer(home[4], dtype=np.uint32).astype(np.int64)
    hot_ids, hot_many = np.frombuffer(home[5], dtype=_U), _u32(home[6])
    hot_code = np.zeros(len(hot_ids), dtype=np.uint8)
    ids, owners, codes = [], [], []
    for _, r, _, own, who, code, hot, theirs in answers:
        base = _U(r) << _U(32)
        ids.append(_u32(own).astype(_U) | base)
        owners.append(_u32(who))
        codes.append(np.frombuffer(code, dtype=np.uint8))
        hot_code[np.searchsorted(hot_ids, _u32(hot).astype(_U) | base)] = np.frombuffer(theirs, dtype=np.uint8)
    ids.append(np.repeat(hot_ids, hot_many))
    owners.append(_u32(home[7]))
    codes.append(np.repeat(hot_code, hot_many))
    ids, owners, codes = (np.concatenate(x) for x in (ids, owners, codes))
    shared = np.bincount(owners, minlength=len(n))
    # What nobody else has comes first in the order and meets nothing.
    room = prefix_length(n, percent) - (n - shared)
    kept = room[owners] > 0
    ids, owners, codes = ids[kept], owners[kept], codes[kept]
    order = np.lexsort((ids, codes, owners))
    ids, owners, codes = ids[order], owners[order], codes[order]
    pos = np.arange(len(owners)) - np.searchsorted(owners, owners)
    front = pos < room[owners]
    ids, owners, codes, pos = ids[front], owners[front].astype(np.int64), codes[front], pos[front]
    cls = np.frombuffer(home[3], dtype="V16")[owners]
    counts = count_of(codes)
    own = np.frombuffer(cls.tobytes(), dtype=_U)[::2]
    return {
        "token": ids.view(np.int64), "salt": (own % (counts // HOT_ROWS + 1).astype(_U)).astype(np.int64), "cls": [c.tobytes() for c in cls],
        "n": n[owners], "s": shared[owners], "pos": pos, "hot": counts >= HOT_ROWS,
    }


def _prefixes(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, 0):
            found = _block_prefixes(rows, percent)
            if len(found["token"]):
                types = {"cls": pa.binary(), "hot": pa.bool_()}
                yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in found.items()], names=list(found))

    return run


def ranked_prefixes(texts: DataFrame, size: int, percent: int, total: int) -> DataFrame:
    """(token, salt, cls, n, s, pos, hot): the prefixes, rarest n-grams first, of the distinct sets of ``texts`` (text).

    ``s`` is the number of a set's n-grams that others have too, ``pos`` the place among these. A set whose prefix holds only
    n-grams of its own has no rows: it can link with nothing. ``total``: n-grams of all sets, which decides the number of ranges.
    A set may come from several tasks; the counts then take it for several, which changes the order only.
    """
    spark = texts.sparkSession
    ranges = min(1 << 15, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE)))
    sent = texts.select("text").mapInArrow(_send(size, ranges), SENT)
    answered = sent.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "block").mapInArrow(_answer, SENT)
    return answered.repartition("block").sortWithinPartitions("block", "range").mapInArrow(_prefixes(percent), PREFIX)
