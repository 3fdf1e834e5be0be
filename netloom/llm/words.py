"""Words and word shingles of Arrow text batches as 64-bit hashes, computed for a whole batch at a time with numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

_U = np.uint64
_SLICE = 1 << 17  # bytes hashed at a time
_LONG = 1 << 10  # longer words are hashed by a digest: sums of powers modulo 2 ** 64 mix too little there

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15


def _power_tables() -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        table = np.full(_SLICE + 1, base, dtype=_U)
        table[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(table, out=table)
        tables.append(table)
    return tables


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over the word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return x ^ (x >> _U(32))


def _spans(data: np.ndarray, row_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a row's border ends a word too."""
    word = ~_IS_SPACE[data]
    opens = np.empty_like(word)
    closes = np.empty_like(word)
    opens[0] = closes[-1] = True
    opens[1:] = ~word[:-1]
    closes[:-1] = ~word[1:]
    inner = row_at[(row_at > 0) & (row_at < len(data))]
    opens[inner] = True
    closes[inner - 1] = True
    return np.flatnonzero(word & opens), np.flatnonzero(word & closes) + 1


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _power_tables()
    out = np.zeros(len(starts), dtype=_U)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            first = starts[at]
            stop = max(int(np.searchsorted(ends, first + _SLICE, side="right")), at + 1)
            piece = data[first : ends[stop - 1]]
            if len(piece) <= _SLICE:
                sums = np.zeros(len(piece) + 1, dtype=_U)
                np.cumsum((piece.astype(_U) + _U(1)) * power[: len(piece)], out=sums[1:])
                begin = starts[at:stop] - first
                out[at:stop] = (sums[ends[at:stop] - first] - sums[begin]) * inverse[begin]
            at = stop
        lengths = ends - starts
        out = mix(out + lengths.astype(_U) * _U(0xC2B2AE3D27D4EB4F))
    for n in np.flatnonzero(lengths > _LONG):
        digest = hashlib.blake2b(data[starts[n] : ends[n]].tobytes(), digest_size=8).digest()
        out[n] = int.from_bytes(digest, "little")
    return out


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the row borders in them."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[at[0] : at[-1]] if body is not None else np.zeros(0, dtype=np.uint8)
    return data, at - at[0]


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all rows, A-Z lower-cased, and the border of each row in them."""
    if not len(texts):
        return np.zeros(0, dtype=_U), np.zeros(1, dtype=np.int64)
    data, at = _raw(texts)
    if not len(data):
        return np.zeros(0, dtype=_U), np.zeros(len(texts) + 1, dtype=np.int64)
    starts, ends = _spans(data, at)
    return _hash_spans(_LOWER[data], starts, ends), np.searchsorted(starts, at)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each row.

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    words, at = hashed_words(texts)
    with np.errstate(over="ignore"):
        factors = [mix(np.array([n + 1], dtype=_U))[0] | _U(1) for n in range(size)]
        if len(words) >= size:
            full = np.zeros(len(words) - size + 1, dtype=_U)
            for n, factor in enumerate(factors):
                full += words[n : len(words) - size + 1 + n] * factor
            full = mix(full)
        out = []
        for first, stop in zip(at[:-1], at[1:]):
            if stop - first >= size:
                out.append(np.unique(full[first : stop - size + 1]))
            elif stop > first:
                whole = _U(stop - first)
                for word, factor in zip(words[first:stop], factors):
                    whole = whole + word * factor
                out.append(mix(np.array([whole], dtype=_U)))
            else:
                out.append(np.zeros(0, dtype=_U))
    return out


def set_digest(values: np.ndarray) -> bytes:
    """128-bit identity of a set given in sorted order."""
    return hashlib.blake2b(np.ascontiguousarray(values).tobytes(), digest_size=16).digest()


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the Arrow batches by rows, and by bytes where the engine offers it, so long texts don't pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
