"""Languages of texts as mixtures: expectation-maximisation over words, the set of languages by penalised likelihood.

Each language has probabilities of hashed byte n-grams, learned on the driver from a bounded sample of labelled texts and broadcast;
their size does not depend on the corpus. A text's words are drawn from its languages: a word's likelihood under a
language comes from the n-grams at its letters, and expectation-maximisation finds the language proportions under which the words are likeliest.
Languages enter the set by falling proportion as long as the gain in log-likelihood is worth the penalty.

Texts are read whole and on their own, in tasks; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from netloom.llm.columns import column
from netloom.llm.words import _raw

UNKNOWN = "und"
# Bytes before and after a letter that belong to its n-gram, and the logarithm of the number of cells per order.
ORDERS = (((1, 1), 15), ((2, 1), 16))
CELLS = sum(1 << bits for _, bits in ORDERS)
BACKGROUND = 0.1  # share of the n-grams of all languages in each language's probabilities
RUN = 24  # bytes of a letter run read as one word; scripts without spaces have long runs
ROUNDS, PENALTY = 12, 2.0
_SLICE = 1 << 20  # bytes of text read at a time
_F = np.float32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Words:
    """Words of some texts: the n-gram cells at each letter, where each word's letters begin, and the words of each text."""

    cells: np.ndarray  # (orders, letters)
    at: np.ndarray  # first letter of each word
    rows_at: np.ndarray  # first word of each text, and the number of words


def read_words(texts: pa.Array) -> Words:
    """Words of lower-cased texts. A word is a run of ASCII letters and bytes of other scripts, cut every ``RUN`` bytes."""
    data, at = _raw(texts)
    # Three blanks between texts keep n-grams inside them.
    place = np.arange(len(data)) + 3 * (np.repeat(np.arange(len(texts)), np.diff(at)) + 1)
    x = np.full(len(data) + 3 * len(texts) + 3, 32, dtype=np.uint8)
    x[place] = np.where(_LETTER[data], data, 32)
    here = np.flatnonzero(x != 32)
    if not len(here):
        return Words(np.zeros((len(ORDERS), 0), np.int32), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    begins = np.ones(len(here), dtype=bool)
    begins[1:] = here[1:] != here[:-1] + 1
    run = np.cumsum(begins) - 1
    nth = np.arange(len(here)) - np.flatnonzero(begins)[run]
    first = np.flatnonzero(nth % RUN == 0)
    wide, cells, base = x.astype(np.uint32), np.empty((len(ORDERS), len(here)), dtype=np.int32), 0
    for n, ((before, after), bits) in enumerate(ORDERS):
        code = np.zeros(len(here), dtype=np.uint32)
        for step in range(-before, after + 1):
            code = (code << np.uint32(8)) | wide[here + step]
        cells[n] = ((code * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int32) + base
        base += 1 << bits
    starts = at + 3 * (np.arange(len(texts) + 1) + 1)
    return Words(cells, first, np.searchsorted(here[first], starts - 1))


class Languages:
    """Names and log-probabilities of the n-grams of each language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        """``counts``: (languages, cells)."""
        self.names, parts, base = names, [], 0
        for _, bits in ORDERS:
            own = counts[:, base : base + (1 << bits)].astype(np.float64)
            base += 1 << bits
            own /= np.maximum(own.sum(axis=1, keepdims=True), 1)
            # Every cell has a little of the background, so an n-gram that nobody knows speaks for nobody.
            common = own.mean(axis=0) + 1e-7
            parts.append(np.log((1 - BACKGROUND) * own + BACKGROUND * common / common.sum()))
        self.log_p = np.ascontiguousarray(np.concatenate(parts, axis=1).T.astype(_F))

    def likelihoods(self, words: Words) -> np.ndarray:
        """(words, languages) log-likelihoods; the orders' are averaged, since they tell of the same letters."""
        out = np.empty((len(words.at), len(self.names)), dtype=_F)
        ends = np.append(words.at[1:], words.cells.shape[1])
        step = max(1, (1 << 20) // (RUN * len(self.names)))
        for a in range(0, len(out), step):
            b = min(a + step, len(out))
            letters = slice(words.at[a], ends[b - 1])
            total = sum(self.log_p[words.cells[n, letters]] for n in range(len(ORDERS)))
            out[a:b] = np.add.reduceat(total, words.at[a:b] - words.at[a], axis=0) / _F(len(ORDERS))
        return out


def proportions(odds: np.ndarray, rows_at: np.ndarray, allowed: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for many texts at once: proportions (texts, languages) and log-likelihoods.

    ``odds``: (words, languages) likelihoods in proportion to each word's largest. Every text has a word; ``allowed``: its languages.
    """
    number = np.diff(rows_at)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = odds * np.repeat(share.astype(_F), number, axis=0)
        joint /= joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, rows_at[:-1], axis=0) / number[:, None]
    mixed = (odds * np.repeat(share.astype(_F), number, axis=0)).sum(axis=1)
    return share, np.add.reduceat(np.log(mixed.astype(np.float64)), rows_at[:-1])


def mixtures(likelihoods: np.ndarray, rows_at: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (texts, languages) over each text's chosen languages, and over all languages.

    The set grows by falling proportion under all languages, from the one likeliest alone. A set of k languages scores its log-likelihood
    less ``penalty`` * (k - 1) * log(1 + words); the growth ends at the first set that scores no better. Texts without words have zeros.
    """
    languages = likelihoods.shape[1]
    chosen = np.zeros((len(rows_at) - 1, languages))
    full = np.zeros_like(chosen)
    filled = np.flatnonzero(np.diff(rows_at) > 0)
    if not len(filled):
        return chosen, full
    at = np.append(rows_at[:-1][filled], rows_at[-1])
    number = np.diff(at)
    # A word's odds never reach zero, so a text can always be explained by any set.
    odds = np.maximum(np.exp(likelihoods - likelihoods.max(axis=1, keepdims=True)), _F(1e-12))
    alone = np.add.reduceat(np.log(odds).astype(np.float64), at[:-1], axis=0)
    share, _ = proportions(odds, at, np.ones((len(filled), languages)))
    full[filled] = share
    rows = np.arange(len(filled))
    first = alone.argmax(axis=1)
    best, score = np.zeros_like(share), alone[rows, first]
    best[rows, first] = 1
    order = np.argsort(-np.where(np.arange(languages) == first[:, None], 2.0, share), axis=1, kind="stable")
    price = penalty * np.log1p(number)
    allowed, active = best > 0, rows
    for k in range(1, languages):
        allowed[rows, order[:, k]] = True
        # No set explains a word better than its likeliest language: log-likelihoods end at 0.
        active = active[score[active] < -price[active] * k]
        if not len(active):
            break
        words = np.concatenate([np.arange(a, b) for a, b in zip(at[active], at[active + 1])])
        own_at = np.concatenate([[0], np.cumsum(number[active])])
        some, fit = proportions(odds[words], own_at, allowed[active].astype(np.float64))
        fit -= price[active] * k
        better = fit > score[active]
        active = active[better]
        best[active], score[active] = some[better], fit[better]
    chosen[filled] = best
    return chosen, full


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of whole texts with about ``_SLICE`` bytes."""
    _, at = _raw(texts)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(at, at[start] + _SLICE, side="right")) - 1)
        yield texts.slice(start, stop - start)
        start = stop


def fit(texts: list[str], langs: list[str]) -> Languages | None:
    """N-gram counts of lower-cased texts; None without texts."""
    names = sorted(set(langs))
    if not names:
        return None
    counts = np.zeros((len(names), CELLS))
    for name, row in zip(names, counts):
        own = [t for t, lang in zip(texts, langs) if lang == name]
        for part in _slices(pa.array(own, pa.large_string())):
            row += np.bincount(read_words(part).cells.reshape(-1), minlength=CELLS)
    return Languages(names, counts)


def training_side(id_col: Column) -> Column:
    """Whether a document may be learned from; the others are held out."""
    return F.crc32(id_col.cast("string")) % 4 != 2


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 500,
    max_total: int = 20_000, max_chars: int = 20_000,
) -> Languages | None:
    """Languages learned from ``docs``: of each ``lang``, the ``max_rows`` rows of the smallest id hashes, of at most ``max_chars`` code
    points, and at most ``max_total`` rows in all, dealt evenly. These bounds hold what the driver reads, whatever the corpus.

    Rows with a null id, text or language, and ids on the held-out side, are ignored. Without rows there is nothing learned (None).
    """
    text, lang = column(docs, text_col).cast("string"), column(docs, lang_col).cast("string")
    known = docs.select(column(docs, id_col).alias("id"), text.alias("text"), lang.alias("lang"))
    known = known.where(training_side(F.col("id")) & F.col("lang").isNotNull() & (F.char_length("text") <= max_chars))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ranked = known.select("id", "lang").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_rows)
    chosen = ranked.orderBy("rank", "lang").limit(max_total).groupBy("id", "lang").agg(F.min("rank").alias("rank"))
    rows = known.join(F.broadcast(chosen), ["id", "lang"])  # at most max_total rows of three small columns
    rows = rows.select(F.lower("text").alias("text"), "lang", "rank").orderBy("rank", "lang", "text").limit(max_total).toArrow()
    return fit(rows.column(0).to_pylist(), rows.column(1).to_pylist())


def identify(
    docs: DataFrame, languages: Languages | None, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY,
) -> DataFrame:
    """(``id_col``, lang_pred, score, languages) of every row of ``docs``.

    ``languages`` lists the chosen set as (lang, share), by falling share; ``lang_pred`` is its first one (ties: the smaller name). ``score`` is the
    share of ``lang_pred`` when all languages compete, drawn towards an even split as if by one more word. Null texts and texts without a letter, and all texts if nothing was learned, are
    ``und`` with score 0 and no languages. Rows are read one by one, so repeated rows and null ids need no care; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(languages)
    text = column(docs, text_col).cast("string")
    # Texts without a letter are emptied here, where letters of all scripts are known.
    text = F.when(text.rlike(r"\p{L}"), F.lower(text)).otherwise(F.lit(""))
    rows = docs.select(column(docs, id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    set_type = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))
    arrow_set = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def read(texts: pa.Array) -> tuple[list[str], list[float], list[list[dict]]]:
        known = shared.value
        words = read_words(texts)
        preds, scores, sets = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in range(len(texts))]
        if known is None or not len(words.at):
            return preds, scores, sets
        chosen, full = mixtures(known.likelihoods(words), words.rows_at, penalty)
        number = np.diff(words.rows_at)
        for n in np.flatnonzero(number):
            ranked = sorted((-round(s, 6), known.names[k], k) for k, s in enumerate(chosen[n].tolist()) if s > 0)
            preds[n], top = ranked[0][1], ranked[0][2]
            sets[n] = [{"lang": name, "share": -s} for s, name, _ in ranked]
            share = (number[n] * full[n, top] + 1 / len(known.names)) / (number[n] + 1)
            scores[n] = round(float(min(1, max(0, share))), 6)
        return preds, scores, sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in _slices(batch.column(1)):
                preds, scores, sets = read(part)
                ids = batch.column(0).slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, arrow_set)],
                    names=["id", "lang_pred", "score", "languages"],
                )

    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("languages", set_type),
    ])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
