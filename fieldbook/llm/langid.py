"""Language identification with language-bitmask n-gram filters.

One Bloom filter holds all languages: every slot is a word with one bit per
language.  An n-gram's slots, combined with AND, give every language that has
it; the counts of a language's bits over a text, less those its fill of the
filter lets through by chance, decide.

n-grams are 3 and 4 bytes of folded letters, word edges included.  A
language's n-grams are those in at least ``MIN_RATE`` of its training texts
and not ``FOREIGN`` times as frequent in another language, so foreign passages
do not pollute it.  Training reads about ``TRAIN_ROWS`` texts a language
(documented bound, chosen by a hash of the id); the number of n-grams of such
a rate, and so the filter, does not grow with the corpus.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0;
with nothing learned every text is ``und``; equal counts go to the language
first in the alphabet; a text with letters but no known n-gram gets the most
frequent language with score 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.words import LOWER_ASCII, mix, row_slices, text_buffers

TRAIN_ROWS = 10_000
MIN_RATE = 0.005
FOREIGN = 8.0
SLOTS = 1 << 20
HASHES = 3
SIZES = (3, 4)
LANGS_PER_WORD = 62
UNKNOWN = "und"
SLICE = 1 << 18                 # bytes of text looked at together
LEAST_COVERAGE = 0.25           # a text with less of its n-grams in its language is rejected

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[0x80:] = True
_FOLD = np.where(_LETTER[LOWER_ASCII], LOWER_ASCII, 32).astype(np.uint8)


@dataclass
class Filter:
    languages: list[str]            # by bit, alphabetical
    slots: np.ndarray               # (words, SLOTS)
    chance: np.ndarray              # per language: how often a foreign n-gram passes
    common: int                     # the most frequent language


def _grams(offsets, data, lo, hi):
    """(n-grams as integers, their rows) of a slice; an n-gram is letters of
    one word, with its edges."""
    base, n = int(offsets[lo]), int(offsets[hi] - offsets[lo])
    rows = hi - lo
    lengths = np.diff(offsets[lo:hi + 1])
    row = np.repeat(np.arange(rows), lengths + 2)             # every text between two spaces
    text = np.full(n + 2 * rows, 32, np.uint8)
    at = np.arange(n) + 2 * np.repeat(np.arange(rows), lengths) + 1
    text[at] = _FOLD[data[base:base + n]]
    letter = text != 32
    out, of = [], []
    for size in SIZES:
        if len(text) < size:
            continue
        last = len(text) - size + 1
        inner = np.ones(last, bool)
        for k in range(1, size - 1):
            inner &= letter[k:k + last]
        inner &= row[:last] == row[size - 1:]
        begin = np.flatnonzero(inner)
        gram = np.full(len(begin), size, np.uint64)
        for k in range(size):
            gram = (gram << np.uint64(8)) | text[begin + k]
        out.append(gram)
        of.append(row[begin])
    return np.concatenate(out or [np.zeros(0, np.uint64)]), np.concatenate(of or [np.zeros(0, np.int64)])


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    h = mix(grams * np.uint64(0x9E3779B97F4A7C15))
    return [((h >> np.uint64(21 * k)) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]


def _count_grams(batches):
    """(lang, gram, texts that have it) per batch."""
    for batch in batches:
        offsets, data = text_buffers(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), object)
        found: dict[str, list[tuple]] = {}
        for lo, hi in row_slices(offsets, SLICE):
            gram, row = _grams(offsets, data, lo, hi)
            pairs = np.unique((row.astype(np.uint64) << np.uint64(40)) | gram)
            row, gram = (pairs >> np.uint64(40)).astype(np.int64), pairs & np.uint64((1 << 40) - 1)
            for lang in set(langs[lo:hi]):
                own = np.unique(gram[np.isin(row, np.flatnonzero(langs[lo:hi] == lang))], return_counts=True)
                found.setdefault(lang, []).append(own)
        for lang, parts in found.items():
            values, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([p[1] for p in parts]), len(values))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)),
                                              pa.array(counts.astype(np.int64))], names=["lang", "gram", "texts"])


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Filter:
    """Filter of the languages of ``labelled`` (rows with NULL language or
    text teach nothing)."""
    labelled = labelled.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    labelled = labelled.where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}   # one row a language
    languages = sorted(sizes)
    empty = Filter(languages, np.zeros((len(languages) // LANGS_PER_WORD + 1, SLOTS), np.uint64), np.zeros(len(languages)), 0)
    if not languages:
        return empty
    share = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, rows / sizes[name])))])
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    counts = (chosen.select("text", "lang").mapInArrow(_count_grams, "lang string, gram long, texts long")
              .groupBy("gram", "lang").agg(F.sum("texts").alias("texts")))
    trained = {r.lang: r.n for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    total = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(float(max(1, trained.get(name, 1)))))])
    rated = counts.withColumn("rate", F.col("texts") / total[F.col("lang")])
    best = rated.groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("lang", "rate")).alias("all"))
    own = best.where(F.col("best") >= MIN_RATE).select("gram", "best", F.explode("all").alias("x")).where(
        (F.col("x.rate") >= MIN_RATE) & (F.col("x.rate") * FOREIGN >= F.col("best"))).select("gram", F.col("x.lang").alias("lang"))
    own = own.toArrow()              # bounded: the rates of a language's n-grams sum to the n-grams of one text
    model, number = empty, {name: k for k, name in enumerate(languages)}
    grams = own.column("gram").to_numpy().astype(np.uint64)
    bit = np.array([number[x] for x in own.column("lang").to_pylist()], np.int64)
    for k in range(len(languages)):
        for slots in _slots(grams[bit == k]):
            model.slots[k // LANGS_PER_WORD][slots] |= np.uint64(1 << (k % LANGS_PER_WORD))
    for k in range(len(languages)):
        fill = ((model.slots[k // LANGS_PER_WORD] >> np.uint64(k % LANGS_PER_WORD)) & np.uint64(1)).mean()
        model.chance[k] = min(fill ** HASHES, 0.99)
    model.common = max(range(len(languages)), key=lambda k: (sizes[languages[k]], -k))
    return model


def _decide(model: Filter, texts: pa.Array) -> pa.Array:
    offsets, data = text_buffers(texts)
    out = []
    for lo, hi in row_slices(offsets, SLICE):
        gram, row = _grams(offsets, data, lo, hi)
        order = np.argsort(row, kind="stable")
        gram, row = gram[order], row[order]
        edge = np.searchsorted(row, np.arange(hi - lo + 1))
        slots = _slots(gram)
        counts = np.zeros((len(model.languages), hi - lo))
        for word, cells in enumerate(model.slots):
            have = cells[slots[0]]
            for s in slots[1:]:
                have &= cells[s]
            for k in range(word * LANGS_PER_WORD, min(len(model.languages), (word + 1) * LANGS_PER_WORD)):
                bits = np.r_[0, np.cumsum((have >> np.uint64(k % LANGS_PER_WORD)) & np.uint64(1))]
                counts[k] = bits[edge[1:]] - bits[edge[:-1]]
        n = np.diff(edge)
        counts = np.maximum(0, (counts - n * model.chance[:, None]) / (1 - model.chance[:, None]))
        letters = _LETTER[LOWER_ASCII[data[int(offsets[lo]):int(offsets[hi])]]]
        plain = np.r_[0, np.cumsum(letters)][(offsets[lo:hi + 1] - offsets[lo])]
        for r in range(hi - lo):
            if not model.languages or plain[r] == plain[r + 1] or not _has_letter(texts, offsets, data, lo + r):
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmax(counts[:, r]))
            if not n[r] or counts[best, r] <= 0:
                out.append((model.languages[model.common], 0.0))
            else:
                out.append((model.languages[best], float(min(1.0, counts[best, r] / n[r]))))
    return pa.array([{"lang": a, "score": b} for a, b in out], pa.struct([("lang", pa.string()), ("score", pa.float64())]))


def _has_letter(texts, offsets, data, row) -> bool:
    """ASCII letters are seen at once; other bytes may be signs of any kind."""
    raw = data[int(offsets[row]):int(offsets[row + 1])]
    folded = LOWER_ASCII[raw[:4096]]
    if ((folded >= 97) & (folded <= 122)).any():
        return True
    return any(c.isalpha() for c in raw.tobytes().decode())


def predicted(docs: DataFrame, model: Filter, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with the struct column ``into``: ``lang`` and ``score`` (the
    share of the text's n-grams that the language has, corrected for chance)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # SLOTS words: fixed size

    @F.arrow_udf("struct<lang: string, score: double>")
    def decide(texts: pa.Array) -> pa.Array:
        return _decide(shared.value, texts)

    # a filter on the result must not compute it a second time
    return docs.withColumn(into, decide.asNondeterministic()(F.col(f"`{text}`")))


def held_out(key: Column, fold: int = 2, folds: int = 4) -> Column:
    """Rows that teach nothing: a checksum of the id names their fold."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))
