"""Quality classifier: histogram gradient-boosted trees over text statistics.

Statistics of whole texts (``STATISTICS``) are binned to bytes by quantiles of
the training rows; trees of fixed depth are grown level by level on gradient
histograms and flattened into arrays, so a batch of texts walks all trees with
a few numpy look-ups.  Training reads about ``TRAIN_ROWS`` labelled rows
(documented bound, chosen by a hash of the id); scoring covers every row.

Defined cases: NULL and empty texts have statistics of zero and are scored
like any other; rows with a NULL label teach nothing; several labels of one id
count as their mean, rounded; with no labelled rows every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.words import LOWER_ASCII, SPACE_WORDS, WordSlice, row_slices, text_buffers, windows

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, LEAST_WEIGHT, RIDGE = 0.15, 2.0, 1.0
THRESHOLD = 0.3

STATISTICS = (
    "log bytes", "log words", "word length", "lower share", "upper share", "digit share", "outside ASCII share",
    "space share", "punctuation share", "sign share", "words ending in a sign", "words without letters",
    "distinct words", "commonest word", "repeated neighbours", "distinct word pairs", "distinct five-word runs",
    "lines a word", "repeated lines", "log line length",
)

_KIND = np.full(256, 6, np.uint8)                       # signs
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 5
_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def _distinct(values: np.ndarray, first: np.ndarray, size: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Per row: distinct share of its values, and the commonest one's share;
    a row's values are ``first[r] .. first[r + 1] - size + 1``."""
    rows = len(first) - 1
    n = np.maximum(np.diff(first) - size + 1, 0)
    row = np.repeat(np.arange(rows), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n)
    order = np.lexsort((values[at], row))
    v, row = values[at][order], row[order]
    new = np.r_[True, (v[1:] != v[:-1]) | (row[1:] != row[:-1])] if len(v) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    most = np.zeros(rows)
    np.maximum.at(most, row[begin], np.diff(np.r_[begin, len(v)]))
    kinds = np.bincount(row[begin], minlength=rows)
    some = np.maximum(n, 1)
    return np.where(n > 0, kinds / some, 0.0), most / some


def statistics(texts: pa.Array) -> np.ndarray:
    """(rows, statistics) of a string column, NULL as empty."""
    offsets, data = text_buffers(texts)
    out = [np.zeros((0, len(STATISTICS)))]
    for lo, hi in row_slices(offsets):
        rows, size = hi - lo, np.diff(offsets[lo:hi + 1])
        raw = data[int(offsets[lo]):int(offsets[hi])]
        row = np.repeat(np.arange(rows), size)
        kinds = np.bincount(row * 8 + _KIND[raw], minlength=rows * 8).reshape(rows, 8)
        w = WordSlice(offsets, data, lo, hi, SPACE_WORDS, LOWER_ASCII)
        lines = WordSlice(offsets, data, lo, hi, _NOT_NEWLINE, LOWER_ASCII)
        n, n_lines, some = w.counts(), lines.counts(), np.maximum(w.counts(), 1)
        per_word = lambda flag: np.diff(np.r_[0, np.cumsum(flag)][w.first]) / some  # noqa: B023, E731
        letters = np.r_[0, np.cumsum(np.isin(_KIND[w.data], (0, 1, 3)))]
        same = np.r_[False, w.hashes[1:] == w.hashes[:-1]][:len(w.hashes)]
        same[w.first[:-1][n > 0]] = False
        pad = lambda x: np.r_[x, np.zeros(len(w.hashes) - len(x), np.uint64)]  # noqa: B023, E731
        distinct, most = _distinct(w.hashes, w.first)
        pairs, _ = _distinct(pad(windows(w.hashes, 2)), w.first, 2)
        runs, _ = _distinct(pad(windows(w.hashes, 5)), w.first, 5)
        line_kinds, _ = _distinct(lines.hashes, lines.first)
        total = np.maximum(size, 1)
        out.append(np.stack([
            np.log1p(size), np.log1p(n), per_word(w.ends - w.starts), *(kinds[:, :7] / total[:, None]).T,
            per_word(_KIND[w.data[w.ends - 1]] == 6), per_word(letters[w.ends] == letters[w.starts]),
            distinct, most, per_word(same), pairs, runs, n_lines / some, np.where(n_lines > 0, 1 - line_kinds, 0.0),
            np.log1p(size / np.maximum(n_lines, 1))], axis=1))
    return np.concatenate(out).astype(np.float32)


@dataclass
class Trees:
    """Flattened trees: node ``i`` of a tree has children ``2 i + 1`` and ``2 i + 2``."""
    start: float
    feature: np.ndarray         # (trees, inner nodes)
    edge: np.ndarray            # (trees, inner nodes): go right above
    leaf: np.ndarray            # (trees, leaves)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, at, inner = np.full(len(x), self.start), np.arange(len(x)), 2**DEPTH - 1
        for feature, edge, leaf in zip(self.feature, self.edge, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[at, feature[node]] > edge[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the labels ``y`` (0 or 1)."""
    inner = 2**DEPTH - 1
    if not len(y):
        return Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.astype(np.float32)      # (features, BINS - 1)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])  # x > e[b - 1]
    share = np.clip(y.mean(), 0.01, 0.99)
    start = float(np.log(share / (1 - share)))
    features, cuts, leaves, total = [], [], [], np.full(len(y), start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            place = (node - first) * BINS
            best, pick = np.full(width, 1e-9), np.zeros((width, 2), np.int64) - 1
            for f, b in enumerate(binned):
                sums = [np.bincount(place + b, v, width * BINS).reshape(width, BINS).cumsum(axis=1) for v in (g, h)]
                left = [s[:, :-1] for s in sums]
                right = [s[:, -1:] - s[:, :-1] for s in sums]
                whole = sums[0][:, -1:] ** 2 / (sums[1][:, -1:] + RIDGE)
                gain = sum(a**2 / (c + RIDGE) for a, c in (left, right)) - whole
                gain[(left[1] < LEAST_WEIGHT) | (right[1] < LEAST_WEIGHT)] = 0
                at = gain.argmax(axis=1)
                value = gain[np.arange(width), at]
                better = value > best
                best[better], pick[better] = value[better], np.stack([np.full(width, f), at], axis=1)[better]
            for k, (f, b) in enumerate(pick.tolist()):
                if f >= 0:                              # an unsplit node sends all rows left
                    feature[first + k], cut[first + k] = f, edges[f, b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = np.bincount(node - inner, g, inner + 1) / (np.bincount(node - inner, h, inner + 1) + RIDGE) * RATE
        total += leaf[node - inner]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(start, np.array(features), np.array(cuts), np.array(leaves))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = TRAIN_ROWS) -> Trees:
    """Trees from the labelled rows: ``labels`` has ``key`` and ``label``."""
    known = labels.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{label}`").alias("label")).where(
        "doc_id is not null and label is not null").groupBy("doc_id").agg(F.round(F.avg("label")).alias("label"))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000)) < 1_000_000 * min(1.0, rows / max(n, 1)))
    texts = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    @F.arrow_udf("array<float>")
    def measure(column: pa.Array) -> pa.Array:
        return pa.array(list(statistics(column)), pa.list_(pa.float32()))

    # about ``rows`` ids, so small enough for every task
    sample = (texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", measure("text").alias("x")).toArrow())
    order = np.lexsort((sample.column("label").to_numpy(), sample.column("doc_id").to_numpy()))
    x = sample.column("x").combine_chunks().flatten().to_numpy().reshape(len(sample), len(STATISTICS))[order]
    return grow(x, sample.column("label").to_numpy()[order])


def scored(docs: DataFrame, trees: Trees, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1, higher: label 1 likelier) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)      # a few thousand nodes

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(statistics(column)), pa.float64())

    return docs.withColumn(into, score(F.col(f"`{text}`")))


def held_out(key: Column, fold: int = 0, folds: int = 5) -> Column:
    """Rows that teach nothing: a checksum of the id names their fold."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))
