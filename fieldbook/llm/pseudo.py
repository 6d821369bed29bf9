"""Language-model scores by masked pseudo-likelihood.

A bidirectional window network predicts every word from the ``REACH`` words on
both sides; the summed conditional log-probabilities of a text are its score.

* *Vocabulary*: every word of the whole corpus, with its count.  The network
  predicts one of ``CLASSES`` classes: the ``WORDS`` most frequent words have
  one of their own, all others are dealt to ``BUCKETS`` hashed ones.  A word
  of these has, besides, its share of its class in the whole corpus, so the
  probability summed is always the word's own: P(class | context) x
  P(word | class).  The counts grow with the distinct words; they lie in
  ranges of hashes, and each chunk of texts asks the ranges for its words.
* *Training* (numpy): every position of every text is predicted in one of the
  ``PASSES`` passes, the one that a hash of word, place and text names, so all
  of the corpus is a target once.  Each input partition
  trains its own copy from the common weights; the copies are averaged by
  their number of predictions in a tree of groups of ``FAN_IN``, so no task
  and not the driver holds more than that many.
* *Scoring*: all positions of all texts, in strips of bounded size.

The network's width (``CLASSES``, ``HIDDEN``) is fixed: among the words of one
hashed class the context does not decide, only their counts do.

The weights depend on how the input is partitioned (as any averaged training
does), not on the order of tasks.  Defined cases: NULL and wordless texts have
no words, a sum and a mean of 0; words next to the ends of a text see an edge
sign there; on an empty corpus nothing is trained; a word that the corpus of
``fit`` does not have counts as half an occurrence in its class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from fieldbook.llm.exchange import PACKED, Layout, chunked, lookup, pack, plan_layout, unpack
from fieldbook.llm.words import ALNUM_WORDS, LOWER_ASCII, WordSlice, mix, row_slices, text_buffers
from fieldbook.session import materialize

REACH = 2
WORDS, BUCKETS = 448, 64
CLASSES = WORDS + BUCKETS
EDGE = CLASSES                  # the sign beyond either end of a text
HIDDEN = 32
PASSES = 2
BATCH, STEP = 1024, 0.05
STRIP = 256             # positions gone through at once: their values stay in the processor's cache
SLICE = 1 << 17         # bytes of text split into words at once, for the same reason
FAN_IN = 16
COUNTED = 1 << 20       # words of a partition counted at once
UNSEEN = 0.5            # occurrences of a word that was not counted


def _slices(texts):
    offsets, data = text_buffers(texts)
    for lo, hi in row_slices(offsets, SLICE):
        yield WordSlice(offsets, data, lo, hi, ALNUM_WORDS, LOWER_ASCII)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    hashes = np.sort(hashes)
    return hashes[np.r_[True, hashes[1:] != hashes[:-1]]] if len(hashes) else hashes


class Places:
    """Where hashes lie among ``keys`` (sorted hashes): their leading bits name
    a short run of keys, which is gone through."""

    def __init__(self, keys: np.ndarray):
        bits = min(20, len(keys).bit_length() + 2)
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.start = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.most = int(np.diff(self.start, append=len(keys)).max())

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``exchange.lookup``."""
        if self.most > 64 or not len(self.keys):            # not spread as hashes are
            return lookup(self.keys, wanted)
        at = self.start.take((wanted >> self.shift).astype(np.int64))
        for _ in range(self.most - 1):
            at += self.keys.take(at, mode="clip") < wanted
        at[at >= len(self.keys)] = 0
        return at, self.keys.take(at) == wanted


def _packed(layout: Layout, chunk: int, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    rows = [(b, chunk, pack(words[r]), counts[r].tobytes()) for b, r in layout.cut(words)]
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      names=["bucket", "chunk", "payload", "extra"])


def _count_words(layout: Layout):
    """Distinct words and their occurrences, by ranges of hashes."""
    def count(batches):
        found, n = [], 0
        for batch in batches:
            for w in _slices(batch.column("text")):
                found.append(w.hashes)
                n += len(w.hashes)
                if n >= COUNTED:
                    yield _packed(layout, 0, *np.unique(np.concatenate(found), return_counts=True))
                    found, n = [], 0
        if n:
            yield _packed(layout, 0, *np.unique(np.concatenate(found), return_counts=True))
    return count


def _sum_counts(table: pa.Table) -> pa.Table:
    """One range: its words with their occurrences in the whole corpus, those
    that may be among the most frequent, and the sums by hashed class."""
    words = np.concatenate([unpack(p.as_py()) for p in table.column("payload")])
    counts = np.concatenate([np.frombuffer(e.as_py(), np.int64) for e in table.column("extra")])
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    begin = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    words, counts = words[begin], np.add.reduceat(counts, begin)
    top = np.lexsort((words.view(np.int64), -counts))[:WORDS]
    sums = np.zeros(BUCKETS, np.int64)
    np.add.at(sums, (words % np.uint64(BUCKETS)).astype(np.int64), counts)
    longs = pa.list_(pa.int64())
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "payload": [pack(words)], "extra": [counts.tobytes()],
                     "top": pa.array([words[top].view(np.int64).tolist()], longs), "n": pa.array([counts[top].tolist()], longs),
                     "sums": pa.array([sums.tolist()], longs)})


def vocabulary(docs: DataFrame) -> Coder:
    """All words of the corpus with their counts (a table, by ranges of
    hashes) and the ``WORDS`` most frequent."""
    layout = plan_layout(docs)
    layout = Layout(layout.chunks, layout.buckets, 64)
    counts = docs.select("text").mapInArrow(_count_words(layout), PACKED).groupBy("bucket").applyInArrow(
        _sum_counts, "bucket int, payload binary, extra binary, top array<long>, n array<long>, sums array<long>")
    counts = materialize(counts, "word-counts")
    top = (counts.select(F.explode(F.arrays_zip("top", "n")).alias("w")).select(F.col("w.top").alias("word"), "w.n")
           .orderBy(F.desc("n"), "word").limit(WORDS).collect())
    words = np.array([r.word for r in top], np.int64).view(np.uint64)
    shared = np.zeros(BUCKETS, np.int64)
    for r in counts.select(F.posexplode("sums").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        shared[r.k] = r.n
    np.subtract.at(shared, (words % np.uint64(BUCKETS)).astype(np.int64), np.array([r.n for r in top], np.int64))
    return Coder(words, shared, layout, counts.select("bucket", "payload", "extra"))


class Coder:
    """Classes of words: ``words`` have their own; ``shared`` holds the
    occurrences of all others by hashed class.  The table of all counts stays
    with the driver's copy."""

    def __init__(self, words: np.ndarray, shared: np.ndarray, layout: Layout, counts: DataFrame | None = None):
        self.order = np.argsort(words)
        self.words = words[self.order]
        self.places = Places(self.words)
        self.shared, self.layout, self.counts = shared, layout, counts

    def __getstate__(self):
        return {**self.__dict__, "counts": None}

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        at, known = self.places.find(hashes)
        rare = WORDS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
        return np.where(known, self.order[at], rare) if len(self.words) else rare

    def within(self, hashes: np.ndarray, classes: np.ndarray, words: Places, counts: np.ndarray) -> np.ndarray:
        """Log-probabilities of words within their classes, from the counts
        of ``words`` in the whole corpus."""
        out, rare = np.zeros(len(hashes)), classes >= WORDS
        at, known = words.find(hashes[rare])
        n = np.where(known, counts[at], 0) if len(counts) else np.zeros(len(at))
        out[rare] = np.log(np.where(n > 0, n, UNSEEN)) - np.log(self.shared + UNSEEN)[classes[rare] - WORDS]
        return out


def contexts(classes: np.ndarray, first: np.ndarray, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
    """(words, 2 * REACH) classes around each chosen word within its text."""
    n, texts = len(classes), len(first) - 1
    place = np.arange(n) + np.repeat(np.arange(1, texts + 1) * REACH, np.diff(first))     # edge signs between texts
    padded = np.full(n + (texts + 1) * REACH, EDGE, np.int64)
    padded[place] = classes
    place = place[chosen]
    out = np.empty((2 * REACH, len(place)), np.int64).T           # what stands at one distance lies together
    for k, shift in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
        out[:, k] = padded[place + shift]
    return out


def _add_rows(table: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to that row of the table which its id names; two values
    are added at once, as the parts of a complex number."""
    width = table.shape[1] // 2
    places = np.arange(len(table) * width).reshape(-1, width).take(ids, axis=0)
    np.add.at(table.reshape(-1).view(np.complex64), places.reshape(-1), rows.reshape(-1).view(np.complex64))


class Network:
    """Context tables, one hidden layer, a softmax over the classes."""

    SHAPES = ((2 * REACH, CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,))

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            rng = np.random.Generator(np.random.PCG64(7))
            flat = np.concatenate([(rng.standard_normal(int(np.prod(s))) * (0.1 if len(s) > 1 else 0.0)) for s in self.SHAPES])
        self.flat = np.array(flat, np.float32)
        cuts = np.cumsum([int(np.prod(s)) for s in self.SHAPES])[:-1]
        self.tables, self.bias, self.out, self.base = (
            part.reshape(s) for part, s in zip(np.split(self.flat, cuts), self.SHAPES, strict=True))
        # the output weights with their base as last row, and the logits of a strip, used again by each
        self.full = self.flat[-(HIDDEN + 1) * CLASSES:].reshape(HIDDEN + 1, CLASSES)
        self.small, self.work, self.grad, self.step = False, None, None, None

    def _bound(self) -> None:
        """Hidden values lie in [-1, 1]: with small enough weights no sum of
        exponentials can overflow, and the greatest logit need not be taken off."""
        self.small = bool((np.abs(self.out).sum(axis=0) + np.abs(self.base)).max() < 70)

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        """Hidden values of a batch, a 1 after them."""
        total = self.tables[0].take(context[:, 0], axis=0)
        total += self.bias
        for k in range(1, 2 * REACH):
            total += self.tables[k].take(context[:, k], axis=0)
        hidden = np.ones((len(total), HIDDEN + 1), np.float32)
        hidden[:, :HIDDEN] = np.tanh(total, out=total)
        return hidden

    def _logits(self, hidden: np.ndarray) -> np.ndarray:
        """Logits of a strip at most; they hold until the next call."""
        if self.work is None:
            self.work = np.empty((STRIP, CLASSES), np.float32)
        logits = np.matmul(hidden, self.full, out=self.work[:len(hidden)])
        if not self.small:
            logits -= logits.max(axis=1, keepdims=True)
        return logits

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        own, total = np.empty(len(target), np.float32), np.empty(len(target), np.float32)
        ones, rows = np.ones(CLASSES, np.float32), np.arange(STRIP) * CLASSES
        self._bound()
        for start in range(0, len(target), BATCH):
            hidden = self._hidden(context[start:start + BATCH])
            for at in range(0, len(hidden), STRIP):
                logits = self._logits(hidden[at:at + STRIP])
                part = slice(start + at, start + at + len(logits))
                own[part] = logits.reshape(-1).take(rows[:len(logits)] + target[part])
                np.matmul(np.exp(logits, out=logits), ones, out=total[part])
        return own.astype(np.float64) - np.log(total, dtype=np.float64)

    def train(self, context: np.ndarray, target: np.ndarray, past: np.ndarray) -> None:
        """One adaptive gradient step; ``past`` sums the squared gradients.

        The batch goes through in strips: the exponentials are not divided by
        their sums, the few values multiplied with them are."""
        if self.grad is None:
            self.grad, self.step = Network(np.zeros_like(self.flat)), np.empty_like(self.flat)
        grad, step, n = self.grad, self.step, len(target)
        grad.flat[:] = 0
        ones, rows = np.ones(CLASSES, np.float32), np.arange(STRIP) * CLASSES
        hidden, back, share = self._hidden(context), np.empty((n, HIDDEN), np.float32), np.empty((n, 1), np.float32)
        values, change = np.ascontiguousarray(hidden[:, :HIDDEN]), np.zeros((CLASSES, HIDDEN), np.float32)
        self._bound()
        for at in range(0, n, STRIP):
            part = slice(at, at + STRIP)
            p = self._logits(hidden[part])
            total = np.exp(p, out=p) @ ones
            p.reshape(-1)[rows[:len(p)] + target[part]] -= total
            share[part, 0] = 1 / (total * np.float32(n))
            np.matmul(p, self.out.T, out=back[part])
            change += p.T @ (values[part] * share[part])
            grad.base += share[part, 0] @ p
        grad.out[:] = change.T
        back *= share
        np.square(values, out=values)
        np.subtract(1, values, out=values)
        back *= values
        grad.bias[:] = back.sum(axis=0)
        for k in range(2 * REACH):
            _add_rows(grad.tables[k], context[:, k], back)
        np.square(grad.flat, out=step)
        past += step
        np.sqrt(past, out=step)
        step += np.float32(1e-6)
        np.divide(grad.flat, step, out=step)
        step *= np.float32(STEP)
        self.flat -= step


def turns(w: WordSlice) -> np.ndarray:
    """The pass in which each position is predicted; it differs between texts
    that have the same word at the same place."""
    place = np.arange(len(w.hashes)) - np.repeat(w.first[:-1], w.counts())
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hashes, dtype=np.uint64)])
    text = np.repeat(mix(total[w.first[1:]] - total[w.first[:-1]]), w.counts())
    return (mix(w.hashes ^ text ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(PASSES)).astype(np.int64)


def _train(shared, coder, turn: int):
    """Weights trained on one input partition: (part, n, weights)."""
    def local(batches):
        net, past, n = Network(shared.value), np.zeros(len(shared.value), np.float32), 0
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def steps(least: int):
            nonlocal waiting, n
            context, target = (np.concatenate(x) for x in zip(*waiting, strict=True))
            at = 0
            while len(target) - at >= least:
                net.train(context[at:at + BATCH], target[at:at + BATCH], past)
                at = min(len(target), at + BATCH)
                if at == len(target):
                    break
            n += at
            waiting = [(context[at:], target[at:])] if at < len(target) else []

        for batch in batches:
            for w in _slices(batch.column("text")):
                classes = coder.value.classes(w.hashes)
                chosen = turns(w) == turn
                if chosen.any():
                    waiting.append((contexts(classes, w.first, chosen), classes[chosen]))
                if sum(len(t) for _, t in waiting) >= BATCH:
                    steps(BATCH)
        if waiting:
            steps(1)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()),
                                              pa.array([net.flat.tobytes()], pa.binary())], names=["part", "n", "weights"])
    return local


def _average(table: pa.Table) -> pa.Table:
    n = table.column("n").to_numpy()
    total = sum(np.frombuffer(w.as_py(), np.float32).astype(np.float64) * k for w, k in zip(table.column("weights"), n, strict=True))
    return pa.table({"part": [min(table.column("part").to_pylist())], "n": [int(n.sum())],
                     "weights": [(total / n.sum()).astype(np.float32).tobytes()]})


def _averaged(copies: DataFrame) -> np.ndarray | None:
    """Tree of group averages; the last ``FAN_IN`` at most come to the driver."""
    copies = materialize(copies, "weights")
    while (n := copies.count()) > FAN_IN:
        groups = -(-n // FAN_IN)
        copies = materialize(copies.withColumn("node", F.pmod("part", F.lit(groups))).groupBy("node").applyInArrow(
            lambda t: _average(t.drop_columns(["node"])), "part long, n long, weights binary"), "weights")
    rest = copies.orderBy("part").toArrow()
    return np.frombuffer(_average(rest).column("weights")[0].as_py(), np.float32) if len(rest) else None


def fit(docs: DataFrame) -> tuple[Coder, Network]:
    """Vocabulary and network of a corpus (column ``text``)."""
    context = docs.sparkSession.sparkContext
    coder, weights = vocabulary(docs), Network().flat
    known = context.broadcast(coder)
    for turn in range(PASSES):
        shared = context.broadcast(weights)                     # fixed size
        copies = docs.select("text").mapInArrow(_train(shared, known, turn), "part long, n long, weights binary")
        averaged = _averaged(copies)
        weights = weights if averaged is None else averaged
    return coder, Network(weights)


_NONE = np.zeros(0, np.uint64), np.zeros(0, np.int64)


def _coded(coder: Coder, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes, classes and first words of the texts, by slice."""
    return [(w.hashes, coder.classes(w.hashes), w.first) for w in _slices(texts)]


def _rare(coded: list) -> np.ndarray:
    """Sorted distinct hashes of the words without a class of their own."""
    return _distinct(np.concatenate([_NONE[0], *[hashes[classes >= WORDS] for hashes, classes, _ in coded]]))


def log_likelihoods(coder: Coder, net: Network, texts: pa.Array, words: np.ndarray = _NONE[0],
                    counts: np.ndarray = _NONE[1]) -> pa.Array:
    """Words and summed conditional log-probabilities of every text;
    ``counts`` are those of the ``words`` (sorted hashes) in the corpus."""
    return _log_likelihoods(coder, net, _coded(coder, texts), words, counts)


def _log_likelihoods(coder: Coder, net: Network, coded: list, words: np.ndarray, counts: np.ndarray) -> pa.Array:
    n_words, totals, places = [np.zeros(0, np.int64)], [np.zeros(0)], Places(words)
    for hashes, classes, first in coded:
        each = net.log_probabilities(contexts(classes, first), classes) + coder.within(hashes, classes, places, counts)
        n_words.append(np.diff(first))
        totals.append(np.diff(np.r_[0.0, np.cumsum(each)][first]))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(n_words), pa.int64()), pa.array(np.concatenate(totals), pa.float64())],
                                      names=["n_words", "total"])


def _texts(table: pa.Table, text: str) -> pa.Array:
    return pa.chunked_array([c.field(text) for c in table.column("doc").chunks], table.schema.field("doc").type.field(text).type)


def _ask(shared, text: str):
    """The rare words of a chunk, to the ranges that have their counts."""
    def ask(table: pa.Table) -> pa.Table:
        coder, _ = shared.value
        words = _rare(_coded(coder, _texts(table, text)))
        return pa.Table.from_batches([_packed(coder.layout, table.column("chunk")[0].as_py(), words, _NONE[1])])
    return ask


def _answer(asked: pa.Table, counted: pa.Table) -> pa.Table:
    """Each chunk's words of one range -> their counts, 0 if not counted."""
    words = np.concatenate([_NONE[0], *[unpack(p.as_py()) for p in counted.column("payload")]])
    counts = np.concatenate([_NONE[1], *[np.frombuffer(e.as_py(), np.int64) for e in counted.column("extra")]])
    answers = []
    for p in asked.column("payload"):
        at, known = lookup(words, unpack(p.as_py()))
        answers.append((np.where(known, counts[at], 0) if len(words) else np.zeros(len(at), np.int64)).tobytes())
    return asked.select(["bucket", "chunk"]).append_column("payload", pa.array([b""] * len(answers), pa.binary())).append_column(
        "extra", pa.array(answers, pa.binary()))


def scored(docs: DataFrame, coder: Coder, net: Network, text: str = "text", into: str = "pseudo") -> DataFrame:
    """``docs`` with the struct column ``into``: ``n_words`` and ``total``."""
    shared = docs.sparkSession.sparkContext.broadcast((coder, net.flat))
    # rows are numbered and written once: chunks hold rows of any id, equal ones too
    rows = materialize(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "pseudo-texts")
    chunks = chunked(rows, plan_layout(rows, f"doc.`{text}`"), "row")
    answers = (chunks.groupBy("chunk").applyInArrow(_ask(shared, text), PACKED).groupBy("bucket")
               .cogroup(coder.counts.groupBy("bucket")).applyInArrow(_answer, PACKED))

    def score(table: pa.Table, answered: pa.Table) -> pa.Table:
        coder, flat = shared.value
        coded = _coded(coder, _texts(table, text))
        counts = [np.frombuffer(e.as_py(), np.int64) for e in answered.sort_by("bucket").column("extra")]
        found = _log_likelihoods(coder, Network(flat), coded, _rare(coded), np.concatenate([_NONE[1], *counts]))
        return pa.table({"doc": table.column("doc"), "found": found})

    shape = StructType([rows.schema["doc"], StructField("found", StructType([StructField("n_words", LongType()),
                                                                             StructField("total", DoubleType())]))])
    out = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, shape)
    return out.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c != into], F.col("found").alias(into))
