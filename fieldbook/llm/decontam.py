"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items form one automaton; the words of every
document stream through it, and the longest match that ends at each word says
which words lie inside an occurring window (``window`` consecutive item words,
or a whole shorter item).  Stretches whose short word runs occur in no item
cannot hold a window and are skipped beforehand by one vectorised look-up, so
the automaton walks only through possible matches.

The items of one automaton are bounded by ``AUTOMATON_WORDS``: longer items
are cut into overlapping pieces (no window is lost), larger item sets are
dealt to several automata, and the documents pass through one after the other.

Defined cases: NULL and wordless texts have no words and are never hit; items
without words have no window; repeated items count once; an item with a NULL
id hits words but is not listed; an empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.exchange import lookup
from fieldbook.llm.frames import columns
from fieldbook.llm.words import ALNUM_WORDS, LOWER_ASCII, WordSlice, row_slices, text_buffers, windows
from fieldbook.session import materialize

WINDOW = 13
COVERAGE_PERCENT = 5            # a document is contaminated from this share of hit words on
AUTOMATON_WORDS = 100_000       # bound of one automaton, and so of what is sent to the tasks
PIECE_WORDS = 5_000
RUN = 4                         # words of the runs that are looked up beforehand


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int) -> int:
        """The state of ``p``'s longest string plus ``word`` (a copy of the
        target when that also holds longer strings)."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word)
            last = new

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """Longest match after one more word: (state, length)."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], matched + 1
        return 0, 0


class Matcher:
    """Automaton, vocabulary and windows of one bounded set of items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        texts = sorted({(i, tuple(w)) for i, w in items if w}, key=lambda x: (x[1], x[0] is None, x[0] or ""))
        self.window = window
        self.names = sorted({i for i, _ in texts if i is not None})
        number = {name: k for k, name in enumerate(self.names)}
        vocabulary = sorted({w for _, words in texts for w in words})
        ids = {w: k for k, w in enumerate(vocabulary)}
        hashes = _hash_words(vocabulary)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.least = min((min(len(w), window) for _, w in texts), default=window)
        self.run = min(RUN, self.least)
        runs = [windows(hashes[[ids[w] for w in words]], self.run) for _, words in texts]
        self.runs = np.unique(np.concatenate(runs or [np.zeros(0, np.uint64)]))
        self.automaton = auto = SuffixAutomaton()
        coded = [(None if i is None else number[i], [ids[w] for w in words]) for i, words in texts]
        for _, words in coded:
            auto.add(words)
        by_length = sorted(range(len(auto.link)), key=auto.length.__getitem__)
        self.full = [0] * len(auto.link)            # the state of a match's last ``window`` words
        for s in by_length:
            if auto.length[s] >= window:
                self.full[s] = s if auto.length[auto.link[s]] < window else self.full[auto.link[s]]
        self.whole: dict[int, set] = {}
        ends: dict[int, list[tuple[int, int | None]]] = {}
        for item, words in coded:
            state, matched = 0, 0
            for word in words:
                state, matched = auto.step(state, matched, word)
                if matched >= window:
                    self.whole.setdefault(self.full[state], set()).add(item)
            if len(words) < window:
                ends.setdefault(state, []).append((len(words), item))
        self.short: list[tuple] = [()] * len(auto.link)  # shorter items that end here
        for s in by_length[1:]:
            self.short[s] = (*ends.get(s, ()), *self.short[auto.link[s]])

    def spans(self, coded: np.ndarray, begin: int, end: int, found: set) -> list[list[int]]:
        """Hit word ranges within ``coded[begin:end]``; ``found`` gets the items."""
        auto, out, state, matched = self.automaton, [], 0, 0
        for at in range(begin, end):
            word = int(coded[at])
            state, matched = auto.step(state, matched, word) if word >= 0 else (0, 0)
            reach = 0
            if matched >= self.window:
                reach = self.window
                found |= self.whole[self.full[state]]
            for n, item in self.short[state]:
                if n <= matched:
                    reach = max(reach, n)
                    found.add(item)
            if reach:
                while out and out[-1][0] >= at + 1 - reach:
                    out.pop()
                if out and out[-1][1] >= at + 1 - reach:
                    out[-1][1] = at + 1
                else:
                    out.append([at + 1 - reach, at + 1])
        return out


def _hash_words(words: list[bytes]) -> np.ndarray:
    offsets = np.cumsum([0] + [len(w) + 1 for w in words])
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    return WordSlice(offsets, data, 0, len(words), ALNUM_WORDS, LOWER_ASCII).hashes if words else np.zeros(0, np.uint64)


def _pieces(window: int):
    """Items as bounded pieces; neighbours share ``window - 1`` words."""
    def cut(batches):
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            names, out = batch.column("item").to_pylist(), []
            for row, name in enumerate(names):
                w = WordSlice(offsets, data, row, row + 1, ALNUM_WORDS, LOWER_ASCII)
                for at in range(0, max(len(w.starts) - window + 1, 1), PIECE_WORDS - window + 1):
                    last = min(at + PIECE_WORDS, len(w.starts))
                    out.append((name, b" ".join(w.word(i) for i in range(at, last)).decode(), last - at))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()),
                                              pa.array([o[2] for o in out], pa.int64())], names=["item", "text", "n"])
    return cut


_HITS_TYPE = "struct<n_words: bigint, spans: array<array<bigint>>, items: array<string>>"
_HIT_TYPE = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])


def _scan(matcher: Matcher, texts: pa.Array, spans: list, items: list) -> pa.Array:
    """Hit ranges and items of every text, added to those found before."""
    offsets, data = text_buffers(texts)
    n_words: list[int] = []
    for lo, hi in row_slices(offsets):
        w = WordSlice(offsets, data, lo, hi, ALNUM_WORDS, LOWER_ASCII)
        at, known = lookup(matcher.hashes, w.hashes)
        coded = np.where(known, matcher.ids[at], -1) if len(matcher.ids) else np.full(len(at), -1)
        hit = lookup(matcher.runs, windows(w.hashes, matcher.run))[1]
        n_words += w.counts().tolist()
        edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
        for begin, end in edge.reshape(-1, 2).tolist():     # stretches of known word runs
            if end - begin < matcher.least - matcher.run + 1:
                continue
            row, last = (int(np.searchsorted(w.first, x, "right")) - 1 for x in (begin, end + matcher.run - 2))
            for r in range(row, last + 1):                  # a stretch may reach over the end of a text
                a, b = int(w.first[r]), int(w.first[r + 1])
                found: set = set()
                got = matcher.spans(coded, max(a, begin), min(b, end + matcher.run - 1), found)
                if got:
                    spans[lo + r] = _merged(spans[lo + r] + [[s - a, e - a] for s, e in got])
                    items[lo + r] = sorted({*items[lo + r], *(matcher.names[i] for i in found if i is not None)})
    rows = [{"n_words": n, "spans": s, "items": i} for n, s, i in zip(n_words, spans, items, strict=True)]
    return pa.array(rows, _HIT_TYPE)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def flagged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = COVERAGE_PERCENT,
            text: str = "text", item: str = "item_id", item_text: str = "text", into: str = "contamination") -> DataFrame:
    """``docs`` with the struct column ``into``: ``n_words``, ``spans`` (hit
    word ranges), ``n_hit``, ``items`` (ids with occurring windows, as sorted
    strings) and ``contaminated`` (hit words reach ``percent`` of all)."""
    spark = docs.sparkSession
    pieces = columns(benchmark, [item, item_text]).toDF("item", "text").withColumn("item", F.col("item").cast("string"))
    pieces = materialize(pieces.mapInArrow(_pieces(window), "item string, text string, n long"), "items")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = total // AUTOMATON_WORDS + 1
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("text", "item"), F.lit(shards)))
    found = None
    for shard in range(shards):
        own = pieces.where(F.col("shard") == shard).select("item", "text").collect()   # bounded by AUTOMATON_WORDS
        matcher = spark.sparkContext.broadcast(Matcher([(r.item, r.text.encode().split()) for r in own], window))
        if found is None:
            docs = docs.withColumn(into, _first_scan(matcher)(F.col(f"`{text}`")))
        else:                                      # one automaton at a time in a task's memory
            docs = materialize(docs, "contamination")
            docs = docs.withColumn(into, _next_scan(matcher)(F.col(f"`{text}`"), F.col(f"`{into}`.spans"), F.col(f"`{into}`.items")))
        found = True
    c = F.col(f"`{into}`")
    hit = F.aggregate(c["spans"], F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return docs.withColumn(into, F.struct(c["n_words"].alias("n_words"), c["spans"].alias("spans"), hit.alias("n_hit"),
                                          c["items"].alias("items"),
                                          ((hit > 0) & (100 * hit >= percent * c["n_words"])).alias("contaminated")))


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its id and the fields of ``flagged``."""
    docs = columns(docs, [key, text]).toDF("doc_id", "text")
    return flagged(docs, benchmark, **options).select("doc_id", "contamination.*")


def _first_scan(matcher):
    @F.arrow_udf(_HITS_TYPE)
    def scan(texts: pa.Array) -> pa.Array:
        return _scan(matcher.value, texts, [[] for _ in range(len(texts))], [[] for _ in range(len(texts))])
    return scan.asNondeterministic()      # a filter on the result must not compute it twice


def _next_scan(matcher):
    @F.arrow_udf(_HITS_TYPE)
    def scan(texts: pa.Array, spans: pa.Array, items: pa.Array) -> pa.Array:
        return _scan(matcher.value, texts, spans.to_pylist(), items.to_pylist())
    return scan.asNondeterministic()      # a filter on the result must not compute it twice
