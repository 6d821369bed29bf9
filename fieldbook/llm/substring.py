"""Substring deduplication with fixed-block anchors.

A word of a document goes when a window of ``window`` consecutive words
covers it that also starts in a document of a smaller id.

1. *Anchors.*  Every document's non-overlapping blocks of ``window // 2``
   words are the reference index; every rolling window of that length probes
   it.  Any window of ``window`` words holds a whole block, so no repeat is
   missed.  Probes travel as packed distinct hashes per chunk (``exchange``).
2. *Extension.*  Only windows around an anchor that another place also has
   are compared as a whole: per chunk the least and greatest id of each
   window, per hash the least id of all.
3. *Removal.*  Windows with a smaller owner are merged to maximal repeats and
   their words removed.

A passage in a third of all documents costs one entry per chunk.  Defined
cases: NULL and wordless texts have no words and keep nothing; documents of
fewer words than ``window`` are kept whole; repeated rows with one id do not
remove each other; a row with a NULL id owns no window, but loses those that
any other row owns.  Windows are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldbook.llm.exchange import PACKED, Layout, chunked, lookup, pack, plan_layout, unpack
from fieldbook.llm.frames import columns
from fieldbook.llm.words import SAME_BYTES, SPACE_WORDS, WordSlice, row_slices, text_buffers, windows

WINDOW = 50
_NO_ID = np.iinfo(np.int64).max
_ROWS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("payload", pa.binary()), ("extra", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                  ("spans", pa.list_(pa.list_(pa.int64())))])


def _texts(table: pa.Table):
    """(rows of the slice, its words) over a whole chunk."""
    offsets, data = text_buffers(table.column("text"))
    for lo, hi in row_slices(offsets):
        yield range(lo, hi), WordSlice(offsets, data, lo, hi, SPACE_WORDS, SAME_BYTES)


def _starts(words: WordSlice, window: int):
    """(row in the slice, first word, number of windows) of texts long enough."""
    counts = words.counts()
    for row in np.flatnonzero(counts >= window).tolist():
        yield row, int(words.first[row]), int(counts[row]) - window + 1


def _packed(layout: Layout, chunk: int, values: np.ndarray, extra: np.ndarray) -> pa.Table:
    rows = [(b, pack(values[r]), extra[r].tobytes()) for b, r in layout.cut(values)]
    return pa.table([[r[0] for r in rows], [chunk] * len(rows), [r[1] for r in rows], [r[2] for r in rows]], schema=_ROWS)


def _probes(layout: Layout, window: int):
    block = window // 2

    def ask(table: pa.Table) -> pa.Table:
        rolling, index = [], []
        for _, words in _texts(table):
            runs = windows(words.hashes, block) >> layout.shift
            for _, a, n in _starts(words, window):
                own = runs[a:a + n + window - block]
                rolling.append(own)
                index.append(own[::block])
        none = [np.zeros(0, np.uint64)]
        values, counts = np.unique(np.concatenate(rolling or none), return_counts=True)
        flags = (counts > 1).astype(np.uint8) * 2
        flags[np.searchsorted(values, np.unique(np.concatenate(index or none)))] |= 1
        return _packed(layout, _chunk(table), values, flags)
    return ask


def _chunk(table: pa.Table) -> int:
    return table.column("chunk")[0].as_py() if len(table) else 0


def _anchors(table: pa.Table) -> pa.Table:
    """One bucket: the hashes that are a reference block somewhere and found
    at two places, told to each chunk that has them."""
    asked = [unpack(p.as_py()) for p in table.column("payload")]
    flags = np.concatenate([np.frombuffer(e.as_py(), np.uint8) for e in table.column("extra")])
    values, place = np.unique(np.concatenate(asked), return_inverse=True)
    indexed = np.bincount(place, flags & 1, len(values)) > 0
    twice = np.bincount(place, 1 + (flags >> 1), len(values)) > 1
    active, at, out = (indexed & twice)[place], 0, []
    for own in asked:
        out.append(pack(own[active[at:at + len(own)]]))
        at += len(own)
    return pa.table([table.column("bucket").combine_chunks(), table.column("chunk").combine_chunks(),
                     pa.array(out, pa.binary()), pa.array([b""] * len(out), pa.binary())], schema=_ROWS)


def _told(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(table.column("bucket").to_numpy())
    values = [unpack(table.column("payload")[int(i)].as_py()) for i in order]
    extra = [np.frombuffer(table.column("extra")[int(i)].as_py(), np.int64) for i in order]
    return (np.concatenate(values or [np.zeros(0, np.uint64)]), np.concatenate(extra or [np.zeros(0, np.int64)]))


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(_NO_ID).to_numpy().astype(np.int64)


def _candidates(layout: Layout, whole: Layout, window: int):
    block = window // 2

    def extend(docs: pa.Table, told: pa.Table) -> pa.Table:
        active, _ = _told(told)
        ids, hashes, owners = _ids(docs), [], []
        for rows, words in _texts(docs):
            runs, full = windows(words.hashes, block) >> layout.shift, windows(words.hashes, window)
            hit = lookup(active, runs)[1]
            for row, a, n in _starts(words, window):
                found = np.flatnonzero(hit[a:a + n + window - block])
                if not len(found):
                    continue
                edge = np.zeros(n + 1, np.int64)       # windows that hold the anchor as a whole
                np.add.at(edge, np.maximum(found - (window - block), 0), 1)
                np.add.at(edge, np.minimum(found + 1, n), -1)
                here = full[a:a + n][np.cumsum(edge[:-1]) > 0]
                hashes.append(here)
                owners.append(np.full(len(here), ids[rows[row]]))
        if not hashes:
            return _ROWS.empty_table()
        all_hashes, all_owners = np.concatenate(hashes), np.concatenate(owners)
        order = np.lexsort((all_owners, all_hashes))
        h, o = all_hashes[order], all_owners[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        last = np.r_[first[1:], len(h)] - 1
        return _packed(whole, _chunk(docs), h[first] >> whole.shift, np.stack([o[first], o[last]], axis=1))
    return extend


def _owners(table: pa.Table) -> pa.Table:
    """One bucket: each window's least id over all chunks, told to the chunks
    where a greater id has it too."""
    asked = [unpack(p.as_py()) for p in table.column("payload")]
    ids = np.concatenate([np.frombuffer(e.as_py(), np.int64).reshape(-1, 2) for e in table.column("extra")])
    values, place = np.unique(np.concatenate(asked), return_inverse=True)
    least = np.full(len(values), _NO_ID)
    np.minimum.at(least, place, ids[:, 0])
    owner = least[place]
    matters, at, out = owner < ids[:, 1], 0, []
    for own in asked:
        m = matters[at:at + len(own)]
        out.append((pack(own[m]), owner[at:at + len(own)][m].tobytes()))
        at += len(own)
    return pa.table([table.column("bucket").combine_chunks(), table.column("chunk").combine_chunks(),
                     pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], schema=_ROWS)


def _remove(whole: Layout, window: int):
    def apply(docs: pa.Table, told: pa.Table) -> pa.Table:
        repeated, owner = _told(told)
        ids, out = _ids(docs), []
        for rows, words in _texts(docs):
            full = windows(words.hashes, window) >> whole.shift
            at, known = lookup(repeated, full)
            spans: dict[int, np.ndarray] = {}
            if known.any():
                for row, a, n in _starts(words, window):
                    mine = np.flatnonzero(known[a:a + n])
                    mine = mine[owner[at[a + mine]] < ids[rows[row]]]
                    if len(mine):                       # runs of windows merge to maximal repeats
                        cut = np.flatnonzero(np.diff(mine) > window)
                        begin, end = mine[np.r_[0, cut + 1]], mine[np.r_[cut, len(mine) - 1]] + window
                        spans[row] = np.stack([begin, end], axis=1)
            for row in range(len(rows)):
                a, b = int(words.first[row]), int(words.first[row + 1])
                text = words.data[words.starts[a]:words.ends[b - 1]].tobytes().split() if b > a else []
                cuts = spans.get(row)
                if cuts is not None:
                    keep, at_word = [], 0
                    for begin, end in cuts.tolist():
                        keep += text[at_word:begin]
                        at_word = end
                    text = keep + text[at_word:]
                out.append((rows[row], b - a, b - a - len(text), b" ".join(text).decode(),
                            [] if cuts is None else cuts.tolist()))
        rows, n_words, n_removed, kept, spans = zip(*out) if out else ((),) * 5
        own = docs.column("doc_id").take(pa.array(rows, pa.int64()))
        return pa.table([own, n_words, n_removed, kept, spans], schema=_OUT)
    return apply


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept``
    (kept words joined by one space) and ``spans`` (removed word ranges,
    ``[start, end)``)."""
    docs = columns(docs, [key, text]).toDF("doc_id", "text")
    layout = plan_layout(docs)
    whole = Layout(layout.chunks, layout.buckets, 63)
    chunks = chunked(docs, layout, "doc_id")
    anchors = (chunks.groupBy("chunk").applyInArrow(_probes(layout, window), PACKED)
               .groupBy("bucket").applyInArrow(_anchors, PACKED))
    owners = (chunks.groupBy("chunk").cogroup(anchors.groupBy("chunk"))
              .applyInArrow(_candidates(layout, whole, window), PACKED)
              .groupBy("bucket").applyInArrow(_owners, PACKED))
    return chunks.groupBy("chunk").cogroup(owners.groupBy("chunk")).applyInArrow(
        _remove(whole, window), "doc_id long, n_words long, n_removed long, kept string, spans array<array<long>>")
