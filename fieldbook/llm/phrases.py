"""Phrase collocations by direct-address tiling.

Words, and then phrases level by level, carry integer ids ranked by frequency.
A text is a sequence of such ids, cut at punctuation and at what is too rare;
two neighbours of one level are a pair, and a pair is a phrase one word longer
(its two halves overlap in all but their ends).  Each level does the same:

1. *Count.*  A chunk of a few megabytes of text cuts the plane of its id pairs
   into square tiles.  Low ids are frequent, so tiles near the origin are dense
   and are counted by one ``bincount`` over the tile's cells; the rest are
   counted as sorted coordinates.  The chunk sends its distinct pairs with
   their counts, striped over buckets by their code, so a pair that every
   chunk has costs a bucket one entry per chunk.
2. *Threshold and rank.*  A bucket sums the chunks' counts (again by tile),
   keeps pairs found ``least`` times, ranks them by count and interleaves its
   ranks with those of the other buckets: ids are unique and rise as
   frequency falls.
3. *Recurse.*  Each chunk is told the ids of its frequent pairs and replaces
   its sequence by them; the next level pairs these.

A part of a frequent phrase is frequent, so no candidate is lost, and the
counts of a phrase's first and last words are those of its ancestors.  Scores
are exact (whole numbers of up to 38 digits).

Defined cases: NULL and empty texts have no words; a NULL language is ``und``;
repeated rows count as often as they stand; an empty table gives no phrase;
word order within a language decides nothing else; other columns are ignored.
Words and languages are told apart by 63-bit hashes; a level of 2**31 or more
frequent phrases is refused with an error.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.exchange import lookup, pack, unpack
from fieldbook.llm.words import LOWER_ASCII, SAME_BYTES, WordSlice, mix, row_slices, text_buffers
from fieldbook.session import materialize

LEAST, LONGEST, TOP = 100, 5, 2000
UNKNOWN = "und"
CHUNK_BYTES = 8 << 20
BUCKET_WORDS = 1 << 21
SIDE = 10                      # a tile is 2**SIDE ids square
DENSE = 1 << 2 * SIDE - 4      # entries from which a tile is counted cell by cell

# punctuation and line ends cut pieces, blanks and tabs cut words
BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
WORD_BYTES = ~BREAKS
WORD_BYTES[[9, 32]] = False

_CHUNK, _TOTAL, _WORD = -1, -2, -3             # rows of a level's table that are no exchange rows
_STATE = "bucket int, chunk long, codes binary, counts binary, seq binary, words binary, lang string, n long"
_TOLD = "chunk long, codes binary, ids binary, counts binary, first binary"
_STATE_ROWS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("codes", pa.binary()), ("counts", pa.binary()),
                         ("seq", pa.binary()), ("words", pa.binary()), ("lang", pa.string()), ("n", pa.int64())])
_TOLD_ROWS = pa.schema([("chunk", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()),
                        ("first", pa.binary())])


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in the narrowest type, byte plane by byte plane, compressed."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    planes = values.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T
    return kind.char.encode() + zstandard.compress(planes.tobytes(), 1)


def _loose(payload: bytes) -> np.ndarray:
    kind = np.dtype(payload[:1].decode())
    planes = np.frombuffer(zstandard.decompress(payload[1:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64)


def _codes(payload: bytes) -> np.ndarray:
    return unpack(zstandard.decompress(payload)).view(np.int64)


def _packed(codes: np.ndarray) -> bytes:
    return zstandard.compress(pack(codes.view(np.uint64)), 1)


def pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Tile row, tile column, and the cell within the tile."""
    low = (1 << SIDE) - 1
    return (left >> SIDE << 31 + SIDE) | (right >> SIDE << 2 * SIDE) | ((left & low) << SIDE) | (right & low)


def pair_ids(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = (1 << SIDE) - 1, (1 << 31 - SIDE) - 1
    return (codes >> 31 + SIDE << SIDE) | (codes >> SIDE & low), (codes >> 2 * SIDE & high) << SIDE | (codes & low)


def _sorted_counts(codes, weights):
    if weights is None:
        return np.unique(codes, return_counts=True)
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(weights, first) if len(first) else weights


def tile_counts(codes: np.ndarray, weights: np.ndarray | None = None, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pair codes and how often each stands (or the sum of its
    weights): tiles of ``dense`` entries cell by cell, the others sorted."""
    if len(codes) < dense:
        return _sorted_counts(codes, weights)
    tile = codes >> 2 * SIDE
    present, sizes = np.unique(tile, return_counts=True)
    parts, rest, cells = [], np.ones(len(codes), bool), (1 << 2 * SIDE) - 1
    for t in present[sizes >= dense]:
        here = tile == t
        rest &= ~here
        total = np.bincount(codes[here] & cells, None if weights is None else weights[here], cells + 1).astype(np.int64)
        cell = np.flatnonzero(total)
        parts.append((cell | (t << 2 * SIDE), total[cell]))
    parts.append(_sorted_counts(codes[rest], None if weights is None else weights[rest]))
    found, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(found, kind="stable")
    return found[order], counts[order]


def _striped(chunk: int, codes: np.ndarray, counts: np.ndarray, buckets: int) -> list[tuple]:
    """One row per bucket for the sorted ``codes`` of a chunk."""
    bucket = codes % buckets
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(b, chunk, _packed(codes[own]), _squeeze(counts[own]), None, None, None, None)
            for b in range(buckets) if len(own := order[edges[b]:edges[b + 1]])]


def _state(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _STATE_ROWS, strict=True)],
                                      schema=_STATE_ROWS)


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The byte ranges one after the other."""
    before = np.cumsum(sizes) - sizes
    return data[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class _Chunk:
    """Texts of one chunk as a sequence of hashes with gaps, and its distinct words."""

    def __init__(self):
        self.bytes, self.parts, self.langs = 0, [], {}

    def add(self, words: WordSlice, langs: list[str]) -> None:
        own = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int64)
        per_row, n = words.counts(), len(words.starts)
        hashes = _of_language(words.hashes, np.repeat(_salts(langs), per_row))
        cuts = np.cumsum(BREAKS[words.data]) if len(words.data) else np.zeros(0, np.int64)
        piece = cuts[words.starts] if n else np.zeros(0, np.int64)
        gap = np.ones(n, bool)                       # before each word that begins a piece or a text
        gap[1:] = piece[1:] != piece[:-1]
        gap[words.first[:-1][per_row > 0]] = True
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        sizes = (words.ends - words.starts)[at]
        row = np.repeat(np.arange(len(langs)), per_row)[at]
        self.bytes += len(words.data)
        self.parts.append((distinct, which, np.arange(n) + np.cumsum(gap), _gather(words.data, words.starts[at], sizes), sizes,
                           own[row], np.bincount(own, per_row, len(self.langs)).astype(np.int64)))

    def rows(self, chunk: int, buckets: int) -> list[tuple]:
        codes, at = np.unique(np.concatenate([p[0] for p in self.parts]), return_index=True)
        seq, counts = [], np.zeros(len(codes), np.int64)
        for distinct, which, place, *_ in self.parts:
            own = np.searchsorted(codes, distinct)
            part = np.zeros(int(place[-1]) + 1 if len(place) else 0, np.int64)
            part[place] = own[which] + 1
            seq.append(part)
            counts[own] += np.bincount(which, minlength=len(distinct))
        sizes = np.concatenate([p[4] for p in self.parts])
        data = np.concatenate([p[3] for p in self.parts])
        # words by falling frequency, so a sequence is mostly small numbers
        order = np.argsort(-counts, kind="stable")
        number = np.empty(len(codes) + 1, np.int64)
        number[0], number[order + 1] = 0, np.arange(1, len(codes) + 1)
        at = at[order]
        words = np.full(int(sizes[at].sum()) + len(at), ord(" "), np.uint8)
        words[np.arange(len(words) - len(at)) + np.repeat(np.arange(len(at)), sizes[at])] = _gather(
            data, (np.cumsum(sizes) - sizes)[at], sizes[at])
        totals = np.zeros(len(self.langs), np.int64)
        for p in self.parts:
            totals[:len(p[6])] += p[6]
        out = [(_TOTAL, None, None, None, None, None, lang, int(n)) for lang, n in zip(self.langs, totals, strict=True)]
        out.append((_CHUNK, chunk, None, _squeeze(np.concatenate([p[5] for p in self.parts])[at]),
                    _squeeze(number[np.concatenate(seq)]), zstandard.compress(words.tobytes(), 1), json.dumps(list(self.langs)), None))
        return out + _striped(chunk, codes, counts, buckets)


def _salts(langs: list[str]) -> np.ndarray:
    """64-bit hashes of the names of languages."""
    return np.array([xxhash.xxh64_intdigest(x) for x in langs], np.uint64)


def _of_language(hashes: np.ndarray, salts: np.ndarray) -> np.ndarray:
    return (mix(hashes + salts) >> np.uint64(1)).astype(np.int64)


def _read(buckets: int):
    def chunks(batches):
        part, number, held = TaskContext.get().partitionId(), 0, _Chunk()
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for lo, hi in row_slices(offsets):
                held.add(WordSlice(offsets, data, lo, hi, WORD_BYTES, LOWER_ASCII), langs[lo:hi])
                if held.bytes >= CHUNK_BYTES:
                    yield _state(held.rows(part << 32 | number, buckets))
                    number, held = number + 1, _Chunk()
        if held.parts:
            yield _state(held.rows(part << 32 | number, buckets))
    return chunks


def _frequent(buckets: int, least: int, level: int):
    """One bucket: what is found ``least`` times, ranked, and told to the chunks that have it."""
    def count(table: pa.Table) -> pa.Table:
        bucket, chunks = table.column("bucket")[0].as_py(), table.column("chunk").to_numpy()
        order = np.argsort(chunks)
        asked = [_codes(table.column("codes")[int(i)].as_py()) for i in order]
        weights = np.concatenate([_loose(table.column("counts")[int(i)].as_py()) for i in order])
        codes, sums = (_sorted_counts if level == 1 else tile_counts)(np.concatenate(asked), weights)
        codes, sums = codes[sums >= least], sums[sums >= least]
        ids = np.empty(len(codes), np.int64)
        ids[np.lexsort((codes, -sums))] = np.arange(len(codes)) * buckets + bucket
        if len(ids) and ids.max() >= 1 << 31:
            raise OverflowError("2**31 or more frequent phrases of one length")
        rows, seen = [(-1, _packed(codes), _squeeze(ids), _squeeze(sums), None)], np.zeros(len(codes), bool)
        for i, own in zip(order, asked, strict=True):
            at = lookup(codes, own)[0][lookup(codes, own)[1]]
            if len(at):
                rows.append((int(chunks[i]), _packed(codes[at]), _squeeze(ids[at]), _squeeze(sums[at]), _squeeze(~seen[at])))
                seen[at] = True
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _TOLD_ROWS, strict=True)], schema=_TOLD_ROWS)
    return count


def _answers(told: pa.Table) -> tuple[np.ndarray, ...]:
    """Codes (sorted), ids, counts and first flags of one chunk, from all buckets."""
    cols = [[f(x.as_py()) for x in told.column(c)] for c, f in (("codes", _codes), ("ids", _loose), ("counts", _loose), ("first", _loose))]
    codes, *rest = (np.concatenate([np.zeros(0, np.int64), *c]) for c in cols)
    order = np.argsort(codes, kind="stable")
    return codes[order], *(x[order] for x in rest)


def _renumber(buckets: int, level: int):
    """One chunk: its sequence in the ids of ``level``, and the pairs of the next."""
    def apply(state: pa.Table, told: pa.Table) -> pa.Table:
        if not len(state):
            return _STATE_ROWS.empty_table()
        row = state.to_pylist()[0]
        codes, ids, counts, first = _answers(told)
        seq, out = _loose(row["seq"]) - 1, []
        if level == 1:
            langs, names = _loose(row["counts"]), json.loads(row["lang"])
            offsets, data = text_buffers(pa.array([zstandard.decompress(row["words"])], pa.binary()))
            words = WordSlice(offsets, data, 0, 1, WORD_BYTES, SAME_BYTES)
            own = _of_language(words.hashes, _salts(names)[langs])
            at, known = lookup(codes, own)
            named = np.where(known, ids[at], -1) if len(ids) else np.full(len(own), -1)
            ranked = np.where(seq >= 0, named[seq], -1) if len(own) else seq
            for i in np.flatnonzero(known):
                if first[at[i]]:
                    out.append((_WORD, int(ids[at[i]]), None, None, None, words.word(i), names[langs[i]], int(counts[at[i]])))
        else:
            both = (seq[:-1] >= 0) & (seq[1:] >= 0)
            ranked = np.full(max(len(seq) - 1, 0), -1)
            at, known = lookup(codes, pair_codes(seq[:-1][both], seq[1:][both]))
            ranked[both] = np.where(known, ids[at], -1) if len(ids) else -1
        ranked = ranked[(ranked >= 0) | np.r_[False, ranked[:-1] >= 0]]          # one gap is enough
        both = (ranked[:-1] >= 0) & (ranked[1:] >= 0)
        out.append((_CHUNK, row["chunk"], None, None, _squeeze(ranked + 1), None, None, None))
        out += _striped(row["chunk"], *tile_counts(pair_codes(ranked[:-1][both], ranked[1:][both])), buckets)
        return pa.Table.from_batches([_state(out)])
    return apply


def _pairs(batches):
    """(id, left, right, n) of the frequent pairs of a level."""
    for batch in batches:
        for row in batch.to_pylist():
            left, right = pair_ids(_codes(row["codes"]))
            yield pa.RecordBatch.from_arrays([pa.array(_loose(row["ids"])), pa.array(left), pa.array(right),
                                              pa.array(_loose(row["counts"]))], names=["id", "left", "right", "n"])


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text",
                     lang: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """For each length from 1: (id, lang, phrase, last, heads, tails, left,
    right), where ``heads`` and ``tails`` hold the counts of its first and last
    1, 2, … words (the phrase itself at the end); and (lang, total), all words."""
    docs = docs.select(F.col(f"`{text}`").cast("string").alias("text"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // 6 // BUCKET_WORDS | 1
    state = materialize(docs.mapInArrow(_read(buckets), _STATE), "phrase_words")
    totals = state.where(F.col("bucket") == _TOTAL).groupBy("lang").agg(F.sum("n").alias("total"))
    levels: list[DataFrame] = []
    for k in range(1, longest + 1):
        told = materialize(state.where("bucket >= 0").select("bucket", "chunk", "codes", "counts").groupBy("bucket")
                           .applyInArrow(_frequent(buckets, least, k), _TOLD), f"phrases_{k}")
        chunks = state.where(F.col("bucket") == _CHUNK)
        if k < longest or k == 1:
            state = materialize(chunks.groupBy("chunk").cogroup(told.where("chunk >= 0").groupBy("chunk"))
                                .applyInArrow(_renumber(buckets, k), _STATE), f"phrase_sequence_{k}")
        if k == 1:
            found = state.where(F.col("bucket") == _WORD).select(
                F.col("chunk").alias("id"), "lang", F.col("words").cast("string").alias("phrase"), "n")
            level = found.select("id", "lang", "phrase", F.col("phrase").alias("last"), F.array("n").alias("heads"),
                                 F.array("n").alias("tails"), F.lit(None).cast("long").alias("left"),
                                 F.lit(None).cast("long").alias("right"))
        else:
            pairs = told.where("chunk = -1").select("codes", "ids", "counts").mapInArrow(_pairs, "id long, left long, right long, n long")
            a = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), "heads")
            b = levels[-1].select(F.col("id").alias("right"), "last", "tails")
            level = pairs.join(a, "left").join(b, "right").select(
                "id", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last",
                F.concat("heads", F.array("n")).alias("heads"), F.concat("tails", F.array("n")).alias("tails"), "left", "right")
        levels.append(materialize(level, f"phrase_table_{k}"))
    return levels, totals


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(1000 * a * n / (left * right))`` in whole numbers of 38 digits;
    no count passes 13 digits and no total 19."""
    whole = [c.cast("decimal(19,0)") for c in (a * 1000, n, left, right)]
    return F.call_function("div", whole[0] * whole[1], whole[2] * whole[3])


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, absorbed_percent: int = 100,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """Phrases of 2 to ``longest`` words found ``least`` times, scored by their
    weakest cut, without those that stand inside a longer one with at least
    ``absorbed_percent`` per cent of their count: lang, phrase, a, l, r, n, score."""
    levels, totals = frequent_phrases(docs, least, longest, text, lang)
    scored = []
    for k in range(2, longest + 1):
        level = levels[k - 1].withColumn("a", F.element_at("heads", -1))
        for longer in levels[k:]:        # counts fall with length: a phrase two words longer implies one in between
            if longer is not levels[k] and absorbed_percent == 100:
                break
            level = _not_inside(level, levels[k - 1:], longer, absorbed_percent)
        cuts = [F.struct(_score(F.col("a"), F.col("total"), F.col("heads")[j - 1], F.col("tails")[k - j - 1]).alias("score"),
                         F.lit(j).alias("cut"), F.col("heads")[j - 1].alias("l"), F.col("tails")[k - j - 1].alias("r"))
                for j in range(1, k)]
        scored.append(level.join(totals, "lang").withColumn("cut", F.array_min(F.array(*cuts)))
                      .select("lang", "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"))
    return reduce(DataFrame.unionByName, scored)


def _not_inside(level: DataFrame, tables: list[DataFrame], longer: DataFrame, percent: int) -> DataFrame:
    """``level`` without phrases inside a phrase of ``longer`` of enough count."""
    inside = longer.select(F.element_at("heads", -1).alias("by"), F.explode(F.array("left", "right")).alias("part"))
    for table in reversed(tables[1:tables.index(longer)]):          # step down to the parts' parts
        inside = (inside.groupBy("part").agg(F.max("by").alias("by")).join(table.withColumnRenamed("id", "part"), "part")
                  .select("by", F.explode(F.array("left", "right")).alias("part")))
    most = inside.groupBy("part").agg(F.max("by").alias("by")).withColumnRenamed("part", "id")
    return level.join(most, "id", "left").where(F.expr(f"by is null or 100 * by < {percent} * a")).drop("by")


def top_collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text: str = "text",
                     lang: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: score, then count, descending, then phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, least, longest, text=text, lang=lang).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
