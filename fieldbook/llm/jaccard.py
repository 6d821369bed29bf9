"""N-gram Jaccard join by vertical partitioning.

Two documents link when ``100 * |A & B| >= 80 * |A | B|`` for their sets of
distinct ``n``-word shingles.  The join never forms pairs from common
shingles, and cuts the global shingle order (the order of the 64-bit hashes)
into equal fragments whose overlaps are counted separately and summed:

1. *Frequencies.*  Chunks exchange their distinct shingles (``exchange``); a
   shingle found only once in the corpus cannot overlap and is dropped, but
   keeps its place in the set size.
2. *Classes.*  Equal sets become one class; copies are never paired.
3. *Candidates.*  Rarest-first prefix filter: linked sets share one of their
   ``size - ceil(0.8 * size) + 1`` rarest shingles.  Documents whose prefix
   holds only unique shingles are alone and leave here.
4. *Counting.*  Every class is cut into ``FRAGMENTS`` vertical fragments;
   a candidate pair's overlaps are counted fragment by fragment and summed.
5. *Components.*  First each shared prefix shingle's most common class is
   paired with the others (linear), and links are closed to components; then
   only pairs of different components are left, which a bitmap bound (two
   sets differ in at least as many shingles as their parity bitmaps differ in
   bits) thins before they are counted.  A pair inside a component cannot
   change the result, so no link that matters is lost.

Defined cases: NULL, empty and wordless texts have an empty set and link with
nothing; texts of fewer words than ``n`` have one shingle, their whole
sequence; equal sets link; repeated rows are copies of each other; a NULL id
takes part but never names a component unless the whole component has none.
Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.exchange import PACKED, Layout, chunked, lookup, pack, plan_layout, unpack
from fieldbook.llm.frames import columns, components
from fieldbook.llm.words import LOWER_ASCII, SPACE_WORDS, WordSlice, hand_back, mix, row_slices, shingle_set, text_buffers, windows
from fieldbook.session import materialize

WORDS_PER_SHINGLE = 5
PERCENT = 80
FRAGMENTS = 8           # overlaps are counted in so many parts of the hash order
SIGNATURE_LONGS = 8     # 64 bits each: the parity bitmap of a set

_REQUEST = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("payload", pa.binary()), ("extra", pa.binary())])
_SETS = ("doc_id long, n long, cls long, cent double, alone long, prefix array<long>, frags array<array<long>>, "
         "sig array<long>")


def shingle_sets(texts, n: int):
    """(row, sorted distinct shingle hashes) of every text of an Arrow column."""
    offsets, data = text_buffers(texts)
    for lo, hi in row_slices(offsets):
        words = WordSlice(offsets, data, lo, hi, SPACE_WORDS, LOWER_ASCII)
        runs, first = windows(words.hashes, n), words.first
        for row in range(hi - lo):
            a, b = first[row], first[row + 1]
            yield lo + row, np.unique(runs[a:b - n + 1]) if b - a >= n else shingle_set(words.hashes[a:b], n)


def _request(layout: Layout, n: int):
    def ask(table: pa.Table) -> pa.Table:
        sets = [s >> layout.shift for _, s in shingle_sets(table.column("text"), n)]
        values, counts = np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]), return_counts=True)
        counts = np.minimum(counts, 255).astype(np.uint8)
        rows = [(b, pack(values[r]), counts[r].tobytes()) for b, r in layout.cut(values)]
        chunk = table.column("chunk")[0].as_py() if len(table) else 0
        return pa.table([[r[0] for r in rows], [chunk] * len(rows), [r[1] for r in rows], [r[2] for r in rows]],
                        schema=_REQUEST)
    return ask


def _frequencies(table: pa.Table) -> pa.Table:
    """One bucket: the shingles found more than once, told to each chunk that
    has them, with their frequency on a log scale of one byte."""
    asked = [unpack(p.as_py()) for p in table.column("payload")]
    counts = np.concatenate([np.frombuffer(c.as_py(), np.uint8) for c in table.column("extra")])
    values, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(place, counts, len(values))
    grade = np.minimum(255, np.round(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
    at, out = 0, []
    for own in asked:
        g = grade[place[at:at + len(own)]]
        at += len(own)
        out.append((pack(own[g > 0]), g[g > 0].tobytes()))
    del values, place, total, grade, asked, counts
    hand_back()
    return pa.table([table.column("bucket").combine_chunks(), table.column("chunk").combine_chunks(),
                     pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())],
                    schema=_REQUEST)


def _reduced_sets(layout: Layout, n: int, percent: int):
    fields = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("cent", pa.float64()),
                        ("alone", pa.int64()), ("prefix", pa.list_(pa.int64())), ("frags", pa.list_(pa.list_(pa.int64()))),
                        ("sig", pa.list_(pa.int64()))])

    def reduce(docs: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(told.column("bucket").to_numpy())
        parts = [(unpack(told.column("payload")[int(i)].as_py()),
                  np.frombuffer(told.column("extra")[int(i)].as_py(), np.uint8)) for i in order]
        common = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint64)])
        grades = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.uint8)])
        ids = docs.column("doc_id").to_pylist()
        rows = []
        for row, s in shingle_sets(docs.column("text"), n):
            size = len(s)
            at, known = lookup(common, s >> layout.shift)
            kept = s[known]
            # |A & B| >= percent / 100 * |A| for linked sets: one of these is shared
            want = size - -(-percent * size // 100) + 1 - (size - len(kept))
            if not len(kept) or want <= 0:
                rows.append((ids[row], size, None, None, None, None, None, None))
                continue
            g = grades[at[known]]
            rare = kept[np.argsort(g, kind="stable")][:want]
            digest = int(mix(np.array([np.bitwise_xor.reduce(mix(s.copy())) + np.uint64(size)], np.uint64)).view(np.int64)[0])
            cuts = np.searchsorted(kept >> np.uint64(61), np.arange(1, FRAGMENTS, dtype=np.uint64))
            frags = [x.view(np.int64).tolist() for x in np.split(kept, cuts)]
            bits = np.bincount((kept % np.uint64(64 * SIGNATURE_LONGS)).astype(np.int64), minlength=64 * SIGNATURE_LONGS) & 1
            sig = np.packbits(bits.astype(np.uint8)).view(np.int64)
            rows.append((ids[row], size, digest, float(g.sum()) / size, size - len(kept), rare.view(np.int64).tolist(),
                         frags, sig.tolist()))
        return pa.table([[r[i] for r in rows] for i in range(8)], schema=fields)
    return reduce


def _linked(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link: overlaps counted by vertical fragment
    and summed per pair."""
    parts = classes.select("cls", F.posexplode("frags").alias("frag", "toks")).where("size(toks) > 0")
    left = pairs.join(parts.select(F.col("cls").alias("a"), "frag", F.col("toks").alias("ta")), "a")
    both = left.join(parts.select(F.col("cls").alias("b"), "frag", F.col("toks").alias("tb")), ["b", "frag"])
    partial = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("long").alias("part"))
    common = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("common"))
    return common.where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b")


def near_duplicate_components(docs: DataFrame, n: int = WORDS_PER_SHINGLE, percent: int = PERCENT,
                              key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the
    smallest id reachable by links) and ``class_id`` (equal sets; NULL when the
    document is alone)."""
    docs = columns(docs, [key, text]).toDF("doc_id", "text")
    layout = plan_layout(docs)
    chunks = chunked(docs, layout, "doc_id")
    asked = chunks.groupBy("chunk").applyInArrow(_request(layout, n), PACKED)
    told = asked.groupBy("bucket").applyInArrow(_frequencies, PACKED)
    sets = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_reduced_sets(layout, n, percent), _SETS)
    sets = materialize(sets, "shingle-sets")

    members = sets.where("cls is not null")
    classes = materialize(members.groupBy("cls").agg(
        F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("cent").alias("cent"), F.first("alone").alias("alone"),
        F.first("prefix").alias("prefix"), F.first("frags").alias("frags"), F.first("sig").alias("sig")), "shingle-classes")
    # pos: the shingle's place in its set, rarest first; unique shingles come before all others
    entries = classes.select("cls", "n", "cent", "alone", F.posexplode("prefix").alias("pos", "tok")).select(
        "tok", "cls", "n", "cent", "alone", (F.col("alone") + F.col("pos")).alias("pos"))

    # each shared shingle's most common class with the others: linear in the entries
    hubs = (entries.groupBy("tok").agg(F.count("*").alias("many"), F.max(F.struct("cent", "cls", "n", "pos")).alias("hub"))
            .where("many > 1")
            .select("tok", F.col("hub.cls").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.pos").alias("hub_pos")))
    stars = (entries.join(hubs, "tok").where((F.col("cls") != F.col("hub")) & _fit("n", "hub_n", "pos", "hub_pos", percent))
             .select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b"),
                     F.when(F.col("cls") < F.col("hub"), F.col("n")).otherwise(F.col("hub_n")).alias("na"),
                     F.when(F.col("cls") < F.col("hub"), F.col("hub_n")).otherwise(F.col("n")).alias("nb"))
             .distinct())
    links = materialize(_linked(stars, classes, percent), "links")
    comps = components(links)

    # what is left: pairs of different components that share a prefix shingle
    named = entries.join(comps, entries.cls == comps.node, "left").select(
        "tok", "cls", "n", "pos", "alone", F.coalesce("comp", "cls").alias("comp"))
    named = materialize(named, "entries")
    mixed = named.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("tok")
    named = named.join(mixed, "tok", "left_semi").join(classes.select("cls", "sig"), "cls")
    left, right = (named.select("tok", *[F.col(c).alias(f"{c}_{s}") for c in ("cls", "n", "pos", "alone", "comp", "sig")]) for s in "ab")
    differ = F.col("alone_a") + F.col("alone_b")        # unique shingles differ from everything
    for i in range(SIGNATURE_LONGS):
        differ += F.bit_count(F.col("sig_a")[i].bitwiseXOR(F.col("sig_b")[i]))
    rest = (left.join(right, "tok").where((F.col("comp_a") < F.col("comp_b")) & _fit("n_a", "n_b", "pos_a", "pos_b", percent)
                                          & ((100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b"))))
            .select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"), F.col("n_a").alias("na"), F.col("n_b").alias("nb"))
            .distinct())
    links = links.unionByName(_linked(rest, classes, percent))
    comps = components(links)

    named = classes.select("cls", "least_id").join(comps, F.col("cls") == F.col("node"), "left").select(
        "cls", "least_id", F.coalesce("comp", "cls").alias("comp"))
    least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    final = named.join(least, "comp").select("cls", "component_id")
    return sets.select("doc_id", "n", "cls").join(final, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("cls").alias("class_id"))


def _fit(a: str, b: str, pos_a: str, pos_b: str, percent: int):
    """Whether two sets can link whose first common shingle stands at these
    places: only shingles from there on can be common."""
    most = F.least(F.col(a) - F.col(pos_a), F.col(b) - F.col(pos_b))
    return 100 * most >= percent * (F.col(a) + F.col(b) - most)
