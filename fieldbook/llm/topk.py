"""Exact top-k inner products by a three-phase uniform threshold.

A vector's score is the sum of its partial scores over ``SEGMENTS`` runs of
dimensions; every segment of every row block is a node with a local list.

1. *Gather.*  Each node sends, per query, its ``k`` highest partial scores and
   its lowest one.  With a missing partial score taken as the lowest, their
   sums bound totals from below; the ``k``-th highest bound is ``tau``.
2. *Cutoff.*  Above the lowest scores, a total of ``tau`` needs a partial
   score of ``tau / segments`` in some segment.  This cutoff goes back to the
   nodes; only rows that reach it somewhere stay, and of them only those
   whose upper bound (cutoff for every segment not reached) reaches ``tau``
   and the block's own ``k``-th lower bound.
3. *Resolve.*  The remaining rows' missing partial scores are looked up, and
   the blocks' ``k`` best exact totals are merged.

Components are ``floor(256 * x)``, so scores are whole numbers and ties exact.
Queries and rows meet in blocks of bounded size; per query a block sends a few
entries, never its scores.

Defined cases: vectors that are NULL, hold NULL or non-finite components (also
after scaling) or have a NULL id take no part; vectors of different length
are not compared, so a query without partners has no rows; an empty vector
scores 0 with other empty ones; rows that repeat an id count once (the
smallest vector); totals beyond the long range count as its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.frames import columns
from fieldbook.session import materialize

K = 5
SCALE = 256.0
SEGMENTS = 4
ROW_BLOCK = 8_192       # rows of a block on average
QUERY_BLOCK = 1_024     # queries of a block on average
STRIP = 64              # queries scored at once, which bounds a task's memory

_BLOCK = pa.schema([("block", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("kind", pa.string()), ("cells", pa.binary())])
_GATHER = pa.schema([("qblock", pa.int32()), ("dim", pa.int32()), ("query_id", pa.int64()), ("segment", pa.int32()),
                     ("low", pa.float64()), ("ids", pa.list_(pa.int64())), ("partials", pa.list_(pa.float64()))])
_TOP = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors packed to blocks of about ``rows`` rows of one length."""
    count = vectors.count() // rows + 1
    block = F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    return vectors.withColumn("block", block).groupBy("block", "dim").applyInArrow(
        _pack, "block int, dim int, ids binary, kind string, cells binary")


def _pack(table: pa.Table) -> pa.Table:
    block, dim = table.column("block")[0].as_py(), table.column("dim")[0].as_py()
    ids = table.column("vec_id").to_numpy().astype(np.int64)
    flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        cells = np.floor(SCALE * flat).reshape(len(ids), dim)
    finite = np.isfinite(cells).all(axis=1)
    ids, cells = ids[finite], cells[finite]
    order = np.lexsort((*cells.T[::-1], ids))
    ids, cells = ids[order], cells[order]
    once = np.r_[True, ids[1:] != ids[:-1]][:len(ids)]
    ids, cells = ids[once], cells[once]
    kind = "<i2" if not cells.size or np.abs(cells).max() < 2**15 else "<f8"
    return pa.table([[block], [dim], [ids.tobytes()], [kind], [cells.astype(kind).tobytes()]], schema=_BLOCK)


def _matrix(ids: bytes, kind: str, cells: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(cells, kind).reshape(len(ids), dim).astype(np.float64)


def _strips(table: pa.Table):
    """(query ids, row ids, partial scores by segment) of one pair of blocks;
    own rows have NaN.  Whole numbers are exact in double up to 2**53; larger
    ones are computed as Python integers."""
    r = table.slice(0, 1).to_pylist()[0]
    q_ids, q = _matrix(r["q_ids"], r["q_kind"], r["q_cells"], r["dim"])
    ids, rows = _matrix(r["ids"], r["kind"], r["cells"], r["dim"])
    cuts = np.array_split(np.arange(r["dim"]), max(1, min(SEGMENTS, r["dim"])))
    most = [float(np.abs(m).max()) if m.size else 0.0 for m in (q, rows)]
    exact = r["dim"] * most[0] * most[1] < 2**53
    if not exact:
        q, rows = (np.array([[int(x) for x in v] for v in m], object).reshape(m.shape) for m in (q, rows))
    for at in range(0, len(q_ids) if len(ids) else 0, STRIP):
        own = q_ids[at:at + STRIP, None] == ids[None, :]
        parts = []
        for cut in cuts:
            p = q[at:at + STRIP, cut] @ rows[:, cut].T
            parts.append(p if len(cut) else np.zeros(own.shape))
        yield r, q_ids[at:at + STRIP], ids, parts, own


def _floats(part: np.ndarray) -> np.ndarray:
    """Partial scores as doubles, for bounds only."""
    return part if part.dtype == np.float64 else part.astype(np.float64)


def _gather(k: int):
    def lists(table: pa.Table) -> pa.Table:
        out = []
        for r, q_ids, ids, parts, own in _strips(table):
            for s, part in enumerate(parts):
                p = np.where(own, -np.inf, _floats(part))
                low = np.where(own, np.inf, p).min(axis=1)
                top = np.argpartition(-p, min(k, len(ids)) - 1, axis=1)[:, :k]
                for i, query in enumerate(q_ids.tolist()):
                    mine = [j for j in top[i].tolist() if not own[i, j]]
                    if mine:
                        out.append((r["qblock"], r["dim"], query, s, low[i], ids[mine].tolist(), p[i, mine].tolist()))
        return pa.table([[o[i] for o in out] for i in range(7)], schema=_GATHER)
    return lists


def _resolve(k: int):
    def best(table: pa.Table) -> pa.Table:
        cutoffs = {c["query_id"]: c for c in table.column("cutoffs")[0].as_py()}
        out = []
        for _, q_ids, ids, parts, own in _strips(table):
            cuts = [cutoffs.get(x) for x in q_ids.tolist()]
            none = [0.0] * len(parts)
            lows = np.array([none if c is None else c["lows"] for c in cuts]).reshape(len(cuts), len(parts))
            tau = np.array([0.0 if c is None else c["tau"] for c in cuts])
            # bounds beyond 2**53 are rounded, so there every row is resolved
            cutoff = tau / len(parts) if parts[0].dtype == np.float64 else np.full(len(cuts), -np.inf)
            seen, lower, upper = np.zeros(own.shape, bool), np.zeros(own.shape), np.zeros(own.shape)
            for s, part in enumerate(parts):
                above = _floats(part) - lows[:, s, None]
                here = above >= cutoff[:, None]
                seen |= here
                lower += np.where(here, above, 0.0)
                upper += np.where(here, above, cutoff[:, None])
            seen &= ~own
            if seen.shape[1] > k:                    # the block's own k-th lower bound
                lower = np.where(seen, lower, -np.inf)
                tau = np.maximum(tau, -np.partition(-lower, k - 1, axis=1)[:, k - 1])
            keep = seen & (upper >= tau[:, None]) if parts[0].dtype == np.float64 else ~own
            for i, query in enumerate(q_ids.tolist()):
                rest = np.flatnonzero(keep[i])
                total = sum(part[i, rest] for part in parts)
                if total.dtype == object:
                    total = np.array([min(max(int(x), -2**63), 2**63 - 1) for x in total], np.int64)
                total = total.astype(np.int64)
                top = rest[np.lexsort((ids[rest], -total.astype(object) if len(total) and total.min() == -2**63 else -total))[:k]]
                exact = dict(zip(rest.tolist(), total.tolist(), strict=True))
                out += [(query, int(ids[j]), exact[j]) for j in top.tolist()]
        return pa.table([[o[i] for o in out] for i in range(3)], schema=_TOP)
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of every row
    that ``is_query`` selects (a condition on ``vec_id``), against all others."""
    vectors = columns(vectors, [key, vector]).toDF("vec_id", "embedding").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).withColumn(
        "dim", F.size("embedding"))
    rows = materialize(_blocks(vectors, ROW_BLOCK), "row-blocks")
    asked = materialize(_blocks(vectors.where(is_query), QUERY_BLOCK), "query-blocks")
    asked = asked.select(F.col("block").alias("qblock"), "dim", F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"),
                         F.col("cells").alias("q_cells"))
    pairs = rows.join(asked, "dim")
    near = ("block", "qblock", "dim")
    lists = materialize(pairs.groupBy(*near).applyInArrow(_gather(k),
        "qblock int, dim int, query_id long, segment int, low double, ids array<long>, partials array<double>"), "top-lists")

    lows = lists.groupBy("query_id", "segment").agg(F.min("low").alias("low"))
    entries = lists.select("query_id", "segment", F.explode(F.arrays_zip("ids", "partials")).alias("e"))
    bounds = (entries.join(lows, ["query_id", "segment"])
              .groupBy("query_id", F.col("e.ids").alias("vec_id")).agg(F.sum(F.col("e.partials") - F.col("low")).alias("bound")))
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"))
    tau = bounds.withColumn("place", F.row_number().over(order)).where(F.col("place") == k).select("query_id", "bound")
    low_lists = lows.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("segment", "low"))).alias("lows"))
    cutoffs = (lists.select("qblock", "dim", "query_id").distinct().join(low_lists, "query_id").join(tau, "query_id", "left")
               .groupBy("qblock", "dim").agg(F.collect_list(F.struct(
                   "query_id", F.coalesce("bound", F.lit(0.0)).alias("tau"), F.col("lows.low").alias("lows"))).alias("cutoffs")))
    found = pairs.join(cutoffs, ["qblock", "dim"]).groupBy(*near).applyInArrow(
        _resolve(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
