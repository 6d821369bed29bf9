"""Mixing sources to target weights by iterative proportional fitting.

Every document is a token count in a cell (source, language, topic).  Raking
scales the cells' token weights in turn so that the totals by source, by
language and by topic meet their targets, until all agree.  Weights are
expected tokens, calibrated to the wanted share of all and never more than the
cell has; a document is kept with its cell's weight over tokens as probability.

A target above what a value has is cut to that, and the others of its dimension
take up the difference; a target of zero keeps nothing.  Targets that still
contradict each other (a full cell in two dimensions) cannot all be met: the
rounds end when they gain nothing more, and ``distance`` tells how far the
worst total is from its target.

The default targets are tempered shares, ``tokens ** TEMPER``, which lower a
source that holds a third of all tokens; any table of shares may be given.
The topic is the cell of ``TOPIC_PLANES`` random hyperplanes over the counts
of a text's hashed words, so like texts share it.

Only the cells are iterated, as a DataFrame written once per round; documents
meet their cell in one join.  Defined cases: NULL source, language and id are
values of their own; NULL and empty texts have one token; a text's chance
depends on its id and text, so repeated rows share it; values without a given
target keep their share of the tokens; an empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.words import LOWER_ASCII, SPACE_WORDS, WordSlice, row_slices, text_buffers
from fieldbook.session import materialize

TEMPER = 0.85
KEEP = 0.5              # share of all tokens to keep
TOPIC_PLANES = 3
TOLERANCE = 1e-3        # greatest relative distance of a total from its target
ROUNDS = 40
STALLED = 3             # rounds without a gain of one per cent end the raking
DIMENSIONS = ("source", "lang", "topic")
_NULL = "\x00"          # stands for NULL among the cell keys


def _token_cell(texts: pa.Array) -> pa.Array:
    offsets, data = text_buffers(texts)
    out = []
    for lo, hi in row_slices(offsets):
        w = WordSlice(offsets, data, lo, hi, SPACE_WORDS, LOWER_ASCII)
        topic = np.zeros(hi - lo, np.int64)
        for plane in range(TOPIC_PLANES):
            side = ((w.hashes >> np.uint64(20 + plane)) & np.uint64(1)).astype(np.int64) * 2 - 1
            total = np.r_[0, np.cumsum(side)]
            topic = 2 * topic + (np.diff(total[w.first]) > 0)
        out += [{"tokens": max(n, 1), "topic": f"t{t}"} for n, t in zip(w.counts().tolist(), topic.tolist(), strict=True)]
    return pa.array(out, pa.struct([("tokens", pa.int64()), ("topic", pa.string())]))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
             whole: bool = False) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, chance) of every document, with
    its columns as a struct ``_whole`` if asked for; ``chance`` is uniform in
    [0, 1) and depends on id and text alone."""
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")] if whole else []
    cell = F.arrow_udf(_token_cell, "struct<tokens: bigint, topic: string>")(F.col(f"`{text}`"))
    chance = F.shiftrightunsigned(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"), F.lit("mixing")), 11) / float(2**53)
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), F.col(f"`{lang}`").alias("lang"),
                       chance.alias("chance"), cell.alias("cell"), *rest).select(
        "doc_id", "source", "lang", F.col("cell.topic").alias("topic"), F.col("cell.tokens").alias("tokens"), "chance",
        *["_whole"] * whole)


def _targets(cells: DataFrame, dimension: str, given: DataFrame | None, keep: float = KEEP) -> DataFrame:
    """(value, share) of a dimension, summing to one, no share above what the
    value's tokens can give when ``keep`` of all tokens are kept."""
    by = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    if given is None:
        by = by.select(dimension, "tokens", F.pow("tokens", F.lit(TEMPER)).alias("part"))
    else:
        value, share = given.columns[:2]
        given = (given.groupBy(F.coalesce(F.col(f"`{value}`").cast("string"), F.lit(_NULL)).alias(dimension))
                 .agg(F.sum(F.col(f"`{share}`").cast("double")).alias("wanted")))
        by = by.join(given, dimension, "left").select(dimension, "tokens", F.coalesce("wanted", F.col("tokens") / total).alias("part"))
    by = materialize(by.withColumn("most", F.col("tokens") / (keep * total)), f"target-{dimension}")
    scale, cut = 0.0, -1
    while True:                         # every turn cuts at least one more value, or is the last
        full = F.col("part") * scale > F.col("most")
        n, taken, left = by.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("part")))).first()
        if n == cut:
            break
        cut, scale = n, max(0.0, 1.0 - (taken or 0.0)) / left if left else scale
    return by.select(dimension, F.least("most", F.col("part") * scale).alias("target"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], keep: float = KEEP) -> DataFrame:
    """``cells`` (dimensions, ``tokens``) with ``weight``, the expected tokens
    to keep: together ``keep`` of all, by dimension in the ``target`` shares,
    and no more than the cell has (what a full cell cannot give, the others
    take up in the next round); and ``distance``, the greatest relative distance
    of a total from its target that is left."""
    wanted = keep * (cells.agg(F.sum("tokens")).first()[0] or 0)
    cells = cells.withColumn("weight", F.col("tokens") * keep)
    best, idle, worst = float("inf"), 0, 0.0
    for _ in range(ROUNDS):
        off = []
        for d, target in targets.items():
            now = cells.groupBy(d).agg(F.sum("weight").alias("now"))
            # a total of zero stays: its target is zero, or another dimension's is
            factor = now.join(target, d).select(
                d, F.when(F.col("now") > 0, F.col("target") * wanted / F.col("now")).otherwise(F.lit(1.0)).alias(f"factor_{d}"))
            cells = cells.join(factor, d).withColumn("weight", F.least("tokens", F.col("weight") * F.col(f"factor_{d}")))
            off.append(F.max(F.abs(F.col(f"factor_{d}") - 1)))
        cells = materialize(cells, "cells")
        worst = cells.agg(F.greatest(*off)).first()[0] or 0.0
        cells = cells.drop(*[f"factor_{d}" for d in targets])
        idle = idle + 1 if worst > 0.99 * best else 0
        best = min(best, worst)
        if worst < TOLERANCE or idle >= STALLED:
            break
    return cells.withColumn("distance", F.lit(float(worst)))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({f"_{d}": F.coalesce(F.col(d).cast("string"), F.lit(_NULL)) for d in DIMENSIONS})


def probabilities(rows: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP) -> DataFrame:
    """(_source, _lang, _topic, probability, distance) of every cell of ``measured`` rows."""
    cells = _keyed(rows).groupBy(*[F.col(f"_{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("tokens").alias("tokens"))
    cells = materialize(cells, "cells")
    cells = raked(cells, {d: _targets(cells, d, (targets or {}).get(d), keep) for d in DIMENSIONS}, keep)
    probability = F.round(F.col("weight") / F.col("tokens"), 9)     # sums may differ in their last bits
    return cells.select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], probability.alias("probability"), "distance")


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, **names) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, probability, distance, kept) of every
    document; ``targets`` gives (value, share) tables by dimension."""
    rows = materialize(measured(docs, **names), "token-cells")
    cells = probabilities(rows, targets, keep)
    return _keyed(rows).join(cells, [f"_{d}" for d in DIMENSIONS]).select(
        "doc_id", "source", "lang", "topic", "tokens", "probability", "distance", (F.col("chance") < F.col("probability")).alias("kept"))


def sampled(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, **names) -> DataFrame:
    """The documents kept, with all their columns."""
    cells = probabilities(measured(docs, **names), targets, keep)
    marked = measured(docs, whole=True, **names)
    return _keyed(marked).join(cells, [f"_{d}" for d in DIMENSIONS]).where(
        F.col("chance") < F.col("probability")).select("_whole.*")
