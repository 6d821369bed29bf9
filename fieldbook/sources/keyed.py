"""Keyed tables in hash buckets: a merge writes, and a look-up reads, only the
buckets that its keys fall in.

A publication writes the rows it brings under ``r=<run>/delta/_bucket=<b>/``
and records, for the buckets it touched alone, the pieces a bucket now consists
of: a whole one first, later deltas after it.  A bucket whose deltas hold half
as many rows as its whole piece, or that has ``MOST_PIECES``, is written anew
under ``r=<run>/whole`` by the same publication; the others are left alone.  So
a row is rewritten a number of times that grows with the logarithm of its
bucket, a bucket of one piece is read as it stands, and only buckets with
deltas are merged by key at reading.

Defined cases: of the rows of one key the highest in the sequence columns
stands, and of those the one published last; NULL keys are keys; a run that was
published before is skipped; a run that failed before it was recorded is
written again; an empty batch is recorded without pieces; a column ``_bucket``
is refused.  Keys are dealt by their text form, so an int and a long meet.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators.dedup import last_writer_wins
from fieldbook.sources.sinks import _published, _record

BUCKET_ROWS, LEAST_BUCKETS = 1 << 20, 8       # sizes of a new table: by its first load, a power of two
MOST_PIECES = 16
_BUCKET, _ORDER = "_bucket", "__n"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _pieces(published: list[tuple[str, dict]]) -> dict[int, list]:
    """Bucket -> its pieces ``[run, folder, rows]``, oldest first."""
    state: dict[int, list] = {}
    for _, how in published:
        state.update({int(b): p for b, p in how["pieces"].items()})
    return state


def _load(spark: SparkSession, table_dir: str, pieces: dict[int, list], runs: list[str]) -> DataFrame:
    """The rows of the pieces, with the place of their run; nothing else is listed."""
    folders: dict[tuple, list[str]] = {}
    for bucket, parts in pieces.items():
        for run, folder, _ in parts:
            root = os.path.join(table_dir, run, folder)
            folders.setdefault((runs.index(run), folder, root), []).append(os.path.join(root, f"{_BUCKET}={bucket}"))
    return reduce(DataFrame.unionByName, [
        spark.read.option("basePath", root).parquet(*sorted(paths)).withColumn(_ORDER, F.lit(2 * n + (folder == "whole")))
        for (n, folder, root), paths in sorted(folders.items())])


def _standing(spark: SparkSession, table_dir: str, pieces: dict[int, list], how: dict, runs: list[str]) -> DataFrame:
    """One row a key of the given buckets: those of one piece as they are."""
    plain = {b: p for b, p in pieces.items() if len(p) == 1}
    mixed = {b: p for b, p in pieces.items() if len(p) > 1}
    parts = [_load(spark, table_dir, plain, runs)] if plain else []
    if mixed:
        parts.append(last_writer_wins(_load(spark, table_dir, mixed, runs), how["keys"], [*how["seq"], _ORDER]))
    return reduce(DataFrame.unionByName, parts).drop(_ORDER)


def _write(df: DataFrame, root: str, buckets: int) -> dict[int, int]:
    """Write by bucket, one file each, and return the rows of each bucket."""
    df.repartition(buckets, _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(root)
    written = df.sparkSession.read.schema(f"{_BUCKET} int").parquet(root)         # footers only; one row a bucket
    return {r[0]: r[1] for r in written.groupBy(_BUCKET).count().collect()}


def merge(df: DataFrame, table_dir: str, run_id: str, keys: list[str], seq: list[str], buckets: int | None = None) -> dict[int, int]:
    """Publish ``df`` over the table and return the rows written by bucket.
    Keys, sequence columns and number of buckets are those of the table once
    it exists; a first load without a number of ``buckets`` is counted for it."""
    if _BUCKET in df.columns:
        raise ValueError(f"the column {_BUCKET} is the table's own")
    spark, run = df.sparkSession, f"r={run_id}"
    published = _published(spark, table_dir)
    if any(name == run for name, _ in published):
        return {}
    if published:
        layout = {k: published[0][1][k] for k in ("keys", "seq", "buckets")}
        if (layout["keys"], layout["seq"]) != (keys, seq):
            raise ValueError(f"{table_dir} is keyed by {layout['keys']} in the order of {layout['seq']}")
    else:
        buckets = buckets or max(LEAST_BUCKETS, 1 << (df.count() // BUCKET_ROWS).bit_length())
        layout = {"keys": keys, "seq": seq, "buckets": buckets}
    n = layout["buckets"]
    rows = last_writer_wins(df, keys, seq) if seq else df.dropDuplicates(keys)
    brought = _write(rows.withColumn(_BUCKET, bucket_of(keys, n)), os.path.join(table_dir, run, "delta"), n)
    before, runs = _pieces(published), [name for name, _ in published] + [run]
    now = {b: [*before.get(b, []), [run, "delta", m]] for b, m in brought.items()}
    full = {b: p for b, p in now.items() if len(p) > 1 and (
        len(p) >= MOST_PIECES or 2 * sum(x[2] for x in p[1:]) >= p[0][2])}
    if full:
        whole = _write(_standing(spark, table_dir, full, layout, runs), os.path.join(table_dir, run, "whole"), n)
        now.update({b: [[run, "whole", m]] for b, m in whole.items()})
    _record(spark, table_dir, len(published), run, {**layout, "pieces": now})
    return brought


def read(spark: SparkSession, table_dir: str, only: list[int] | None = None) -> DataFrame | None:
    """The table as published, or its buckets ``only``; None before the first
    row is published."""
    published = _published(spark, table_dir)
    pieces = _pieces(published)
    if not pieces:
        return None
    runs = [name for name, _ in published]
    wanted = pieces if only is None else {b: p for b, p in pieces.items() if b in set(only)}
    if not wanted:
        return _standing(spark, table_dir, dict([next(iter(pieces.items()))]), published[0][1], runs).drop(_BUCKET).limit(0)
    return _standing(spark, table_dir, wanted, published[0][1], runs).drop(_BUCKET)


def look_up(wanted: DataFrame, table_dir: str) -> DataFrame | None:
    """The table's rows whose key ``wanted`` has (columns named as the keys);
    only the buckets of those keys are opened."""
    spark = wanted.sparkSession
    published = _published(spark, table_dir)
    if not published:
        return None
    how = published[0][1]
    asked = wanted.select(*[F.col(f"`{k}`").alias(f"__{k}") for k in how["keys"]])
    only = wanted.select(bucket_of(how["keys"], how["buckets"])).distinct().collect()      # at most one row a bucket
    table = read(spark, table_dir, [r[0] for r in only])
    if table is None:
        return None
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`__{k}`")) for k in how["keys"]])
    return table.join(asked, same, "left_semi")


def save_bucketed(table: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """``table`` as the session's bucketed and sorted table ``name`` at
    ``path``: two of them with equal buckets join on their keys, and one groups
    by them, without a shuffle."""
    (table.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return table.sparkSession.table(name)
