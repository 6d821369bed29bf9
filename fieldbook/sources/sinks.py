"""Table sinks: stamped, partitioned parquet in run-versioned directories.

A table directory holds whole versions ``v=<run id>/``, deltas ``d=<run id>/``
(rows by key that stand over what was published before) and ``_PUBLISHED``, to
which each publication adds a numbered line; readers take the highest whole
version and the deltas after it.  New rows are written next to the published
ones (never over one of them), so a failed run leaves the table untouched and a
retried run rewrites only what was never published.
"""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators.dedup import last_writer_wins


def stamp(df: DataFrame, col: str = "_loaded_at") -> DataFrame:
    return df.withColumn(col, F.current_timestamp())


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def _published(spark: SparkSession, table_dir: str) -> list[tuple[str, dict]]:
    """Published versions and deltas, oldest first, each with how it is merged.  Every publication adds one small
    file and none is ever replaced, so there is no moment without a pointer.
    A table that has versions but no record of them is an error, not empty."""
    def missing(e: AnalysisException) -> bool:
        return e.getCondition() == "PATH_NOT_FOUND"
    try:
        rows = spark.read.text(os.path.join(table_dir, "_PUBLISHED")).collect()  # one line per version
    except AnalysisException as e:
        if not missing(e):
            raise
        try:
            spark.read.format("binaryFile").load(os.path.join(table_dir, "[vr]=*")).schema  # noqa: B018 - resolves the path
        except AnalysisException as none:
            if missing(none):
                return []
            raise
        raise RuntimeError(f"{table_dir} has versions, but its _PUBLISHED record is lost") from e
    lines = sorted((r[0].strip().split(" ", 2) for r in rows), key=lambda line: int(line[0]))
    return [(line[1], json.loads(line[2]) if len(line) > 2 else {}) for line in lines]


def _record(spark: SparkSession, table_dir: str, number: int, name: str, how: dict | None = None) -> None:
    line = f"{number} {name}" + (f" {json.dumps(how)}" if how else "")
    spark.createDataFrame([(line,)], "v string").coalesce(1).write.mode("append").text(os.path.join(table_dir, "_PUBLISHED"))


def current_version(spark: SparkSession, table_dir: str) -> str | None:
    published = _published(spark, table_dir)
    return published[-1][0] if published else None


def is_published(spark: SparkSession, table_dir: str, run_id: str) -> bool:
    return any(name in (f"v={run_id}", f"d={run_id}") for name, _ in _published(spark, table_dir))


def _standing(published: list[tuple[str, dict]]) -> list[tuple[str, dict]]:
    """The last whole version and the deltas after it."""
    whole = [i for i, (name, _) in enumerate(published) if name.startswith("v=")]
    return published[whole[-1] if whole else 0:]


def read_current(spark: SparkSession, table_dir: str, schema=None) -> DataFrame | None:
    """The table as published: of the rows of one key the highest in the
    sequence columns stands, and of those the one published last."""
    standing = _standing(_published(spark, table_dir))
    if not standing:
        return None
    r = spark.read if schema is None else spark.read.schema(schema)
    parts = [r.parquet(os.path.join(table_dir, name)) for name, _ in standing]
    if len(parts) == 1:
        return parts[0]
    how = standing[-1][1]
    both = reduce(DataFrame.unionByName, [p.withColumn("__n", F.lit(n)) for n, p in enumerate(parts)])
    return last_writer_wins(both, how["keys"], [*how["seq"], "__n"]).drop("__n")


def publish_delta(df: DataFrame, table_dir: str, run_id: str, keys: list[str], seq_cols: list[str]) -> int:
    """Write ``df`` (one row a key) over what is published, without touching
    it, and return its rows.  Once the deltas hold half as many rows as the
    whole version, both are written as the next one: a row is rewritten a
    number of times that grows with the logarithm of the table, not with the
    number of batches.  The first publication is a whole version."""
    spark = df.sparkSession
    published = _published(spark, table_dir)
    count = lambda name: spark.read.parquet(os.path.join(table_dir, name)).count()  # noqa: E731 - from the footers
    if not published:
        return count(publish_version(df, table_dir, run_id=run_id))
    write_table(df, os.path.join(table_dir, f"d={run_id}"))
    _record(spark, table_dir, len(published), f"d={run_id}", {"keys": keys, "seq": seq_cols})
    (whole, _), *deltas = _standing(_published(spark, table_dir))
    sizes = [count(name) for name, _ in deltas]
    if 2 * sum(sizes) >= count(whole):
        publish_version(read_current(spark, table_dir), table_dir, run_id=f"{run_id}-whole")
    return sizes[-1]


def publish_version(df: DataFrame, table_dir: str, partition_by: list[str] | None = None,
                    run_id: str | None = None) -> str:
    """Write ``df`` as a new version, then record it.  A run that was
    published before gets a folder of its own, as ``df`` may read the old one."""
    spark = df.sparkSession
    published = _published(spark, table_dir)
    v = f"v={run_id or uuid.uuid4().hex}"
    again = sum(p == v or p.startswith(f"{v}~") for p, _ in published)
    v = f"{v}~{again}" if again else v
    write_table(df, os.path.join(table_dir, v), partition_by)
    _record(spark, table_dir, len(published), v)
    return v
