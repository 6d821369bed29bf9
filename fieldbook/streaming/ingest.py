"""Scheduled incremental pulls re-aimed as micro-batch streams.

* ``stream_upsert``    - landing folder -> table, idempotent: every micro-batch
  is published as a delta over the table (last writer by a sequence column), so
  a batch writes what it brings and not the whole table; a batch that was
  published before is skipped, so the sink is effectively exactly-once.
* ``stream_daily_volume`` - daily volume per kind; the overlap of re-read
  windows is absorbed by the event key.  There is no watermark: an event counts
  in its day however late it lands, so the result depends neither on the order
  nor on the number of files.  The state keeps every event key (in RocksDB, on
  the executors' disks) and one sum per day and kind, and grows with the input.
* every batch has a row in the load log (entity, batch, rows read and written,
  rows that lost against another of their key, status, time).
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldbook.operators.dedup import last_writer_wins
from fieldbook.sources.sinks import is_published, publish_delta

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """State partitions of a stateful stream are fixed when it first starts
    (then kept in its checkpoint).  The dedup state grows with the input, so it
    is sized to the cluster's parallelism rather than to whatever the session's
    batch setting happens to be, and lies on disk, not in memory."""
    key, provider = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
    old, old_provider = spark.conf.get(key), spark.conf.get(provider)
    try:
        want = n or spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote session: keep the session value
        want = int(old)
    spark.conf.set(key, str(want))
    spark.conf.set(provider, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, old)
        spark.conf.set(provider, old_provider)


LOAD_LOG_SCHEMA = ("entity string, batch_id long, rows_read long, rows_written long, rows_rejected long, status string, "
                   "loaded_at timestamp")


def append_load_log(spark: SparkSession, log_dir: str, entity: str, batch_id: int, read: int, written: int | None) -> None:
    """One row per (entity, batch), rewritten when the batch is replayed (then
    nothing is written to the table)."""
    row = (read, written or 0, 0 if written is None else read - written, "replayed" if written is None else "loaded")
    (spark.createDataFrame([row], "rows_read long, rows_written long, rows_rejected long, status string")
          .withColumn("loaded_at", F.current_timestamp()).coalesce(1)
          .write.mode("overwrite").parquet(os.path.join(log_dir, f"entity={entity}", f"batch_id={batch_id}")))


def _merge_batch(target_dir: str, keys: list[str], seq_cols: list[str], log_dir: str | None, entity: str,
                 transform=None):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark, run_id, written = batch.sparkSession, f"b{batch_id:012d}", None
        rows = transform(batch) if transform else batch
        if is_published(spark, target_dir, run_id):          # a replay: the table has this batch
            read = rows.count() if log_dir else 0
        else:                                                # rows are counted while they are written
            seen = Observation()
            rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
            updates = last_writer_wins(rows, keys, seq_cols) if seq_cols else rows
            written = publish_delta(updates, target_dir, run_id, keys, seq_cols)
            read = seen.get["n"]
        if log_dir:
            append_load_log(spark, log_dir, entity, batch_id, read, written)
    return run


def stream_upsert(spark: SparkSession, landing: str, schema: StructType, target_dir: str, checkpoint_dir: str,
                  keys: list[str], seq_cols: list[str], fmt: str = "json", entity: str = "entity",
                  log_dir: str | None = None, glob: str | None = None,
                  available_now: bool = True, transform=None, max_files: int = 64) -> StreamingQuery:
    """Landing folder -> upserted table (I-17 / W-01).  ``transform`` shapes
    each micro-batch (e.g. explodes page envelopes) before the merge."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        r = r.option("pathGlobFilter", glob)
    src = r.format(fmt).load(landing)
    w = (src.writeStream.foreachBatch(_merge_batch(target_dir, keys, seq_cols, log_dir, entity, transform))
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="2 hours")
    return w.start()


def daily_volume(events: DataFrame, ts: str, kind: str, value: str, key: str,
                 value_type: str = "decimal(18,2)") -> DataFrame:
    """Streaming aggregate: events and value per day and kind, every key once
    and no event left out for being late."""
    return (events.dropDuplicates([key]).groupBy(F.to_date(ts).alias("day"), kind)
            # exact decimal sums: the result does not depend on batch or row order
            .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col(value).cast(value_type)).alias("value")))


def stream_daily_volume(spark: SparkSession, source_dir: str, schema: StructType, target_dir: str,
                        checkpoint_dir: str, glob: str | None = None, log_dir: str | None = None,
                        ts: str = "ts", kind: str = "event_type", value: str = "value",
                        key: str = "event_id", max_files: int = 64) -> StreamingQuery:
    """W-02 / W-03 / W-04: daily volume in update mode, merged into a
    table keyed by (day, kind) after every micro-batch."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        r = r.option("pathGlobFilter", glob)
    agg = daily_volume(r.parquet(source_dir), ts, kind, value, key)
    merge = _merge_batch(target_dir, ["day", kind], [], log_dir, "daily_volume")
    with state_partitions(spark):
        return (agg.writeStream.outputMode("update").foreachBatch(merge)
                .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def run_to_end(q: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an availableNow query; surface its failure."""
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_paths(base: str) -> tuple[str, str, str]:
    """(target, checkpoint, load log) folders of one stream job under ``base``."""
    return os.path.join(base, "table"), os.path.join(base, "_checkpoint"), os.path.join(base, "load_log")
