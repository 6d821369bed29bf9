"""Daily volume of overlapping loads with a bounded look-back (W-02, W-04).

Each load reads the last ``hours`` again, so most of its rows were loaded
before.  A batch is compared with the keys accepted in that window and, for
rows older than it, with the keys of the days those rows fall on: the keys are
kept by day, so what a batch reads follows the overlap and not the history,
nothing is held in state stores, and a late row is neither lost nor counted
twice.  Accepted keys, partial sums and the log of a batch lie in folders of
their own, which a replay of the batch writes again from the batches before it.
"""

from __future__ import annotations

import os
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldbook.constants import LOOKBACK_HOURS
from fieldbook.operators.dedup import first_per_key
from fieldbook.operators.joins import anti_join
from fieldbook.session import materialize

_LOG = ("batch_id long, rows_read long, rows_accepted long, rows_repeated long, rows_late long, keys_compared long, high timestamp_ntz")


def _batches(spark: SparkSession, folder: str) -> DataFrame | None:
    """All batches' files under ``folder``, None before the first."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_volume(spark: SparkSession, base: str, kind: str = "event_type") -> DataFrame | None:
    """Events and value per day and kind over all batches."""
    parts = _batches(spark, os.path.join(base, "volume"))
    return parts if parts is None else parts.groupBy("day", kind).agg(F.sum("events").alias("events"), F.sum("value").alias("value"))


def read_log(spark: SparkSession, base: str) -> DataFrame | None:
    log = _batches(spark, os.path.join(base, "log"))
    return log if log is None else log.drop("batch")


def load_batch(batch: DataFrame, batch_id: int, base: str, ts: str = "ts", kind: str = "event_type", value: str = "value",
               key: str = "event_id", hours: int = LOOKBACK_HOURS, value_type: str = "decimal(18,2)") -> None:
    """Accept the batch's new keys and log it; its rows are read once, its counts
    are observed while they are written.  Of rows of one key the earliest counts;
    rows without key or time are read and not accepted."""
    spark, own = batch.sparkSession, f"batch={batch_id:012d}"
    log, before = read_log(spark, base), _batches(spark, os.path.join(base, "accepted"))
    high = None if log is None else log.where(F.col("batch_id") < batch_id).agg(F.max("high")).first()[0]
    read, kept = Observation(), Observation()
    rows = batch.select(F.col(key).alias("key"), F.col(ts).cast("timestamp_ntz").alias("ts"), F.col(kind).alias(kind),
                        F.col(value).cast(value_type).alias("value"))
    rows = rows.observe(read, F.count(F.lit(1)).alias("n"), F.max("ts").alias("high"))
    rows = rows.where(F.col("key").isNotNull() & F.col("ts").isNotNull())
    staged = materialize(first_per_key(rows, ["key"], [F.col("ts").asc_nulls_last(), F.col(kind), F.col("value")])
                         .withColumn("day", F.to_date("ts")), "overlap")
    compared = 0
    new = staged
    if before is not None:
        edge = F.lit(high - timedelta(hours=hours) if high else None).cast("date")
        days = staged.select("day").distinct().unionByName(before.where(F.col("day") >= edge).select("day").distinct()).distinct()
        # few days, so the join prunes the folders of all others
        seen = before.where(F.col("batch") < batch_id).join(F.broadcast(days), "day", "left_semi").select("key")
        seen = materialize(seen, "overlap_keys")
        compared, new = seen.count(), anti_join(staged, seen, ["key"], null_safe=True)
    late = F.col("ts") < F.lit(high - timedelta(hours=hours)) if high else F.lit(False)
    accepted = os.path.join(base, "accepted", own)
    new.observe(kept, F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late")).write.partitionBy("day").mode("overwrite").parquet(accepted)
    mine = spark.read.schema(f"key {dict(staged.dtypes)['key']}, ts timestamp_ntz, `{kind}` string, value {value_type}, day date").parquet(accepted)
    mine.groupBy("day", kind).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value")).write.mode("overwrite").parquet(
        os.path.join(base, "volume", own))
    n, accepted_n = read.get["n"], kept.get["n"]
    highest = max((x for x in (high, read.get["high"]) if x is not None), default=None)
    spark.createDataFrame([(batch_id, n, accepted_n, n - accepted_n, kept.get["late"], compared, highest)], _LOG).coalesce(1).write.mode(
        "overwrite").parquet(os.path.join(base, "log", own))


def stream_overlap(spark: SparkSession, landing: str, schema: StructType, base: str, checkpoint_dir: str,
                   max_files: int = 64, **columns) -> StreamingQuery:
    """Landing folder of parquet loads -> accepted keys, volume and log under ``base``."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)
    return (src.writeStream.foreachBatch(lambda batch, n: load_batch(batch, n, base, **columns))
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def progress(query: StreamingQuery) -> list[dict]:
    """Batches of a finished query as the engine reports them: rows in, seconds, rows of state."""
    return [{"batch_id": p["batchId"], "rows_in": p["numInputRows"], "seconds": p["durationMs"].get("triggerExecution", 0) / 1000,
             "state_rows": sum(s["numRowsTotal"] for s in p["stateOperators"])} for p in query.recentProgress]
