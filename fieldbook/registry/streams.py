"""Streaming queries: the incremental-load jobs run to completion on the
driver tables; the registered result is the published table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from fieldbook.registry.base import query
from fieldbook.registry.standins import Tables
from fieldbook.session import scratch_path
from fieldbook.sources import keyed, pages
from fieldbook.sources.sinks import read_current
from fieldbook.streaming import ingest, overlap


def _base(t: Tables, name: str) -> str:
    return os.path.join(scratch_path(t.spark, "streams"), f"{name}-{uuid.uuid4().hex}")


@query("stream_daily_volume", None, """
SELECT CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS day, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2""")
def stream_daily_volume(t: Tables) -> DataFrame:
    """W-01..W-04: events streamed from the landing folder, de-duplicated by
    key, aggregated per day and kind, merged per batch; late events count."""
    events = t.raw("events")
    schema = events.schema
    target, ckpt, log = ingest.stream_paths(_base(t, "daily_volume"))
    q = ingest.stream_daily_volume(t.spark, t.sf_dir, schema, target, ckpt, glob="events.parquet", log_dir=log)
    ingest.run_to_end(q)
    return read_current(t.spark, target).select("day", "event_type", "events", "value")


PAGE_DOC = StructType([StructField("Ref_Key", LongType()), StructField("Kind", StringType()),
                       StructField("Amount", DoubleType()), StructField("Seq", LongType())])


@query("stream_upsert_pages", None, """
SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS value,
       CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS BIGINT) AS seq
FROM events""")
def stream_upsert_pages(t: Tables) -> DataFrame:
    """I-17 / W-01 / I-16 / M-24 / N8: two landed loads (all events, then corrected
    purchases) streamed into one table; the newest version of a key wins."""
    ev = t.raw("events")
    base = _base(t, "pages")
    landing = os.path.join(base, "landing")
    doc = lambda amount, seq: F.struct(F.col("event_id").alias("Ref_Key"), F.col("event_type").alias("Kind"),
                                       amount.alias("Amount"), F.lit(seq).cast("long").alias("Seq")).alias("doc")
    load1 = ev.select(F.floor(F.col("event_id") / 500).alias("page"), doc(F.col("value"), 1))
    load2 = ev.where(F.col("event_type") == "purchase").select(F.floor(F.col("event_id") / 500).alias("page"),
                                                                doc(F.col("value") + 1, 2))
    pages.write_pages(load1, landing, "page", mode="append")
    pages.write_pages(load2, landing, "page", mode="append")
    target, ckpt, log = ingest.stream_paths(base)
    explode = lambda b: b.select(F.inline("value")).select(
        F.col("Ref_Key").alias("event_id"), F.col("Kind").alias("event_type"), F.col("Amount").alias("value"),
        F.col("Seq").alias("seq"))
    q = ingest.stream_upsert(t.spark, landing, pages.envelope_schema(PAGE_DOC), target, ckpt, ["event_id"], ["seq"],
                             entity="events", log_dir=log, glob="*.json", transform=explode)
    ingest.run_to_end(q)
    return read_current(t.spark, target)


def _overlapping_loads(t: Tables) -> str:
    """Landed loads: two that overlap, one of old events, one sent twice in itself."""
    landing = _base(t, "overlap-landing")
    ev = t.raw("events").select("event_id", "ts", "event_type", "value")
    n = F.col("event_id") % 10
    for rows in (ev.where(n < 4), ev.where((n >= 2) & (n < 7)), ev.where((n == 7) | (n == 9)), ev.where(n == 8).unionByName(ev.where(n == 8))):
        rows.coalesce(1).write.mode("append").parquet(landing)
    return landing


def _overlap_base(t: Tables) -> str:
    landing, base = _overlapping_loads(t), _base(t, "overlap")
    schema = t.spark.read.parquet(landing).schema
    q = overlap.stream_overlap(t.spark, landing, schema, base, os.path.join(base, "_checkpoint"), max_files=1)
    ingest.run_to_end(q)
    return base


@query("stream_overlap_volume", None, """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2""")
def stream_overlap_volume(t: Tables) -> DataFrame:
    """W-02 / W-03: daily volume of overlapping and late loads, compared with the
    accepted keys of the look-back and of the days touched only."""
    return overlap.read_volume(t.spark, _overlap_base(t))


@query("load_log_batches", None, """
WITH e AS (SELECT event_id % 10 AS n, CAST(ts AS TIMESTAMP) AS ts FROM events),
b AS (SELECT 0 AS batch_id, n, ts FROM e WHERE n < 4 UNION ALL SELECT 1, n, ts FROM e WHERE n >= 2 AND n < 7
      UNION ALL SELECT 2, n, ts FROM e WHERE n IN (7, 9) UNION ALL SELECT 3, n, ts FROM e WHERE n = 8 UNION ALL SELECT 3, n, ts FROM e WHERE n = 8),
high AS (SELECT batch_id, max(max(ts)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b GROUP BY batch_id)
SELECT CAST(b.batch_id AS BIGINT) AS batch_id, count(*) AS rows_read,
       CAST(sum(CASE WHEN b.batch_id = 1 AND n < 4 THEN 0 WHEN b.batch_id = 3 THEN 0.5 ELSE 1 END) AS BIGINT) AS rows_accepted,
       CAST(sum(CASE WHEN b.batch_id = 1 AND n < 4 THEN 1 WHEN b.batch_id = 3 THEN 0.5 ELSE 0 END) AS BIGINT) AS rows_repeated,
       CAST(coalesce(sum(CASE WHEN ts < before - INTERVAL 48 HOUR AND NOT (b.batch_id = 1 AND n < 4) THEN CASE WHEN b.batch_id = 3 THEN 0.5 ELSE 1 END END), 0) AS BIGINT) AS rows_late
FROM b JOIN high ON high.batch_id = b.batch_id GROUP BY b.batch_id""")
def load_log_batches(t: Tables) -> DataFrame:
    """W-04 / M-24: the load log of four batches, the second replayed after the
    others: read, accepted, repeated and late rows, as observed while writing."""
    base = _overlap_base(t)
    again = t.raw("events").select("event_id", "ts", "event_type", "value").where("event_id % 10 >= 2 and event_id % 10 < 7")
    overlap.load_batch(again, 1, base)
    return overlap.read_log(t.spark, base).select("batch_id", "rows_read", "rows_accepted", "rows_repeated", "rows_late")


@query("keyed_table_merge", None, """
SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS value,
       CAST(CASE WHEN event_type = 'purchase' THEN 3 ELSE 2 END AS BIGINT) AS seq
FROM events""")
def keyed_table_merge(t: Tables) -> DataFrame:
    """I-10 / I-16: all events merged into a bucketed keyed table, then corrected
    purchases, then an older version of everything, which must not win."""
    base = _base(t, "keyed")
    ev = t.raw("events").select("event_id", "event_type", "value")
    batches = (ev.withColumn("seq", F.lit(2).cast("long")),
               ev.where(F.col("event_type") == "purchase").withColumns({"value": F.col("value") + 1, "seq": F.lit(3).cast("long")}),
               ev.withColumns({"value": F.col("value") - 1, "seq": F.lit(1).cast("long")}))
    for n, batch in enumerate(batches):
        keyed.merge(batch, base, f"load{n}", ["event_id"], ["seq"])
    return keyed.read(t.spark, base)
