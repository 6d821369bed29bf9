"""Ingest queries: landed pages, dedup, upserts, reconciliation, normalisation."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from fieldbook.functions.normalize import (
    falsy_to_null, lenient_decimal, norm_guid, norm_text, strict_decimal, strict_int,
)
from fieldbook.operators.dedup import first_per_key
from fieldbook.operators.predicates import dim_not_deleted
from fieldbook.operators.upsert import upsert, upsert_set_based
from fieldbook.plans import facts
from fieldbook.registry.base import query
from fieldbook.registry.standins import Tables
from fieldbook.registry.work import waybill_headers, waybill_lines
from fieldbook.session import materialize, scratch_path
from fieldbook.sources import pages

RAW_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                  "l_tax", "l_returnflag", "l_linestatus"]


@query("dedup_first_page", None, """
SELECT * EXCLUDE (rn, l_shipdate), CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem)
WHERE rn = 1""")
def dedup_first_page(t: Tables) -> DataFrame:
    """I-05: keys repeated across pages, the first in page order wins
    (page order stood in by a total order over the line columns)."""
    li = t.raw("lineitem")
    return first_per_key(li, ["l_orderkey", "l_linenumber"], [F.col(c).asc() for c in RAW_LINE_ORDER])


def _orders_slices(t: Tables):
    o = t.raw("orders").select(F.col("o_orderkey").alias("_id"), F.col("o_orderstatus").alias("status"),
                               F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
                               F.col("o_orderpriority").alias("priority"), "o_orderdate")
    target = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).drop("o_orderdate")
    newer = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    p1 = newer.select("_id", "status", (F.col("price") + 1).cast("decimal(18,2)").alias("price"),
                      F.concat(F.lit("X-"), "priority").alias("priority"), F.lit(1).alias("seq"))
    p2 = newer.where(F.col("status") == "F").select(
        "_id", "status", (F.col("price") + 2).cast("decimal(18,2)").alias("price"),
        F.concat(F.lit("Y-"), "priority").alias("priority"), F.lit(2).alias("seq"))
    return target, p1.unionByName(p2)


SLICES_SQL = """
WITH o AS (SELECT o_orderkey AS _id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                  o_orderpriority AS priority, o_orderdate FROM orders),
target AS (SELECT _id, status, price, priority FROM o WHERE o_orderdate < TIMESTAMP '1998-01-01'),
payload AS (
  SELECT _id, status, CAST(price + 1 AS DECIMAL(18,2)) AS price, 'X-' || priority AS priority, 1 AS seq
  FROM o WHERE o_orderdate >= TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT _id, status, CAST(price + 2 AS DECIMAL(18,2)), 'Y-' || priority, 2
  FROM o WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND status = 'F'),
upd AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY _id ORDER BY seq DESC) AS rn FROM payload) WHERE rn = 1)
"""


@query("upsert_last_writer", None, SLICES_SQL + """
SELECT _id, status, CAST(price AS DOUBLE) AS price, priority FROM target t
WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u._id = t._id)
UNION ALL SELECT _id, status, CAST(price AS DOUBLE), priority FROM upd""")
def upsert_last_writer(t: Tables) -> DataFrame:
    """I-10 / N8: upsert; a key repeated in one payload -> the last wins."""
    target, payload = _orders_slices(t)
    return upsert(target, payload, ["_id"], seq_cols=["seq"])


@query("upsert_preserve_cols", None, SLICES_SQL + """
SELECT _id, status, CAST(price AS DOUBLE) AS price, priority FROM target t
WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u._id = t._id)
UNION ALL
SELECT u._id, u.status, CAST(u.price AS DOUBLE), COALESCE(t.priority, u.priority)
FROM upd u LEFT JOIN target t ON t._id = u._id""")
def upsert_preserve_cols(t: Tables) -> DataFrame:
    """N11: columns outside the update list keep the target's value."""
    target, payload = _orders_slices(t)
    return upsert(target, payload, ["_id"], update_cols=["status", "price"], seq_cols=["seq"])


@query("set_based_upsert", ["sd_docs", "sd_lines"], """,
f AS (SELECT d._id AS doc_id, d.doc_date, l.line_number, l.operation_id AS agr_operaciya_id, l.work_ha
      FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id WHERE d._posted = TRUE AND d._deletionmark = FALSE),
target AS (SELECT doc_id, line_number, agr_operaciya_id, work_ha FROM f WHERE doc_date < TIMESTAMP '1998-01-01'),
src AS (SELECT doc_id, line_number, agr_operaciya_id, work_ha + 1 AS work_ha FROM f
        WHERE doc_date >= TIMESTAMP '1997-01-01')
SELECT doc_id, line_number, agr_operaciya_id, CAST(work_ha AS DOUBLE) AS work_ha FROM target t
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.doc_id = t.doc_id AND s.line_number = t.line_number
                  AND s.agr_operaciya_id IS NOT DISTINCT FROM t.agr_operaciya_id)
UNION ALL SELECT doc_id, line_number, agr_operaciya_id, CAST(work_ha AS DOUBLE) FROM src""")
def set_based_upsert(t: Tables) -> DataFrame:
    """I-11 / N9 / N10: set-based upsert of the waybill fact on
    (doc, line, operation); the source is checked unique first, keys null-safe."""
    f = facts.waybill_work_fact(waybill_headers(t), waybill_lines(t)).select(
        "doc_id", "doc_date", "line_number", "agr_operaciya_id", F.col("obem_rabot_ga").alias("work_ha"))
    cut = lambda op, d: f.where(op(F.col("doc_date"), F.lit(d).cast("timestamp_ntz"))).drop("doc_date")
    target = cut(lambda a, b: a < b, "1998-01-01")
    src = cut(lambda a, b: a >= b, "1997-01-01").withColumn("work_ha", F.col("work_ha") + 1)
    return upsert_set_based(target, src, ["doc_id", "line_number", "agr_operaciya_id"])


@query("reconcile_orphans", ["sd_docs", "sd_lines"], """,
h0 AS (SELECT _id FROM sd_docs WHERE doc_date < TIMESTAMP '2000-01-01'),
missing AS (SELECT DISTINCT doc_id FROM sd_lines l WHERE NOT EXISTS (SELECT 1 FROM h0 WHERE h0._id = l.doc_id)),
fetched AS (SELECT _id FROM sd_docs WHERE _posted = TRUE AND _id IN (SELECT doc_id FROM missing)),
h AS (SELECT _id FROM h0 UNION ALL SELECT _id FROM fetched)
SELECT (SELECT COUNT(*) FROM h) AS headers,
       (SELECT COUNT(*) FROM sd_lines WHERE doc_id IN (SELECT _id FROM h)) AS kept_lines,
       (SELECT COUNT(*) FROM sd_lines WHERE doc_id NOT IN (SELECT _id FROM h)) AS orphan_lines""")
def reconcile_orphans(t: Tables) -> DataFrame:
    """I-07 / J-11 / Q-04 / U-02: lines against headers read on another date;
    missing headers re-read (posted only), remaining orphans counted."""
    d = t.sd_docs
    h0 = d.where(F.col("doc_date") < F.lit("2000-01-01").cast("timestamp_ntz")).select("_id")
    repair = d.where(F.col("_posted") == F.lit(True)).select("_id")
    headers, kept, orphans = pages.reconcile(h0, t.sd_lines.select("doc_id", "line_number"), repair)
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return headers.agg(F.count(F.lit(1)).alias("headers")).select(
        "headers", n(kept).alias("kept_lines"), n(orphans).alias("orphan_lines"))


@query("lookback_window", None, """
SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type FROM events
WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL 48 HOUR""")
def lookback_window(t: Tables) -> DataFrame:
    """I-03 / I-04: incremental read of the last 48 hours before the run."""
    ev = t.raw("events")
    run_ts = ev.agg(F.max("ts")).scalar()
    return pages.since(ev, "ts", pages.lookback_column(run_ts)).select("event_id", "ts", "user_id", "event_type")


DOC_SCHEMA = StructType([
    StructField("Ref_Key", LongType()), StructField("Date", TimestampNTZType()),
    StructField("UserId", LongType()), StructField("Kind", StringType()), StructField("Amount", DoubleType()),
    StructField("Lines", ArrayType(StructType([StructField("LineNumber", LongType()),
                                               StructField("K", LongType())]))),
])


@query("pages_roundtrip", None, """
SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, 1 AS line_number,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""")
def pages_roundtrip(t: Tables) -> DataFrame:
    """I-01 / I-02 / I-06: events landed as paged JSON documents (one table
    part line each), read back with a declared schema, exploded to lines."""
    ev = t.raw("events")
    docs = ev.select(
        F.floor(F.col("event_id") / 500).alias("page"),
        F.struct(F.col("event_id").alias("Ref_Key"), F.col("ts").alias("Date"), F.col("user_id").alias("UserId"),
                 F.col("event_type").alias("Kind"), F.col("value").alias("Amount"),
                 F.array(F.struct(F.lit(0).cast("long").alias("LineNumber"),
                                  F.get_json_object("props", "$.k").cast("long").alias("K"))).alias("Lines"),
                 F.lit("dropped by $select").alias("Unused")).alias("doc"))
    path = os.path.join(scratch_path(t.spark, "landing"), f"events-{uuid.uuid4().hex}")
    pages.write_pages(docs, path, "page")
    read = pages.read_pages(t.spark, path, DOC_SCHEMA, multi_line=False)
    headers = pages.project_entity(read, {"event_id": "Ref_Key", "ts": "Date", "user_id": "UserId",
                                          "event_type": "Kind", "value": "Amount", "Lines": "Lines"})
    headers = pages.first_seen(headers, "event_id")
    lines = pages.explode_lines(headers, "Lines", "event_id", {"k": "K"})
    return headers.drop("Lines", "_page", "_pos").join(
        lines.withColumnRenamed("doc_id", "event_id"), "event_id")


@query("schema_probe", None, """
SELECT COALESCE(n.column_name, o.column_name) AS column_name,
       CASE WHEN n.column_name IS NULL THEN 'missing' WHEN o.column_name IS NULL THEN 'extra' ELSE 'type' END AS status
FROM (DESCRIBE events) o
FULL JOIN (DESCRIBE SELECT * EXCLUDE (props) REPLACE (CAST(user_id AS VARCHAR) AS user_id), event_type AS session_id FROM events) n
  ON n.column_name = o.column_name
WHERE n.column_type IS DISTINCT FROM o.column_type""")
def schema_probe(t: Tables) -> DataFrame:
    """I-12 / Q-10: a copy of the events that lost a column, got one and
    changed the type of one, probed through its own file schema."""
    drifted = t.raw("events").drop("props").withColumns(
        {"user_id": F.col("user_id").cast("string"), "session_id": F.col("event_type")})
    # t.raw reads with the declared schema, which is what is expected
    return (pages.probe_schema(materialize(drifted, "drifted_events"), t.raw("events").schema)
            .withColumnRenamed("column", "column_name"))


@query("restore_from_backup", ["sd_items"], """
SELECT _id, description, source FROM (
  SELECT *, row_number() OVER (PARTITION BY _id ORDER BY prio) AS rn FROM (
    SELECT _id, description, 'current' AS source, 0 AS prio FROM sd_items WHERE _deletionmark = FALSE
    UNION ALL
    SELECT _id, description || ' (копия)', 'backup', 1 FROM sd_items))
WHERE rn = 1""")
def restore_from_backup(t: Tables) -> DataFrame:
    """U-03: restore a catalog from its backup: union, one row per id, the
    current copy preferred."""
    cur = dim_not_deleted(t.sd_items).select("_id", "description", F.lit("current").alias("source"),
                                             F.lit(0).alias("prio"))
    bak = t.sd_items.select("_id", F.concat("description", F.lit(" (копия)")).alias("description"),
                            F.lit("backup").alias("source"), F.lit(1).alias("prio"))
    return first_per_key(cur.unionByName(bak), "_id", [F.col("prio").asc()]).drop("prio")


NUMBER_TEXT = ("CASE WHEN p_size % 7 = 0 THEN 'abc ' || p_name WHEN p_size % 11 = 0 THEN '' "
               "WHEN p_size % 13 = 0 THEN 'null' "
               "ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) || "
               "CASE WHEN p_size % 2 = 0 THEN '456' ELSE '' END END")


@query("lenient_vs_strict_number", None, f"""
WITH x AS (SELECT p_partkey, {NUMBER_TEXT} AS t, CAST(p_size AS STRING) AS size_text FROM part)
SELECT p_partkey, t,
  CAST(TRY_CAST(TRY_CAST(CASE WHEN t IN ('', 'null') THEN NULL ELSE t END AS DOUBLE) AS DECIMAL(18,3)) AS DOUBLE)
    AS lenient,
  CAST(CAST(CASE WHEN regexp_full_match(t, '[0-9]+(\\.[0-9]+)?') THEN t END AS DECIMAL(18,3)) AS DOUBLE) AS strict,
  CAST(size_text AS INTEGER) AS size
FROM x""")
def lenient_vs_strict_number(t: Tables) -> DataFrame:
    """S-03 / S-04 / S-06: strict parse (fails on bad text, applied to numeric
    texts) versus lenient parse (bad text -> NULL)."""
    x = t.raw("part").selectExpr("p_partkey", f"{NUMBER_TEXT} AS t", "CAST(p_size AS STRING) AS size_text")
    numeric = F.when(F.col("t").rlike(r"^[0-9]+(\.[0-9]+)?$"), F.col("t"))
    return x.select("p_partkey", "t", lenient_decimal("t").alias("lenient"),
                    strict_decimal(numeric).alias("strict"), strict_int("size_text").alias("size"))


GUID_TEXT = ("CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN 'null' "
             "WHEN 2 THEN '00000000-0000-0000-0000-000000000000' WHEN 3 THEN ' ' WHEN 4 THEN NULL "
             "ELSE upper(event_type) || '-' || CAST(user_id AS STRING) END")


@query("norm_text_guid", None, f"""
WITH x AS (SELECT event_id, {GUID_TEXT} AS t FROM events)
SELECT event_id, t,
  CASE WHEN t IS NULL OR t IN ('', 'null') THEN NULL ELSE t END AS norm_text,
  NULLIF(lower(CASE WHEN t IS NULL OR t IN ('', 'null') THEN NULL ELSE t END),
         '00000000-0000-0000-0000-000000000000') AS norm_guid,
  NULLIF(t, '') AS falsy_null
FROM x""")
def norm_text_guid(t: Tables) -> DataFrame:
    """S-01 / S-02 / S-07: NULL-ish text and zero GUID normalisation."""
    x = t.raw("events").selectExpr("event_id", f"{GUID_TEXT} AS t")
    return x.select("event_id", "t", norm_text("t").alias("norm_text"), norm_guid("t").alias("norm_guid"),
                    falsy_to_null("t").alias("falsy_null"))
