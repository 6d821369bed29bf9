"""Queries of the remaining marts: catalogs read from pages, sheets, field
history, goods movement with its links, storage snapshot, out-of-order loads."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from fieldbook import schemas
from fieldbook.functions.normalize import norm_text, passthrough_decimal
from fieldbook.functions.parsers import parse_article
from fieldbook.plans import dims, facts, production, staging
from fieldbook.registry.base import query
from fieldbook.registry.movement import catalogs, movement_headers, movement_lines
from fieldbook.registry.standins import Tables
from fieldbook.session import materialize, scratch_path
from fieldbook.sources import pages
from fieldbook.sources.sheets import read_sheet
from fieldbook.sources.sinks import read_current
from fieldbook.streaming import ingest


def _folder(t: Tables, name: str) -> str:
    return os.path.join(scratch_path(t.spark, "marts"), f"{name}-{uuid.uuid4().hex}")


# --- catalog from pages ----------------------------------------------------

CATALOG_DOC = StructType([StructField("Ref_Key", StringType()), StructField("DeletionMark", BooleanType()),
                          StructField("Description", StringType()), StructField("Parent_Key", StringType()),
                          StructField("IsFolder", BooleanType())])
CATALOG_MAP = {"_id": "Ref_Key", "_deletionmark": "DeletionMark", "description": "Description", "parent_id": "Parent_Key"}


@query("catalog_without_folders", ["sd_items"], """
SELECT CAST(_id AS VARCHAR) AS _id, _deletionmark, description, CASE WHEN _id % 4 > 0 THEN unit_code END AS parent_id
FROM sd_items WHERE NOT (_id % 10 = 0)""")
def catalog_without_folders(t: Tables) -> DataFrame:
    """I-09: a catalog read from its pages; folder rows are skipped, a missing
    flag means "not a folder"; NULL-ish parents are cleared."""
    flag = F.when(F.col("_id") % 10 == 0, True).when(F.col("_id") % 10 < 6, False)
    parent = F.when(F.col("_id") % 4 > 0, F.col("unit_code")).otherwise("null")
    docs = t.sd_items.select(
        F.floor(F.col("_id") / 500).alias("page"),
        F.struct(F.col("_id").cast("string").alias("Ref_Key"), F.col("_deletionmark").alias("DeletionMark"),
                 F.col("description").alias("Description"), parent.alias("Parent_Key"), flag.alias("IsFolder")).alias("doc"))
    path = pages.write_pages(docs, _folder(t, "catalog"), "page")
    read = pages.drop_folders(pages.read_pages(t.spark, path, CATALOG_DOC, multi_line=False))
    return pages.project_entity(read, {**CATALOG_MAP, "parent_id": norm_text("Parent_Key")}).drop("_page", "_pos")


@query("item_article_parse", ["sd_items"], """
SELECT _id, unit_code AS kind, CAST(size AS VARCHAR) || '+' AS caliber, CASE WHEN _id % 3 > 0 THEN 'M' || _id END AS label
FROM sd_items""")
def item_article_parse(t: Tables) -> DataFrame:
    """S-29: kind, caliber and tail label of an item article."""
    label = F.when(F.col("_id") % 3 > 0, F.concat(F.lit("M"), F.col("_id").cast("string"))).otherwise("")
    article = F.concat("unit_code", F.lit("_G"), F.col("size").cast("string"), F.lit("+/x_"), label)
    return t.sd_items.select("_id", parse_article(article).alias("p")).select("_id", "p.*")


@query("catalog_numbers", None, """
SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,4)) AS DOUBLE) END AS weight_kg FROM part""")
def catalog_numbers(t: Tables) -> DataFrame:
    """S-05: typed catalog numbers pass; only NULL-ish text is cleared."""
    number = F.col("p_retailprice").cast("decimal(12,4)").cast("string")
    text = F.when(F.col("p_size") % 5 > 0, number).when(F.col("p_size") % 10 == 0, "null").otherwise("")
    return t.raw("part").select("p_partkey", passthrough_decimal(text).alias("weight_kg"))


@query("calendar_insert_if_absent", None, """
SELECT CAST(day AS VARCHAR) AS date_day, CAST(year(day) AS INTEGER) AS year
FROM (SELECT CAST(unnest(generate_series(MIN(l_shipdate)::DATE, MAX(l_shipdate)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM lineitem)
WHERE day < (SELECT MIN(o_orderdate)::DATE FROM orders) OR day > (SELECT MAX(o_orderdate)::DATE FROM orders)""")
def calendar_insert_if_absent(t: Tables) -> DataFrame:
    """M-07: days of the shipments that the calendar of the orders has not."""
    span = lambda table, day: t.raw(table).agg(F.min(day).alias("start"), F.max(day).alias("end"))
    have = dims.dim_date(span("orders", "o_orderdate"))
    return dims.dim_date_insert(have, dims.dim_date(span("lineitem", "l_shipdate"))).select("date_day", "year")


# --- sheets ----------------------------------------------------------------

def _sheet(t: Tables, name: str, rows: DataFrame) -> DataFrame:
    """``rows`` written as the CSV sheet ``name`` and read as users' sheets are."""
    fields = schemas.RAW[name].fields
    have = set(rows.columns)
    path = _folder(t, name)
    rows.select(*[F.col(f.name) if f.name in have else F.lit(None).cast("string").alias(f.name) for f in fields]) \
        .write.option("header", True).csv(path)
    return read_sheet(t.spark, path, schemas.RAW[name])


def shift_sheet(t: Tables) -> DataFrame:
    return _sheet(t, "sheet_shifts", t.raw("orders").selectExpr(
        "CAST(o_orderdate AS DATE) AS shift_date", "concat('master ', CAST(o_custkey % 9 AS STRING)) AS master",
        "CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS shift_code", "CAST(o_orderkey AS STRING) AS item_id",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS plan_kg", "CAST(o_totalprice - o_orderkey % 100 AS DECIMAL(18,2)) AS fact_kg",
        "CAST(8 AS DECIMAL(10,2)) AS plan_hours", "CAST(o_orderkey % 9 AS DECIMAL(10,2)) AS fact_hours"))


def downtime_sheet(t: Tables) -> DataFrame:
    return _sheet(t, "sheet_downtime", t.raw("events").selectExpr(
        "CAST(ts AS DATE) AS downtime_date", "concat('e', CAST(event_id AS STRING)) AS equipment_id",
        "CASE WHEN user_id % 5 > 0 THEN event_type END AS reason", "CAST(event_id % 7 AS DECIMAL(8,2)) AS duration_hours",
        "concat('master ', CAST(user_id % 9 AS STRING)) AS master", "'F' AS shift_code", "upper(event_type) AS reason_group"))


SHIFT_SQL = """
WITH made AS (SELECT *, 'master ' || o_custkey % 9 AS master, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS code FROM orders),
stops AS (SELECT *, 'master ' || user_id % 9 AS master FROM events),
shifts AS (
  SELECT master, code, row_number() OVER (ORDER BY master, code NULLS FIRST) AS shift_sk
  FROM (SELECT master, code FROM made UNION SELECT master, 'F' FROM stops))
"""


@query("dim_shift", None, SHIFT_SQL + "SELECT master, code AS shift_code, shift_sk FROM shifts")
def dim_shift(t: Tables) -> DataFrame:
    """M-10: master and shift code pairs of both sheets; a missing code is a value."""
    return production.dim_shift(shift_sheet(t), downtime_sheet(t))


@query("production_output", None, SHIFT_SQL + """
SELECT CAST(o_orderdate::DATE AS VARCHAR) AS date_day, shift_sk, o_orderkey::VARCHAR AS item_id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS plan_kg, cents / 100::DOUBLE AS fact_kg,
       CAST(o_orderkey % 9 AS DOUBLE) AS fact_hours,
       sign(cents) * ((2 * abs(cents) + hours) // (2 * hours)) / 100::DOUBLE AS productivity_kg_h
FROM (SELECT *, NULLIF(o_orderkey % 9, 0) AS hours,
             CAST(CAST(o_totalprice - o_orderkey % 100 AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents FROM made) m
JOIN shifts ON shifts.master = m.master AND shifts.code IS NOT DISTINCT FROM m.code""")
def production_output(t: Tables) -> DataFrame:
    """M-21 / I-13: plan and fact output per shift with productivity."""
    shifts = shift_sheet(t)
    items = t.raw("orders").select(F.col("o_orderkey").cast("string").alias("ref_key_1c"),
                                   F.col("o_orderkey").cast("string").alias("nom_sk"))
    out = production.production_output(shifts, materialize(production.dim_shift(shifts, downtime_sheet(t)), "dim_shift"), items)
    return out.select("date_day", "shift_sk", F.col("nom_sk").alias("item_id"), "plan_kg", "fact_kg", "fact_hours", "productivity_kg_h")


REASON_SQL = SHIFT_SQL.rstrip() + """,
reasons AS (
  SELECT event_type AS reason_name, upper(event_type) AS reason_group, row_number() OVER (ORDER BY event_type) AS reason_sk
  FROM events WHERE user_id % 5 > 0 AND event_type IS NOT NULL GROUP BY event_type)
"""


@query("dim_downtime_reason", None, REASON_SQL + "SELECT reason_name, reason_group, reason_sk FROM reasons")
def dim_downtime_reason(t: Tables) -> DataFrame:
    """M-10: downtime reasons of the sheet with their group."""
    return production.dim_downtime_reason(downtime_sheet(t))


@query("downtime_fact", None, REASON_SQL + """
SELECT CAST(ts::DATE AS VARCHAR) AS date_day, shift_sk, reason_sk, CAST(event_id % 7 AS DOUBLE) AS duration_h
FROM stops JOIN shifts USING (master) JOIN reasons ON reason_name = event_type WHERE code = 'F' AND user_id % 5 > 0""")
def downtime_fact(t: Tables) -> DataFrame:
    """M-21 / I-13: downtime per shift and reason; rows without a reason stay out."""
    down = downtime_sheet(t)
    shifts = materialize(production.dim_shift(shift_sheet(t), down), "dim_shift")
    reasons = materialize(production.dim_downtime_reason(down), "dim_reason")
    return production.downtime_fact(down, shifts, reasons).drop("src_sheet")


# --- field history ----------------------------------------------------------

@query("field_history_mart", ["sd_field_history"], """,
used AS (SELECT * FROM sd_field_history WHERE line_number % 7 > 0),
span AS (SELECT max(greatest(year, year(valid_from), coalesce(year(valid_to), 0))) AS last_year FROM used)
SELECT field_id, line_number, crop, CAST(sown_area_ha AS DOUBLE) AS sown_area_ha,
       CAST(unnest(CASE WHEN year > 0 THEN [year::BIGINT]
                   ELSE range(year(valid_from), greatest(coalesce(year(valid_to), last_year), year(valid_from)) + 1) END) AS BIGINT) AS year
FROM used, span""")
def field_history_mart(t: Tables) -> DataFrame:
    """M-23 / I-14: areas and crops per year from the history entities; unused
    lines go, year-0 lines take the years of their validity, to the last year
    of the history while they are in force."""
    unused = F.when(F.col("line_number") % 7 == 0, True).when(F.col("line_number") % 2 == 0, False)
    h = t.sd_field_history.withColumns({"unused": unused, "total_area_ha": F.col("sown_area_ha")})
    return production.field_history_mart(h).drop("total_area_ha")


# --- goods movement ----------------------------------------------------------

def movement_linked(t: Tables) -> DataFrame:
    # a line's links come from its own row: no join of the lines with themselves
    lines = movement_lines(t, sender_id=F.col("machine_id"), recipient_id=(F.col("item_id") + F.col("doc_id")) % 97,
                           cost_object_id=F.col("operation_id"))
    items, units = catalogs(t)
    units = units.withColumns({"weight_kg": F.col("_id") % 9, "volume_l": F.col("_id") % 4})
    moved = facts.tmc_movement(staging.stg_movement_lines(movement_headers(t), lines), items, units)
    warehouses = t.sd_machines.select("_id", F.col("name").alias("description"))
    return facts.movement_links(moved, warehouses, t.sd_operations.select("_id", "description"))


LINKED_SQL = """,
line AS (
  SELECT doc_id, line_number, CAST(doc_date AS DATE) AS day, item_id, machine_id AS sender, (item_id + doc_id) % 97 AS recipient, operation_id,
         (item_id + machine_id) % 50 + 1 AS unit,
         IF(operaciya IN ('ПередачаПродукцииИзПроизводства', 'ПередачаМатериаловВКладовую'), 1, -1) AS turn, qty
  FROM sd_lines JOIN sd_docs ON doc_id = _id WHERE _posted AND _deletionmark IS NOT TRUE)
"""


@query("movement_links", ["sd_docs", "sd_lines", "sd_items", "sd_machines", "sd_operations"], LINKED_SQL + """
SELECT doc_id, line_number, s.name AS sender, r.name AS recipient, o.description AS cost_object,
       u._id % 9 AS weight_kg, u._id % 4 AS volume_l, IF(turn > 0, recipient, sender) AS posted_warehouse_id
FROM line LEFT JOIN sd_machines s ON s._id = sender LEFT JOIN sd_machines r ON r._id = recipient
LEFT JOIN sd_operations o ON o._id = operation_id LEFT JOIN sd_items u ON u._id = unit AND u._deletionmark IS FALSE""")
def movement_links(t: Tables) -> DataFrame:
    """J-12 / M-17: movement lines with both warehouses, cost object and the
    unit's weight and volume; every line is kept."""
    return movement_linked(t).select("doc_id", "line_number", "sender", "recipient", "cost_object", "weight_kg", "volume_l",
                                     "posted_warehouse_id")


@query("storage_snapshot", ["sd_docs", "sd_lines"], LINKED_SQL + """,
day AS (SELECT IF(turn > 0, recipient, sender) AS warehouse_id, item_id, day, SUM(turn * qty) AS moved FROM line GROUP BY 1, 2, 3),
spine AS (SELECT warehouse_id, item_id, CAST(unnest(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS DATE) AS day FROM day GROUP BY 1, 2)
SELECT warehouse_id, item_id AS nomenklatura_id, CAST(day AS VARCHAR) AS date_day, CAST(IFNULL(moved, 0) AS DOUBLE) AS qty_day,
       CAST(SUM(IFNULL(moved, 0)) OVER (PARTITION BY warehouse_id, item_id ORDER BY day) AS DOUBLE) AS balance
FROM spine LEFT JOIN day USING (warehouse_id, item_id, day)""")
def storage_snapshot(t: Tables) -> DataFrame:
    """M-22: balance of every day between a pair's first and last movement;
    what leaves is posted to the sender, what arrives to the recipient."""
    m = movement_linked(t).withColumn("warehouse_id", F.col("posted_warehouse_id"))
    return facts.storage_balance(m, "warehouse_id", "nomenklatura_id", densify=True)


@query("dim_warehouse", ["sd_machines"], """
SELECT CAST(_id AS VARCHAR) AS code_1c, name, row_number() OVER (ORDER BY CAST(_id AS VARCHAR)) AS wh_sk
FROM sd_machines WHERE nation % 4 > 1""")
def dim_warehouse(t: Tables) -> DataFrame:
    """M-10 / M-11: warehouses that are not marked deleted (an unknown mark counts
    as deleted here), with dense keys."""
    catalog = t.sd_machines.select(F.col("_id").cast("string").alias("_id"), F.col("name").alias("description"),
                                   F.expr("CASE nation % 4 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END").alias("_deletionmark"))
    return dims.simple_dim(catalog, {"code_1c": "_id", "name": "description"}, ["code_1c"], "wh_sk")


# --- out-of-order loads ------------------------------------------------------

@query("stream_out_of_order", None, """
SELECT CAST(date_trunc('month', ts)::DATE AS VARCHAR) AS month, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2""")
def stream_out_of_order(t: Tables) -> DataFrame:
    """W-01 / W-03: the later half of the events is streamed before the earlier
    half.  The keyed table has no watermark, so rows that come late count in
    their month, and rows sent twice count once."""
    events, base = t.raw("events"), _folder(t, "late")
    landing = os.path.join(base, "landing")
    target, ckpt, log = ingest.stream_paths(base)
    middle = events.agg(F.percentile_approx(F.col("ts").cast("timestamp"), 0.5)).scalar().cast("timestamp_ntz")
    overlap = F.col("event_id") % 5 == 0                  # sent with both loads
    for load in (events.where((F.col("ts") >= middle) | overlap), events.where((F.col("ts") < middle) | overlap)):
        load.write.mode("append").parquet(landing)
        ingest.run_to_end(ingest.stream_upsert(t.spark, landing, events.schema, target, ckpt, ["event_id"], ["ts"],
                                               fmt="parquet", entity="events", log_dir=log))
    return (read_current(t.spark, target).groupBy(F.trunc(F.to_date("ts"), "month").alias("month"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value")))
