"""Entity-driven load: pages with the source's field names -> raw tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.registry.base import query
from fieldbook.registry.standins import Tables
from fieldbook.session import scratch_path, shuffles_released
from fieldbook.sources import entities, pages


FILE_PAGES = 128          # a landed file holds so many pages at most: a compressed file is read by one task


def _paged(rows: DataFrame) -> DataFrame:
    """Rows (page, ...) as (page, rows)."""
    return rows.groupBy("page").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "page"])).alias("rows"))


def _land(t: Tables, name: str, *batches: DataFrame, doc: Callable[[Column], Column]) -> str:
    """Pages (page, rows) as landed JSON pages of ``doc(row)``, compressed, one
    sub-folder a batch in reading order.  Documents are made where their page
    is written, so only the rows' own columns are shuffled."""
    base = os.path.join(scratch_path(t.spark, "landing"), f"{name}-{uuid.uuid4().hex}")
    with shuffles_released(t.spark):
        for n, pages_ in enumerate(batches):
            (pages_.select(F.to_json(F.struct(F.transform("rows", doc).alias("value")), {"ignoreNullFields": "false"}).alias("value"))
             .write.options(compression="gzip", maxRecordsPerFile=FILE_PAGES).text(os.path.join(base, f"batch={n}")))
    return base


@query("entity_catalog_load", None, """
WITH d AS (
  SELECT p_partkey, p_size, p_brand, p_type, p_retailprice, p_name, p_size < 5 AS again FROM part),
k AS (
  SELECT CASE WHEN p_size = 50 THEN NULL ELSE 'u-' || p_partkey END AS id, p_size > 45 AS _deletionmark,
         CASE WHEN again THEN 'new ' || p_name WHEN p_size = 7 THEN NULL ELSE p_name END AS description, p_brand AS code,
         CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_retailprice AS DOUBLE) END AS weight_kg,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS volume_l, p_size % 10 = 0 AS bad, p_size = 50 AS no_key, p_type
  FROM d)
SELECT CASE WHEN bad THEN 'rejected' ELSE 'loaded' END AS state, id AS _id,
       CASE WHEN NOT bad THEN _deletionmark END AS _deletionmark, CASE WHEN NOT bad THEN description END AS description,
       CASE WHEN NOT bad THEN code END AS code, CASE WHEN NOT bad THEN weight_kg END AS weight_kg,
       CASE WHEN NOT bad THEN CAST(volume_l AS DOUBLE) END AS volume_l,
       CASE WHEN NOT bad THEN '{"Комментарий":"' || p_type || '"}' END AS rest,
       CASE WHEN bad THEN CASE WHEN no_key THEN 'no _id; ' ELSE '' END || 'not a number: weight_kg' END AS reasons
FROM k""")
def entity_catalog_load(t: Tables) -> DataFrame:
    """I-02 / I-09 / I-10: a catalog (units) from its pages: pruned fields,
    rules per column, keys sent again in a later batch (the last wins), unmapped
    fields kept, rows without a key or with an unreadable strict number rejected
    with their reasons."""
    part = t.raw("part").withColumn("page", F.floor(F.col("p_partkey") / 200))

    def docs(df, description):
        return df.select("page", F.struct(
            F.when(F.col("p_size") == 50, "").otherwise(F.concat(F.lit("u-"), F.col("p_partkey").cast("string"))).alias("Ref_Key"),
            (F.col("p_size") > 45).alias("DeletionMark"), description.alias("Description"), F.col("p_brand").alias("Code"),
            F.when(F.col("p_size") % 10 == 0, "н/д").otherwise(F.col("p_retailprice").cast("string")).alias("Вес"),
            F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("Объем"), F.col("p_type").alias("Комментарий")).alias("doc"))

    first = docs(part, F.when(F.col("p_size") == 7, "null").otherwise(F.col("p_name")))
    again = docs(part.where("p_size < 5"), F.concat(F.lit("new "), "p_name"))
    loaded = entities.load(t.spark, _land(t, "units", _paged(first), _paged(again), doc=lambda r: r["doc"]), entities.ENTITIES["units"])
    rows = loaded.rows.select(F.lit("loaded").alias("state"), "_id", "_deletionmark", "description", "code", "weight_kg",
                              "volume_l", F.col("_rest").alias("rest"), F.lit(None).cast("string").alias("reasons"))
    refused = loaded.rejects.select(F.lit("rejected").alias("state"), F.nullif(F.get_json_object("doc", "$.Ref_Key"), F.lit("")).alias("_id"),
                                    F.array_join("reasons", "; ").alias("reasons"))
    return rows.unionByName(refused, allowMissingColumns=True)


@query("entity_document_load", ["sd_docs", "sd_lines"], """
SELECT 'w-' || d._id AS doc_id, CAST(d.doc_date AS VARCHAR) AS doc_date, d._posted, CAST(d.total_amount AS DOUBLE) AS ves_brutto_kg,
       l.line_number, 'w-' || d._id || '-' || l.line_number AS line_key,
       CASE WHEN l.returnflag = 'A' THEN NULL ELSE CAST(l.qty AS DOUBLE) END AS massa_kg,
       CASE WHEN l.linestatus = 'F' THEN 'field-' || l.item_id END AS pole_id,
       CASE WHEN l.returnflag = 'A' THEN 'около ' || CAST(l.qty AS VARCHAR) END AS unread
FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id""")
def entity_document_load(t: Tables) -> DataFrame:
    """I-02 / I-06 / I-08: a document with a table part (weighings and their
    slips): numbers by the lenient rule, what it could not read kept as text,
    zero keys as no link, lines keyed by document and number."""
    zero = "00000000-0000-0000-0000-000000000000"
    none = F.lit(None).cast("string")
    lines = t.numbered_by("sd_lines", "page", "FLOOR(l_orderkey / 400)").where("doc_id IS NOT NULL")
    slips = lines.groupBy("page", "doc_id").agg(F.collect_list(F.struct("line_number", "linestatus", "item_id", "returnflag", "qty")).alias("slips"))
    slips = slips.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("doc_id", "slips"))).alias("slips"))
    docs = t.sd_docs.select(F.floor(F.col("_id") / 400).alias("page"), "_id", "_posted", "doc_number", "doc_date", "total_amount")
    slip = lambda s: F.struct(
        s["line_number"].alias("LineNumber"), F.when(s["linestatus"] == "F", F.concat(F.lit("field-"), s["item_id"].cast("string"))).otherwise(zero).alias("Поле_Key"),
        none.alias("НомерТалона"), none.alias("ТипТалона"),
        F.when(s["returnflag"] == "A", F.concat(F.lit("около "), s["qty"].cast("string"))).otherwise(s["qty"].cast("string")).alias("Масса"),
        F.lit(zero).alias("Комбайн_Key"), none.alias("Механизатор"), none.alias("ОбъемБункера"), none.alias("ПроцентЗаполнения"))
    weighing = lambda d: F.struct(
        F.concat(F.lit("w-"), d["_id"].cast("string")).alias("Ref_Key"), F.lit(False).alias("DeletionMark"), d["_posted"].alias("Posted"),
        d["doc_number"].alias("Number"), F.date_format(d["doc_date"], "yyyy-MM-dd'T'HH:mm:ss").alias("Date"), F.lit("СПоля").alias("ВидВзвешивания"),
        *[F.lit(zero).alias(c) for c in ("Откуда", "Куда", "Номенклатура_Key", "Водитель", "Автомобиль")], F.lit(0).alias("ВесТары"),
        d["total_amount"].cast("string").alias("ВесБрутто"), none.alias("ВесНетто"), none.alias("Автор_Key"),
        F.transform(F.col("slips")[d["_id"]], slip).alias("Талоны"))
    loaded = entities.load(t.spark, _land(t, "weighing", _paged(docs).join(slips, "page", "left"), doc=weighing), entities.ENTITIES["weighing"])
    head = loaded.rows.select(F.col("_id").alias("doc_id"), "doc_date", "_posted", "ves_brutto_kg")
    lines = loaded.lines["weighing_slips"].select("doc_id", "line_number", "line_key", "massa_kg", "pole_id",
                                                  F.col("_unparsed").getItem("massa_kg").alias("unread"))
    return head.join(lines, "doc_id")


@query("entity_two_part_load", ["sd_docs", "sd_lines"], """
, kept AS (
  SELECT _id, doc_number, doc_date FROM sd_docs WHERE doc_date >= TIMESTAMP '1995-06-01' OR (_id % 5 <> 0 AND EXISTS (
    SELECT 1 FROM sd_lines l WHERE l.doc_id = sd_docs._id AND l.ship_date >= TIMESTAMP '1995-06-01')))
SELECT 'b-' || l.doc_id AS doc_id, l.line_number, CAST(l.work_ha AS DOUBLE) AS work_ha,
       CASE WHEN k._id IS NULL THEN 'orphan' WHEN k.doc_date < TIMESTAMP '1995-06-01' THEN 'repaired' ELSE 'kept' END AS state,
       k.doc_number
FROM sd_lines l LEFT JOIN kept k ON k._id = l.doc_id WHERE l.ship_date >= TIMESTAMP '1995-06-01'""")
def entity_two_part_load(t: Tables) -> DataFrame:
    """I-03 / I-07 / I-14 / J-11: headers and work lines of a waybill read as two
    entities, each since its own date; headers that only a line knows are read
    again (four of five are still there), what is left over is counted."""
    start = F.lit("1995-06-01").cast("timestamp_ntz")
    none = F.lit(None).cast("string")
    key = lambda c: F.concat(F.lit("b-"), c.cast("string"))
    headers = t.sd_docs.select(F.floor(F.col("_id") / 400).alias("page"), "_id", "doc_date", "_posted", "doc_number")
    header = lambda d: F.struct(
        key(d["_id"]).alias("Ref_Key"), F.lit(False).alias("DeletionMark"), d["_posted"].alias("Posted"), d["doc_number"].alias("Number"),
        F.date_format(d["doc_date"], "yyyy-MM-dd'T'HH:mm:ss").alias("Date"), none.alias("ДатаНачалаРабот"), none.alias("ДатаОкончанияРабот"),
        none.alias("Техника_Key"), none.alias("Механизатор"), F.lit("1.5").alias("МоточасовВсего"), none.alias("Комментарий"))
    lines = t.numbered_by("sd_lines", "page", "FLOOR(l_orderkey / 400)").where(F.col("ship_date") >= start).select(
        "page", "doc_id", "line_number", "ship_date", "operation_id", "work_ha", "norm_ha")
    line = lambda r: F.struct(
        key(r["doc_id"]).alias("Ref_Key"), r["line_number"].alias("LineNumber"), r["ship_date"].cast("string").alias("ДеньРаботы"),
        r["operation_id"].cast("string").alias("ВидРаботы_Key"), none.alias("ЕдиницаДопОбъема_Key"),
        r["work_ha"].cast("string").alias("Гектаров"), r["norm_ha"].cast("string").alias("СменнаяНормаВыработки"))
    waybill = entities.ENTITIES["waybill"]
    late = headers.where(F.col("doc_date") >= start)
    head = entities.load(t.spark, _land(t, "waybill", _paged(late), doc=header), waybill).rows
    again = entities.load(t.spark, _land(t, "waybill-again", _paged(headers.where("_id % 5 <> 0")), doc=header), waybill).rows
    work = entities.load(t.spark, _land(t, "waybill-lines", _paged(lines), doc=line), entities.ENTITIES["waybill_lines"]).rows
    used = ["_id", "doc_number", "doc_date"]          # what is kept of the rows while they are matched
    head, kept, orphans = pages.reconcile(head.select(*used), work.select("doc_id", "line_number", "obem_rabot_ga"), again.select(*used))
    named = kept.join(head.select(F.col("_id").alias("doc_id"), "doc_number", "doc_date"), "doc_id")
    named = named.withColumn("state", F.when(F.col("doc_date").cast("timestamp_ntz") < start, "repaired").otherwise("kept"))
    out = ["doc_id", "line_number", F.col("obem_rabot_ga").alias("work_ha"), "state", "doc_number"]
    return named.select(*out).unionByName(orphans.withColumns({"state": F.lit("orphan"), "doc_number": none}).select(*out))
