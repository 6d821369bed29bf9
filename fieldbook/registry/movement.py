"""Goods-movement queries: split facts, classified movement, balances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import TOTAL_LABEL
from fieldbook.operators.aggregates import with_total_row
from fieldbook.operators.predicates import dim_not_deleted
from fieldbook.plans import facts, quality, reports, staging
from fieldbook.sources import pages
from fieldbook.registry.base import query
from fieldbook.registry.standins import Tables

M_SD = ["sd_docs", "sd_lines", "sd_items"]


def movement_headers(t: Tables) -> DataFrame:
    return t.sd_docs.select("_id", "_posted", "_deletionmark", "doc_number", "doc_date")


def movement_lines(t: Tables, **more: Column) -> DataFrame:
    return t.sd_lines.select("doc_id", "line_number", F.col("item_id").alias("nomenklatura_id"),
                             ((F.col("item_id") + F.col("machine_id")) % 50 + 1).alias("edinica_id"),
                             F.col("qty").alias("kolichestvo"),
                             F.col("amount").alias("summa"), "operaciya",
                             F.col("machine_id").alias("warehouse_id"), *[c.alias(n) for n, c in more.items()])


def catalogs(t: Tables):
    items = dim_not_deleted(t.sd_items).select("_id", "description")
    units = dim_not_deleted(t.sd_items).select("_id", F.col("unit_name").alias("description"),
                                               F.col("unit_code").alias("code"))
    return items, units


def tmc(t: Tables) -> DataFrame:
    stg = staging.stg_movement_lines(movement_headers(t), movement_lines(t))
    items, units = catalogs(t)
    return facts.tmc_movement(stg, items, units)


MOVE_SQL = """,
mv AS (SELECT d._id AS doc_id, d.doc_number, d.doc_date, d._posted, d._deletionmark, l.line_number,
              l.item_id AS nomenklatura_id, (l.item_id + l.machine_id) % 50 + 1 AS edinica_id, l.qty AS kolichestvo,
              l.amount AS summa, l.operaciya, l.machine_id AS warehouse_id
       FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id),
iv AS (SELECT _id, description, unit_name, unit_code FROM sd_items WHERE _deletionmark = FALSE),
tmc AS (
  SELECT a.*,
    CASE a.operaciya WHEN 'ПередачаМатериаловВПроизводство' THEN 'material_issue_to_production'
      WHEN 'ПередачаПродукцииИзПроизводства' THEN 'production_receipt'
      WHEN 'ПередачаМатериаловВКладовую' THEN 'material_return_to_warehouse'
      WHEN 'ПередачаПродукцииИзКладовой' THEN 'product_issue_from_warehouse' END AS movement_type,
    CASE a.operaciya WHEN 'ПередачаМатериаловВПроизводство' THEN -1 WHEN 'ПередачаПродукцииИзПроизводства' THEN 1
      WHEN 'ПередачаМатериаловВКладовую' THEN 1 WHEN 'ПередачаПродукцииИзКладовой' THEN -1 END AS quantity_sign,
    COALESCE(it.description, '[Не загружено из 1С] ' || CAST(a.nomenklatura_id AS VARCHAR)) AS nomenclature,
    it.description IS NOT NULL AS is_nomenclature_resolved,
    COALESCE(u.unit_name, 'Не определена') AS uom_name, u.unit_code AS uom_code
  FROM mv a LEFT JOIN iv it ON it._id = a.nomenklatura_id LEFT JOIN iv u ON u._id = a.edinica_id
  WHERE COALESCE(a._deletionmark, FALSE) = FALSE AND COALESCE(a._posted, FALSE) = TRUE),
tmc2 AS (SELECT *, kolichestvo * quantity_sign AS quantity_signed FROM tmc)
"""


@query("movement_lines_clean", ["sd_docs", "sd_lines"], """
SELECT d._id AS doc_id, l.line_number, CAST(d._id AS VARCHAR) || '_' || CAST(l.line_number AS VARCHAR) AS line_key,
       d._posted, d._deletionmark,
       COALESCE(d._deletionmark, FALSE) = FALSE AND COALESCE(d._posted, FALSE) AS is_active
FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id""")
def movement_lines_clean(t: Tables) -> DataFrame:
    """M-05 / I-08: header x lines, flags carried, no filter (rows in = rows
    out), with the composite line key."""
    s = staging.stg_movement_lines(movement_headers(t), movement_lines(t))
    return s.select("doc_id", "line_number", pages.line_key("doc_id", "line_number", "_").alias("line_key"),
                    "_posted", "_deletionmark", "is_active")


@query("split_by_operation", ["sd_docs", "sd_lines"], """,
act AS (SELECT l.* FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id
        WHERE d._posted = TRUE AND d._deletionmark = FALSE)
SELECT CASE operaciya WHEN 'ПередачаМатериаловВПроизводство' THEN 'material_issue'
                      WHEN 'ПередачаПродукцииИзПроизводства' THEN 'harvest_receipt'
                      ELSE 'other_movement' END AS fact,
       COUNT(*) AS rows, CAST(SUM(qty) AS DOUBLE) AS quantity, CAST(SUM(amount) AS DOUBLE) AS amount
FROM act GROUP BY 1""")
def split_by_operation(t: Tables) -> DataFrame:
    """M-12 / P-05: active lines split into material issue / harvest receipt / other."""
    parts = facts.split_movement(movement_headers(t), movement_lines(t))
    aggs = [df.agg(F.count(F.lit(1)).alias("rows"), F.sum("kolichestvo").alias("quantity"),
                   F.sum("summa").alias("amount")).select(F.lit(name).alias("fact"), "*")
            for name, df in parts.items()]
    return reduce(DataFrame.unionByName, aggs)


@query("material_issue_fact", ["sd_docs", "sd_lines"], """
SELECT d._id AS doc_id, d.doc_number, CAST(d.doc_date AS VARCHAR) AS doc_date, l.line_number,
       l.item_id AS nomenklatura_id, CAST(l.qty AS DOUBLE) AS kolichestvo, CAST(l.amount AS DOUBLE) AS summa
FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id
WHERE d._posted = TRUE AND d._deletionmark = FALSE AND l.operaciya = 'ПередачаМатериаловВПроизводство'""")
def material_issue_fact(t: Tables) -> DataFrame:
    """M-12 first branch as fact rows."""
    f = facts.split_movement(movement_headers(t), movement_lines(t))["material_issue"]
    return f.select("doc_id", "doc_number", "doc_date", "line_number", "nomenklatura_id", "kolichestvo", "summa")


@query("tmc_movement", M_SD, MOVE_SQL + """
SELECT doc_id, line_number, movement_type, quantity_sign, CAST(quantity_signed AS DOUBLE) AS quantity_signed,
       nomenclature, is_nomenclature_resolved, uom_name, uom_code
FROM tmc2""")
def tmc_movement(t: Tables) -> DataFrame:
    """M-17 / J-12 / S-30 / S-31 / S-32: classified active movement lines."""
    return tmc(t).select("doc_id", "line_number", "movement_type", "quantity_sign", "quantity_signed",
                         "nomenclature", "is_nomenclature_resolved", "uom_name", "uom_code")


@query("movement_by_type", M_SD, MOVE_SQL + """,
g AS (SELECT movement_type, COUNT(*) AS rows, COUNT(*) FILTER (WHERE is_nomenclature_resolved) AS item_resolved,
             COUNT(*) FILTER (WHERE NOT is_nomenclature_resolved) AS item_unresolved,
             COUNT(uom_code) AS unit_resolved
      FROM tmc2 GROUP BY 1)
SELECT * FROM g
UNION ALL SELECT 'Итого', CAST(SUM(rows) AS BIGINT), CAST(SUM(item_resolved) AS BIGINT),
                 CAST(SUM(item_unresolved) AS BIGINT), CAST(SUM(unit_resolved) AS BIGINT) FROM g""")
def movement_by_type(t: Tables) -> DataFrame:
    """G-09 / U-01: movement by type with resolution counts and a total row, in one pass."""
    return with_total_row(tmc(t), "movement_type", [
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_nomenclature_resolved")).alias("item_resolved"),
        F.count_if(~F.col("is_nomenclature_resolved")).alias("item_unresolved"),
        F.count("uom_code").alias("unit_resolved")], TOTAL_LABEL)


@query("movement_by_unit", M_SD, MOVE_SQL + """
SELECT edinica_id, uom_name, uom_code, COUNT(*) AS rows, CAST(SUM(kolichestvo) AS DOUBLE) AS quantity
FROM tmc2 GROUP BY 1, 2, 3""")
def movement_by_unit(t: Tables) -> DataFrame:
    """G-10: rows and quantity per unit."""
    return reports.movement_by_unit(tmc(t))


@query("movement_summary", M_SD, MOVE_SQL + """
SELECT CAST(CAST(doc_date AS DATE) AS VARCHAR) AS day, movement_type, warehouse_id, nomenklatura_id, nomenclature, edinica_id, uom_name,
       CAST(SUM(quantity_signed) AS DOUBLE) AS quantity_signed, COUNT(*) AS rows
FROM tmc2 GROUP BY ALL""")
def movement_summary(t: Tables) -> DataFrame:
    """R-18: movement by date, type, warehouse, item and unit."""
    return reports.movement_summary(tmc(t))


@query("top_items_per_unit", M_SD, MOVE_SQL + """
SELECT uom_name, nomenclature, CAST(quantity AS DOUBLE) AS quantity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT uom_name, nomenclature, SUM(kolichestvo) AS quantity,
         row_number() OVER (PARTITION BY uom_name ORDER BY SUM(kolichestvo) DESC, nomenclature) AS rank
  FROM tmc2 WHERE is_nomenclature_resolved AND uom_name IS NOT NULL AND uom_name <> 'Не определена' GROUP BY 1, 2)
WHERE rank <= 15""")
def top_items_per_unit(t: Tables) -> DataFrame:
    """R-19 / P-09: top items among resolved rows, per unit."""
    return reports.top_items_per_unit(tmc(t), 15)


@query("unresolved_monitor", M_SD, MOVE_SQL + """
SELECT movement_type, COUNT(*) AS rows, COUNT(*) FILTER (WHERE NOT is_nomenclature_resolved) AS unresolved,
       CAST(COUNT(*) FILTER (WHERE NOT is_nomenclature_resolved) AS DOUBLE) / COUNT(*) AS unresolved_share,
       COUNT(*) - COUNT(uom_code) AS units_unresolved, CAST(COUNT(*) - COUNT(uom_code) AS DOUBLE) / COUNT(*) AS units_unresolved_share
FROM tmc2 GROUP BY 1""")
def unresolved_monitor(t: Tables) -> DataFrame:
    """R-21 / K-06: unresolved item and unit shares by movement type."""
    return reports.unresolved_monitor(tmc(t))


@query("running_balance", M_SD, MOVE_SQL + """,
daily AS (SELECT warehouse_id, nomenklatura_id, CAST(doc_date AS DATE) AS date_day,
                 SUM(quantity_signed) AS qty_day FROM tmc2 GROUP BY 1, 2, 3)
SELECT warehouse_id, nomenklatura_id, CAST(date_day AS VARCHAR) AS date_day, CAST(qty_day AS DOUBLE) AS qty_day,
       CAST(SUM(qty_day) OVER (PARTITION BY warehouse_id, nomenklatura_id ORDER BY date_day
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS balance
FROM daily""")
def running_balance(t: Tables) -> DataFrame:
    """M-22: balance per warehouse and item after each movement day."""
    return facts.storage_balance(tmc(t), "warehouse_id", "nomenklatura_id")


@query("unit_mixing_check", M_SD, MOVE_SQL + """
SELECT movement_type, COUNT(DISTINCT uom_name) AS units FROM tmc2 GROUP BY 1 HAVING COUNT(DISTINCT uom_name) > 1""")
def unit_mixing_check(t: Tables) -> DataFrame:
    """Q-14 / N21: groups whose quantities span several units."""
    return quality.unit_mixing(tmc(t), ["movement_type"], "uom_name")


@query("field_material_usage", ["sd_docs", "sd_lines", "sd_fields", "sd_items"], r""",
wo AS (
  SELECT d._id, d.doc_date, d.sender_text AS otpravitel_text, l.item_id AS nomenklatura_id, l.qty AS kolichestvo,
         (l.item_id + l.machine_id) % 50 + 1 AS edinica_id,
         COALESCE(CASE WHEN regexp_matches(d.sender_text, '(?i)^Поле\s+')
                       THEN NULLIF(TRIM(regexp_replace(d.sender_text, '(?i)^Поле\s+', '')), '') END,
                  NULLIF(TRIM(split_part(d.sender_text, ',', 1)), '')) AS pole_nomer
  FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id
  WHERE COALESCE(d._deletionmark, FALSE) = FALSE),
wo2 AS (SELECT w.*, f._id AS pole_id FROM wo w LEFT JOIN sd_fields f ON f.description = w.pole_nomer)
SELECT CAST(CAST(w.doc_date AS DATE) AS VARCHAR) AS date_day, w.pole_id, w.nomenklatura_id, it.description AS item_name,
       w.edinica_id, u.unit_name, CAST(SUM(w.kolichestvo) AS DOUBLE) AS quantity
FROM wo2 w LEFT JOIN sd_items it ON it._id = w.nomenklatura_id
LEFT JOIN sd_items u ON u._id = w.edinica_id AND u._deletionmark = FALSE
GROUP BY ALL""")
def field_material_usage(t: Tables) -> DataFrame:
    """M-03 + M-20: write-off lines resolved to fields by sender text, summed
    per day, field, item and unit."""
    h = t.sd_docs.select("_id", "_deletionmark", "doc_date", F.col("sender_text").alias("otpravitel_text"))
    ln = t.sd_lines.select("doc_id", F.col("item_id").alias("nomenklatura_id"), F.col("qty").alias("kolichestvo"),
                           ((F.col("item_id") + F.col("machine_id")) % 50 + 1).alias("edinica_id"))
    w = staging.stg_writeoff(h, ln, t.sd_fields)
    items = t.sd_items.select("_id", "description")
    _, units = catalogs(t)
    return facts.material_usage(w, items, units)


@query("harvest_receipt_bi", M_SD, """,
iv AS (SELECT _id, description, unit_name FROM sd_items WHERE _deletionmark = FALSE),
f AS (SELECT d._id AS doc_id, l.line_number, l.item_id AS nomenklatura_id, (l.item_id + l.machine_id) % 50 + 1 AS unit_id,
             l.qty AS kolichestvo
      FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id
      WHERE d._posted = TRUE AND d._deletionmark = FALSE AND l.operaciya = 'ПередачаПродукцииИзПроизводства')
SELECT f.doc_id, f.line_number, CAST(f.kolichestvo AS DOUBLE) AS kolichestvo,
       COALESCE(it.description, '[Не загружено из 1С] ' || CAST(f.nomenklatura_id AS VARCHAR)) AS nomenclature,
       COALESCE(u.unit_name, 'Не определена') AS uom_name
FROM f LEFT JOIN iv it ON it._id = f.nomenklatura_id LEFT JOIN iv u ON u._id = f.unit_id""")
def harvest_receipt_bi(t: Tables) -> DataFrame:
    """M-18: BI view of the harvest-receipt fact (all fact rows kept)."""
    f = facts.split_movement(movement_headers(t), movement_lines(t))["harvest_receipt"]
    items, units = catalogs(t)
    return facts.movement_fact_bi(f, items, units).select("doc_id", "line_number", "kolichestvo", "nomenclature",
                                                          "uom_name")


@query("load_counters", ["sd_docs", "sd_lines"], """
SELECT (SELECT COUNT(*) FROM sd_docs) AS docs, (SELECT COUNT(*) FROM sd_lines) AS lines""")
def load_counters(t: Tables) -> DataFrame:
    """G-13 / Q-01: documents and lines of a load."""
    return quality.load_counts(t.sd_docs, t.sd_lines)
