"""Field-work queries: waybill documents x lines -> work report -> dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators import predicates as P
from fieldbook.operators.aggregates import count_if
from fieldbook.operators.joins import self_parent_join
from fieldbook.plans import facts, metrics, reports
from fieldbook.registry.base import query
from fieldbook.registry.standins import Tables

WORK_SD = ["sd_docs", "sd_lines", "sd_machines", "sd_people", "sd_operations", "sd_operation_groups"]


def waybill_headers(t: Tables) -> DataFrame:
    d = t.sd_docs
    return d.select("_id", "_posted", "_deletionmark", "doc_number", "doc_date",
                    F.col("person_id").alias("voditel_id"),
                    F.col("fuel_issued").alias("toplivo_vydano"),
                    F.col("fuel_returned").alias("toplivo_vozvrat"))


def waybill_lines(t: Tables) -> DataFrame:
    return t.sd_lines.select("doc_id", "line_number", F.col("machine_id").alias("tehnika_id"),
                             F.col("operation_id").alias("agr_operaciya_id"),
                             F.col("work_ha").alias("obem_rabot_ga"), F.col("norm_ha").alias("norma_vyrabotki"))


def equipment(t: Tables) -> DataFrame:
    return t.sd_machines.select(F.col("_id").alias("code_1c"), "name", "eq_type")


def work_dataset(t: Tables) -> DataFrame:
    fact = facts.waybill_work_fact(waybill_headers(t), waybill_lines(t))
    return facts.work_report(fact, equipment(t), t.sd_people, t.tech_operations())


# SQL building blocks of the oracle
# (labels of every catalog stand in one list; a line looks each of its ids up
# there, a missing label falls back to the id, and the percentage is rounded
# in whole numbers)
FACT_SQL = """
ops AS (FROM sd_operations UNION ALL FROM sd_operation_groups),
label AS (
  SELECT 'machine' AS what, CAST(_id AS VARCHAR) AS id, name AS text, eq_type AS detail, NULL AS parent FROM sd_machines
  UNION ALL SELECT 'person', CAST(individual_id AS VARCHAR), description, NULL, NULL FROM sd_people
  UNION ALL SELECT 'operation', CAST(_id AS VARCHAR), description, CAST(operation_kind AS VARCHAR), CAST(parent_id AS VARCHAR) FROM ops),
active AS (SELECT _id, doc_number, doc_date, person_id FROM sd_docs WHERE _posted IS TRUE AND _deletionmark IS FALSE),
task AS (
  SELECT active.*, line_number, work_ha, norm_ha, CAST(machine_id AS VARCHAR) AS machine,
         CAST(person_id AS VARCHAR) AS person, CAST(operation_id AS VARCHAR) AS operation,
         CAST(work_ha * 10000 AS BIGINT) AS work_u, CAST(norm_ha * 1000 AS BIGINT) AS norm_u
  FROM sd_lines JOIN active ON doc_id = _id WHERE work_ha > 0),
w AS (
  SELECT doc_date::DATE AS work_date, make_date(CAST(year(doc_date) AS BIGINT), CAST(month(doc_date) AS BIGINT), 1) AS month,
         _id::VARCHAR AS source_doc_id, doc_number AS document_no, line_number,
         work_ha AS work_area_ha, norm_ha AS work_norm_ha,
         IF(norm_u > 0, (200 * work_u + norm_u) // (2 * norm_u) / 10.0::DOUBLE, NULL) AS norm_completion_pct,
         machine AS equipment_id, IFNULL(m.text, machine) AS equipment, IFNULL(m.detail, 'Не определён') AS equipment_type,
         person AS employee_id, IFNULL(h.text, person) AS employee,
         operation AS operation_id, IFNULL(o.text, operation) AS operation_name,
         o.detail AS operation_code, CAST(o.parent AS BIGINT) AS operation_group_id, IFNULL(g.text, 'Без группы') AS operation_group
  FROM task
  LEFT JOIN label g ON g.what = 'operation' AND g.id = (
    SELECT any_value(x.parent) FROM label x WHERE x.what = 'operation' AND x.id = task.operation)
  LEFT JOIN label o ON (o.what, o.id) = ('operation', operation)
  LEFT JOIN label h ON (h.what, h.id) = ('person', person)
  LEFT JOIN label m ON (m.what, m.id) = ('machine', machine))
"""


def _with(sql_tail: str) -> str:
    """Continue the stand-in WITH clause with the fact/report CTEs."""
    return "," + FACT_SQL + sql_tail


@query("strict_active_docs", ["sd_docs"], """
SELECT _id, doc_number, CAST(doc_date AS VARCHAR) AS doc_date FROM sd_docs
WHERE _posted = TRUE AND _deletionmark = FALSE""")
def strict_active_docs(t: Tables) -> DataFrame:
    """P-01 / N1: posted and not deleted; a NULL flag drops the row."""
    return P.strict_active(t.sd_docs).select("_id", "doc_number", "doc_date")


@query("tolerant_not_deleted", ["sd_docs"], """
SELECT _id, _posted FROM sd_docs WHERE COALESCE(_deletionmark, FALSE) = FALSE""")
def tolerant_not_deleted(t: Tables) -> DataFrame:
    """P-02 / N2: NULL deletion mark counts as not deleted; posting ignored."""
    return P.tolerant_not_deleted(t.sd_docs).select("_id", "_posted")


@query("tolerant_active_docs", ["sd_docs"], """
SELECT _id FROM sd_docs WHERE COALESCE(_deletionmark, FALSE) = FALSE AND COALESCE(_posted, FALSE) = TRUE""")
def tolerant_active_docs(t: Tables) -> DataFrame:
    """P-03 / N3: both flags tolerant."""
    return P.tolerant_active(t.sd_docs).select("_id")


@query("dim_view_not_deleted", ["sd_items"], """
SELECT _id, description FROM sd_items WHERE _deletionmark = FALSE""")
def dim_view_not_deleted(t: Tables) -> DataFrame:
    """P-04 / N4 / M-11: dimension views drop NULL marks too."""
    return P.dim_not_deleted(t.sd_items).select("_id", "description")


@query("header_lines_inner", ["sd_docs", "sd_lines"], """
SELECT d._id AS doc_id, d.doc_number, CAST(d.doc_date AS VARCHAR) AS doc_date, l.line_number,
       l.machine_id AS tehnika_id, l.operation_id AS agr_operaciya_id,
       CAST(l.work_ha AS DOUBLE) AS obem_rabot_ga, CAST(l.norm_ha AS DOUBLE) AS norma_vyrabotki,
       d.person_id AS voditel_id, CAST(d.fuel_issued AS DOUBLE) AS toplivo_vydano,
       CAST(d.fuel_returned AS DOUBLE) AS toplivo_vozvrat
FROM sd_docs d JOIN sd_lines l ON l.doc_id = d._id
WHERE d._posted = TRUE AND d._deletionmark = FALSE""")
def header_lines_inner(t: Tables) -> DataFrame:
    """J-01 + M-13: active waybill lines with header measures repeated."""
    return facts.waybill_work_fact(waybill_headers(t), waybill_lines(t))


@query("work_report", WORK_SD, _with("""
SELECT CAST(work_date AS VARCHAR) AS work_date, CAST(month AS VARCHAR) AS month, document_no, line_number,
       equipment_id, equipment, equipment_type, employee_id, employee, operation_id,
       CAST(work_area_ha AS DOUBLE) AS work_area_ha, CAST(work_norm_ha AS DOUBLE) AS work_norm_ha,
       CAST(norm_completion_pct AS DOUBLE) AS norm_completion_pct, source_doc_id, operation_name,
       operation_code, operation_group_id, operation_group
FROM w"""))
def work_report(t: Tables) -> DataFrame:
    """M-15 with J-04, J-05, S-13, S-14, S-22, S-23, P-07."""
    return work_dataset(t)


@query("self_join_parent", ["sd_operations", "sd_operation_groups"], """,
ops AS (SELECT * FROM sd_operations UNION ALL SELECT * FROM sd_operation_groups)
SELECT o._id, o.description, o.parent_id, p.description AS parent_description
FROM ops o LEFT JOIN ops p ON p._id = o.parent_id""")
def self_join_parent(t: Tables) -> DataFrame:
    """J-05: one level of the operation hierarchy."""
    ops = t.tech_operations()
    return self_parent_join(ops, "_id", "parent_id", ["description"], prefix="parent_").select(
        "_id", "description", "parent_id", "parent_description")


@query("norm_by_month_group", WORK_SD, _with("""
SELECT CAST(month AS VARCHAR) AS month, operation_group,
       CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha, CAST(SUM(work_norm_ha) AS DOUBLE) AS work_norm_ha,
       COUNT(DISTINCT source_doc_id) AS documents,
       CAST(CASE WHEN SUM(work_norm_ha) > 0 THEN ROUND(100.0 * SUM(work_area_ha) / SUM(work_norm_ha), 1) END AS DOUBLE)
         AS norm_completion_pct
FROM w GROUP BY 1, 2"""))
def norm_by_month_group(t: Tables) -> DataFrame:
    """Flagship: norm completion (ratio of sums) and documents per month and operation group."""
    return reports.norm_by_month_group(work_dataset(t))


@query("kpi_strip", WORK_SD, _with("""
SELECT CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha, CAST(SUM(work_norm_ha) AS DOUBLE) AS work_norm_ha,
       COUNT(DISTINCT source_doc_id) AS documents, COUNT(DISTINCT equipment_id) AS machines,
       COUNT(DISTINCT employee_id) AS people,
       CAST(CASE WHEN SUM(work_norm_ha) > 0 THEN ROUND(100.0 * SUM(work_area_ha) / SUM(work_norm_ha), 1) END AS DOUBLE)
         AS norm_completion_pct
FROM w"""))
def kpi_strip(t: Tables) -> DataFrame:
    """R-12 / K-03 / N26: KPI strip."""
    return reports.kpi_strip(work_dataset(t))


@query("top15_operations", WORK_SD, _with("""
SELECT operation_name, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha FROM w
GROUP BY 1 ORDER BY SUM(work_area_ha) DESC, operation_name LIMIT 15"""))
def top15_operations(t: Tables) -> DataFrame:
    """R-08 / T-03: top-15 operations by area."""
    return reports.top_by_area(work_dataset(t), "operation_name", 15)


@query("top15_machines", WORK_SD, _with("""
SELECT equipment, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha FROM w
GROUP BY 1 ORDER BY SUM(work_area_ha) DESC, equipment LIMIT 15"""))
def top15_machines(t: Tables) -> DataFrame:
    """R-14: top-15 machines by area."""
    return reports.top_by_area(work_dataset(t), "equipment", 15)


@query("top15_people", WORK_SD, _with("""
SELECT employee, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha FROM w
GROUP BY 1 ORDER BY SUM(work_area_ha) DESC, employee LIMIT 15"""))
def top15_people(t: Tables) -> DataFrame:
    """R-14: top-15 people by area."""
    return reports.top_by_area(work_dataset(t), "employee", 15)


@query("area_by_month_group", WORK_SD, _with("""
SELECT CAST(month AS VARCHAR) AS month, operation_group, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha
FROM w GROUP BY 1, 2"""))
def area_by_month_group(t: Tables) -> DataFrame:
    """R-09: stacked area by month and operation group."""
    return reports.area_by_month_group(work_dataset(t))


@query("share_by_group", WORK_SD, _with("""
SELECT operation_group, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha,
       CAST(SUM(work_area_ha) AS DOUBLE) / CAST(SUM(SUM(work_area_ha)) OVER () AS DOUBLE) AS share
FROM w GROUP BY 1"""))
def share_by_group(t: Tables) -> DataFrame:
    """R-10: area share per operation group."""
    return reports.area_share_by_group(work_dataset(t))


@query("work_by_month", WORK_SD, _with("""
SELECT CAST(month AS VARCHAR) AS month, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha, COUNT(*) AS rows
FROM w GROUP BY 1"""))
def work_by_month(t: Tables) -> DataFrame:
    """R-13: work by month."""
    return reports.work_by_month(work_dataset(t))


@query("area_by_equipment_type", WORK_SD, _with("""
SELECT equipment_type, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha FROM w GROUP BY 1"""))
def area_by_equipment_type(t: Tables) -> DataFrame:
    """R-15: area by machine type."""
    return reports.area_by_equipment_type(work_dataset(t))


@query("heatmap_operation_month", WORK_SD, _with("""
SELECT operation_name, CAST(month AS VARCHAR) AS month, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha
FROM w GROUP BY 1, 2"""))
def heatmap_operation_month(t: Tables) -> DataFrame:
    """R-16: operation x month heat map (long form)."""
    return reports.heatmap_operation_month(work_dataset(t))


@query("operations_by_group", WORK_SD, _with("""
SELECT operation_group, operation_name, operation_code, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha,
       COUNT(*) AS rows
FROM w GROUP BY 1, 2, 3"""))
def operations_by_group(t: Tables) -> DataFrame:
    """R-17: operations by group with code, area, rows."""
    return reports.operations_by_group(work_dataset(t))


@query("machine_work_by_day", WORK_SD, _with("""
SELECT CAST(work_date AS VARCHAR) AS work_date, equipment, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha,
       COUNT(*) AS rows
FROM w WHERE work_area_ha > 0 GROUP BY 1, 2"""))
def machine_work_by_day(t: Tables) -> DataFrame:
    """R-20: machine work by date and machine, work > 0."""
    return reports.machine_work(work_dataset(t))


@query("work_detail_selected", WORK_SD, _with("""
SELECT CAST(work_date AS VARCHAR) AS work_date, document_no, equipment, employee, operation_name,
       operation_group, CAST(work_area_ha AS DOUBLE) AS work_area_ha, CAST(work_norm_ha AS DOUBLE) AS work_norm_ha,
       CAST(norm_completion_pct AS DOUBLE) AS norm_completion_pct
FROM w WHERE year(work_date) = 1998 AND operation_group IN ('AMERICA', 'ASIA') AND equipment_type <> 'heavy'"""))
def work_detail_selected(t: Tables) -> DataFrame:
    """R-11 / P-10: detail table under dashboard selectors (year, group, type)."""
    sel = [F.year("work_date") == 1998, F.col("operation_group").isin("AMERICA", "ASIA"),
           F.col("equipment_type") != "heavy"]
    return reports.work_detail(work_dataset(t), sel)


@query("norm_completion_by_operation", WORK_SD, _with("""
SELECT operation_name, CAST(SUM(work_area_ha) AS DOUBLE) AS work_area_ha,
       CAST(SUM(work_norm_ha) AS DOUBLE) AS work_norm_ha,
       CAST(CASE WHEN SUM(work_norm_ha) > 0 THEN ROUND(100.0 * SUM(work_area_ha) / SUM(work_norm_ha), 1) END AS DOUBLE)
         AS norm_completion_pct
FROM w GROUP BY 1"""))
def norm_completion_by_operation(t: Tables) -> DataFrame:
    """K-03: norm completion as a ratio of sums per operation."""
    return metrics.norm_completion_total(work_dataset(t), ["operation_name"])


@query("waybill_fuel_balance", ["sd_docs"], """
SELECT CAST(date_trunc('month', doc_date) AS DATE)::VARCHAR AS month,
       CAST(SUM(fuel_issued) AS DOUBLE) AS issued,
       CAST(SUM(fuel_returned) AS DOUBLE) AS returned,
       CAST(SUM(fuel_issued - COALESCE(fuel_returned, 0)) AS DOUBLE) AS consumed
FROM sd_docs WHERE _posted = TRUE AND _deletionmark = FALSE GROUP BY 1""")
def waybill_fuel_balance(t: Tables) -> DataFrame:
    """K-05: fuel issued / returned / consumed from active headers (not lines)."""
    h = P.strict_active(waybill_headers(t)).withColumn("month", F.trunc(F.to_date("doc_date"), "month"))
    return metrics.waybill_fuel_balance(h, ["month"])


@query("conditional_counts", ["sd_docs"], """
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE _deletionmark IS FALSE) AS active,
       COUNT(*) FILTER (WHERE _deletionmark IS NULL) AS unknown_mark,
       COUNT(*) FILTER (WHERE _posted AND _deletionmark IS FALSE) AS posted_active
FROM sd_docs""")
def conditional_counts(t: Tables) -> DataFrame:
    """G-05 / Q-03: conditional counts; ``IS FALSE`` excludes NULL."""
    d = t.sd_docs
    return d.agg(F.count(F.lit(1)).alias("total"), count_if(F.col("_deletionmark") == F.lit(False)).alias("active"),
                 count_if(F.col("_deletionmark").isNull()).alias("unknown_mark"),
                 count_if(P.strict_active_flag()).alias("posted_active"))


@query("waybill_work_bi", WORK_SD, "," + FACT_SQL.replace(" WHERE work_ha > 0", "") + """
SELECT document_no, line_number, equipment, equipment_type, employee, operation_name, operation_group,
       CAST(work_area_ha AS DOUBLE) AS work_area_ha, CAST(norm_completion_pct AS DOUBLE) AS norm_completion_pct
FROM w""")
def waybill_work_bi(t: Tables) -> DataFrame:
    """M-18: BI view of the waybill-work fact: every active line, labelled."""
    fact = facts.waybill_work_fact(waybill_headers(t), waybill_lines(t))
    w = facts.work_report(fact, equipment(t), t.sd_people, t.tech_operations(), positive_only=False)
    return w.select("document_no", "line_number", "equipment", "equipment_type", "employee", "operation_name",
                    "operation_group", "work_area_ha", "norm_completion_pct")


@query("dim_equipment", ["sd_machines"], """
SELECT code_1c, name, eq_type, dense_rank() OVER (ORDER BY code_1c NULLS FIRST) AS eq_sk
FROM (SELECT _id AS code_1c, name, eq_type FROM sd_machines WHERE eq_type IS DISTINCT FROM 'heavy')""")
def dim_equipment(t: Tables) -> DataFrame:
    """M-10 / M-11: equipment dimension from the machine catalog (rows marked
    deleted dropped) with dense surrogate keys."""
    from fieldbook.plans import dims
    cat = t.sd_machines.withColumn("_deletionmark", F.coalesce(F.col("eq_type") == "heavy", F.lit(False)))
    return dims.simple_dim(cat, {"code_1c": "_id", "name": "name", "eq_type": "eq_type"}, ["code_1c"], "eq_sk")
