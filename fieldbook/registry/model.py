"""Star-schema modelling queries: calendar, SCD2, as-of join, metrics, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import AGRO_PHASES, DAY_NAMES, MONTH_NAMES
from fieldbook.functions.ratios import productivity_kg_h, yield_t_ha
from fieldbook.operators.indexing import dense_keys
from fieldbook.operators.joins import asof_join
from fieldbook.operators.scd2 import scd2_versions
from fieldbook.plans import dims, facts, metrics
from fieldbook.registry.base import query
from fieldbook.registry.harvest import H_SD, enriched, hq
from fieldbook.registry.standins import Tables

MONTHS_SQL, DAYS_SQL, PHASES_SQL = (str(list(names)) for names in (MONTH_NAMES, DAY_NAMES, AGRO_PHASES))


@query("calendar_dim", None, f"""
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS s, CAST(MAX(o_orderdate) AS DATE) AS e FROM orders),
d AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date_day FROM b),
p AS (SELECT date_day, CAST(year(date_day) AS INTEGER) AS y, CAST(month(date_day) AS INTEGER) AS m,
             CAST(isodow(date_day) AS INTEGER) AS dow FROM d)
SELECT CAST(date_day AS VARCHAR) AS date_day, y AS year, CAST(quarter(date_day) AS INTEGER) AS quarter, m AS month,
       {MONTHS_SQL}[m] AS month_name_ru, CAST(week(date_day) AS INTEGER) AS week, dow AS day_of_week,
       {DAYS_SQL}[dow] AS day_name_ru, dow IN (6, 7) AS is_weekend,
       CASE WHEN m >= 7 THEN y ELSE y - 1 END AS season,
       CASE WHEN m >= 7 THEN CAST(y AS VARCHAR) || '-' || CAST(y + 1 AS VARCHAR)
            ELSE CAST(y - 1 AS VARCHAR) || '-' || CAST(y AS VARCHAR) END AS season_label,
       {PHASES_SQL}[m] AS agro_phase
FROM p""")
def calendar_dim(t: Tables) -> DataFrame:
    """M-07 / S-15..S-18: calendar over the span of the document dates."""
    bounds = t.raw("orders").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return dims.dim_date(bounds)


SCD2_SQL = """
WITH daily AS (
  SELECT o_custkey, d, o_orderpriority FROM (
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
ch AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY d) AS prev,
              row_number() OVER (PARTITION BY o_custkey ORDER BY d) AS k FROM daily),
v0 AS (SELECT o_custkey, o_orderpriority, d AS valid_from FROM ch
       WHERE k = 1 OR prev IS DISTINCT FROM o_orderpriority),
v AS (SELECT *, COALESCE(lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from), DATE '9999-12-31')
                  AS valid_to FROM v0)
"""


def versions(t: Tables) -> DataFrame:
    return scd2_versions(t.raw("orders"), "o_custkey", "o_orderdate", ["o_orderpriority"], ["o_orderkey"])


@query("scd2_build", None, SCD2_SQL + """
SELECT o_custkey, o_orderpriority, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       valid_to = DATE '9999-12-31' AS is_current
FROM v""")
def scd2_build(t: Tables) -> DataFrame:
    """M-06: SCD2 versions of a customer's order priority over order dates."""
    return versions(t)


@query("dim_field_load", None, """
WITH daily AS (
  SELECT * FROM (
    SELECT 'АК-' || o_custkey AS code, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS department, o_orderstatus AS organization,
           row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
steps AS (
  SELECT *, lag(d) OVER w IS NULL OR lag(department) OVER w IS DISTINCT FROM department
            OR lag(organization) OVER w IS DISTINCT FROM organization AS starts
  FROM daily WINDOW w AS (PARTITION BY code ORDER BY d)),
v AS (SELECT *, lead(d) OVER (PARTITION BY code ORDER BY d) AS next_d FROM steps WHERE starts)
SELECT code AS field_code_1c, 'Поле ' || code AS field_name, department, organization, department <> '5-LOW' AS is_active,
       CAST(d AS VARCHAR) AS valid_from, CAST(coalesce(next_d, DATE '9999-12-31') AS VARCHAR) AS valid_to, next_d IS NULL AS is_current,
       (SELECT count(*) FROM v) AS n_keys
FROM v""")
def dim_field_load(t: Tables) -> DataFrame:
    """M-06: three loads of the field dimension, the middle years last: versions
    already written are closed, split and joined; the result equals a rebuild
    from all snapshots, and every version has a surrogate key of its own."""
    o = t.raw("orders")
    code = F.concat(F.lit("АК-"), F.col("o_custkey").cast("string"))
    snapshots = o.select(code.alias("field_code_1c"), F.col("o_orderdate").alias("snapshot_date"), "o_orderkey",
                         F.concat(F.lit("Поле "), code).alias("field_name"), F.col("o_orderpriority").alias("department"),
                         F.lit(None).cast("decimal(10,2)").alias("area_ha"), F.col("o_orderstatus").alias("organization"),
                         (F.col("o_orderpriority") != "5-LOW").alias("is_active"))
    year, loaded = F.year("snapshot_date"), None
    for part in (year < 1994, year >= 1997, (year >= 1994) & (year < 1997)):
        loaded = dims.load_dim_field(loaded, snapshots.where(part), ["o_orderkey"])
    keys = loaded.versions.agg(F.count_distinct("field_sk")).scalar()
    return loaded.versions.drop("field_sk", "area_ha").withColumn("n_keys", keys)


@query("scd2_asof_join", ["sd_docs", "sd_lines"], SCD2_SQL.replace("WITH daily", ", daily") + """,
f AS (SELECT l.doc_id, l.line_number, CAST(l.ship_date AS DATE) AS ship_day, d.person_id AS o_custkey
      FROM sd_lines l JOIN sd_docs d ON d._id = l.doc_id)
SELECT f.doc_id, f.line_number, CAST(f.ship_day AS VARCHAR) AS ship_day, f.o_custkey, v.o_orderpriority
FROM f LEFT JOIN (SELECT * REPLACE (IF(o_orderpriority = '5-LOW', LEAST(valid_to, CAST(valid_from + INTERVAL 60 DAY AS DATE)), valid_to) AS valid_to)
                  FROM v) v
  ON f.o_custkey = v.o_custkey AND f.ship_day >= v.valid_from AND f.ship_day < v.valid_to""")
def scd2_asof_join(t: Tables) -> DataFrame:
    """J-13: each line gets the customer version valid on its ship day.  A
    version of the lowest priority ends after 60 days, so some days lie in no
    version at all: there the line has none."""
    f = t.sd_lines.join(t.sd_docs.select(F.col("_id").alias("doc_id"), F.col("person_id").alias("o_custkey")),
                        "doc_id").select("doc_id", "line_number", F.to_date("ship_date").alias("ship_day"),
                                         "o_custkey")
    ended = versions(t).withColumn("valid_to", F.when(F.col("o_orderpriority") == "5-LOW", F.least(
        "valid_to", F.date_add("valid_from", 60))).otherwise(F.col("valid_to")))
    return asof_join(f, ended, "o_custkey", "ship_day", "valid_from", ["o_orderpriority"], valid_to="valid_to")


@query("yield_by_history_year", H_SD + ["sd_field_history"], hq("""
, tot AS (SELECT pole_id, kultura, god_urozhaya, SUM(kolichestvo_kg) AS weight_kg FROM enr GROUP BY ALL),
years AS (
  SELECT field_id, crop, sown_area_ha, year <> 0 AS dated,
         unnest(IF(year <> 0, [year::BIGINT], range(year(valid_from), 1 + IFNULL(year(valid_to), 2100)))) AS y
  FROM sd_field_history),
area AS (
  SELECT field_id, crop, y, CASE WHEN bool_or(dated) THEN SUM(sown_area_ha) FILTER (dated) ELSE SUM(sown_area_ha) END AS ha
  FROM years GROUP BY 1, 2, 3),
met AS (
  SELECT tot.*, ha, CAST(weight_kg * 1000 AS HUGEINT) AS kg_m, CAST(ha * 10000 AS HUGEINT) AS area_u
  FROM tot LEFT JOIN area ON (field_id, crop, y) = (pole_id, kultura, god_urozhaya))
SELECT pole_id, kultura, god_urozhaya, CAST(weight_kg AS DOUBLE) AS weight_kg, CAST(ha AS DOUBLE) AS sown_area_ha,
       IF(area_u > 0, CAST((2 * kg_m + area_u) // (2 * area_u) AS DOUBLE) / 100, NULL) AS yield_t_ha
FROM met"""))
def yield_by_history_year(t: Tables) -> DataFrame:
    """K-01 / J-14 / S-24: yield per field, crop and year against the areas of
    the field history (lines of the year, else year-0 lines valid in it)."""
    return metrics.yield_by_field_crop_year(enriched(t), t.sd_field_history)


@query("fuel_allocation", ["sd_lines"], """,
fuel AS (SELECT machine_id AS equipment_id, CAST(date_trunc('month', ship_date) AS DATE) AS month, qty AS fuel_l
         FROM sd_lines WHERE linestatus = 'O'),
work AS (SELECT machine_id AS equipment_id, CAST(date_trunc('month', ship_date) AS DATE) AS month,
                CAST(operation_id AS VARCHAR) AS field_id, work_ha AS area_ha FROM sd_lines WHERE linestatus = 'F'),
amt AS (SELECT equipment_id, month, SUM(fuel_l) AS amount FROM fuel GROUP BY 1, 2),
drv AS (SELECT equipment_id, month, field_id, SUM(area_ha) AS driver FROM work GROUP BY 1, 2, 3),
tot AS (SELECT equipment_id, month, SUM(driver) AS driver_total FROM drv GROUP BY 1, 2)
SELECT a.equipment_id, CAST(a.month AS VARCHAR) AS month, d.field_id, CAST(d.driver AS DOUBLE) AS driver,
       CAST(t.driver_total AS DOUBLE) AS driver_total, CAST(a.amount AS DOUBLE) AS amount,
       CAST(d.driver AS DOUBLE) / CAST(t.driver_total AS DOUBLE) AS share,
       CAST(a.amount AS DOUBLE) * CAST(d.driver AS DOUBLE) / CAST(t.driver_total AS DOUBLE) AS allocated
FROM amt a JOIN drv d ON d.equipment_id = a.equipment_id AND d.month = a.month
JOIN tot t ON t.equipment_id = a.equipment_id AND t.month = a.month
WHERE t.driver_total > 0
UNION ALL
SELECT equipment_id, CAST(month AS VARCHAR), NULL, NULL, NULL, CAST(amount AS DOUBLE), NULL, CAST(amount AS DOUBLE)
FROM amt a WHERE NOT EXISTS (SELECT 1 FROM tot t WHERE t.equipment_id = a.equipment_id AND t.month = a.month
                             AND t.driver_total > 0)""")
def fuel_allocation(t: Tables) -> DataFrame:
    """K-02 / J-16: machine fuel per month split over fields by worked area;
    months without work keep their fuel as one unallocated row."""
    ln = t.sd_lines.withColumn("month", F.trunc(F.to_date("ship_date"), "month"))
    fuel = ln.where(F.col("linestatus") == "O").select(F.col("machine_id").alias("equipment_id"), "month",
                                                        F.col("qty").alias("fuel_l"))
    work = ln.where(F.col("linestatus") == "F").select(
        F.col("machine_id").alias("equipment_id"), "month", F.col("operation_id").cast("string").alias("field_id"),
        F.col("work_ha").alias("area_ha"))
    return metrics.fuel_per_field(fuel, work)


@query("fuel_usage_fact", ["sd_lines", "sd_machines", "sd_fields"], """,
amt AS (SELECT machine_id, CAST(date_trunc('month', ship_date) AS DATE) AS month, CAST(SUM(qty) * 1000 AS HUGEINT) AS ml
        FROM sd_lines WHERE linestatus = 'O' GROUP BY 1, 2),
drv AS (SELECT machine_id, CAST(date_trunc('month', ship_date) AS DATE) AS month, 'F-' || operation_id AS field_id,
               CAST(SUM(work_ha) * 10000 AS HUGEINT) AS d FROM sd_lines WHERE linestatus = 'F' AND work_ha > 0 GROUP BY 1, 2, 3),
part AS (
  SELECT a.machine_id, a.month, v.field_id, v.d, a.ml, a.ml * v.d // SUM(v.d) OVER g AS units, a.ml * v.d % SUM(v.d) OVER g AS rest
  FROM amt a JOIN drv v ON v.machine_id = a.machine_id AND v.month = a.month WINDOW g AS (PARTITION BY a.machine_id, a.month)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY machine_id, month ORDER BY rest DESC, d DESC, field_id) AS rn,
         ml - SUM(units) OVER (PARTITION BY machine_id, month) AS spare FROM part),
split AS (
  SELECT machine_id, month, field_id, CAST(units + CASE WHEN rn <= spare THEN 1 ELSE 0 END AS BIGINT) AS ml, CAST(d AS BIGINT) AS d FROM placed
  UNION ALL SELECT machine_id, month, NULL, CAST(ml AS BIGINT), NULL FROM amt a
  WHERE NOT EXISTS (SELECT 1 FROM drv WHERE drv.machine_id = a.machine_id AND drv.month = a.month)),
eq AS (SELECT _id, row_number() OVER (ORDER BY _id) AS eq_sk FROM sd_machines),
fl AS (SELECT _id, row_number() OVER (ORDER BY _id) AS field_sk FROM (SELECT DISTINCT _id FROM sd_fields))
SELECT CAST(s.month AS VARCHAR) AS date_day, s.machine_id AS equipment_id, s.field_id, eq_sk, field_sk, s.ml / 1000 AS liters, s.d / 10000 AS area_ha
FROM split s LEFT JOIN eq ON eq._id = s.machine_id LEFT JOIN fl ON CAST(fl._id AS VARCHAR) = s.field_id""")
def fuel_usage_fact(t: Tables) -> DataFrame:
    """M-20 / K-02: fuel fact in whole millilitres, keyed to machine and field;
    litres of a machine and month sum back to the source exactly."""
    ln = t.sd_lines.withColumn("month", F.trunc(F.to_date("ship_date"), "month")).withColumnRenamed("machine_id", "equipment_id")
    fuel = ln.where(F.col("linestatus") == "O").select("equipment_id", "month", F.col("qty").alias("fuel_l"))
    work = ln.where(F.col("linestatus") == "F").select(
        "equipment_id", "month", F.concat(F.lit("F-"), F.col("operation_id").cast("string")).alias("field_id"), F.col("work_ha").alias("area_ha"))
    machines = dense_keys(t.sd_machines.select(F.col("_id").alias("code_1c")), ["code_1c"], "eq_sk")
    fields = dense_keys(t.sd_fields.select(F.col("_id").alias("field_code_1c")), ["field_code_1c"], "field_sk")
    fact = facts.fuel_usage(fuel, work, machines, fields.select(F.col("field_code_1c").cast("string").alias("field_code_1c"), "field_sk",
                                                                F.lit(True).alias("is_current")))
    return fact.drop("_loaded_at")


@query("yield_guarded_ratio", ["sd_lines"], """,
x AS (SELECT doc_id, line_number, amount, work_ha, norm_ha, CAST(amount * 1000 AS BIGINT) AS kg_m,
             CAST(work_ha * 10000 AS BIGINT) AS area_u, CAST(norm_ha * 1000 AS BIGINT) AS h_m FROM sd_lines)
SELECT doc_id, line_number,
  CASE WHEN work_ha IS NULL OR work_ha = 0 THEN NULL
       ELSE CAST((2 * kg_m + area_u) // (2 * area_u) AS DOUBLE) / 100 END AS yield_t_ha,
  CASE WHEN norm_ha IS NULL OR norm_ha = 0 THEN NULL
       ELSE CAST((2 * kg_m * 100 + h_m) // (2 * h_m) AS DOUBLE) / 100 END AS productivity_kg_h
FROM x""")
def yield_guarded_ratio(t: Tables) -> DataFrame:
    """S-24 / S-25: yield t/ha and productivity kg/h, NULL on a NULL or zero
    denominator, rounded half up to 2 decimals."""
    ln = t.sd_lines
    return ln.select("doc_id", "line_number", yield_t_ha("amount", "work_ha").alias("yield_t_ha"),
                     productivity_kg_h("amount", "norm_ha").alias("productivity_kg_h"))


@query("surrogate_keys_dense", None, """
SELECT l_partkey, l_suppkey, dense_rank() OVER (ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST) AS pair_sk
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""")
def surrogate_keys_dense(t: Tables) -> DataFrame:
    """M-SK: dense surrogate keys over a natural key without a single-task window."""
    return dense_keys(t.raw("lineitem"), ["l_partkey", "l_suppkey"], "pair_sk")
