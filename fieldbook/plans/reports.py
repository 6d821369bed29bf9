"""Dashboard queries over the flat datasets (harvest, field work, movement).

Every report takes the dataset and optional selectors (Columns ANDed) and
is a single grouped aggregate; quantities are always grouped with their unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import TOP_N
from fieldbook.functions.ratios import ratio_of_sums_pct
from fieldbook.operators.aggregates import share_of_total
from fieldbook.operators.predicates import apply_selectors, positive, safe_report_rows
from fieldbook.operators.ranking import top_n, top_n_per_group

Sel = list[Column] | None


def _tons(col: str = "kolichestvo_kg") -> Column:
    return (F.sum(col) / 1000).alias("tons")


# --- harvest (R-01 ... R-07, R-22) -----------------------------------------

def harvest_by_year(h: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(h, selectors).groupBy("god_urozhaya").agg(_tons(), F.count(F.lit(1)).alias("weighings"))


def harvest_by_field(h: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(h, selectors).groupBy("pole_nomer").agg(_tons())


def harvest_by_irrigation(h: DataFrame, year: int, selectors: Sel = None) -> DataFrame:
    return apply_selectors(h, (selectors or []) + [F.col("god_urozhaya") == year]).groupBy("poliv").agg(_tons())


def harvest_by_sort(h: DataFrame, year: int, selectors: Sel = None) -> DataFrame:
    return apply_selectors(h, (selectors or []) + [F.col("god_urozhaya") == year]).groupBy("sort").agg(_tons())


def harvest_detail(h: DataFrame, year: int, selectors: Sel = None) -> DataFrame:
    keys = ["pole_nomer", "uchastok_nomer", "sort", "reproduktsiya", "poliv"]
    return apply_selectors(h, (selectors or []) + [F.col("god_urozhaya") == year]).groupBy(*keys).agg(_tons())


def harvest_by_month(h: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(h, selectors).groupBy(F.trunc(F.to_date("doc_date"), "month").alias("month")).agg(_tons())


def harvest_sort_irrigation(h: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(h, selectors).groupBy("god_urozhaya", "sort", "poliv").agg(
        F.count(F.lit(1)).alias("weighings"), _tons())


def reception_by_day(h: DataFrame, selectors: Sel = None) -> DataFrame:
    """Reception dashboard: daily volume and weighing count per destination."""
    return apply_selectors(h, selectors).groupBy(F.to_date("doc_date").alias("day"), "warehouse_id").agg(
        F.count(F.lit(1)).alias("weighings"), _tons(), F.count_distinct("pole_id").alias("fields"))


# --- field work (R-08 ... R-17, R-20) -------------------------------------

def _area() -> Column:
    return F.sum("work_area_ha").alias("work_area_ha")


def top_by_area(w: DataFrame, dim: str, n: int = TOP_N, selectors: Sel = None) -> DataFrame:
    """Top-n of a dimension by summed area; ties broken by the dimension value."""
    g = apply_selectors(w, selectors).groupBy(dim).agg(_area())
    return top_n(g, [F.col("work_area_ha").desc(), F.col(dim).asc()], n)


def area_by_month_group(w: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(w, selectors).groupBy("month", "operation_group").agg(_area())


def area_share_by_group(w: DataFrame, selectors: Sel = None) -> DataFrame:
    g = apply_selectors(w, selectors).groupBy("operation_group").agg(_area())
    return share_of_total(g, "work_area_ha", "share")


def work_detail(w: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(w, selectors).select(
        "work_date", "document_no", "equipment", "employee", "operation_name", "operation_group",
        "work_area_ha", "work_norm_ha", "norm_completion_pct")


def kpi_strip(w: DataFrame, selectors: Sel = None, approx: bool = False) -> DataFrame:
    """Area, distinct documents / machines / people, ratio-of-sums completion.

    Exact distinct counts expand every row once per counted column; with
    ``approx=True`` they become HyperLogLog sketches merged map-side (about 1 %
    relative error), the form for very large inputs."""
    d = apply_selectors(w, selectors)
    dc = (lambda c: F.approx_count_distinct(c, 0.01)) if approx else F.count_distinct
    return d.agg(
        _area(), F.sum("work_norm_ha").alias("work_norm_ha"),
        dc("source_doc_id").alias("documents"),
        dc("equipment_id").alias("machines"),
        dc("employee_id").alias("people"),
    ).withColumn("norm_completion_pct", ratio_of_sums_pct(F.col("work_area_ha"), F.col("work_norm_ha")))


def work_by_month(w: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(w, selectors).groupBy("month").agg(_area(), F.count(F.lit(1)).alias("rows"))


def area_by_equipment_type(w: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(w, selectors).groupBy("equipment_type").agg(_area())


def heatmap_operation_month(w: DataFrame, selectors: Sel = None, months: list | None = None) -> DataFrame:
    """Operation x month; ``months`` given -> pivoted wide form (no extra pass
    to discover the pivot values), else long form."""
    d = apply_selectors(w, selectors)
    if months is None:
        return d.groupBy("operation_name", "month").agg(_area())
    return d.groupBy("operation_name").pivot("month", months).agg(F.sum("work_area_ha"))


def operations_by_group(w: DataFrame, selectors: Sel = None) -> DataFrame:
    return apply_selectors(w, selectors).groupBy("operation_group", "operation_name", "operation_code").agg(
        _area(), F.count(F.lit(1)).alias("rows"))


def machine_work(w: DataFrame, selectors: Sel = None) -> DataFrame:
    return positive(apply_selectors(w, selectors), "work_area_ha").groupBy("work_date", "equipment").agg(
        _area(), F.count(F.lit(1)).alias("rows"))


def norm_by_month_group(w: DataFrame, selectors: Sel = None) -> DataFrame:
    """Share of norm completed and number of documents per month and
    operation group (ratio of sums)."""
    d = apply_selectors(w, selectors)
    return d.groupBy("month", "operation_group").agg(
        _area(), F.sum("work_norm_ha").alias("work_norm_ha"),
        F.count_distinct("source_doc_id").alias("documents"),
    ).withColumn("norm_completion_pct", ratio_of_sums_pct(F.col("work_area_ha"), F.col("work_norm_ha")))


# --- goods movement (R-18, R-19, R-21) -------------------------------------

def movement_summary(m: DataFrame, selectors: Sel = None) -> DataFrame:
    """By day, type, warehouse, item and unit (unit is a mandatory key: units
    and items are told apart by id, also where they share a label)."""
    return apply_selectors(m, selectors).groupBy(
        F.to_date("doc_date").alias("day"), "movement_type", "warehouse_id", "nomenklatura_id", "nomenclature", "edinica_id", "uom_name"
    ).agg(F.sum("quantity_signed").alias("quantity_signed"), F.count(F.lit(1)).alias("rows"))


def movement_by_unit(m: DataFrame, selectors: Sel = None) -> DataFrame:
    """Rows and quantity per unit id; unknown units stay apart."""
    return apply_selectors(m, selectors).groupBy("edinica_id", "uom_name", "uom_code").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("kolichestvo").alias("quantity"))


def top_items_per_unit(m: DataFrame, n: int = TOP_N, selectors: Sel = None) -> DataFrame:
    d = safe_report_rows(apply_selectors(m, selectors))
    g = d.groupBy("uom_name", "nomenclature").agg(F.sum("kolichestvo").alias("quantity"))
    return top_n_per_group(g, "uom_name", [F.col("quantity").desc(), F.col("nomenclature").asc()], n)


def unresolved_monitor(m: DataFrame, selectors: Sel = None) -> DataFrame:
    d = apply_selectors(m, selectors)
    return d.groupBy("movement_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("is_nomenclature_resolved")).alias("unresolved"),
        F.count_if(F.col("uom_code").isNull()).alias("units_unresolved"),
    ).withColumns({"unresolved_share": F.col("unresolved") / F.col("rows"),
                   "units_unresolved_share": F.col("units_unresolved") / F.col("rows")})
