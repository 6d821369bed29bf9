"""Derived agronomic metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions.ratios import ratio_of_sums_pct, yield_t_ha
from fieldbook.operators.allocation import allocate_by_share


def harvest_by_field_crop_year(harvest: DataFrame) -> DataFrame:
    return harvest.groupBy("pole_id", "kultura", "god_urozhaya").agg(F.sum("kolichestvo_kg").alias("weight_kg"))


def field_history_match(totals: DataFrame, history: DataFrame) -> DataFrame:
    """Totals per field, crop and year -> the area sown with that crop: the
    sum over the history lines of the same year, else over the year-0 lines
    whose validity covers the year; NULL when there are none.

    Both sides meet on field and crop, so a total is compared with the few
    lines of its own field only, and the totals are computed once.
    """
    year = F.col("god_urozhaya")
    h = history.select(F.col("field_id").alias("__f"), F.col("crop").alias("__c"), F.col("year").alias("__y"),
                       F.year("valid_from").alias("__from"), F.year("valid_to").alias("__to"), "sown_area_ha")
    valid = (F.col("__y") == 0) & (F.col("__from") <= year) & F.coalesce(F.col("__to") >= year, F.lit(True))
    on = (F.col("pole_id") == F.col("__f")) & (F.col("kultura") == F.col("__c")) & ((F.col("__y") == year) | valid)
    dated = F.col("__y") != 0
    area = F.when(F.count_if(dated) > 0, F.sum(F.when(dated, F.col("sown_area_ha")))).otherwise(F.sum("sown_area_ha"))
    return totals.join(h, on, "left").groupBy(*totals.columns).agg(area.alias("sown_area_ha"))


def yield_by_field_crop_year(harvest: DataFrame, history: DataFrame) -> DataFrame:
    """Yield t/ha = kg / (1000 x sown area); NULL when the area is unknown
    (the row is kept)."""
    m = field_history_match(harvest_by_field_crop_year(harvest), history)
    return m.withColumn("yield_t_ha", yield_t_ha("weight_kg", "sown_area_ha"))


def fuel_per_field(fuel: DataFrame, work: DataFrame) -> DataFrame:
    """Machine fuel of a month split over fields by worked area."""
    return allocate_by_share(fuel, work, ["equipment_id", "month"], "field_id", "fuel_l", "area_ha")


def norm_completion_total(report: DataFrame, group: list[str]) -> DataFrame:
    return report.groupBy(*group).agg(
        F.sum("work_area_ha").alias("work_area_ha"), F.sum("work_norm_ha").alias("work_norm_ha")
    ).withColumn("norm_completion_pct", ratio_of_sums_pct(F.col("work_area_ha"), F.col("work_norm_ha")))


def waybill_fuel_balance(headers: DataFrame, group: list[str]) -> DataFrame:
    """Fuel issued, returned and consumed, at header level (never over lines)."""
    return headers.groupBy(*group).agg(
        F.sum("toplivo_vydano").alias("issued"), F.sum("toplivo_vozvrat").alias("returned"),
        F.sum(F.col("toplivo_vydano") - F.coalesce("toplivo_vozvrat", F.lit(0))).alias("consumed"))


def resolved_share(df: DataFrame, group: list[str], flag: str) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(flag)).alias("resolved"),
                                  (F.count_if(F.col(flag)) / F.count(F.lit(1))).alias("resolved_share"))


def freshness(specs: dict[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Per table: last load / event time, row count and fill rate of one
    column; ``specs`` maps a name to (table, time column, fill column)."""
    from functools import reduce
    parts = []
    for name, (df, ts_col, fill_col) in specs.items():
        fill = (F.count(fill_col) / F.count(F.lit(1))) if fill_col else F.lit(None).cast("double")
        parts.append(df.agg(F.max(ts_col).cast("string").alias("last_loaded_at"),
                            F.count(F.lit(1)).alias("rows"), fill.alias("fill_rate"))
                       .select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def freshness_lag(fresh: DataFrame) -> DataFrame:
    """``freshness`` with each table's lag in whole hours behind the newest one
    and whether it is empty (an empty table has no lag); one row per table, so
    the window over all of them is small."""
    last = F.to_timestamp_ntz("last_loaded_at")
    newest = F.max(last).over(Window.partitionBy())
    return fresh.withColumns({"lag_hours": F.timestamp_diff("HOUR", last, newest), "is_empty": F.col("rows") == 0})
