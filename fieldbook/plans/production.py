"""Production sheets -> shift / downtime-reason dimensions and facts, and the
field-history mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.ratios import productivity_kg_h
from fieldbook.operators.indexing import dense_keys
from fieldbook.operators.joins import lookup_join, null_safe_join


def dim_shift(shifts: DataFrame, downtime: DataFrame | None = None) -> DataFrame:
    """(master, shift code) pairs of both sheets with dense keys; a shift whose
    master is not noted is one of its own."""
    pairs = shifts.select("master", "shift_code")
    if downtime is not None:
        pairs = pairs.unionByName(downtime.select("master", "shift_code"))
    return dense_keys(pairs, ["master", "shift_code"], "shift_sk")


def dim_downtime_reason(downtime: DataFrame) -> DataFrame:
    reasons = downtime.where(F.col("reason").isNotNull()).groupBy(F.col("reason").alias("reason_name")).agg(
        F.max("reason_group").alias("reason_group"))
    return reasons.join(dense_keys(reasons, ["reason_name"], "reason_sk"), "reason_name")


def production_output(shifts: DataFrame, shift_dim: DataFrame, nom_dim: DataFrame | None = None,
                      wh_dim: DataFrame | None = None, sheet: str = "shifts") -> DataFrame:
    """Plan / fact output per day and shift with productivity kg/h (NULL on
    zero or missing hours); item and warehouse keys are optional lookups."""
    f = null_safe_join(shifts, shift_dim, ["master", "shift_code"], "inner")
    if nom_dim is not None:
        f = lookup_join(f, nom_dim.select(F.col("ref_key_1c").alias("__n"), "nom_sk"), [("item_id", "__n")])
    if wh_dim is not None:
        f = lookup_join(f, wh_dim.select(F.col("code_1c").alias("__w"), "wh_sk"), [("warehouse_id", "__w")])
    return f.select(F.col("shift_date").alias("date_day"), "shift_sk",
                    *(["nom_sk"] if nom_dim is not None else []), *(["wh_sk"] if wh_dim is not None else []),
                    "plan_kg", "fact_kg", "plan_hours", "fact_hours",
                    productivity_kg_h("fact_kg", "fact_hours").alias("productivity_kg_h"),
                    F.lit(sheet).alias("src_sheet"))


def downtime_fact(downtime: DataFrame, shift_dim: DataFrame, reason_dim: DataFrame,
                  sheet: str = "downtime") -> DataFrame:
    f = null_safe_join(downtime, shift_dim, ["master", "shift_code"], "inner")
    f = f.join(reason_dim.select(F.col("reason_name").alias("reason"), "reason_sk"), "reason")
    return f.select(F.col("downtime_date").alias("date_day"), "shift_sk", "reason_sk",
                    F.col("duration_hours").cast("decimal(10,2)").alias("duration_h"), F.lit(sheet).alias("src_sheet"))


def field_history_mart(history: DataFrame) -> DataFrame:
    """Field areas and crops per year: rows marked unused are dropped; year-0
    rows (no explicit year, or none at all) take the calendar years of their
    validity, and those still in force last to the last year of the history."""
    h = history.where(~F.coalesce(F.col("unused"), F.lit(False))).withColumn("year", F.nullif("year", F.lit(0)))
    last = h.agg(F.max(F.greatest("year", F.year("valid_from"), F.year("valid_to")))).scalar()
    until = F.greatest(F.coalesce(F.year("valid_to"), last), F.year("valid_from"))
    years = F.when(F.col("year").isNotNull(), F.array(F.col("year").cast("int"))).when(
        F.col("valid_from").isNotNull(), F.sequence(F.year("valid_from"), until))
    return h.select("field_id", F.explode(years).alias("year"), "crop", "sown_area_ha", "total_area_ha", "line_number")
