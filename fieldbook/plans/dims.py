"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import (
    CALENDAR_END, CALENDAR_START, NOMENCLATURE_TECH_CATEGORY, NOMENCLATURE_TECH_KIND,
    NOMENCLATURE_UNNAMED,
)
from fieldbook.functions.calendar import calendar_columns
from fieldbook.operators.dedup import latest_per_key
from fieldbook.operators.indexing import dense_keys
from fieldbook.operators.joins import anti_join, null_safe_join
from fieldbook.operators.predicates import dim_not_deleted
from fieldbook.operators.scd2 import Scd2, scd2_load, scd2_versions
from fieldbook.plans.facts import crop_attributes


def date_spine(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per day between the bounds of each input row (a day spine)."""
    return bounds.select(F.explode(F.sequence(F.to_date(start_col), F.to_date(end_col),
                                              F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def dim_date(spark_or_bounds, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Calendar with ISO week/weekday, localised names, farm season and
    agronomic phase.  ``spark_or_bounds`` is a session (fixed span) or a
    one-row DataFrame with ``start``/``end`` derived from the facts."""
    if isinstance(spark_or_bounds, DataFrame):
        bounds = spark_or_bounds
    else:
        bounds = spark_or_bounds.createDataFrame([(start, end)], "start string, end string")
    return date_spine(bounds).select(*calendar_columns("date_day"))


def dim_date_insert(existing: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days not yet present (insert-if-absent)."""
    return anti_join(calendar, existing, ["date_day"])


def crop_candidates(enriched: DataFrame) -> DataFrame:
    return crop_attributes(enriched).select("variety", "color", "reproduction", "irrigation").distinct()


def dim_crop_new(enriched: DataFrame, existing: DataFrame) -> DataFrame:
    """Crop tuples not yet in the dimension, compared null-safely, with new
    surrogate keys continuing after the current maximum."""
    cand = anti_join(crop_candidates(enriched), existing, ["variety", "color", "reproduction", "irrigation"],
                     null_safe=True)
    start = existing.agg(F.coalesce(F.max("crop_sk"), F.lit(0))).scalar()
    return dense_keys(cand, ["variety", "color", "reproduction", "irrigation"], "crop_sk", start_after=start)


def missing_nomenclature(enriched: DataFrame, dim_nom: DataFrame, tiebreak: list[str]) -> DataFrame:
    """Technical item records for item ids seen in harvest rows but absent
    from the item dimension: latest document's name (NULL dates first)."""
    h = enriched.where(F.col("nomenklatura_id").isNotNull())
    h = anti_join(h, dim_nom, [("nomenklatura_id", "ref_key_1c")])
    h = latest_per_key(h, "nomenklatura_id", "doc_date", tiebreak)
    name = F.coalesce(F.nullif("nomenklatura_name", F.lit("")), F.nullif("pole_party_name", F.lit("")),
                      F.lit(NOMENCLATURE_UNNAMED))
    return h.select(F.col("nomenklatura_id").alias("ref_key_1c"), name.alias("name_1c"),
                    F.lit(NOMENCLATURE_TECH_KIND).alias("nom_kind"),
                    F.lit(NOMENCLATURE_TECH_CATEGORY).alias("category"),
                    F.lit(True).alias("is_active"))


FIELD_ATTRS = ["field_name", "department", "area_ha", "organization", "is_active"]


def dim_field_versions(snapshots: DataFrame, tiebreak: list[str]) -> DataFrame:
    """SCD2 field dimension from all dated catalog snapshots."""
    return scd2_versions(snapshots, "field_code_1c", "snapshot_date", FIELD_ATTRS, tiebreak)


def load_dim_field(loaded: Scd2 | None, snapshots: DataFrame, tiebreak: list[str]) -> Scd2:
    """One load of the field dimension: closes, splits and inserts versions."""
    return scd2_load(loaded, snapshots, "field_code_1c", "snapshot_date", FIELD_ATTRS, tiebreak, "field_sk")


def simple_dim(catalog: DataFrame, mapping: dict[str, str], natural: list[str], sk: str) -> DataFrame:
    """Catalog view (deleted rows dropped) with dense surrogate keys; a NULL
    part of the natural key is a value like any other."""
    v = dim_not_deleted(catalog).select(*[F.col(s).alias(t) for t, s in mapping.items()])
    return null_safe_join(v, dense_keys(v, natural, sk), natural, "inner")


def field_sections(enriched: DataFrame) -> DataFrame:
    return enriched.select("pole_nomer", "uchastok_nomer").distinct()


def crop_varieties(enriched: DataFrame) -> DataFrame:
    return enriched.select("kultura", "sort", "reproduktsiya", "poliv").distinct()
