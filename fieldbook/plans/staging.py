"""Staging views: cleaned documents joined to their lines and to the fields
they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import RESOLVED_BY_STRUCTURE, UNRESOLVED, WEIGHING_FROM_FIELD
from fieldbook.functions.field_number import field_number_any
from fieldbook.functions.normalize import norm_guid
from fieldbook.operators.joins import lookup_join
from fieldbook.operators.predicates import link_present, not_deleted_flag, tolerant_not_deleted

SLIP_COMBINE = "ТалонКомбайнера"   # fixed value: combine-operator slip type


def field_lookup(fields: DataFrame) -> DataFrame:
    """Field catalog as (field number text -> field id)."""
    return fields.select(F.col("description").alias("pole_nomer"), F.col("_id").alias("pole_id"))


def resolved_structure(structure: DataFrame, fields: DataFrame) -> DataFrame:
    """Company-structure catalog -> name, parsed field number and field id.
    Parsing and the field lookup run once per catalog row."""
    cs = structure.select(F.col("_id").alias("__cs_id"), F.col("description").alias("otkuda_name"),
                          field_number_any("description").alias("pole_nomer"))
    return lookup_join(cs, field_lookup(fields), [("pole_nomer", "pole_nomer")])


def stg_weighing(weighings: DataFrame, structure: DataFrame, fields: DataFrame) -> DataFrame:
    """Weighings not deleted (NULL mark = kept) with the sender's structure
    name, the field number parsed from it and the field it resolves to."""
    w = tolerant_not_deleted(weighings)
    w = lookup_join(w, resolved_structure(structure, fields), [("otkuda_id", "__cs_id")])
    return (w.withColumn("god_urozhaya", F.year("doc_date"))
             .withColumn("pole_resolution_method",
                         F.when(F.col("pole_id").isNotNull(), F.lit(RESOLVED_BY_STRUCTURE))
                          .otherwise(F.lit(UNRESOLVED))))


def harvest_base(stg: DataFrame) -> DataFrame:
    """One row per from-field weighing (transfers excluded)."""
    return stg.where(F.col("vid_vzveshivaniya") == F.lit(WEIGHING_FROM_FIELD)).select(
        F.col("_id").alias("src_doc_id"), "doc_date", "god_urozhaya", "pole_id", "pole_nomer",
        F.col("otkuda_name").alias("pole_party_name"), "nomenklatura_id",
        F.col("ves_netto_kg").alias("kolichestvo_kg"), "ves_brutto_kg", "ves_tary_kg",
        "voditel_id", F.col("kuda_id").alias("warehouse_id"), "pole_resolution_method",
        F.col("pole_id").isNotNull().alias("is_pole_resolved"))


def stg_writeoff(headers: DataFrame, lines: DataFrame, fields: DataFrame) -> DataFrame:
    """Write-off lines with the field parsed from the sender text."""
    h = tolerant_not_deleted(headers)
    j = h.join(lines.withColumnRenamed("doc_id", "__doc"), F.col("_id") == F.col("__doc")).drop("__doc")
    j = j.withColumn("pole_nomer", field_number_any("otpravitel_text"))
    return lookup_join(j, field_lookup(fields), [("pole_nomer", "pole_nomer")])


def stg_slips(slips: DataFrame, weighings: DataFrame) -> DataFrame:
    """Combine-operator slips that carry a real field id."""
    d = weighings.select(F.col("_id").alias("__d"), "doc_date", "doc_number")
    s = slips.withColumn("pole_id", norm_guid("pole_id")).where(F.col("tip_talona") == F.lit(SLIP_COMBINE))
    s = link_present(s, "pole_id")
    j = s.join(d, s["doc_id"] == d["__d"]).drop("__d")
    return j.withColumn("god_urozhaya", F.year("doc_date"))


def stg_movement_lines(headers: DataFrame, lines: DataFrame, guid_cols=("pole_id", "edinica_id")) -> DataFrame:
    """Movement header x lines, GUIDs cleaned, both flags carried (no filter)."""
    j = headers.join(lines.withColumnRenamed("doc_id", "__doc"), F.col("_id") == F.col("__doc"))
    j = j.withColumnRenamed("__doc", "doc_id")
    for c in guid_cols:
        if c in j.columns and dict(j.dtypes)[c] == "string":
            j = j.withColumn(c, norm_guid(c))
    return j.withColumn("is_active", not_deleted_flag() & F.coalesce(F.col("_posted"), F.lit(False)))
