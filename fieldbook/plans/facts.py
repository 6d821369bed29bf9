"""Facts: operational splits, waybill work, movement, harvest, balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import (
    EQUIPMENT_TYPE_UNKNOWN, OPERATION_GROUP_NONE, OPERATION_HARVEST_RECEIPT,
    OPERATION_MATERIAL_ISSUE, UNRESOLVED_UNIT,
)
from fieldbook.functions.labels import (
    color_label, irrigation_label, reproduction_label,
    unresolved_item_label, variety_label,
)
from fieldbook.functions.movement import movement_type, quantity_sign
from fieldbook.functions.parsers import parse_item_name, parse_party_name
from fieldbook.functions.ratios import norm_completion_pct, yield_t_ha
from fieldbook.operators.allocation import allocate_exactly
from fieldbook.operators.balance import running_balance
from fieldbook.operators.joins import lookup_join, null_safe_join, self_parent_join
from fieldbook.operators.predicates import positive, strict_active, tolerant_active
from fieldbook.operators.upsert import append_absent
from fieldbook.sources.sinks import stamp


def header_lines(headers: DataFrame, lines: DataFrame, header_cols: list[str], line_cols: list[str]) -> DataFrame:
    """Document header x its lines on the document id (inner)."""
    h = headers.select(F.col("_id").alias("doc_id"), *header_cols)
    return h.join(lines.select("doc_id", *line_cols), "doc_id")


# --- movement split -------------------------------------------------------

MOVEMENT_FACT_COLS = ["doc_id", "doc_number", "doc_date", "pole_id", "nomenklatura_id", "line_number",
                      "edinica_id", "kolichestvo", "summa"]


def split_movement(headers: DataFrame, lines: DataFrame, kind_col: str = "operaciya") -> dict[str, DataFrame]:
    """Active (strictly posted, not deleted) movement lines split by operation:
    material issue, harvest receipt, and everything else (incl. NULL kind).
    The three parts partition the active lines."""
    h = strict_active(headers)
    hcols = [c for c in ("doc_number", "doc_date", kind_col) if c in headers.columns]
    lcols = [c for c in lines.columns if c != "doc_id" and c not in hcols]
    j = header_lines(h, lines, hcols, lcols)
    k = F.col(kind_col)
    issue = j.where(k == F.lit(OPERATION_MATERIAL_ISSUE))
    receipt = j.where(k == F.lit(OPERATION_HARVEST_RECEIPT))
    other = j.where(k.isNull() | ~k.isin(OPERATION_MATERIAL_ISSUE, OPERATION_HARVEST_RECEIPT))
    return {"material_issue": issue, "harvest_receipt": receipt, "other_movement": other}


# --- waybill work ---------------------------------------------------------

WAYBILL_HEADER_MEASURES = ["narabotka_moto_chas", "probeg_km", "toplivo_vydano", "toplivo_vozvrat"]


def waybill_work_fact(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Active waybill lines with the header's machine, driver and measures.

    Header measures repeat on every line: sum them per document, never over lines."""
    h = strict_active(headers)
    hcols = [c for c in ["doc_number", "doc_date", "tehnika_id", "model_tehniki_id", "voditel_id",
                         *WAYBILL_HEADER_MEASURES] if c in headers.columns]
    lcols = [c for c in lines.columns if c != "doc_id" and c not in hcols]
    return header_lines(h, lines, hcols, lcols)


def work_report(fact: DataFrame, equipment: DataFrame, employees: DataFrame,
                operations: DataFrame, positive_only: bool = True) -> DataFrame:
    """Field-work dataset for dashboards: labels for machine, driver,
    operation and operation group; norm completion; only rows with work
    (``positive_only=False`` keeps every fact row: the BI view of the fact)."""
    f = positive(fact, "obem_rabot_ga") if positive_only else fact
    eq = equipment.select(F.col("code_1c").alias("__eq"), F.col("name").alias("__eq_name"),
                          F.col("eq_type").alias("__eq_type"))
    emp = employees.select(F.col("individual_id").alias("__emp"), F.col("description").alias("__emp_name"))
    ops = self_parent_join(operations, "_id", "parent_id", ["description"], prefix="__grp_")
    ops = ops.select(F.col("_id").alias("__op"), F.col("description").alias("__op_name"),
                     F.col("operation_kind").alias("operation_code"),
                     F.col("parent_id").alias("operation_group_id"), F.col("__grp_description").alias("__grp"))
    f = lookup_join(f, eq, [("tehnika_id", "__eq")])
    f = lookup_join(f, emp, [("voditel_id", "__emp")])
    f = lookup_join(f, ops, [("agr_operaciya_id", "__op")])
    return f.select(
        F.to_date("doc_date").alias("work_date"),
        F.trunc(F.to_date("doc_date"), "month").alias("month"),
        F.col("doc_number").alias("document_no"),
        "line_number",
        F.col("tehnika_id").cast("string").alias("equipment_id"),
        F.coalesce("__eq_name", F.col("tehnika_id").cast("string")).alias("equipment"),
        F.coalesce("__eq_type", F.lit(EQUIPMENT_TYPE_UNKNOWN)).alias("equipment_type"),
        F.col("voditel_id").cast("string").alias("employee_id"),
        F.coalesce("__emp_name", F.col("voditel_id").cast("string")).alias("employee"),
        F.col("agr_operaciya_id").cast("string").alias("operation_id"),
        F.col("obem_rabot_ga").alias("work_area_ha"),
        F.col("norma_vyrabotki").alias("work_norm_ha"),
        norm_completion_pct("obem_rabot_ga", "norma_vyrabotki").alias("norm_completion_pct"),
        F.col("doc_id").cast("string").alias("source_doc_id"),
        F.coalesce("__op_name", F.col("agr_operaciya_id").cast("string")).alias("operation_name"),
        "operation_code",
        "operation_group_id",
        F.coalesce("__grp", F.lit(OPERATION_GROUP_NONE)).alias("operation_group"),
    )


# --- goods movement -------------------------------------------------------

def tmc_movement(stg_lines: DataFrame, items: DataFrame, units: DataFrame | None = None,
                 kind_col: str = "operaciya") -> DataFrame:
    """Active movement lines (tolerant rule) with business type, sign, signed
    quantity, item label (unresolved items keep their id) and unit."""
    m = tolerant_active(stg_lines)
    it = items.select(F.col("_id").alias("__it"), F.col("description").alias("__it_name"),
                      *([F.col("edinica_id").alias("__it_unit")] if "edinica_id" in items.columns else []))
    # type and sign before the look-ups: a join of a large catalog does not move the kind's text for them
    m = (m.withColumn("movement_type", movement_type(kind_col))
          .withColumn("quantity_sign", quantity_sign(kind_col))
          .withColumn("quantity_signed", F.col("kolichestvo") * F.col("quantity_sign")))
    m = lookup_join(m, it, [("nomenklatura_id", "__it")])
    m = (m.withColumn("nomenclature", unresolved_item_label("__it_name", "nomenklatura_id"))
          .withColumn("is_nomenclature_resolved", F.col("__it_name").isNotNull()))
    if units is not None:
        u = units.select(F.col("_id").alias("__u"), F.col("description").alias("uom_name"),
                         F.col("code").alias("uom_code"), *[c for c in ("weight_kg", "volume_l") if c in units.columns])
        m = lookup_join(m, u, [("edinica_id", "__u")])
        m = m.withColumn("uom_name", F.coalesce("uom_name", F.lit(UNRESOLVED_UNIT)))
    return m.drop("__it_name", "__it_unit")


def movement_links(movement: DataFrame, warehouses: DataFrame, cost_objects: DataFrame) -> DataFrame:
    """Names of the sending and the receiving warehouse and of the cost object;
    every line is kept.  ``posted_warehouse_id`` is where the signed quantity
    counts: what leaves at the sender, what arrives at the recipient."""
    m = movement
    for key, catalog, name in (("sender_id", warehouses, "sender"), ("recipient_id", warehouses, "recipient"),
                               ("cost_object_id", cost_objects, "cost_object")):
        c = catalog.select(F.col("_id").alias(f"__{name}"), F.col("description").alias(name))
        m = lookup_join(m, c, [(key, f"__{name}")])
    return m.withColumn("posted_warehouse_id", F.when(F.col("quantity_sign") > 0, F.col("recipient_id")).otherwise(F.col("sender_id")))


def movement_fact_bi(fact: DataFrame, items: DataFrame, units: DataFrame) -> DataFrame:
    """BI view of a movement fact: every fact row kept, item and unit labels
    attached by left lookups."""
    it = items.select(F.col("_id").alias("__it"), F.col("description").alias("__it_name"))
    u = units.select(F.col("_id").alias("__u"), F.col("description").alias("uom_name"))
    f = lookup_join(lookup_join(fact, it, [("nomenklatura_id", "__it")]), u, [("edinica_id", "__u")])
    return (f.withColumn("nomenclature", unresolved_item_label("__it_name", "nomenklatura_id"))
             .withColumn("uom_name", F.coalesce("uom_name", F.lit(UNRESOLVED_UNIT))).drop("__it_name"))


def storage_balance(movement: DataFrame, warehouse_col: str, item_col: str, day_col: str = "doc_date",
                    qty_col: str = "quantity_signed", densify: bool = False) -> DataFrame:
    """Balance per warehouse and item after each movement day (or every day
    between a pair's first and last movement with ``densify``)."""
    return running_balance(movement, [warehouse_col, item_col], day_col, qty_col, densify=densify)


# --- harvest --------------------------------------------------------------

CROP_CODE_MAP = (("Ка", "Картофель"),)   # fixed value: crop prefix -> crop


def harvest_enriched(base: DataFrame, items: DataFrame, party_names: DataFrame | None = None,
                     crop_codes=CROP_CODE_MAP) -> DataFrame:
    """Harvest rows with item name and the crop attributes parsed from the
    item name first, then from the party name; tonnes = kg / 1000.

    Names are parsed where they live - once per catalog row (items, party
    names) - and the parsed attributes are joined to the harvest rows, so
    the regular expressions run at catalog, not fact, cardinality.
    ``party_names`` is the catalog the party names come from (one column
    ``description``); without it the distinct names of ``base`` are used.
    """
    spark = base.sparkSession
    it = items.select(F.col("_id").alias("__it"), F.col("description").alias("nomenklatura_name"),
                      parse_item_name("description").alias("__i"))
    names = (party_names.select(F.col("description").alias("__pp")) if party_names is not None
             else base.select(F.col("pole_party_name").alias("__pp"))).where(F.col("__pp").isNotNull()).distinct()
    codes = spark.createDataFrame(list(crop_codes), "__code string, kultura string")
    pp = names.withColumn("__p", parse_party_name("__pp"))
    pp = (pp.withColumn("__code", F.substring(F.col("__p.crop_code"), 1, 2))
            .join(F.broadcast(codes), "__code", "left").drop("__code"))
    h = lookup_join(base, it, [("nomenklatura_id", "__it")])
    h = lookup_join(h, pp, [("pole_party_name", "__pp")])
    code = F.col("__p.crop_code")
    party_sort = F.when(F.length(code) > 2, F.expr("substring(__p.crop_code, 3)"))
    return h.select(
        *base.columns, "nomenklatura_name", "kultura",
        F.coalesce("__i.sort", party_sort).alias("sort"),
        F.coalesce("__i.reproduction", "__p.reproduction", F.lit("")).alias("reproduktsiya"),
        F.coalesce("__i.irrigation", F.lit("Не указан")).alias("poliv"),
        F.coalesce(F.col("__i.plot"), F.col("__p.plot")).cast("string").alias("uchastok_nomer"),
        F.coalesce("__i.year", "__p.year").alias("god_1c"),
        (F.col("kolichestvo_kg") / 1000).alias("kolichestvo_t"),
    )


def crop_attributes(h: DataFrame) -> DataFrame:
    """The four crop-dimension attributes of harvest rows (kept where they are there already)."""
    if {"variety", "color", "reproduction", "irrigation"} <= set(h.columns):
        return h
    return h.select(
        variety_label("kultura", "sort").alias("variety"),
        color_label("nomenklatura_name", "pole_party_name").alias("color"),
        reproduction_label("reproduktsiya").alias("reproduction"),
        irrigation_label("poliv").alias("irrigation"),
        *h.columns)


def harvest_fact_rows(enriched: DataFrame, dim_field: DataFrame, dim_nom: DataFrame,
                      dim_crop: DataFrame) -> DataFrame:
    """Harvest rows keyed by the current field, item and crop dimension rows."""
    h = crop_attributes(enriched)
    f = dim_field.where(F.col("is_current")).select(F.col("field_code_1c").alias("__f"), "field_sk")
    n = dim_nom.select(F.col("ref_key_1c").alias("__n"), "nom_sk")
    h = h.withColumn("__pf", F.col("pole_id").cast("string")).withColumn("__nf", F.col("nomenklatura_id").cast("string"))
    h = lookup_join(lookup_join(h, f, [("__pf", "__f")], how="inner"), n, [("__nf", "__n")], how="inner") \
        .drop("__pf", "__nf")
    h = null_safe_join(h, dim_crop.select("variety", "color", "reproduction", "irrigation", "crop_sk"),
                       ["variety", "color", "reproduction", "irrigation"], "inner", broadcast=None)
    return h.select(F.to_date("doc_date").alias("date_day"), "field_sk", "crop_sk", "nom_sk",
                    F.col("uchastok_nomer").alias("plot_no"), F.lit(None).cast("decimal(10,2)").alias("area_ha"),
                    F.col("kolichestvo_kg").cast("decimal(18,2)").alias("weight_kg"),
                    F.col("src_doc_id").cast("string").alias("src_doc_ref"))


HARVEST_KEYS = ["doc_date", "pole_id", "nomenklatura_id", "variety", "color", "reproduction", "irrigation",
                "uchastok_nomer", "kolichestvo_kg", "src_doc_id"]


def route_harvest(rows: DataFrame, dim_field: DataFrame, dim_nom: DataFrame, dim_crop: DataFrame) -> DataFrame:
    """Every harvest row once, keyed to the dimensions as far as they go, with
    all ``reasons`` why it is no fact row (none: it is one).  ``rows`` are
    enriched rows, or rejects of an earlier run: those keep what the lookups
    need, so a dimension row that arrives late turns them into facts.  The yield
    is NULL without an area (the field version's, if it has one)."""
    h = crop_attributes(rows).select(*HARVEST_KEYS, F.col("pole_id").cast("string").alias("__pf"), F.col("nomenklatura_id").cast("string").alias("__nf"))
    area = F.col("area_ha") if "area_ha" in dim_field.columns else F.lit(None)
    f = dim_field.where(F.col("is_current")).select(F.col("field_code_1c").alias("__f"), "field_sk", area.cast("decimal(10,2)").alias("area_ha"))
    n = dim_nom.select(F.col("ref_key_1c").alias("__n"), "nom_sk")
    h = lookup_join(lookup_join(h, f, [("__pf", "__f")]), n, [("__nf", "__n")]).drop("__pf", "__nf")
    h = null_safe_join(h, dim_crop.select("variety", "color", "reproduction", "irrigation", "crop_sk"),
                       ["variety", "color", "reproduction", "irrigation"], "left", broadcast=None)
    why = {"no date": F.col("doc_date").isNull(), "no field": F.col("pole_id").isNull(),
           "unknown field": F.col("pole_id").isNotNull() & F.col("field_sk").isNull(), "no item": F.col("nomenklatura_id").isNull(),
           "unknown item": F.col("nomenklatura_id").isNotNull() & F.col("nom_sk").isNull(), "unknown crop": F.col("crop_sk").isNull()}
    weight = F.col("kolichestvo_kg").cast("decimal(18,2)")
    return h.select(*HARVEST_KEYS, F.to_date("doc_date").alias("date_day"), "field_sk", "crop_sk", "nom_sk",
                    F.col("uchastok_nomer").alias("plot_no"), "area_ha", weight.alias("weight_kg"),
                    yield_t_ha(weight, F.col("area_ha")).alias("yield_t_ha"), F.col("src_doc_id").cast("string").alias("src_doc_ref"),
                    F.array_compact(F.array(*[F.when(c, F.lit(w)) for w, c in why.items()])).alias("reasons"))


def harvest_facts(routed: DataFrame) -> DataFrame:
    """The fact rows of routed rows, with the load stamp."""
    return stamp(routed.where(F.size("reasons") == 0).drop("reasons", *HARVEST_KEYS))


def harvest_rejects(routed: DataFrame) -> DataFrame:
    """The rejected rows with their reasons, fit to be routed again."""
    return routed.where(F.size("reasons") > 0).select(*HARVEST_KEYS, "reasons")


def append_harvest(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert-if-absent by source document: already loaded documents are not
    changed by corrected re-loads."""
    return append_absent(existing, rows, ["src_doc_ref"])


def material_usage(writeoff: DataFrame, items: DataFrame, units: DataFrame) -> DataFrame:
    """Field material usage from write-offs: quantity per field, item and unit.
    Units are told apart by id, so units without a name are never summed
    together; names are looked up for the sums only."""
    used = writeoff.groupBy(F.to_date("doc_date").alias("date_day"), "pole_id", "nomenklatura_id", "edinica_id").agg(
        F.sum("kolichestvo").alias("quantity"))
    it = items.select(F.col("_id").alias("__it"), F.col("description").alias("item_name"))
    u = units.select(F.col("_id").alias("__u"), F.col("description").alias("unit_name"))
    named = lookup_join(lookup_join(used, it, [("nomenklatura_id", "__it")]), u, [("edinica_id", "__u")])
    return named.select("date_day", "pole_id", "nomenklatura_id", "item_name", "edinica_id", "unit_name", "quantity")


def fuel_usage(fuel: DataFrame, work: DataFrame, dim_equipment: DataFrame, dim_field: DataFrame) -> DataFrame:
    """Fuel fact: a machine's litres of a month on the fields it worked, to the
    last digit; litres without work have no field, those of an unknown machine
    or field keep a NULL key."""
    split = allocate_exactly(fuel, work, ["equipment_id", "month"], "field_id", "fuel_l", "area_ha")
    e = dim_equipment.select(F.col("code_1c").alias("__e"), "eq_sk")
    f = dim_field.where(F.col("is_current")).select(F.col("field_code_1c").alias("__f"), "field_sk")
    keyed = lookup_join(lookup_join(split, e, [("equipment_id", "__e")]), f, [("field_id", "__f")])
    return stamp(keyed.select(F.col("month").alias("date_day"), "equipment_id", "field_id", "eq_sk", "field_sk",
                              F.col("allocated").alias("liters"), F.col("driver").alias("area_ha")))
