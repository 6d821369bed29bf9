"""Declared schemas of the raw entities, their keys and foreign keys.

The ERP source has no usable metadata endpoint, so every entity is read with
a declared schema (no inference); ``sources.entities`` maps source fields to
these columns.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, IntegerType, StringType, StructField, StructType,
    TimestampNTZType, TimestampType,
)

S, B, I = StringType(), BooleanType(), IntegerType()
TS, TSN, D = TimestampType(), TimestampNTZType(), DateType()


def dec(p: int, s: int) -> DecimalType:
    return DecimalType(p, s)


def struct(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


COMMON = [("_id", S), ("_deletionmark", B)]

# --- raw tables -------------------------------------------------------------
RAW = {
    "units": struct(*COMMON, ("description", S), ("code", S), ("weight_kg", dec(12, 4)), ("volume_l", dec(12, 4))),
    "machine_models": struct(*COMMON, ("description", S), ("manufacturer", S), ("equipment_class", S),
                             ("power_hp", dec(8, 2))),
    "fields": struct(*COMMON, ("description", S), ("parent_id", S), ("area_ha", dec(12, 4)), ("cadastr_num", S),
                     ("farm_id", S)),
    "crops": struct(*COMMON, ("description", S), ("parent_id", S), ("crop_kind", S)),
    "fuel_cards": struct(*COMMON, ("description", S), ("card_number", S), ("owner_id", S)),
    "employees": struct(*COMMON, ("description", S), ("individual_id", S), ("position_id", S), ("department_id", S)),
    "cashflow_items": struct(*COMMON, ("description", S), ("parent_id", S), ("cashflow_kind", S)),
    "crop_rotations": struct(*COMMON, ("description", S)),
    "company_structure": struct(*COMMON, ("description", S), ("parent_id", S), ("inn", S), ("node_type", S)),
    "equipment": struct(*COMMON, ("description", S), ("model_id", S), ("reg_number", S), ("equipment_type", S)),
    "expense_items": struct(*COMMON, ("description", S), ("parent_id", S), ("expense_kind", S)),
    "tech_operations": struct(*COMMON, ("description", S), ("parent_id", S), ("operation_kind", S)),
    "nomenclature": struct(*COMMON, ("description", S), ("parent_id", S), ("article", S), ("base_unit_id", S),
                           ("nomen_group_id", S), ("nomen_kind", S)),
    "warehouses": struct(*COMMON, ("description", S), ("parent_id", S), ("warehouse_type", S)),
    "counterparties": struct(*COMMON, ("description", S), ("inn", S), ("kpp", S), ("counterparty_kind", S)),
    "movement": struct(*COMMON, ("_posted", B), ("doc_number", S), ("doc_date", TS), ("operaciya", S),
                       ("sender_id", S), ("recipient_id", S), ("cost_object_id", S), ("work_type_id", S),
                       ("kommentariy", S)),
    "movement_lines": struct(("doc_id", S), ("line_number", I), ("pole_id", S), ("nomenklatura_id", S),
                             ("edinica_id", S), ("kolichestvo", dec(18, 3)), ("summa", dec(18, 2)), ("seriya", S)),
    "waybill": struct(*COMMON, ("_posted", B), ("doc_number", S), ("doc_date", TS), ("data_nachala", TS),
                      ("data_okonchaniya", TS), ("tehnika_id", S), ("model_tehniki_id", S), ("voditel_id", S),
                      ("narabotka_moto_chas", dec(10, 2)), ("probeg_km", dec(10, 2)),
                      ("toplivo_vydano", dec(12, 3)), ("toplivo_vozvrat", dec(12, 3)), ("kommentariy", S)),
    "waybill_lines": struct(("doc_id", S), ("line_number", I), ("pole_id", S), ("agr_operaciya_id", S),
                            ("edinica_id", S), ("obem_rabot_ga", dec(12, 4)), ("norma_vyrabotki", dec(10, 3))),
    "weighing": struct(*COMMON, ("_posted", B), ("doc_number", S), ("doc_date", TSN), ("vid_vzveshivaniya", S),
                       ("otkuda_id", S), ("kuda_id", S), ("nomenklatura_id", S), ("voditel_id", S),
                       ("avtomobil_id", S), ("ves_tary_kg", dec(18, 3)), ("ves_brutto_kg", dec(18, 3)),
                       ("ves_netto_kg", dec(18, 3)), ("avtor_id", S)),
    "weighing_slips": struct(("doc_id", S), ("line_number", I), ("pole_id", S), ("nomer_talona", S),
                             ("tip_talona", S), ("massa_kg", dec(18, 3)), ("kombayn_id", S), ("mehanizator_id", S),
                             ("obem_bunkera", dec(18, 3)), ("procent_zapolneniya", dec(6, 2))),
    "writeoff": struct(*COMMON, ("_posted", B), ("doc_number", S), ("doc_date", TSN), ("otpravitel_text", S),
                       ("poluchatel_text", S), ("operaciya", S), ("otvetstvennyi_id", S)),
    "writeoff_lines": struct(("doc_id", S), ("line_number", I), ("nomenklatura_id", S), ("kolichestvo", dec(18, 3)),
                             ("edinica_id", S)),
    "fuel_summary": struct(*COMMON, ("doc_number", S), ("doc_date", TSN), ("period_start", D), ("period_end", D),
                           ("organization_id", S), ("department_id", S)),
    "fuel_summary_lines": struct(("doc_id", S), ("line_number", I), ("equipment_id", S), ("fuel_brand", S),
                                 ("nachalny_ostatok_l", dec(18, 3)), ("zapravleno_l", dec(18, 3)),
                                 ("fakticheskiy_rashod_l", dec(18, 3)), ("konechny_ostatok_l", dec(18, 3))),
    "production_stages": struct(*COMMON, ("doc_number", S), ("doc_date", TSN), ("organization_id", S),
                                ("podrazdelenie_text", S), ("status", S), ("otvetstvennyi_id", S)),
    "field_history": struct(("field_id", S), ("line_number", I), ("year", I), ("crop", S),
                            ("total_area_ha", dec(12, 4)), ("sown_area_ha", dec(12, 4)),
                            ("contour_area_ha", dec(12, 4)), ("cost_object_id", S), ("valid_from", D),
                            ("valid_to", D), ("unused", B), ("department", S)),
    "sheet_shifts": struct(("shift_date", D), ("field_id", S), ("crop_id", S), ("equipment_id", S),
                           ("employee_id", S), ("operation", S), ("area_ha", dec(12, 4)),
                           # columns the production fact needs but the sheet did not declare
                           ("master", S), ("shift_code", S), ("item_id", S), ("warehouse_id", S),
                           ("plan_kg", dec(18, 2)), ("fact_kg", dec(18, 2)), ("plan_hours", dec(10, 2)),
                           ("fact_hours", dec(10, 2))),
    "sheet_downtime": struct(("downtime_date", D), ("equipment_id", S), ("reason", S), ("duration_hours", dec(8, 2)),
                             ("master", S), ("shift_code", S), ("reason_group", S)),
}

KEYS = {name: (["doc_id", "line_number"] if name.endswith("_lines") or name == "weighing_slips"
               else ["field_id", "line_number"] if name == "field_history" else ["_id"])
        for name in RAW if not name.startswith("sheet_")}

# foreign keys declared by the warehouse (child, column, parent, column)
FOREIGN_KEYS = [
    ("movement_lines", "doc_id", "movement", "_id"),
    ("waybill_lines", "doc_id", "waybill", "_id"),
    ("weighing_slips", "doc_id", "weighing", "_id"),
    ("writeoff_lines", "doc_id", "writeoff", "_id"),
    ("fuel_summary_lines", "doc_id", "fuel_summary", "_id"),
]
