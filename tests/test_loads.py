"""Dimension loads out of order, routed facts, and rows with NULL keys."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldbook.operators.scd2 import scd2_load, scd2_versions
from fieldbook.plans import dims, facts, production
from tests.conftest import rows

SNAP = "code string, day date, seq int, a string, b int"


def snapshots(spark, data):
    return spark.createDataFrame(data, SNAP)


def versions(df):
    return sorted((r.code, r.valid_from, r.valid_to, r.a, r.b, r.is_current) for r in df.collect())


BATCHES = [
    [("x", date(2024, 1, 1), 1, "A", 1), ("x", date(2024, 1, 5), 1, "A", 1), ("y", date(2024, 2, 1), 1, None, None),
     (None, date(2024, 1, 1), 1, "lost", 0), ("x", None, 1, "lost", 0)],
    [("x", date(2024, 1, 9), 1, "B", 1), ("x", date(2024, 1, 9), 2, "B", 2), ("z", date(2024, 3, 1), 1, "Z", 0)],
    [("x", date(2024, 1, 3), 1, "C", 1), ("x", date(2023, 12, 1), 1, "A", 1), ("y", date(2024, 3, 1), 1, None, None)],   # late
    [("x", date(2024, 1, 3), 9, "A", 1)],                                            # the late day again: joined to one
]


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (1, 0, 2, 3), (2, 3, 1, 0)])
def test_scd2_load_equals_rebuild_in_any_order(spark, order):
    loaded, seen = None, {}
    for n in order:
        loaded = scd2_load(loaded, snapshots(spark, BATCHES[n]), "code", "day", ["a", "b"], ["seq"])
        for code, day, *rest in sorted(BATCHES[n], key=lambda r: r[2]):
            if code and day:
                seen[code, day] = (code, day, *rest)                                # the batch loaded last wins a day
        whole = scd2_versions(snapshots(spark, list(seen.values())), "code", "day", ["a", "b"], ["seq"])
        assert versions(loaded.versions) == versions(whole)
        keys = [r.sk for r in loaded.versions.collect()]
        assert len(set(keys)) == len(keys) and None not in keys


def test_scd2_load_splits_and_keeps_keys(spark):
    load = lambda loaded, data: scd2_load(loaded, snapshots(spark, data), "code", "day", ["a", "b"], ["seq"])
    one = load(None, BATCHES[0])
    first = {(r.code, r.valid_from): r.sk for r in one.versions.collect()}
    two = load(one, [("x", date(2024, 1, 3), 1, "C", 1)])
    got = {(r.code, r.valid_from): r for r in two.versions.collect()}
    assert [(got["x", date(2024, 1, d)].a, got["x", date(2024, 1, d)].valid_to) for d in (1, 3, 5)] == [
        ("A", date(2024, 1, 3)), ("C", date(2024, 1, 5)), ("A", date(9999, 12, 31))]
    assert all(got[k].sk == sk for k, sk in first.items()) and min(got["x", date(2024, 1, d)].sk for d in (3, 5)) > max(first.values())
    assert load(None, []).versions.count() == 0 and load(two, []).versions.count() == 4


HARVEST = ("doc_date timestamp_ntz, pole_id string, nomenklatura_id string, variety string, color string, reproduction string, "
           "irrigation string, uchastok_nomer string, kolichestvo_kg decimal(18,3), src_doc_id string")


def test_routed_harvest_keeps_every_row(spark):
    at = datetime(2024, 8, 1, 9)
    data = [(at, "f1", "i1", "v", None, None, "p", "1", Decimal(5000), "d1"), (at, "f2", "i1", "v", None, None, "p", None, Decimal(1), "d2"),
            (None, None, "zz", "v", "red", None, "p", None, None, "d3"), (at, "f1", None, "v", None, None, "p", None, Decimal(2), "d4")]
    e = spark.createDataFrame([*data, data[0]], HARVEST)
    field = spark.createDataFrame([("f1", 1, True, Decimal(2)), ("f1", 9, False, Decimal(7)), ("f2", 2, True, None)],
                                  "field_code_1c string, field_sk long, is_current boolean, area_ha decimal(10,2)")
    item = spark.createDataFrame([("i1", 5)], "ref_key_1c string, nom_sk long")
    crop = spark.createDataFrame([("v", None, None, "p", 3)], "variety string, color string, reproduction string, irrigation string, crop_sk long")
    routed = facts.route_harvest(e, field.where("field_code_1c = 'f1'"), item, crop)
    good = facts.harvest_facts(routed)
    assert rows(good.select("src_doc_ref", "field_sk", "crop_sk", "nom_sk", "yield_t_ha")) == [("d1", 1, 3, 5, Decimal("2.50"))] * 2
    assert "_loaded_at" in good.columns and good.where("_loaded_at is null").count() == 0
    refused = facts.harvest_rejects(routed)
    assert {r.src_doc_id: r.reasons for r in refused.collect()} == {
        "d2": ["unknown field"], "d3": ["no date", "no field", "unknown item", "unknown crop"], "d4": ["no item"]}
    again = facts.route_harvest(refused, field, item, crop)
    assert rows(facts.harvest_facts(again).select("src_doc_ref", "field_sk", "yield_t_ha")) == [("d2", 2, None)]
    assert facts.harvest_rejects(again).count() == 2


def test_crop_attributes_are_derived_once(spark):
    e = spark.createDataFrame([("Ка", "Гала", "", "Не указан", "белый", None)], "kultura string, sort string, reproduktsiya string, "
                              "poliv string, nomenklatura_name string, pole_party_name string")
    once = facts.crop_attributes(e)
    again = dims.crop_candidates(once)
    assert facts.crop_attributes(once).columns == once.columns
    assert rows(again) == rows(dims.crop_candidates(e)) and len(rows(again)) == 1


def test_null_codes_and_masters_are_kept(spark):
    cat = spark.createDataFrame([(None, "x", False), ("b", "y", False), ("c", "z", True)], "_id string, description string, _deletionmark boolean")
    got = dims.simple_dim(cat, {"code": "_id", "name": "description"}, ["code"], "sk")
    assert rows(got.select("code", "name", "sk")) == sorted([(None, "x", 1), ("b", "y", 2)], key=repr)
    sheet = spark.createDataFrame([(date(2024, 1, 1), None, "1", Decimal(1), Decimal(2), Decimal(3), Decimal(4)),
                                   (date(2024, 1, 1), "m", None, Decimal(1), Decimal(2), Decimal(3), Decimal(0))],
                                  "shift_date date, master string, shift_code string, plan_kg decimal(18,2), fact_kg decimal(18,2), "
                                  "plan_hours decimal(10,2), fact_hours decimal(10,2)")
    dim = production.dim_shift(sheet)
    assert dim.count() == 2 and production.production_output(sheet, dim).count() == 2


def test_open_history_lines_last_to_the_end(spark):
    h = spark.createDataFrame([("f", 1, 0, "c", date(2020, 5, 1), None, None), ("f", 2, None, "c", date(2021, 1, 1), date(2022, 1, 1), False),
                               ("f", 3, 2023, "c", None, None, False), ("f", 4, 2030, "c", None, None, True), ("f", 5, 0, "c", None, None, None)],
                              "field_id string, line_number int, year int, crop string, valid_from date, valid_to date, unused boolean")
    h = h.withColumns({"sown_area_ha": F.lit(1), "total_area_ha": F.lit(1)})
    got = sorted((r.line_number, r.year) for r in production.field_history_mart(h).collect())
    assert got == [(1, 2020), (1, 2021), (1, 2022), (1, 2023), (2, 2021), (2, 2022), (3, 2023)]
