"""Entity-driven load (I-02, I-06 ... I-10, I-14) on landed pages."""

import glob
import json
import os
import random
import tempfile
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from fieldbook import schemas
from fieldbook.functions.normalize import lenient_decimal
from fieldbook.registry.entities import entity_document_load
from fieldbook.registry.standins import Tables
from fieldbook.session import scratch_path
from fieldbook.sources import entities
from fieldbook.sources.entities import ENTITIES
from tests.conftest import rows, shuffled_bytes

ZERO = "00000000-0000-0000-0000-000000000000"


def land(*pages):
    folder = tempfile.mkdtemp(prefix="entity-")
    for n, page in enumerate(pages):
        with open(os.path.join(folder, f"p{n}.json"), "w", encoding="utf-8") as f:
            f.write(page if isinstance(page, str) else json.dumps({"value": page}, ensure_ascii=False))
    return folder


def weighing(key="A", **more):
    return {"Ref_Key": key, "DeletionMark": False, "Posted": True, "Number": "1", "Date": "2025-09-01T10:00:00",
            "ВидВзвешивания": "СПоля", "Откуда": "S1", "Куда": ZERO, "Номенклатура_Key": "", "Водитель": None,
            "Автомобиль": "null", "ВесТары": 1.5, "ВесБрутто": "11.5", "ВесНетто": "десять", "Автор_Key": None,
            "Талоны": [], **more}


def slip(n, **more):
    return {"LineNumber": n, "Поле_Key": "F", "НомерТалона": "7", "ТипТалона": "", "Масса": 3, "Комбайн_Key": ZERO,
            "Механизатор": None, "ОбъемБункера": "x", "ПроцентЗаполнения": None, **more}


def unit(key, **more):
    return {"Ref_Key": key, "DeletionMark": None, "Description": "кг", "Code": "01", "Вес": "1.25", "Объем": None, **more}


def test_every_entity_fits_its_raw_table():
    for name, entity in ENTITIES.items():
        columns = {f.name for f in schemas.RAW[name].fields}
        assert set(entity.fields) <= columns and set(entity.key) <= set(entity.fields), name
        for part in entity.parts:
            assert set(part.fields) | {"doc_id", "line_number"} <= {f.name for f in schemas.RAW[part.table].fields}, part.table
    assert ENTITIES["weighing"].select().startswith("Ref_Key,DeletionMark,Posted,Number,Date,ВидВзвешивания,Откуда")


def test_document_with_table_part(spark):
    got = entities.load(spark, land([weighing(Талоны=[slip(0), slip(5, Масса="много")], Новое={"a": 1})]), ENTITIES["weighing"])
    r = got.rows.first()
    assert [f.name for f in schemas.RAW["weighing"].fields] == got.rows.columns[:-2]
    assert (r._id, r.otkuda_id, r.kuda_id, r.nomenklatura_id, r.avtomobil_id) == ("A", "s1", None, None, None)
    assert (r.ves_tary_kg, r.ves_brutto_kg, r.ves_netto_kg) == (Decimal("1.5"), Decimal("11.5"), None)
    assert r.doc_date == datetime(2025, 9, 1, 10, 0) and r._posted is True
    assert r._unparsed == {"ves_netto_kg": "десять"} and json.loads(r._rest) == {"Новое": '{"a":1}'}
    lines = sorted(got.lines["weighing_slips"].collect(), key=lambda x: x.line_number)
    assert [(x.doc_id, x.line_number, x.line_key, x.massa_kg, x.kombayn_id) for x in lines] == [
        ("A", 1, "A-1", Decimal(3), None), ("A", 5, "A-5", None, None)]
    assert lines[1]._unparsed == {"massa_kg": "много", "obem_bunkera": "x"} and got.rejects.count() == 0


@pytest.mark.parametrize("name", ["ВесНетто", "Date"])
def test_a_field_that_is_not_sent_is_an_error(spark, name):
    doc = weighing()
    del doc[name]
    with pytest.raises(Exception, match=f"not sent: {name}"):
        entities.load(spark, land([weighing("B"), doc]), ENTITIES["weighing"]).rows.collect()
    bad = slip(1)
    del bad["Масса"]
    with pytest.raises(Exception, match="Талоны: not sent: Масса"):
        entities.load(spark, land([weighing(Талоны=[bad])]), ENTITIES["weighing"]).lines["weighing_slips"].count()


def test_a_missing_table_part_gives_no_line(spark):
    doc = weighing("B")
    del doc["Талоны"]
    got = entities.load(spark, land([doc, weighing("C", Талоны=None)]), ENTITIES["weighing"])
    assert got.rows.count() == 2 and got.lines["weighing_slips"].count() == 0


def test_rejects_keep_the_document_and_all_reasons(spark):
    got = entities.load(spark, land([unit("a"), unit(""), unit(None, Вес="тонна", Объем="-"), unit("b", Вес="null")]), ENTITIES["units"])
    assert sorted((r._id, r.weight_kg) for r in got.rows.collect()) == [("a", Decimal("1.25")), ("b", None)]
    refused = {tuple(r.reasons): json.loads(r.doc) for r in got.rejects.collect()}
    assert set(refused) == {("no _id",), ("no _id", "not a number: weight_kg, volume_l")}
    assert refused["no _id", "not a number: weight_kg, volume_l"]["Вес"] == "тонна"


def test_repeated_keys_by_entity(spark):
    first = {"Ref_Key": "w", "DeletionMark": False, "Posted": True, "Number": "1", "Date": "2025-01-01T00:00:00",
             "ДатаНачалаРабот": None, "ДатаОкончанияРабот": None, "Техника_Key": "t", "Механизатор": "m", "МоточасовВсего": 1,
             "Комментарий": "first"}
    pages = land([first], [{**first, "Комментарий": "second"}])
    assert entities.load(spark, pages, ENTITIES["waybill"]).rows.first().kommentariy == "first"
    pages = land([unit("a"), unit("a", Description="x")], [unit("a", Description="last")])
    assert [r.description for r in entities.load(spark, pages, ENTITIES["units"]).rows.collect()] == ["last"]
    kept = entities.load(spark, land([weighing(Талоны=[slip(1)])], [weighing(Талоны=[slip(2), slip(3)])]), ENTITIES["weighing"])
    assert sorted(r.line_number for r in kept.lines["weighing_slips"].collect()) == [2, 3]          # lines of the kept version


def test_folders_are_skipped_where_the_source_says_so(spark):
    crop = {"Ref_Key": "c", "DeletionMark": False, "Description": "Пшеница", "Parent_Key": "", "IsFolder": False, "КультураПоКлассификатору": "1"}
    docs = [crop, {**crop, "Ref_Key": "d", "IsFolder": True}, {**crop, "Ref_Key": "e", "IsFolder": None}]
    assert sorted(r._id for r in entities.load(spark, land(docs), ENTITIES["crops"]).rows.collect()) == ["c", "e"]
    item = {"Ref_Key": "i", "DeletionMark": False, "Description": "x", "Parent_Key": "p", "ТипЗатрат": "z", "IsFolder": True}
    assert entities.load(spark, land([item]), ENTITIES["expense_items"]).rows.count() == 1


def test_torn_pages_are_reported(spark):
    got = entities.load(spark, land([unit("a")], '{"value":[{"Ref_Key":', '{"error": "busy"}', {"value": []}["value"], ""), ENTITIES["units"])
    assert got.rows.count() == 1 and sorted(r.page for r in got.pages.collect()) == ['{"error": "busy"}', '{"value":[{"Ref_Key":']


def test_merge_into_the_raw_table(spark):
    units = ENTITIES["units"]
    old = entities.load(spark, land([unit("a"), unit("b")]), units).rows.select(*[f.name for f in schemas.RAW["units"].fields])
    new = entities.load(spark, land([unit("b", Description="т"), unit("c")]), units).rows
    assert sorted((r._id, r.description) for r in entities.merge(old, new, units.key).collect()) == [("a", "кг"), ("b", "т"), ("c", "кг")]


def parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_a_document_is_parsed_once_whatever_is_asked_of_it(spark):
    sent = {"Ref_Key": "b-1", "LineNumber": 1, "ВидРаботы_Key": "3", "ЕдиницаДопОбъема_Key": None, "Гектаров": "4.5", "СменнаяНормаВыработки": "9"}
    got = entities.load(spark, land([sent]), ENTITIES["waybill_lines"])
    work = got.rows.select("doc_id", "line_number", "obem_rabot_ga")
    assert parses(work) == 2                              # the page and the document, whatever filters read of them
    assert [tuple(r) for r in work.collect()] == [("b-1", 1, Decimal("4.5"))] and got.rows.first()._rest is None
    more = entities.load(spark, land([{**sent, "Новое": [1]}]), ENTITIES["waybill_lines"])
    assert more.rows.first()._rest == '{"Новое":"[1]"}'


def test_rows_and_parts_come_from_one_reading_of_the_pages(spark):
    got = entities.load(spark, land([weighing(Талоны=[slip(1, Масса="около 3"), slip(2, Масса=" 1e2 ")])]), ENTITIES["weighing"])
    lines = got.lines["weighing_slips"].select("line_key", "massa_kg", "_unparsed")
    assert parses(got.rows.select("_id", "ves_brutto_kg")) == 0 and parses(lines.select("massa_kg")) == 1
    assert [(r.line_key, r.massa_kg, r._unparsed["massa_kg"] if "massa_kg" in r._unparsed else None) for r in lines.orderBy("line_key").collect()] == [
        ("A-1", None, "около 3"), ("A-2", Decimal(100), None)]
    for text in ("NaN", "-Infinity", ".5", "+7", " 8", "\t9", "1d", "нет", "e5", "", None):
        assert spark.range(1).select(entities._typed(F.lit(text).cast("string"), entities.LENIENT, DecimalType(9, 2))
                                     .eqNullSafe(lenient_decimal(F.lit(text).cast("string"), 9, 2))).first()[0], text


def orders_and_lines(spark, orders=900, twice=()):
    """A folder of orders and lineitem: 0 to 3 lines an order, some orders twice, lines and orders without a key."""
    folder, day = tempfile.mkdtemp(prefix="tables-"), datetime(1995, 5, 1)
    heads = [(k, k % 7, "FOP"[k % 3], 1.5 * k, day.replace(month=1 + k % 12), "5-LOW") for k in [*range(orders), *twice]] + [(None, 1, "F", 1.0, day, "5-LOW")]
    lines = [(k, 1 + k % 9, 3, n, float(k % 50), 10.0 * k, 0.05, 0.02, "ANR"[(k + n) % 3], "FO"[n % 2], day.replace(month=1 + (k + n) % 12))
             for k in range(orders) for n in range(k % 4)] + [(None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", day)]
    spark.createDataFrame(heads, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, folder)


def test_landed_pages_are_compressed_and_leave_no_shuffles(spark):
    t = orders_and_lines(spark, twice=[3, 6])
    before = shuffled_bytes(spark)
    got = entity_document_load(t)
    assert shuffled_bytes(spark, most=before) <= before
    pages = max(glob.glob(os.path.join(scratch_path(spark, "landing"), "weighing-*")), key=os.path.getmtime)
    files = glob.glob(f"{pages}/batch=0/part-*")
    sent = sum(len(r.value.encode()) for r in spark.read.text(files).collect())
    assert 10 * sum(os.path.getsize(f) for f in files) < sent
    lines = rows(got.select("doc_id", "line_number", "ves_brutto_kg"))
    assert lines == sorted(((f"w-{k}", n + 1, Decimal("1.5") * k) for k in range(900) for n in range(k % 4)), key=repr)


def test_stand_in_numbered_by_a_coarser_group(spark):
    t = orders_and_lines(spark)
    got = t.numbered_by("sd_lines", "page", "FLOOR(l_orderkey / 400)")
    assert rows(got.drop("page")) == rows(t.sd_lines) and rows(got.select("page").distinct()) == [(0,), (1,), (2,), (None,)]
    plan = got.groupBy("page", "doc_id").count().groupBy("page").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_whole_documents_are_not_shuffled(spark):
    text = random.Random(1)
    docs = [weighing(str(k), Талоны=[slip(1, НомерТалона=text.randbytes(5000).hex())]) for k in range(200)]
    before = shuffled_bytes(spark)
    got = entities.load(spark, land(docs[:100], docs[100:], [weighing("7", Талоны=[slip(4)])]), ENTITIES["weighing"])
    assert shuffled_bytes(spark, most=before + 100_000) <= before + 100_000
    assert got.rows.count() == 200 and sorted(r.line_number for r in got.lines["weighing_slips"].collect()) == [1] * 199 + [4]


def test_the_version_kept_is_the_first_or_the_last(spark):
    first = entities.Entity("s", "weighing", ENTITIES["weighing"].fields, ENTITIES["weighing"].parts, repeated="first")
    sent = land([weighing("a", Number="1"), weighing("b", Number="2"), weighing("a", Number="3")], [weighing("", Number="4"), weighing("a", Number="5")])
    kept = lambda entity: rows(entities.load(spark, sent, entity).rows.select("_id", "doc_number"))
    assert kept(first) == [("a", "1"), ("b", "2")] and kept(ENTITIES["weighing"]) == [("a", "5"), ("b", "2")]
