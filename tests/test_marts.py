"""Sheets, production facts, slips, history mart, sinks and entity schemas."""

import json
import os
import tempfile
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from fieldbook import schemas
from fieldbook.functions.parsers import parse_article
from fieldbook.plans import production, staging
from fieldbook.sources import pages, sinks
from fieldbook.sources.sheets import read_sheet
from tests.conftest import rows


def _csv(text):
    d = tempfile.mkdtemp(prefix="sheet-")
    with open(os.path.join(d, "s.csv"), "w", encoding="utf-8") as f:
        f.write(text)
    return d


def test_sheet_production_and_downtime(spark):
    shifts = read_sheet(spark, _csv(
        "shift_date,field_id,crop_id,equipment_id,employee_id,operation,area_ha,master,shift_code,item_id,"
        "warehouse_id,plan_kg,fact_kg,plan_hours,fact_hours\n"
        "2024-09-01,,,,,,,Иванов,день,i1,w1,1000,900,8,6\n"
        "2024-09-01,,,,,,,Петров,ночь,i1,w1,500,0,8,0\n"), schemas.RAW["sheet_shifts"])
    down = read_sheet(spark, _csv(
        "downtime_date,equipment_id,reason,duration_hours,master,shift_code,reason_group\n"
        "2024-09-01,e1,поломка,1.5,Иванов,день,оборудование\n"), schemas.RAW["sheet_downtime"])
    sd = production.dim_shift(shifts, down)
    assert sd.count() == 2
    out = {r.fact_kg: r.productivity_kg_h for r in production.production_output(shifts, sd).collect()}
    assert out == {Decimal("900.00"): Decimal("150.00"), Decimal("0.00"): None}
    rd = production.dim_downtime_reason(down)
    dt = production.downtime_fact(down, sd, rd).collect()
    assert len(dt) == 1 and dt[0].duration_h == Decimal("1.50")


def test_slips_keep_combine_slips_with_field(spark):
    slips = spark.createDataFrame([
        ("d1", 1, "00000000-0000-0000-0000-000000000000", "ТалонКомбайнера"),
        ("d1", 2, "F-1", "ТалонКомбайнера"), ("d1", 3, "F-2", "Другой"), ("d1", 4, None, "ТалонКомбайнера")],
        "doc_id string, line_number int, pole_id string, tip_talona string")
    w = spark.createDataFrame([("d1", datetime(2025, 9, 1), "N1")], "_id string, doc_date timestamp, doc_number string")
    out = staging.stg_slips(slips, w).collect()
    assert [(r.line_number, r.pole_id, r.god_urozhaya) for r in out] == [(2, "f-1", 2025)]


def test_field_history_mart(spark):
    h = spark.createDataFrame([
        ("F1", 1, 2024, "c1", Decimal("10"), Decimal("12"), None, None, False),
        ("F1", 2, 0, "c2", Decimal("5"), Decimal("6"), date(2021, 1, 1), date(2022, 12, 31), None),
        ("F1", 3, 2023, "c3", Decimal("7"), Decimal("7"), None, None, True)],
        "field_id string, line_number int, year int, crop string, sown_area_ha decimal(12,4), "
        "total_area_ha decimal(12,4), valid_from date, valid_to date, unused boolean")
    got = sorted((r.year, r.crop) for r in production.field_history_mart(h).collect())
    assert got == [(2021, "c2"), (2022, "c2"), (2024, "c1")]


def test_article_parser(spark):
    df = spark.createDataFrame([("К_ГПР_ГаБРС3/45+_МСД3НН",)], "a string")
    p = df.select(parse_article("a").alias("p")).first().p
    assert p.kind == "К"


def test_versioned_publish(spark):
    base = tempfile.mkdtemp(prefix="table-")
    v1 = sinks.publish_version(sinks.stamp(spark.range(3)), base, run_id="1")
    assert sinks.read_current(spark, base).count() == 3
    sinks.publish_version(spark.range(5), base, run_id="2")
    assert sinks.current_version(spark, base) == "v=2" and v1 == "v=1"
    assert sinks.read_current(spark, base).count() == 5


def test_stream_matches_batch(spark):
    from fieldbook.streaming import ingest
    src = tempfile.mkdtemp(prefix="stream-src-")
    ev = spark.createDataFrame([(1, datetime(2024, 1, 1, 5), "a", 1.25), (2, datetime(2024, 1, 1, 6), "a", 2.5),
                                (3, datetime(2024, 1, 2, 1), "b", 4.0), (1, datetime(2024, 1, 1, 5), "a", 1.25)],
                               "event_id long, ts timestamp, event_type string, value double")
    ev.coalesce(1).write.mode("overwrite").parquet(src)
    target, ckpt, log = ingest.stream_paths(tempfile.mkdtemp(prefix="stream-"))
    ingest.run_to_end(ingest.stream_daily_volume(spark, src, ev.schema, target, ckpt, log_dir=log))
    got = rows(sinks.read_current(spark, target).select("day", "event_type", "events", F.col("value").cast("double")))
    assert got == [(date(2024, 1, 1), "a", 2, 3.75), (date(2024, 1, 2), "b", 1, 4.0)]   # duplicate event dropped
    assert spark.read.parquet(log).count() >= 1


def test_daily_stream_counts_late_events_of_many_files(spark):
    from fieldbook.streaming import ingest
    src, base = tempfile.mkdtemp(prefix="late-src-"), tempfile.mkdtemp(prefix="late-")
    schema = "event_id long, ts timestamp, event_type string, value double"
    target, ckpt, log = ingest.stream_paths(base)

    def land(month):                        # five files, and the first event of the other load once more
        found = [(100 * month + k, datetime(2024, month, 1 + k), "a", 1.5) for k in range(10)] + [(600, datetime(2024, 6, 1), "a", 1.5)] * 2
        spark.createDataFrame(found, schema).repartition(5).write.mode("append").parquet(src)
        ingest.run_to_end(ingest.stream_daily_volume(spark, src, spark.createDataFrame([], schema).schema, target, ckpt, log_dir=log, max_files=2))

    for month in (6, 1, 3):                 # newest first, several micro-batches each
        land(month)
    got = rows(sinks.read_current(spark, target).select("day", "event_type", "events", F.col("value").cast("double")))
    assert got == sorted([(date(2024, m, 1 + k), "a", 1, 1.5) for m in (1, 3, 6) for k in range(10)], key=repr)


def test_reports_pivot_share_and_enforce(spark):
    import pytest as _pytest
    from fieldbook.plans import metrics, quality, reports
    w = spark.createDataFrame([("op1", date(2024, 5, 1), Decimal("10")), ("op1", date(2024, 6, 1), Decimal("5")),
                               ("op2", date(2024, 5, 1), Decimal("3"))],
                              "operation_name string, month date, work_area_ha decimal(12,4)")
    wide = {r.operation_name: (r[1], r[2]) for r in
            reports.heatmap_operation_month(w, months=[date(2024, 5, 1), date(2024, 6, 1)]).collect()}
    assert wide == {"op1": (Decimal("10.0000"), Decimal("5.0000")), "op2": (Decimal("3.0000"), None)}
    m = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "g string, ok boolean")
    assert rows(metrics.resolved_share(m, ["g"], "ok")) == [("a", 2, 1, 0.5), ("b", 1, 1, 1.0)]
    with _pytest.raises(quality.QualityError):
        quality.enforce(m.where("NOT ok"), "unresolved")
    assert quality.enforce(m.where("NOT ok"), "unresolved", severity="warn") == 1
