"""Tables survive replays and a lost record; validity and unit rules."""

import datetime as dt
import os
import tempfile

import pytest
from conftest import rows

from fieldbook.operators.joins import asof_join
from fieldbook.operators.predicates import safe_report_rows
from fieldbook.constants import UNRESOLVED_UNIT
from fieldbook.sources import sinks
from fieldbook.streaming import ingest


@pytest.mark.parametrize("seq", [["seq"], []])
def test_replayed_batch_keeps_every_row(spark, seq):
    base, log = tempfile.mkdtemp(prefix="replay-"), tempfile.mkdtemp(prefix="log-")
    run = ingest._merge_batch(base, ["k"], seq, log, "e")
    batch = lambda *r: spark.createDataFrame(list(r), "k long, v string, seq long")
    run(batch((1, "a", 1), (2, "b", 1)), 0)
    for _ in range(2):
        run(batch((2, "c", 2), (3, "d", 2)), 1)
    assert rows(sinks.read_current(spark, base).select("k", "v")) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(spark.read.parquet(log).select("batch_id", "rows_read")) == [(0, 2), (1, 2)]


def test_a_batch_writes_only_what_it_brings(spark):
    base, log = tempfile.mkdtemp(prefix="delta-"), tempfile.mkdtemp(prefix="log-")
    run = ingest._merge_batch(base, ["k"], ["seq"], log, "e")
    batch = lambda *r: spark.createDataFrame(list(r), "k long, v string, seq long")
    count = lambda name: spark.read.parquet(os.path.join(base, name)).count()
    run(batch(*[(k, "old", 1) for k in range(20)]), 0)
    run(batch((3, "new", 2), (3, "newer", 3), (4, "late", 0)), 1)
    assert sorted(f for f in os.listdir(base) if "=" in f) == ["d=b000000000001", "v=b000000000000"]
    assert count("d=b000000000001") == 2 and count("v=b000000000000") == 20
    got = dict(rows(sinks.read_current(spark, base).select("k", "v")))
    assert len(got) == 20 and got[3] == "newer" and got[4] == "old"      # a late row of an older version does not win
    run(batch(*[(k, "again", 4) for k in range(10, 30)]), 2)             # as large as the table: both become the next version
    assert sinks.current_version(spark, base) == "v=b000000000002-whole"
    got = dict(rows(sinks.read_current(spark, base).select("k", "v")))
    assert len(got) == 30 and got[3] == "newer" and got[4] == "old" and got[10] == "again"
    assert rows(spark.read.parquet(log).select("batch_id", "rows_read", "rows_written", "rows_rejected", "status")) == [
        (0, 20, 20, 0, "loaded"), (1, 3, 2, 1, "loaded"), (2, 20, 20, 0, "loaded")]


def test_a_lost_record_is_an_error(spark):
    base = tempfile.mkdtemp(prefix="lost-")
    assert sinks.read_current(spark, base) is None
    sinks.write_table(spark.range(2), os.path.join(base, "v=a"))
    with pytest.raises(RuntimeError, match="lost"):
        sinks.publish_version(spark.range(1), base, run_id="b")


def test_a_repeated_run_never_writes_over_what_it_reads(spark):
    base = tempfile.mkdtemp(prefix="again-")
    sinks.publish_version(spark.range(3), base, run_id="x")
    sinks.publish_version(sinks.read_current(spark, base).union(spark.range(3, 5)), base, run_id="x")
    assert sinks.read_current(spark, base).count() == 5
    assert sinks.current_version(spark, base) == "v=x~1"


@pytest.mark.parametrize("bucket", ["month", None])
def test_asof_ends_with_the_version(spark, bucket):
    d = dt.date
    versions = spark.createDataFrame([(1, d(2020, 1, 1), d(2021, 1, 1), "old"), (1, d(2022, 1, 1), None, "new"),
                                      (2, d(2020, 1, 1), None, "a"), (2, d(2020, 1, 1), None, "b")],
                                     "k int, vf date, vt date, attr string")
    facts = spark.createDataFrame([(1, d(2020, 6, 1)), (1, d(2021, 1, 1)), (1, d(2021, 6, 1)), (1, d(2024, 1, 1)), (2, d(2020, 1, 1))],
                                  "k int, t date")
    got = rows(asof_join(facts, versions, "k", "t", "vf", ["attr"], bucket=bucket, valid_to="vt").select("k", "t", "attr"))
    assert got == sorted([(1, d(2020, 6, 1), "old"), (1, d(2021, 1, 1), None), (1, d(2021, 6, 1), None),
                          (1, d(2024, 1, 1), "new"), (2, d(2020, 1, 1), "b")], key=repr)


def test_unknown_units_stay_out_of_reports(spark):
    df = spark.createDataFrame([(True, "kg"), (True, UNRESOLVED_UNIT), (True, None), (False, "kg")],
                               "is_nomenclature_resolved boolean, uom_name string")
    assert rows(safe_report_rows(df)) == [(True, "kg")]
