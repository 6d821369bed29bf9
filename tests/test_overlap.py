"""Overlapping and late loads against a batch count; bounded comparison; log."""

import os
import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fieldbook.streaming import ingest, overlap
from tests.conftest import rows

EVENT = "event_id long, ts timestamp, event_type string, value double"
START = datetime(2024, 1, 1)


def event(n, hours=None):
    return (n, START + timedelta(hours=n if hours is None else hours), "ab"[n % 2], n / 4)


def load(spark, base, batch_id, data):
    overlap.load_batch(spark.createDataFrame(data, EVENT), batch_id, base)


def test_ten_overlapping_loads_equal_one_batch(spark):
    base, sent = tempfile.mkdtemp(prefix="overlap-"), {}
    loads = [[event(n) for n in range(max(0, 24 * k - 48), 24 * k + 24)] for k in range(10)]      # 48 h again in each
    loads[7] += [event(1000 + n, hours=n) for n in range(5)]                                      # seven days late
    loads[9] += [event(1000 + n, hours=n) for n in range(5)]                                      # and once more
    loads[4] += [(None, START, "a", 1.0), (2000, None, "a", 1.0)]
    for k, data in enumerate(loads):
        load(spark, base, k, data)
        sent |= {e[0]: e for e in data if e[0] is not None and e[1] is not None}
    load(spark, base, 4, loads[4])                                                                # a replay changes nothing
    want = {}
    for _, ts, kind, value in sent.values():
        n, total = want.get((ts.date(), kind), (0, 0))
        want[ts.date(), kind] = (n + 1, total + value)
    got = {(r.day, r.event_type): (r.events, float(r.value)) for r in overlap.read_volume(spark, base).collect()}
    assert got == want
    log = {r.batch_id: r for r in overlap.read_log(spark, base).collect()}
    assert [log[k].rows_late for k in range(10)] == [0] * 7 + [5, 0, 0]
    assert log[4].rows_read == 74 and log[4].rows_accepted == 24 and log[4].rows_repeated == 50
    assert (log[9].rows_accepted, log[9].rows_repeated) == (24, 53)
    # what is compared stays at the overlap (and the late rows' days), not at the history
    assert max(log[k].keys_compared for k in (5, 6, 8)) <= 96 and log[9].keys_compared <= 120


def test_stream_of_files_and_progress(spark):
    base, landing = tempfile.mkdtemp(prefix="overlap-"), tempfile.mkdtemp(prefix="overlap-in-")
    for part in ([event(n) for n in range(30)], [event(n) for n in range(20, 60)], []):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(landing)
    q = overlap.stream_overlap(spark, landing, spark.read.parquet(landing).schema, base, os.path.join(base, "_ck"), max_files=1)
    ingest.run_to_end(q)
    assert overlap.read_volume(spark, base).agg(F.sum("events")).first()[0] == 60
    report = [p for p in overlap.progress(q) if p["rows_in"]]
    assert [p["rows_in"] for p in report] == [30, 40] and all(p["state_rows"] == 0 for p in report)
    assert rows(overlap.read_log(spark, base).where("rows_read > 0").select("batch_id", "rows_read", "rows_accepted")) == [(0, 30, 30), (1, 40, 30)]


def test_nothing_loaded(spark):
    base = tempfile.mkdtemp(prefix="overlap-")
    assert overlap.read_volume(spark, base) is None and overlap.read_log(spark, base) is None
    load(spark, base, 0, [])
    assert overlap.read_volume(spark, base).count() == 0 and overlap.read_log(spark, base).first().rows_read == 0
