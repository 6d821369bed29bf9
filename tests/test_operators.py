"""Operators on hand-made fixtures (rules N1-N4, N8-N14, N20, N21, N24, N26)."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldbook.operators import predicates as P
from fieldbook.operators.allocation import allocate_by_share
from fieldbook.operators.balance import running_balance
from fieldbook.operators.dedup import latest_per_key
from fieldbook.operators.indexing import dense_keys
from fieldbook.operators.joins import anti_join, asof_join, lookup_join, null_safe_join
from fieldbook.operators.scd2 import scd2_versions
from fieldbook.operators.upsert import DuplicateKeyError, append_absent, upsert, upsert_set_based
from fieldbook.plans import quality
from tests.conftest import rows

FLAGS = [True, False, None]


def headers(spark):
    data = [(i, p, d) for i, (p, d) in enumerate((p, d) for p in FLAGS for d in FLAGS)]
    return spark.createDataFrame(data, "_id int, _posted boolean, _deletionmark boolean")


def test_three_null_rules(spark):
    h = headers(spark)
    assert P.strict_active(h).count() == 1
    assert P.tolerant_not_deleted(h).count() == 6
    assert P.tolerant_active(h).count() == 2
    assert P.dim_not_deleted(h).count() == 3


def test_last_writer_and_preserved_columns(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "k int, v string, p string")
    upd = spark.createDataFrame([(1, "x", "new", 1), (1, "y", "new", 2), (3, "z", "new", 1)],
                                "k int, v string, p string, seq int")
    out = upsert(target, upd, ["k"], update_cols=["v"], seq_cols=["seq"])
    assert rows(out) == [(1, "y", "keep"), (2, "b", "keep"), (3, "z", "new")]


def test_set_based_upsert_rejects_duplicate_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        upsert_set_based(t, spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string"), ["k"])


def test_null_key_loaded_twice_is_one_row(spark):
    src = spark.createDataFrame([(1, None, 5), (1, 7, 6)], "doc int, item int, q int")
    empty = src.limit(0)
    once = upsert(empty, src, ["doc", "item"])
    twice = upsert(once, src, ["doc", "item"])
    assert twice.count() == 2


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=12))
def test_upsert_is_idempotent(spark, data):
    src = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k int, v int, seq int")
    target = spark.createDataFrame([(0, 99, -1)], "k int, v int, seq int")
    once = upsert(target, src, ["k"], seq_cols=["seq"])
    assert rows(upsert(once, src, ["k"], seq_cols=["seq"])) == rows(once)


def test_append_absent_keeps_loaded_documents(spark):
    fact = spark.createDataFrame([("d1", 10)], "src string, kg int")
    again = spark.createDataFrame([("d1", 11), ("d2", 5)], "src string, kg int")
    assert rows(append_absent(fact, again, ["src"])) == [("d1", 10), ("d2", 5)]


def test_latest_per_key_null_date_first(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, date(2024, 1, 1), "b"), (1, date(2024, 2, 1), "c")],
                               "k int, d date, name string")
    assert latest_per_key(df, "k", "d", ["name"]).first().name == "a"


def test_null_safe_join_and_anti(spark):
    dim = spark.createDataFrame([("v", None, None, "x", 1)], "a string, b string, c string, d string, sk int")
    fact = spark.createDataFrame([("v", None, None, "x")], "a string, b string, c string, d string")
    assert null_safe_join(fact, dim, ["a", "b", "c", "d"]).count() == 1
    assert anti_join(fact, dim, ["a", "b", "c", "d"], null_safe=True).count() == 0
    assert anti_join(fact, dim, ["a", "b", "c", "d"]).count() == 1


def test_lookup_fanout_is_reported(spark):
    fields = spark.createDataFrame([("f1", "318"), ("f2", "318"), ("f3", "100")], "_id string, description string")
    fact = spark.createDataFrame([(1, "318")], "w int, nomer string")
    j = lookup_join(fact, fields, [("nomer", "description")])
    assert j.count() == 2
    assert quality.lookup_fanout(fields, "description").count() == 1


def test_lookup_null_split_matches_plain_join(spark):
    fact = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "i int, k string")
    dim = spark.createDataFrame([("a", "A")], "k string, name string")
    assert rows(lookup_join(fact, dim, "k", split_null_keys=True)) == rows(lookup_join(fact, dim, "k"))


def test_unit_mixing(spark):
    df = spark.createDataFrame([("i1", "kg"), ("i1", "t"), ("i2", "kg")], "item string, unit string")
    assert rows(quality.unit_mixing(df, ["item"], "unit")) == [("i1", 2)]


def test_running_balance_densified(spark):
    mv = spark.createDataFrame([("w", "i", datetime(2024, 1, 1), Decimal("10")),
                                ("w", "i", datetime(2024, 1, 3), Decimal("-4"))],
                               "wh string, item string, d timestamp, q decimal(18,3)")
    out = running_balance(mv, ["wh", "item"], "d", "q", densify=True).orderBy("date_day")
    assert [float(r.balance) for r in out.collect()] == [10.0, 10.0, 6.0]


def test_densified_days_are_not_joined_or_shuffled(spark):
    day = lambda d: datetime(2024, 1, d)
    mv = spark.createDataFrame([("w", "i", day(1), Decimal(10)), ("w", "i", day(1), Decimal(5)), ("w", "i", day(4), None),
                                ("w", "i", day(5), Decimal(-3)), ("w", "j", day(2), Decimal(1)), (None, "i", day(2), Decimal(9)),
                                (None, "i", day(3), Decimal(9)), ("w", "k", None, Decimal(4))], "wh string, item string, d timestamp, q decimal(18,3)")
    out = running_balance(mv, ["wh", "item"], "d", "q", densify=True)
    got = sorted((r.wh or "", r.item, r.date_day.day, float(r.qty_day), float(r.balance)) for r in out.collect())
    assert got == [("", "i", 2, 0, 0), ("", "i", 3, 0, 0), ("w", "i", 1, 15, 15), ("w", "i", 2, 0, 15), ("w", "i", 3, 0, 15),
                   ("w", "i", 4, 0, 15), ("w", "i", 5, -3, 12), ("w", "j", 2, 1, 1)]
    plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2   # the daily sums and the window over them


def test_fuel_allocation(spark):
    fuel = spark.createDataFrame([("m1", "2024-05", 100.0), ("m2", "2024-05", 100.0)], "m string, mon string, l double")
    work = spark.createDataFrame([("m1", "2024-05", "A", 30.0), ("m1", "2024-05", "B", 10.0)],
                                 "m string, mon string, f string, ha double")
    out = {(r.m, r.f): r.allocated for r in allocate_by_share(fuel, work, ["m", "mon"], "f", "l", "ha").collect()}
    assert out == {("m1", "A"): 75.0, ("m1", "B"): 25.0, ("m2", None): 100.0}


def test_dense_keys_match_dense_rank(spark):
    df = spark.range(0, 3000).select((F.col("id") % 997).alias("a"), (F.col("id") % 7).alias("b"))
    got = {(r.a, r.b): r.sk for r in dense_keys(df, ["a", "b"], "sk", num_partitions=5).collect()}
    want = {k: i + 1 for i, k in enumerate(sorted(got))}
    assert got == want


def test_asof_join_matches_brute_force(spark):
    versions = spark.createDataFrame([(1, date(2024, 1, 1), "A"), (1, date(2024, 3, 1), "B"), (2, date(2024, 2, 1), "C")],
                                     "k int, vf date, attr string")
    facts = spark.createDataFrame([(1, date(2023, 12, 31)), (1, date(2024, 1, 1)), (1, date(2024, 5, 1)),
                                   (2, date(2024, 2, 2)), (3, date(2024, 1, 1))], "k int, t date")
    got = rows(asof_join(facts, versions, "k", "t", "vf", ["attr"]))
    vs = versions.collect()
    want = []
    for f in facts.collect():
        c = [v for v in vs if v.k == f.k and v.vf <= f.t]
        want.append((f.k, f.t, max(c, key=lambda v: v.vf).attr if c else None))
    assert got == sorted(want, key=repr)


def test_scd2_versions(spark):
    snaps = spark.createDataFrame([("f1", datetime(2024, 1, 1), "A", 1), ("f1", datetime(2024, 2, 1), "A", 2),
                                   ("f1", datetime(2024, 3, 1), "B", 3), ("f1", datetime(2024, 3, 1), "C", 4)],
                                  "key string, ts timestamp, attr string, seq int")
    v = scd2_versions(snaps, "key", "ts", ["attr"], ["seq"]).orderBy("valid_from").collect()
    assert [(r.attr, r.valid_from, r.valid_to, r.is_current) for r in v] == [
        ("A", date(2024, 1, 1), date(2024, 3, 1), False), ("C", date(2024, 3, 1), date(9999, 12, 31), True)]


def test_asof_join_buckets_match_per_key_scan(spark):
    import random
    rnd = random.Random(7)
    vs = [(k, date(2023, 1, 1).fromordinal(date(2023, 1, 1).toordinal() + rnd.randrange(0, 700)), f"v{i}")
          for i, k in enumerate(rnd.choice([1, 1, 1, 2, 3]) for _ in range(40))]
    fs = [(rnd.choice([1, 1, 1, 1, 2, 3, 4]), date(2023, 1, 1).fromordinal(date(2023, 1, 1).toordinal()
                                                                         + rnd.randrange(-30, 760)))
          for _ in range(500)]
    versions = spark.createDataFrame(vs, "k int, vf date, attr string").dropDuplicates(["k", "vf"])
    facts = spark.createDataFrame(fs, "k int, t date")
    by_month = rows(asof_join(facts, versions, "k", "t", "vf", ["attr"], bucket="month"))
    by_day = rows(asof_join(facts, versions, "k", "t", "vf", ["attr"], bucket="day"))
    per_key = rows(asof_join(facts, versions, "k", "t", "vf", ["attr"], bucket=None))
    assert by_month == per_key == by_day


def test_broadcast_is_bound_in_bytes(spark):
    from fieldbook.operators.joins import broadcast_if_small
    df = spark.createDataFrame([("x" * 500,), (None,)], "s string")
    hinted = lambda limit: "broadcast" in broadcast_if_small(df, limit)._jdf.queryExecution().toString()
    assert hinted(600) and not hinted(400)
    assert "broadcast" in broadcast_if_small(df.where("false"), 0)._jdf.queryExecution().toString()


def test_yield_takes_the_areas_of_the_crop(spark):
    from datetime import date
    from decimal import Decimal as D
    from fieldbook.plans.metrics import yield_by_field_crop_year
    harvest = spark.createDataFrame([("f", "a", 2024, D("6000")), ("f", "b", 2024, D("1000")), ("f", "a", 2023, D("4000")),
                                     ("f", None, 2024, D("500")), ("g", "a", 2024, D("7"))],
                                    "pole_id string, kultura string, god_urozhaya int, kolichestvo_kg decimal(18,3)")
    history = spark.createDataFrame([
        ("f", "a", 2024, None, None, D("2")), ("f", "a", 2024, None, None, D("1")), ("f", "b", 2024, None, None, D("0")),
        ("f", "a", 0, date(2022, 5, 1), None, D("4")), ("g", "a", 0, date(2025, 1, 1), None, D("4"))],
        "field_id string, crop string, year int, valid_from date, valid_to date, sown_area_ha decimal(12,4)")
    got = {tuple(r[:3]): r.yield_t_ha for r in yield_by_field_crop_year(harvest, history).collect()}
    assert got == {("f", "a", 2024): D("2.00"), ("f", "b", 2024): None, ("f", "a", 2023): D("1.00"),
                   ("f", None, 2024): None, ("g", "a", 2024): None}


def test_allocation_in_whole_units_sums_back(spark):
    import random
    from decimal import Decimal
    from fieldbook.operators.allocation import allocate_exactly
    rng = random.Random(6)
    amounts = [(k, Decimal(rng.randint(-5000, 50_000)) / 1000) for k in range(60) for _ in range(2)]
    drivers = [(k, f"f{n}", Decimal(rng.choice([0, 1, 1, 3, 7, 12_345])) / 10_000) for k in range(55) for n in range(rng.randint(0, 6))]
    drivers += [(3, "bad", Decimal(-1)), (4, None, Decimal(1))]
    got = allocate_exactly(spark.createDataFrame(amounts, "k int, amount decimal(12,3)"),
                           spark.createDataFrame(drivers, "k int, field string, area decimal(12,4)"), ["k"], "field", "amount", "area").collect()
    totals, parts = {}, {}
    for k, a in amounts:
        totals[k] = totals.get(k, 0) + a
    for r in got:
        parts.setdefault(r.k, []).append(r)
    assert {k: sum(r.allocated for r in rs) for k, rs in parts.items()} == totals                  # to the last digit
    for k, rs in parts.items():
        whole = sum(r.driver or 0 for r in rs)
        for r in rs:
            assert r.field is None or r.driver is None or abs(r.allocated - totals[k] * r.driver / whole) < Decimal("0.001")
    assert allocate_exactly(spark.createDataFrame([], "k int, amount decimal(12,3)"),
                            spark.createDataFrame(drivers, "k int, field string, area decimal(12,4)"), ["k"], "field", "amount", "area").count() == 0


def test_total_row_by_rollup_scans_once(spark):
    from fieldbook.operators.aggregates import with_total_row
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 4)], "kind string, n int")
    out = with_total_row(df, "kind", [F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")], "TOTAL")
    assert sorted(map(tuple, out.select("kind", "n", "rows").collect()), key=repr) == [("TOTAL", 7, 3), ("a", 3, 2), (None, 4, 1)]
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
