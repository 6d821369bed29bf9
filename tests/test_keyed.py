"""Bucketed keyed tables against a plain dictionary; files and plans of merges."""

import os
import random
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldbook.plans import facts
from fieldbook.sources import keyed

SCHEMA = "k long, v string, seq long"


def listing(base):
    return {os.path.join(d, f)[len(base):] for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}


def test_merges_equal_a_dictionary(spark):
    base, rng, truth = tempfile.mkdtemp(prefix="keyed-"), random.Random(2), {}
    assert keyed.read(spark, base) is None
    for n, size in enumerate([200, 7, 60, 0, 150]):
        batch = {(rng.choice([None, *range(300)]), rng.randint(0, 9)): f"v{n}-{i}" for i in range(size)}
        for (k, s), v in batch.items():                 # a later batch wins a tie, within one no (key, seq) repeats
            if k not in truth or s >= truth[k][1]:
                truth[k] = (v, s)
        df = spark.createDataFrame([(k, v, s) for (k, s), v in batch.items()], SCHEMA)
        keyed.merge(df, base, f"b{n}", ["k"], ["seq"], buckets=8)
        assert keyed.merge(df, base, f"b{n}", ["k"], ["seq"], buckets=8) == {}     # a replay changes nothing
        got = {r.k: (r.v, r.seq) for r in keyed.read(spark, base).collect()}
        assert got == truth and keyed.read(spark, base).count() == len(truth)
    wanted = spark.createDataFrame([(None,), (5,), (999,)], "k int")
    assert {r.k for r in keyed.look_up(wanted, base).collect()} == {None, 5} & set(truth)
    with pytest.raises(ValueError):
        keyed.merge(df, base, "x", ["v"], ["seq"])
    with pytest.raises(ValueError):
        keyed.merge(df.withColumn("_bucket", F.lit(1)), base, "x", ["k"], ["seq"])


def test_merge_and_look_up_touch_only_their_buckets(spark):
    base = tempfile.mkdtemp(prefix="keyed-")
    batch = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    keyed.merge(batch(*[(k, "old", 1) for k in range(800)]), base, "a", ["k"], ["seq"], buckets=8)
    before = listing(base)
    touched = keyed.merge(batch((3, "new", 2)), base, "b", ["k"], ["seq"])
    assert len(touched) == 1 and len(listing(base) - before) == 1 and before <= listing(base)
    bucket = f"_bucket={next(iter(touched))}/"
    key = spark.createDataFrame([(3,)], "k long")
    found = keyed.look_up(key, base)
    assert rows(found.select("k", "v")) == [(3, "new")]
    assert all(bucket in f for f in found.inputFiles()) and len(found.inputFiles()) == 2
    plan = keyed.read(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1                      # the one bucket with a delta; the others are read as they stand
    assert len(keyed.read(spark, base).inputFiles()) == 9
    # half as many rows as the bucket has: only that bucket is written anew
    same = [r.k for r in keyed.read(spark, base, list(touched)).collect()]
    keyed.merge(batch(*[(k, "again", 3) for k in same]), base, "c", ["k"], ["seq"])
    assert {f.split("/")[3] for f in listing(base) if "/whole/" in f} == {bucket[:-1]}
    assert "Window [" not in keyed.read(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert keyed.read(spark, base).where("v = 'again'").count() == len(same)


def test_bucketed_tables_join_without_a_shuffle(spark):
    folder = tempfile.mkdtemp(prefix="bucketed-")
    names = [f"keyed_{os.path.basename(folder).replace('-', '_')}_{x}" for x in "ab"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = (keyed.save_bucketed(spark.range(500).withColumnRenamed("id", "k").withColumn(c, F.lit(c)), name,
                                    os.path.join(folder, c), ["k"], 8) for c, name in zip("xy", names, strict=True))
        joined = a.join(b, "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_usage_keeps_units_without_a_name_apart(spark):
    used = spark.createDataFrame([(1, 7, 8, 1.0), (1, 7, 9, 2.0), (1, 7, 9, 3.0)], "pole_id int, nomenklatura_id int, edinica_id int, kolichestvo double")
    used = used.withColumn("doc_date", F.lit("2024-05-01").cast("timestamp"))
    catalog = spark.createDataFrame([(7, "item")], "_id int, description string")
    got = facts.material_usage(used, catalog, catalog.limit(0))
    assert rows(got.select("edinica_id", "unit_name", "quantity")) == [(8, None, 1.0), (9, None, 5.0)]
