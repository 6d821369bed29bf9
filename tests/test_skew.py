"""Skewed inputs: a key that is NULL on every row, a key holding most rows."""

from pyspark.sql import functions as F

from fieldbook.operators.balance import running_balance
from fieldbook.operators.dedup import first_per_key
from fieldbook.operators.joins import lookup_join
from fieldbook.operators.ranking import top_n_per_group
from tests.conftest import rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_null_link_keeps_every_row(spark):
    fact = spark.range(0, 5000).select("id", F.lit(None).cast("string").alias("pole_id"))
    dim = spark.range(0, 100).select(F.col("id").cast("string").alias("pole_id"), F.lit("f").alias("name"))
    plain = lookup_join(fact, dim, "pole_id", broadcast=False)
    split = lookup_join(fact, dim, "pole_id", broadcast=False, split_null_keys=True)
    assert split.count() == 5000 and rows(split) == rows(plain)
    assert split.where(F.col("name").isNotNull()).count() == 0


def test_hot_key_first_row_is_reduced_before_the_shuffle(spark):
    # two thirds of the rows share key 0
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"),
                                      F.col("id").alias("v"))
    out = first_per_key(df, "k", [F.col("v").desc()])
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.where("k = 0").first().v == 29999 and out.count() == 10000


def test_hot_group_top_n(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") < 15000, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
                                      F.col("id").alias("v"))
    out = top_n_per_group(df, "g", [F.col("v").desc()], 3)
    assert rows(out.select("g", "v")) == sorted([("hot", 14999), ("hot", 14998), ("hot", 14997),
                                                 ("cold", 19999), ("cold", 19998), ("cold", 19997)], key=repr)
    assert "Partial" in _plan(out)


def test_hot_pair_balance_is_aggregated_per_day_first(spark):
    mv = spark.range(0, 20000).select(F.lit("w").alias("wh"), F.lit("i").alias("item"),
                                      F.expr("timestamp_seconds(id * 3600)").alias("ts"), F.lit(1).alias("q"))
    out = running_balance(mv, ["wh", "item"], "ts", "q")
    plan = _plan(out)
    assert plan.index("Window") < plan.rindex("HashAggregate")   # window sits above the daily aggregate
    assert out.count() == 834 and out.agg(F.max("balance")).first()[0] == 20000
