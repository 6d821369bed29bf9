"""DataFrame helpers of the operators: reading, writing once, components."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Only the wanted columns, by exact name, whatever else the table has."""
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underlined until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list, as (node, comp) with
    the smallest node of the component; nodes without an edge are absent.

    Alternating large-star and small-star steps: every step is one grouped
    minimum (combined before the shuffle) and one join, so a hub with a third
    of all edges is pre-aggregated, and the rounds grow with the logarithm of
    the graph.  Each round is written to the shared folder, which cuts the
    lineage.  An empty edge list gives an empty result.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u is not null and v is not null and u <> v").distinct())
    e = materialize(e, "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = materialize(small, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003), F.countDistinct("u")).first()
        now = tuple(now)
        if now == before or now[0] == now[2] and _is_star(e):
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _is_star(e: DataFrame) -> bool:
    """Whether no node is both a leaf and a centre (each node has one edge)."""
    return e.select(F.col("v").alias("u")).join(e.select("u"), "u", "left_semi").isEmpty()
