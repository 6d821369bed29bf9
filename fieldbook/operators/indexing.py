"""Dense surrogate keys without a single-partition window.

``dense_rank() OVER (ORDER BY natural key)`` with no PARTITION BY runs in one
task.  Here the distinct keys are range-partitioned, sorted and written once
with their place, each partition's rows are counted in the written copy (one
tiny row per partition), the prefix sums of those counts are broadcast back,
and a row's key is its partition offset plus its position inside the
partition.  Counting and numbering read the same copy, so a stage that runs
again cannot give them different ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.session import materialize


def dense_keys(df: DataFrame, natural: list[str], sk_col: str = "sk",
               start_after: Column | int = 0, num_partitions: int | None = None) -> DataFrame:
    """Distinct ``natural`` tuples numbered 1.. in ascending order (NULLs first),
    shifted by ``start_after`` (e.g. the current maximum key of a dimension)."""
    order = [F.col(c).asc_nulls_first() for c in natural]
    d = df.select(*natural).distinct()
    # without an explicit count AQE may merge adjacent small ranges; merged
    # partitions stay in key order, and ids/positions are taken per task
    ranged = d.repartitionByRange(num_partitions, *order) if num_partitions else d.repartitionByRange(*order)
    s = materialize(ranged.sortWithinPartitions(*order)
                    .withColumn("__p", F.spark_partition_id())
                    .withColumn("__m", F.monotonically_increasing_id()), "dense_keys")
    stats = s.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__m0"))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    out = s.join(F.broadcast(offs.select("__p", "__m0", "__off")), "__p")
    return out.select(*natural, (base + F.col("__off") + F.col("__m") - F.col("__m0") + 1).cast("bigint").alias(sk_col))


def assign_new_keys(existing: DataFrame, incoming: DataFrame, natural: list[str], sk_col: str,
                    null_safe: bool = True) -> DataFrame:
    """Surrogate keys for natural tuples not yet in ``existing``, continuing
    after its maximum key.  Existing rows keep their keys."""
    from fieldbook.operators.joins import anti_join
    new = anti_join(incoming.select(*natural).distinct(), existing, natural, null_safe=null_safe)
    mx = existing.agg(F.coalesce(F.max(sk_col), F.lit(0)).alias("__mx"))
    keyed = dense_keys(new, natural, "__rel")
    return (keyed.join(F.broadcast(mx), how="inner")
                 .select(*natural, (F.col("__mx") + F.col("__rel")).cast("bigint").alias(sk_col)))
