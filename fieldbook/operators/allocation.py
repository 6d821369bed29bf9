"""Proportional allocation (fuel per field by worked area)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def allocate_by_share(amounts: DataFrame, drivers: DataFrame, keys: list[str], target: str,
                      amount_col: str, driver_col: str) -> DataFrame:
    """Split each ``amount`` over ``target`` rows in proportion to ``driver``.

    amounts: ``keys + [amount_col]`` (e.g. machine, month, fuel litres)
    drivers: ``keys + [target, driver_col]`` (e.g. machine, month, field, hectares)

    Result: ``keys, target, driver, driver_total, share, allocated``.  Key
    groups with an amount but no positive driver total get one row with
    ``target`` NULL carrying the whole amount as unallocated, so the
    allocated column always sums back to the amounts.  Both sides are
    aggregated before they are joined: the join sees one row per key group
    and target, not per source line.
    """
    amt = amounts.groupBy(*keys).agg(F.sum(amount_col).alias("amount"))
    drv = drivers.groupBy(*keys, target).agg(F.sum(driver_col).alias("driver"))
    tot = drv.groupBy(*keys).agg(F.sum("driver").alias("driver_total"))
    shares = drv.join(tot, keys).where(F.col("driver_total") > 0)
    allocated = (amt.join(shares, keys)
                 .withColumn("share", F.col("driver").cast("double") / F.col("driver_total").cast("double"))
                 .withColumn("allocated", F.col("amount").cast("double") * F.col("driver").cast("double")
                             / F.col("driver_total").cast("double")))
    unalloc = (amt.join(tot.where(F.col("driver_total") > 0), keys, "left_anti")
               .select(*keys, F.lit(None).cast(drv.schema[target].dataType).alias(target),
                       F.lit(None).cast(drv.schema["driver"].dataType).alias("driver"),
                       F.lit(None).cast(tot.schema["driver_total"].dataType).alias("driver_total"),
                       "amount",
                       F.lit(None).cast("double").alias("share"),
                       F.col("amount").cast("double").alias("allocated")))
    return allocated.select(*unalloc.columns).unionByName(unalloc)


def allocate_exactly(amounts: DataFrame, drivers: DataFrame, keys: list[str], target: str,
                     amount_col: str, driver_col: str, scale: int = 3) -> DataFrame:
    """As ``allocate_by_share``, in whole units of ``scale`` decimals that sum
    back to the amount to the last digit (largest remainder).

    Every target gets the whole units of its share; the units left over, fewer
    than there are targets, go one each to the greatest remainders, ties to the
    greater driver, then to the smaller target.  Negative amounts are split like
    their opposite; negative drivers count as none.  Amounts may have ``scale``
    decimals at most.  Result: ``keys, target, driver, amount, allocated``.
    """
    whole = lambda c, s: (F.col(c).cast(f"decimal(38,{s})") * 10 ** s).cast("decimal(19,0)")
    amt = amounts.groupBy(*keys).agg(F.sum(amount_col).alias("amount"))
    finest = drivers.schema[driver_col].dataType
    digits = finest.scale if isinstance(finest, DecimalType) else 0
    drv = drivers.where(F.col(driver_col) > 0).groupBy(*keys, target).agg(F.sum(driver_col).alias("driver"))
    total = drv.groupBy(*keys).agg(F.sum("driver").alias("driver_total"))
    j = amt.join(drv.join(total, keys), keys).withColumns({
        "__u": F.abs(whole("amount", scale)), "__d": whole("driver", digits), "__t": whole("driver_total", digits)})
    j = j.withColumns({"__share": F.call_function("div", F.col("__u") * F.col("__d"), F.col("__t")),
                       "__rest": F.col("__u") * F.col("__d") % F.col("__t")})
    group = Window.partitionBy(*keys)                       # a group is one row per target
    j = j.withColumns({"__left": F.col("__u") - F.sum("__share").over(group),
                       "__rn": F.row_number().over(group.orderBy(F.desc("__rest"), F.desc("driver"), F.col(target)))})
    units = F.col("__share") + F.when(F.col("__rn") <= F.col("__left"), 1).otherwise(0)
    units = F.when(F.col("amount") < 0, -units).otherwise(units)
    kind = f"decimal(38,{scale})"
    split = j.select(*keys, target, "driver", "amount", (units.cast("decimal(30,0)") / 10 ** scale).cast(kind).alias("allocated"))
    without = amt.join(total, keys, "left_anti").select(
        *keys, F.lit(None).cast(drv.schema[target].dataType).alias(target), F.lit(None).cast(drv.schema["driver"].dataType).alias("driver"),
        "amount", F.col("amount").cast(kind).alias("allocated"))
    return split.unionByName(without)
