"""Running stock balance from signed movements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_movement(movements: DataFrame, keys: list[str], day_col: str, qty_col: str) -> DataFrame:
    """Signed quantity per key and day (partial aggregation before the shuffle)."""
    return movements.groupBy(*keys, F.to_date(F.col(day_col)).alias("date_day")).agg(
        F.sum(qty_col).alias("qty_day"))


def running_balance(movements: DataFrame, keys: list[str], day_col: str, qty_col: str,
                    densify: bool = False) -> DataFrame:
    """Balance per key after each day.

    Movements are first summed per key and day, so the cumulative window of
    a key holds one row per day, however many lines that key has.
    ``densify`` adds the days without movement between a key's first and
    last movement (never the full calendar x keys product): each row is
    repeated up to the day before the key's next one, after the window, so
    the added days are neither shuffled nor sorted.  A key with a NULL part
    has its days, without any quantity; movements without a day are left out.
    """
    daily = daily_movement(movements, keys, day_col, qty_col)
    by_day = Window.partitionBy(*keys).orderBy("date_day")
    w = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not densify:
        return daily.withColumn("balance", F.sum("qty_day").over(w))
    none = F.lit(0).cast(daily.schema["qty_day"].dataType)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    daily = daily.where(F.col("date_day").isNotNull()).withColumn("qty_day", F.coalesce(F.when(known, F.col("qty_day")), none))
    last = F.coalesce(F.date_sub(F.lead("date_day").over(by_day), 1), F.col("date_day"))
    spans = daily.withColumns({"balance": F.sum("qty_day").over(w), "__moved": F.col("date_day"), "__last": last})
    days = spans.select(*keys, F.explode(F.sequence("__moved", "__last", F.expr("INTERVAL 1 DAY"))).alias("date_day"),
                        "qty_day", "balance", "__moved")
    return days.withColumn("qty_day", F.when(F.col("date_day") == F.col("__moved"), F.col("qty_day")).otherwise(none)).drop("__moved").select(
        *keys, "date_day", "qty_day", "balance")
