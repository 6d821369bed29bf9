"""Movement classification: operation kind -> movement type and sign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.constants import MOVEMENT_KINDS


def movement_kind_map(spark: SparkSession, kinds=MOVEMENT_KINDS) -> DataFrame:
    """The kind map as a (tiny, fixed-size) DataFrame: operation, movement_type, quantity_sign."""
    return spark.createDataFrame(list(kinds), "operation string, movement_type string, quantity_sign int")


def movement_type(op, kinds=MOVEMENT_KINDS) -> Column:
    """Inline CASE form of the map (no join needed for a handful of kinds)."""
    o = F.col(op) if isinstance(op, str) else op
    expr = None
    for k, t, _ in kinds:
        expr = (F.when(o == k, F.lit(t)) if expr is None else expr.when(o == k, F.lit(t)))
    return expr


def quantity_sign(op, kinds=MOVEMENT_KINDS) -> Column:
    o = F.col(op) if isinstance(op, str) else op
    expr = None
    for k, _, s in kinds:
        expr = (F.when(o == k, F.lit(s)) if expr is None else expr.when(o == k, F.lit(s)))
    return expr


def signed_quantity(qty, sign) -> Column:
    q = F.col(qty) if isinstance(qty, str) else qty
    s = F.col(sign) if isinstance(sign, str) else sign
    return q * s
