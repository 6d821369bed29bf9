"""Slowly changing dimension, type 2."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.constants import OPEN_END_DATE
from fieldbook.operators.dedup import first_per_key
from fieldbook.operators.indexing import dense_keys
from fieldbook.operators.joins import anti_join, semi_join
from fieldbook.operators.upsert import upsert
from fieldbook.session import materialize


def scd2_versions(snapshots: DataFrame, key: str, date_col: str, attrs: list[str],
                  tiebreak: list[str]) -> DataFrame:
    """Versions ``(key, attrs..., valid_from, valid_to, is_current)`` from dated
    attribute snapshots.

    1. several snapshots of a key on one day: the last by ``tiebreak`` counts;
    2. a new version starts where any attribute differs (null-safe) from the
       previous day's value;
    3. ``valid_to`` is the next version's start (half-open); the open end is
       9999-12-31.
    Windows are per key over at most one row per day, so a key's window holds
    its history in days, not its raw rows.
    """
    day = F.to_date(F.col(date_col))
    daily = first_per_key(snapshots.withColumn("__day", day), [key, "__day"],
                          [F.col(c).desc() for c in tiebreak])
    w = Window.partitionBy(key).orderBy("__day")
    prev = F.lag(F.struct(*attrs)).over(w)
    changed = daily.withColumn("__prev", prev).where(
        F.col("__prev").isNull() | ~F.struct(*attrs).eqNullSafe(F.col("__prev")))
    out = changed.select(key, *attrs, F.col("__day").alias("valid_from"))
    nxt = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return (out.withColumn("valid_to", F.coalesce(nxt, F.lit(OPEN_END_DATE).cast("date")))
               .withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END_DATE).cast("date")))


@dataclass(frozen=True)
class Scd2:
    """A dimension as loaded so far: ``observed`` (key, day, attributes; one row
    a key and day) and ``versions`` (surrogate key, key, attributes, interval)."""
    observed: DataFrame
    versions: DataFrame


def scd2_load(loaded: Scd2 | None, snapshots: DataFrame, key: str, date_col: str, attrs: list[str],
              tiebreak: list[str], sk: str = "sk") -> Scd2:
    """Close-and-insert load of one batch of dated snapshots.

    The result equals a rebuild from all snapshots of all batches, in whatever
    order they come: a late snapshot splits, shortens or joins versions that
    were written before.  Intervals alone cannot say when a value was seen
    again, so the observed days are kept beside them.  Only keys of the batch are
    versioned anew; a version that keeps its start keeps its surrogate key, new
    ones are numbered after the greatest.  A day seen again takes the batch's
    value.  Rows without key or day take no part.
    """
    day = F.to_date(F.col(date_col))
    batch = first_per_key(snapshots.withColumn("day", day).where(F.col(key).isNotNull() & F.col("day").isNotNull()),
                          [key, "day"], [F.col(c).desc() for c in tiebreak]).select(key, "day", *attrs)
    batch = materialize(batch, "scd2_batch")
    touched = batch.select(key).distinct()
    if loaded is None:
        observed, untouched = batch, None
        before = batch.limit(0).select(F.lit(None).cast("long").alias(sk), key, F.col("day").alias("valid_from"))
    else:
        observed, before = upsert(loaded.observed, batch, [key, "day"]), loaded.versions.select(sk, key, "valid_from")
        untouched = anti_join(loaded.versions, touched, [key])
    mine = scd2_versions(semi_join(observed, touched, [key]), key, "day", attrs, ["day"])
    mine = materialize(mine.join(before, [key, "valid_from"], "left"), "scd2_versions")
    greatest = before.agg(F.coalesce(F.max(sk), F.lit(0))).scalar()
    fresh = dense_keys(mine.where(F.col(sk).isNull()), [key, "valid_from"], "__new", start_after=greatest)
    mine = mine.join(fresh, [key, "valid_from"], "left").withColumn(sk, F.coalesce(sk, "__new")).drop("__new")
    cols = [sk, key, *attrs, "valid_from", "valid_to", "is_current"]
    versions = mine.select(*cols) if untouched is None else untouched.select(*cols).unionByName(mine.select(*cols))
    return Scd2(materialize(observed, "scd2_observed"), materialize(versions, "scd2_loaded"))
