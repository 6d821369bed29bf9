"""Join forms used by the warehouse.

Broadcast policy: a lookup side is broadcast only after its size in bytes has
been checked (``broadcast_if_small``), or when its size is fixed by
construction (code maps).  Beyond the bound Spark plans a shuffle join, and
AQE's skew-join splitting handles hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from fieldbook.constants import LOOKUP_BROADCAST_MAX_BYTES


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row's values: text by its bytes, nested values by their JSON form."""
    size = F.lit(16 * len(df.columns))
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        elif isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return size


def broadcast_if_small(df: DataFrame, max_bytes: int) -> DataFrame:
    """Hint a broadcast only after checking the size in bytes (one partial
    aggregate; only the number reaches the driver).  Above the bound the plain
    DataFrame is returned and Spark picks a shuffle join."""
    n = df.agg(F.sum(_row_bytes(df).cast("long"))).first()[0] or 0
    return F.broadcast(df) if n <= max_bytes else df


def _cond(left: DataFrame, right: DataFrame, pairs, null_safe: bool) -> Column:
    conds = []
    for lk, rk in pairs:
        lc, rc = left[lk], right[rk]
        conds.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    return reduce(lambda a, b: a & b, conds)


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [(p, p) if isinstance(p, str) else tuple(p) for p in on]


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                split_null_keys: bool = False, broadcast: bool | None = None) -> DataFrame:
    """Fact -> dimension lookup on (fact_col, dim_col) pairs; dim key columns
    are dropped from the output.

    ``broadcast``: None (default) measures the dimension and broadcasts it only
    when it has at most ``LOOKUP_BROADCAST_MAX_BYTES``, which keeps the fact
    side from being shuffled at all; False leaves the choice to Spark
    (statistics and AQE); True is for tables of fixed, tiny size.

    ``split_null_keys`` routes rows whose key is NULL around the join (they can
    never match) so that a key that is NULL on most rows does not land in one
    shuffle partition when the dimension is too large to broadcast.
    """
    pairs = _pairs(on)
    if broadcast is None:
        dim = broadcast_if_small(dim, LOOKUP_BROADCAST_MAX_BYTES)
    elif broadcast:
        dim = F.broadcast(dim)
    dim_keys = [r for _, r in pairs]
    dim_alias = dim.select(*[F.col(c).alias(f"__k{i}") if c in dim_keys else F.col(c)
                             for i, c in enumerate(dim.columns)])
    renamed = {c: f"__k{i}" for i, c in enumerate(dim.columns) if c in dim_keys}
    rp = [(l, renamed[r]) for l, r in pairs]
    if not split_null_keys or how != "left":
        out = fact.join(dim_alias, _cond(fact, dim_alias, rp, False), how)
        return out.drop(*renamed.values())
    has_key = reduce(lambda a, b: a & b, [F.col(l).isNotNull() for l, _ in pairs])
    matched = fact.where(has_key)
    joined = matched.join(dim_alias, _cond(matched, dim_alias, rp, False), "left").drop(*renamed.values())
    unmatched = fact.where(~has_key)
    for f in joined.schema.fields:
        if f.name not in unmatched.columns:
            unmatched = unmatched.withColumn(f.name, F.lit(None).cast(f.dataType))
    return joined.unionByName(unmatched.select(*joined.columns))


def null_safe_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                   broadcast: bool | None = False) -> DataFrame:
    """``IS NOT DISTINCT FROM`` on every key pair.  Catalyst rewrites ``<=>``
    into coalesce/isnull equi-keys, so this stays a hash or sort-merge join.
    ``broadcast=None`` broadcasts ``right`` after a size check."""
    pairs = _pairs(on)
    if broadcast is None:
        right = broadcast_if_small(right, LOOKUP_BROADCAST_MAX_BYTES)
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in right.columns])
    rp = [(lk, f"__r_{rk}") for lk, rk in pairs]
    out = left.join(r, _cond(left, r, rp, True), how)
    if how in ("left_anti", "left_semi", "anti", "semi", "leftanti", "leftsemi"):
        return out
    keys = {rk for _, rk in pairs}
    return out.select(*left.columns, *[F.col(f"__r_{c}").alias(c) for c in right.columns
                                       if c not in keys and c not in left.columns])


def anti_join(left: DataFrame, right: DataFrame, on, null_safe: bool = False) -> DataFrame:
    """NOT EXISTS / left-join-IS-NULL as a left anti join."""
    pairs = _pairs(on)
    r = right.select(*[F.col(rk).alias(f"__a_{i}") for i, (_, rk) in enumerate(pairs)])
    rp = [(lk, f"__a_{i}") for i, (lk, _) in enumerate(pairs)]
    return left.join(r, _cond(left, r, rp, null_safe), "left_anti")


def semi_join(left: DataFrame, right: DataFrame, on, null_safe: bool = False) -> DataFrame:
    pairs = _pairs(on)
    r = right.select(*[F.col(rk).alias(f"__s_{i}") for i, (_, rk) in enumerate(pairs)])
    rp = [(lk, f"__s_{i}") for i, (lk, _) in enumerate(pairs)]
    return left.join(r, _cond(left, r, rp, null_safe), "left_semi")


def self_parent_join(df: DataFrame, id_col: str, parent_col: str, cols: list[str],
                     prefix: str = "parent_") -> DataFrame:
    """One level of a self-referencing hierarchy: each row gets its parent's columns."""
    parent = df.select(F.col(id_col).alias("__pid"), *[F.col(c).alias(prefix + c) for c in cols])
    return df.join(parent, df[parent_col] == parent["__pid"], "left").drop("__pid")


def asof_join(facts: DataFrame, versions: DataFrame, key: str, ts: str,
              valid_from: str, payload: list[str], bucket: str | None = "month",
              valid_to: str | None = None) -> DataFrame:
    """Attach to each fact the version of ``key`` valid at ``ts`` (the latest
    ``valid_from <= ts``, the greatest payload on a tie; with ``valid_to`` only
    if the version is still open: ``ts < valid_to``, NULL is open).

    Exact, linear and without fact x version pairs: facts and version starts
    are unioned and scanned in time order with ``last(ignorenulls)``.  The scan
    is partitioned by (key, time bucket), so a key holding a large share of the
    facts is spread over as many tasks as it has buckets; the version in force
    when a bucket starts comes from a small per-(key, bucket) table (at most
    one row per key and bucket) scanned the same way.  ``bucket=None`` scans per
    key only.
    """
    tag = "__is_fact"
    end = F.col(valid_to).alias("__to") if valid_to else F.lit(None).cast("string").alias("__to")
    vstruct = F.struct(*[F.col(p) for p in payload], end)
    v = versions.select(F.col(key).alias(key), F.col(valid_from).alias("__t"), F.lit(0).alias(tag),
                        vstruct.alias("__v"))
    f = facts.select(F.col(key).alias(key), F.col(ts).alias("__t"), F.lit(1).alias(tag),
                     F.lit(None).cast(v.schema["__v"].dataType).alias("__v"),
                     F.struct(*[F.col(c) for c in facts.columns]).alias("__f"))
    v = v.withColumn("__f", F.lit(None).cast(f.schema["__f"].dataType))
    both = v.unionByName(f)
    if bucket is None:
        w = (Window.partitionBy(key).orderBy(F.col("__t").asc(), F.col(tag).asc(), F.col("__v").asc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = both.withColumn("__cur", F.last("__v", ignorenulls=True).over(w)).where(F.col(tag) == 1)
    else:
        both = both.withColumn("__b", F.date_trunc(bucket, F.col("__t")))
        # last version of every (key, bucket) that has versions ...
        last_v = (both.where(F.col(tag) == 0).groupBy(key, "__b")
                  .agg(F.max(F.struct("__t", "__v"))["__v"].alias("__lv")))
        # ... carried into every (key, bucket) that has facts, from strictly earlier buckets
        fb = both.where(F.col(tag) == 1).select(key, "__b").distinct()
        # a fact bucket sorts before the versions of its own bucket: it only
        # sees versions of earlier buckets (its own are applied by the scan)
        marks = (last_v.select(key, "__b", "__lv", F.lit(1).alias("__o"))
                 .unionByName(fb.select(key, "__b", F.lit(None).cast(last_v.schema["__lv"].dataType).alias("__lv"),
                                        F.lit(0).alias("__o"))))
        wb = (Window.partitionBy(key).orderBy(F.col("__b").asc(), F.col("__o").asc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        carry = (marks.withColumn("__in", F.last("__lv", ignorenulls=True).over(wb))
                 .where(F.col("__o") == 0).select(key, "__b", "__in"))
        w = (Window.partitionBy(key, "__b").orderBy(F.col("__t").asc(), F.col(tag).asc(), F.col("__v").asc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        scanned = both.withColumn("__cur", F.last("__v", ignorenulls=True).over(w)).where(F.col(tag) == 1)
        out = (scanned.join(carry, [key, "__b"], "left")
               .withColumn("__cur", F.coalesce("__cur", "__in")))
    if valid_to:
        out = out.withColumn("__cur", F.when(F.col("__cur.__to").isNull() | (F.col("__t") < F.col("__cur.__to")), F.col("__cur")))
    return out.select("__f.*", *[F.col(f"__cur.{p}").alias(p) for p in payload])
