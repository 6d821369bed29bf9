"""Idempotent merges on immutable parquet tables.

Parquet has no MERGE; a merge is ``target minus touched keys`` plus the new
versions, written to a new directory (see ``sources.sinks``).  Keys are
compared null-safely so that a NULL part of a composite key does not make a
re-run insert the row again (a deliberate deviation from the source
database, which treats NULLs as distinct in unique constraints).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.dedup import last_writer_wins
from fieldbook.operators.joins import anti_join


class DuplicateKeyError(ValueError):
    pass


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def assert_unique_keys(df: DataFrame, keys) -> DataFrame:
    """A set-based upsert may not hit one key twice: raise if it would.

    The check is one aggregate whose result is a single boolean."""
    k = _keys(keys)
    dup = df.groupBy(*k).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise DuplicateKeyError(f"source has duplicate keys on {k}")
    return df


def upsert(target: DataFrame, updates: DataFrame, keys, update_cols: list[str] | None = None,
           seq_cols: list[str] | None = None, loaded_at: str | None = None) -> DataFrame:
    """Merge ``updates`` into ``target`` on ``keys``.

    * several versions of a key in ``updates``: the last by ``seq_cols`` wins;
    * columns outside ``update_cols`` keep the target's value when the key
      already exists (set-on-insert-only columns);
    * ``loaded_at``: stamp column set to the current timestamp on written rows.
    """
    k = _keys(keys)
    if seq_cols:
        updates = last_writer_wins(updates, k, seq_cols)
    cols = target.columns
    upd = updates
    if loaded_at and loaded_at in cols:
        upd = upd.withColumn(loaded_at, F.current_timestamp())
    if update_cols is not None:
        keep = [c for c in cols if c not in k and c not in update_cols and c != loaded_at]
        if keep:
            old = target.select(*[F.col(c).alias(f"__t_{c}") for c in k + keep],
                                F.lit(True).alias("__t_hit"))
            cond = None
            for c in k:
                e = upd[c].eqNullSafe(old[f"__t_{c}"])
                cond = e if cond is None else cond & e
            j = upd.join(old, cond, "left")
            # when the key exists in the target, preserved columns keep its values
            for c in keep:
                j = j.withColumn(c, F.when(F.col("__t_hit"), F.col(f"__t_{c}")).otherwise(F.col(c)))
            upd = j.select(*cols)
    upd = upd.select(*cols)
    untouched = anti_join(target, upd, k, null_safe=True)
    return untouched.unionByName(upd)


def upsert_set_based(target: DataFrame, source: DataFrame, keys, update_cols=None,
                     loaded_at: str | None = None) -> DataFrame:
    """``INSERT ... SELECT ... ON CONFLICT DO UPDATE``: the source must be unique on keys."""
    assert_unique_keys(source, keys)
    return upsert(target, source, keys, update_cols=update_cols, loaded_at=loaded_at)


def append_absent(target: DataFrame, source: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    """Insert-if-absent: rows of ``source`` whose key is not in ``target``.

    Existing rows are never changed (corrections to already-loaded documents
    are not propagated)."""
    new = anti_join(source.select(*target.columns), target, _keys(keys), null_safe=null_safe)
    return target.unionByName(new)


def new_rows(target: DataFrame, source: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    """Only the rows ``append_absent`` would add."""
    return anti_join(source, target, _keys(keys), null_safe=null_safe)
