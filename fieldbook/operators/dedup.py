"""One row per key.

``row_number() = 1`` over a key: Spark inserts a partial ``WindowGroupLimit``
before the shuffle, so each map task already keeps one row per key and a key
repeated on a third of the input costs no more shuffle than any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """Keep the first row of each key under ``order`` (which must be total to
    make the choice deterministic: add a tiebreak column)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def dedup_first_seen(df: DataFrame, keys, page_col: str = "_page", pos_col: str = "_pos") -> DataFrame:
    """Keys repeated across pages: the first page/position wins."""
    return first_per_key(df, keys, [F.col(page_col).asc(), F.col(pos_col).asc()])


def last_writer_wins(df: DataFrame, keys, seq_cols: list[str]) -> DataFrame:
    """Same key several times in one payload: the last one (highest sequence) wins."""
    return first_per_key(df, keys, [F.col(c).desc() for c in seq_cols])


def latest_per_key(df: DataFrame, keys, date_col: str, tiebreak: list[str]) -> DataFrame:
    """``DISTINCT ON (key) ... ORDER BY date DESC``: the source database puts
    NULL dates first on DESC, so they win; ties resolved by ``tiebreak``."""
    order = [F.col(date_col).desc_nulls_first()] + [F.col(c).asc() for c in tiebreak]
    return first_per_key(df, keys, order)
