"""Data-quality and profiling queries over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.aggregates import duplicate_audit, duplicate_keys
from fieldbook.plans import metrics, quality
from fieldbook.registry.base import query
from fieldbook.registry.standins import Tables

TABLE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
}
FKS = [  # (name, child, fk, parent, pk)
    ("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.s_nationkey", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation.n_regionkey", "nation", "n_regionkey", "region", "r_regionkey"),
]


def _sql_union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


@query("duplicate_keys", None, """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def duplicate_keys_query(t: Tables) -> DataFrame:
    """G-06 / Q-05: keys present more than once."""
    return duplicate_keys(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dup_audit_all_tables", None, _sql_union([
    f"SELECT '{n}' AS table_name, COUNT(*) AS rows, "
    f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(k)} FROM {n})) AS distinct_keys, "
    f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(k)} FROM {n})) AS duplicates FROM {n}"
    for n, k in TABLE_KEYS.items()]))
def dup_audit_all_tables(t: Tables) -> DataFrame:
    """G-07 / U-01: rows minus distinct keys for every table, unioned."""
    return duplicate_audit({n: t.raw(n) for n in TABLE_KEYS}, TABLE_KEYS)


@query("lookup_fanout", None, """
SELECT p_name, COUNT(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""")
def lookup_fanout(t: Tables) -> DataFrame:
    """Q-06 / N20: lookup keys that are not unique (a join on them fans out)."""
    return quality.lookup_fanout(t.raw("part"), "p_name").withColumnRenamed("n", "n")


@query("fk_violations", None, _sql_union([
    f"SELECT '{name}' AS fk, COUNT(*) AS violations FROM {c} x WHERE x.{fk} IS NOT NULL "
    f"AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{fk})" for name, c, fk, p, pk in FKS]))
def fk_violations(t: Tables) -> DataFrame:
    """Q-11: foreign keys without a parent row, counted per key."""
    parts = [quality.fk_violations(t.raw(c), t.raw(p), fk, pk).agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(name).alias("fk"), "violations") for name, c, fk, p, pk in FKS]
    return reduce(DataFrame.unionByName, parts)


NOT_NULL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]


@query("null_key_violations", None, _sql_union([
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM orders" for c in NOT_NULL]))
def null_key_violations(t: Tables) -> DataFrame:
    """Q-12: NULLs in NOT NULL / key columns, one pass over the table."""
    return quality.null_violations(t.raw("orders"), NOT_NULL)


@query("dataset_profile", ["sd_docs", "sd_lines"], """
SELECT COUNT(*) AS rows, CAST(MIN(CAST(l.ship_date AS DATE)) AS VARCHAR) AS min_date,
       CAST(MAX(CAST(l.ship_date AS DATE)) AS VARCHAR) AS max_date,
       CAST(ROUND(SUM(l.amount), 0) AS DOUBLE) AS amount, COUNT(DISTINCT l.doc_id) AS documents,
       COUNT(DISTINCT l.item_id) AS items, COUNT(DISTINCT l.machine_id) AS machines
FROM sd_lines l JOIN sd_docs d ON d._id = l.doc_id WHERE d._posted = TRUE AND d._deletionmark = FALSE""")
def dataset_profile(t: Tables) -> DataFrame:
    """G-08: rows, date range, rounded sum and three distinct counts in one aggregate."""
    act = t.sd_lines.join(t.sd_docs.where(F.col("_posted") & ~F.col("_deletionmark")).select(
        F.col("_id").alias("doc_id")), "doc_id")
    return act.agg(F.count(F.lit(1)).alias("rows"), F.min(F.to_date("ship_date")).alias("min_date"),
                   F.max(F.to_date("ship_date")).alias("max_date"), F.round(F.sum("amount"), 0).alias("amount"),
                   F.count_distinct("doc_id").alias("documents"), F.count_distinct("item_id").alias("items"),
                   F.count_distinct("machine_id").alias("machines"))


@query("table_row_counts", None, _sql_union([
    f"SELECT '{n}' AS table_name, COUNT(*) AS rows FROM {n} HAVING COUNT(*) > 0" for n in TABLE_KEYS]))
def table_row_counts(t: Tables) -> DataFrame:
    """G-12: row count per table, non-empty tables only."""
    parts = [t.raw(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n in TABLE_KEYS]
    return reduce(DataFrame.unionByName, parts).where(F.col("rows") > 0)


FRESH = {"orders": ("o_orderdate", "o_custkey"), "lineitem": ("l_shipdate", "l_partkey"),
         "events": ("ts", "props")}


@query("data_freshness", None, _sql_union([
    f"SELECT '{n}' AS table_name, CAST(MAX({ts}) AS VARCHAR) AS last_loaded_at, COUNT(*) AS rows, "
    f"CAST(COUNT({fc}) AS DOUBLE) / COUNT(*) AS fill_rate FROM {n}" for n, (ts, fc) in FRESH.items()]))
def data_freshness(t: Tables) -> DataFrame:
    """K-07: last load time, rows and fill rate per table."""
    return metrics.freshness({n: (t.raw(n), ts, fc) for n, (ts, fc) in FRESH.items()})


@query("mart_freshness", None, """
WITH f AS (
  SELECT 'orders' AS table_name, max(CAST(o_orderdate AS TIMESTAMP)) AS last, count(*) AS rows FROM orders
  UNION ALL SELECT 'lineitem', max(CAST(l_shipdate AS TIMESTAMP)), count(*) FROM lineitem
  UNION ALL SELECT 'events', max(CAST(ts AS TIMESTAMP)), count(*) FROM events
  UNION ALL SELECT 'undated', max(CAST(o_orderdate AS TIMESTAMP)), count(*) FROM orders WHERE o_orderstatus = 'X')
SELECT table_name, rows, rows = 0 AS is_empty, epoch_ms(max(last) OVER () - last) // 3600000 AS lag_hours FROM f""")
def mart_freshness(t: Tables) -> DataFrame:
    """K-07: lag behind the newest table and empty marts."""
    orders = t.raw("orders")
    fresh = metrics.freshness({"orders": (orders, "o_orderdate", None), "lineitem": (t.raw("lineitem"), "l_shipdate", None),
                               "events": (t.raw("events"), "ts", None),
                               "undated": (orders.where("o_orderstatus = 'X'"), "o_orderdate", None)})
    return metrics.freshness_lag(fresh).select("table_name", "rows", "is_empty", "lag_hours")


@query("docs_without_lines", None, """
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def docs_without_lines(t: Tables) -> DataFrame:
    """Q-01: documents loaded without any line."""
    return quality.docs_without_lines(t.raw("orders"), t.raw("lineitem"), "o_orderkey", "l_orderkey") \
        .select("o_orderkey")


# one source per order status; no order has the last one
STATUS_SOURCES = ["F", "O", "P", "X"]


@query("empty_sources", None, """
SELECT 'orders_' || s AS table_name, COUNT(o_orderkey) AS rows
FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS s) LEFT JOIN orders ON o_orderstatus = s GROUP BY 1 HAVING rows = 0""")
def empty_sources(t: Tables) -> DataFrame:
    """Q-02: sources that returned no rows (at most one row of each is counted)."""
    orders = t.raw("orders")
    return quality.empty_source({f"orders_{s}": orders.where(F.col("o_orderstatus") == s) for s in STATUS_SOURCES})


@query("active_vs_total", ["sd_items"], """
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE _deletionmark IS FALSE) AS active FROM sd_items""")
def active_vs_total(t: Tables) -> DataFrame:
    """Q-03 / G-05: total versus active catalog rows."""
    return quality.active_vs_total(t.sd_items)
