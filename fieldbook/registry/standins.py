"""Domain-shaped stand-ins derived from the driver tables.

Each stand-in is a projection (plus, for lines, a per-document line
numbering) of one driver table, written once as SQL expressions that both
Spark (``selectExpr``) and the DuckDB oracle (a CTE) evaluate.  This is
input preparation only; the operators under test are written separately on
each side.

Mapping
-------
* documents (``sd_docs``)    <- orders: posted = status <> 'P'; deletion mark
  TRUE for '5-LOW', NULL for '4-NOT SPECIFIED', else FALSE (all three NULL
  rules occur)
* lines (``sd_lines``)       <- lineitem: (order, line number) is not unique in
  the source, so lines are renumbered per document over a total order;
  work = discount x 100 ha, norm = tax x 100 ha, operation kind from
  (return flag, line status)
* items (``sd_items``)       <- part, deleted when size > 45 (NULL for 41..45)
* machines / warehouses      <- supplier; people <- customer
* operations (``sd_operations``) <- nation and region as one two-level hierarchy
* fields (``sd_fields``)     <- nation: the field number is the nation key
* company structure          <- supplier, its name encodes a field number
* weighings (``sd_weighings``) <- lineitem, one weighing per line
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

LINE_ORDER = ("l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, "
              "l_discount, l_tax, l_returnflag, l_linestatus")

OPERATION_KIND_SQL = (
    "CASE WHEN l_returnflag = 'A' THEN 'ПередачаМатериаловВПроизводство' "
    "WHEN l_returnflag = 'R' THEN 'ПередачаПродукцииИзПроизводства' "
    "WHEN l_linestatus = 'F' THEN 'ПередачаМатериаловВКладовую' "
    "ELSE 'ПередачаПродукцииИзКладовой' END"
)

# stand-in name -> (driver table, select expressions)
STANDINS: dict[str, tuple[str, list[str]]] = {
    "sd_docs": ("orders", [
        "o_orderkey AS _id",
        "'D-' || CAST(o_orderkey AS STRING) AS doc_number",
        "o_orderdate AS doc_date",
        "o_orderstatus <> 'P' AS _posted",
        "CASE o_orderpriority WHEN '5-LOW' THEN TRUE WHEN '4-NOT SPECIFIED' THEN NULL ELSE FALSE END AS _deletionmark",
        "o_custkey AS person_id",
        "o_orderpriority AS priority",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Поле ' || CAST(o_custkey % 30 AS STRING) "
        "ELSE CAST(o_custkey % 40 AS STRING) || ', склад ГСМ' END AS sender_text",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount",
        "CAST(o_totalprice AS DECIMAL(12,3)) AS fuel_issued",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(FLOOR(o_totalprice / 10000) AS DECIMAL(12,3)) END AS fuel_returned",
    ]),
    "sd_lines": ("lineitem", [
        "l_orderkey AS doc_id",
        f"CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS INT) AS line_number",
        "l_partkey AS item_id",
        "l_suppkey AS machine_id",
        "CAST(l_linenumber AS BIGINT) AS operation_id",
        "l_shipdate AS ship_date",
        "CAST(l_quantity AS DECIMAL(18,3)) AS qty",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount",
        "CAST(CAST(l_discount AS DECIMAL(12,4)) * 100 AS DECIMAL(12,4)) AS work_ha",
        "CAST(CAST(l_tax AS DECIMAL(10,3)) * 100 AS DECIMAL(10,3)) AS norm_ha",
        f"{OPERATION_KIND_SQL} AS operaciya",
        "l_returnflag AS returnflag",
        "l_linestatus AS linestatus",
    ]),
    "sd_items": ("part", [
        "p_partkey AS _id",
        "p_name AS description",
        "CASE WHEN p_size > 45 THEN TRUE WHEN p_size > 40 THEN NULL ELSE FALSE END AS _deletionmark",
        "p_type AS unit_name",
        "upper(substr(p_type, 1, 3)) AS unit_code",
        "p_size AS size",
        "'Урожай ' || CAST(1995 + p_partkey % 7 AS STRING) || ' ' || "
        "CASE WHEN p_size <= 20 THEN 'Гала' WHEN p_size <= 35 THEN 'Кармен' ELSE 'Фламинго' END || "
        "'РС' || CAST(1 + p_partkey % 3 AS STRING) || "
        "CASE split_part(p_name, ' ', 1) WHEN 'red' THEN ' Красный' WHEN 'cold' THEN ' Белый' ELSE '' END || "
        "CASE WHEN p_type IN ('LARGE', 'PROMO') THEN ' без полива' ELSE ' с поливом' END || "
        "'., поле ' || CAST(p_size AS STRING) || "
        "CASE WHEN p_type = 'SMALL' THEN '' ELSE ', уч.' || CAST(1 + p_partkey % 9 AS STRING) END AS harvest_name",
    ]),
    "sd_machines": ("supplier", [
        "s_suppkey AS _id",
        "s_name AS name",
        "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 5000 THEN 'light' ELSE 'heavy' END AS eq_type",
        "s_nationkey AS nation",
    ]),
    "sd_people": ("customer", [
        "c_custkey AS _id",
        "c_custkey AS individual_id",
        "c_name AS description",
        "c_mktsegment AS segment",
        "c_nationkey AS nation",
    ]),
    "sd_fields": ("nation", [
        "'F-' || CAST(n_nationkey AS STRING) AS _id",
        "CAST(n_nationkey AS STRING) AS description",
        "n_regionkey AS department",
    ]),
    "sd_structure": ("supplier", [
        "s_suppkey AS _id",
        "CASE WHEN s_acctbal < 1000 THEN 'Поле ' || CAST(s_nationkey * 2 AS STRING) "
        "ELSE CAST(s_nationkey * 2 AS STRING) || ', Ка' || "
        "CASE WHEN s_acctbal < 4000 THEN 'Гала' WHEN s_acctbal < 7000 THEN 'Кармен' ELSE 'Фламинго' END || "
        "'РС' || CAST(1 + s_suppkey % 3 AS STRING) || 'ПУч.' || CAST(1 + s_suppkey % 9 AS STRING) || "
        "' ' || CAST(2020 + s_suppkey % 6 AS STRING) || ' г.' || "
        "CASE WHEN s_suppkey % 5 = 0 THEN ' (не исп. с 31.10.2025)' ELSE '' END END AS description",
    ]),
    "sd_weighings": ("lineitem", [
        f"CAST(l_orderkey AS STRING) || '-' || CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS STRING) AS _id",
        "l_shipdate AS doc_date",
        "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Перемещение' ELSE 'СПоля' END AS vid_vzveshivaniya",
        "CASE WHEN l_discount >= 0.1 THEN TRUE WHEN l_tax = 0 THEN NULL ELSE FALSE END AS _deletionmark",
        "l_suppkey AS otkuda_id",
        "CAST(l_linenumber AS BIGINT) AS kuda_id",
        "l_partkey AS nomenklatura_id",
        "l_orderkey AS voditel_id",
        "CAST(l_extendedprice AS DECIMAL(18,3)) AS ves_netto_kg",
        "CAST(l_quantity AS DECIMAL(18,3)) AS ves_tary_kg",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,3)) + CAST(l_quantity AS DECIMAL(18,3)) "
        "+ CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS DECIMAL(18,3)) AS ves_brutto_kg",
    ]),
    "sd_slips": ("lineitem", [
        f"CAST(l_orderkey AS STRING) || '-' || CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS STRING) AS doc_id",
        "CAST(1 AS INT) AS line_number",
        "CASE WHEN l_discount > 0.05 THEN 'F-' || CAST(l_suppkey % 25 AS STRING) "
        "WHEN l_discount > 0.02 THEN '00000000-0000-0000-0000-000000000000' END AS pole_id",
        "CASE WHEN l_returnflag = 'N' THEN 'ТалонКомбайнера' ELSE 'ТалонВодителя' END AS tip_talona",
        "CAST(l_quantity AS DECIMAL(18,3)) AS massa_kg",
    ]),
    "sd_operations": ("nation", [
        "CAST(n_nationkey AS BIGINT) AS _id",
        "n_name AS description",
        "CAST(100 + n_regionkey AS BIGINT) AS parent_id",
        "'OP' || CAST(n_nationkey AS STRING) AS operation_kind",
    ]),
    "sd_operation_groups": ("region", [
        "CAST(100 + r_regionkey AS BIGINT) AS _id",
        "r_name AS description",
        "CAST(NULL AS BIGINT) AS parent_id",
        "'GR' || CAST(r_regionkey AS STRING) AS operation_kind",
    ]),
    "sd_field_history": ("supplier", [
        "'F-' || CAST(s_nationkey AS STRING) AS field_id",
        "s_suppkey AS line_number",
        "CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1995 + s_suppkey % 7 END AS year",
        "CASE WHEN s_acctbal < 100 THEN CAST(0 AS DECIMAL(12,4)) ELSE CAST(s_acctbal AS DECIMAL(12,4)) END AS sown_area_ha",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'Пшеница' ELSE 'Картофель' END AS crop",
        "make_date(CAST(1995 + s_suppkey % 5 AS INT), 1, 1) AS valid_from",
        "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE make_date(CAST(1997 + s_suppkey % 5 AS INT), 12, 31) END AS valid_to",
    ]),
    "sd_events": ("events", [
        "event_id", "ts", "user_id", "event_type",
        "CAST(value AS DECIMAL(18,2)) AS value",
        "props",
    ]),
}


def standin_cte(names: list[str]) -> str:
    """``WITH`` clause defining the named stand-ins for the SQL oracle."""
    parts = []
    for n in names:
        table, exprs = STANDINS[n]
        parts.append(f"{n} AS (SELECT {', '.join(exprs)} FROM {table})")
    if "sd_tech_operations" in names:
        raise ValueError("sd_tech_operations is derived; use the two parts")
    return "WITH " + ",\n".join(parts) + "\n"


# declared schemas of the driver tables: read without inference
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


@dataclass
class Tables:
    """Lazy access to driver tables and stand-ins of one scale-factor folder."""
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        key = ("raw", name)
        if key not in self._cache:
            r = self.spark.read
            if name in DRIVER_SCHEMAS:
                r = r.schema(DRIVER_SCHEMAS[name])
            self._cache[key] = r.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("sd_"):
            key = ("sd", name)
            if key not in self._cache:
                table, exprs = STANDINS[name]
                self._cache[key] = self.raw(table).selectExpr(*exprs)
            return self._cache[key]
        raise AttributeError(name)

    def numbered_by(self, name: str, group: str, by: str) -> DataFrame:
        """The rows of stand-in ``name`` and ``group``, an expression of the raw
        table that is a function of the key its windows are over.  Rows are
        dealt by the group and numbered there, so that neither grouping by it
        nor by it and the key needs another shuffle."""
        table, exprs = STANDINS[name]
        windows = [e for e in exprs if " OVER (" in e]
        raw = self.raw(table).selectExpr("*", f"{by} AS {group}").repartition(group)
        made = raw.selectExpr("*", *[e.replace("PARTITION BY ", f"PARTITION BY {group}, ") for e in windows])
        return made.selectExpr(group, *[e.rsplit(" AS ", 1)[1] if e in windows else e for e in exprs])

    def tech_operations(self) -> DataFrame:
        """Operations and their groups as one self-referencing catalog."""
        return self.sd_operations.unionByName(self.sd_operation_groups)
