"""Harvest queries: weighing -> field resolution -> enrichment -> star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import AGRO_PHASES
from fieldbook.functions.field_number import field_number_any, field_number_plain, field_number_prefixed
from fieldbook.functions.parsers import parse_item_name, parse_party_name
from fieldbook.operators.aggregates import control_totals, coverage_by
from fieldbook.operators.indexing import dense_keys
from fieldbook.operators.predicates import dim_not_deleted
from fieldbook.plans import dims, facts, quality, reports, staging
from fieldbook.registry.base import query
from fieldbook.registry.standins import Tables
from fieldbook.session import materialize

H_SD = ["sd_weighings", "sd_structure", "sd_fields", "sd_items"]
REPORT_YEAR = 1997


def items_view(t: Tables) -> DataFrame:
    """Current item catalog (deleted rows dropped); names carry harvest attributes."""
    return dim_not_deleted(t.sd_items).select("_id", F.col("harvest_name").alias("description"))


def harvest_base(t: Tables) -> DataFrame:
    stg = staging.stg_weighing(t.sd_weighings, t.sd_structure, t.sd_fields)
    return staging.harvest_base(stg)


def enriched(t: Tables) -> DataFrame:
    return facts.harvest_enriched(harvest_base(t), items_view(t), t.sd_structure.select("description"))


# --- SQL oracle building blocks -----------------------------------------
# (written from the naming rules without patterns: names are cut at fixed signs
# by position, once per catalog row, and looked up by key)

MARKS_SQL = "[" + ", ".join(f"'{m}'" for m in [*(f"РС{d}" for d in range(10)), "ЭС", "СЭ", "ОС"]) + "]"


def digits_sql(text: str) -> str:
    """The digits ``text`` begins with, as text ('' for none)."""
    return f"substr({text}, 1, length({text}) - length(ltrim({text}, '0123456789')))"


def after_sql(text: str, sign: str, low: bool = False) -> str:
    """What follows ``sign`` in ``text``; NULL when it does not occur."""
    where = f"strpos({f'lower({text})' if low else text}, '{sign}')"
    return f"substr({text}, NULLIF({where}, 0) + {len(sign)})"


def mark_sql(text: str) -> str:
    """Position of the first reproduction mark after the first sign of ``text``."""
    return f"list_min([p FOR p IN [strpos({text}, m) FOR m IN {MARKS_SQL}] IF p > 1])"


def number_sql(text: str, form: str = "any") -> str:
    plain = f"NULLIF(trim(split_part({text}, ',', 1)), '')"
    named = f"IF(starts_with(lower({text}), 'поле '), NULLIF(trim(substr({text}, 6)), ''), NULL)"
    return {"plain": plain, "named": named, "any": f"IFNULL({named}, {plain})"}[form]


# one row per structure node: the parts of its name
PARTY_SQL = f"""
party_cut AS (
  SELECT _id AS node, description AS label, ltrim(substr(description, strpos(description, ',') + 1)) AS tail,
         strpos(description, ',') > 0 AS listed, {digits_sql(after_sql('description', 'Уч.'))} AS plot_text FROM sd_structure),
party_mark AS (SELECT *, listed AND plot_text <> '' AS planted, {mark_sql('tail')} AS mark FROM party_cut),
party_end AS (
  SELECT *, IF(substr(tail, mark, 2) = 'РС', 2 + length({digits_sql('substr(tail, mark + 2)')}), 2) AS mark_length FROM party_mark),
party AS (
  SELECT node, label, {number_sql('label', 'plain')} AS plain_number, {number_sql('label')} AS field_number,
         IF(planted, substr(tail, 1, mark - 1), NULL) AS crop_code,
         IF(planted, substr(tail, mark, mark_length), NULL) AS reproduction,
         IF(planted, NULLIF(trim(split_part(substr(tail, mark + mark_length), 'Уч.', 1)), ''), NULL) AS method,
         TRY_CAST(NULLIF(plot_text, '') AS INTEGER) AS plot,
         TRY_CAST(substr(label, NULLIF(strpos(label, ' г.'), 0) - 4, 4) AS INTEGER) AS year,
         IF(listed AND plot_text IS NULL AND TRY_CAST(split_part(tail, ' ', 2) AS INTEGER) IS NOT NULL,
            split_part(tail, ' ', 1), NULL) AS state,
         string_split(substr({after_sql('label', 'не исп. с ')}, 1, 10), '.') AS unused
  FROM party_end)"""

# one row per item: the parts of its harvest name
ITEM_SQL = f"""
item_cut AS (
  SELECT _id AS item, harvest_name AS label, _deletionmark IS FALSE AS listed, lower(harvest_name) AS low,
         {after_sql('harvest_name', 'урожай ', True)} AS told FROM sd_items),
item_word AS (SELECT *, {digits_sql('told')} AS year_text, split_part(told, ' ', 2) AS word FROM item_cut),
item_mark AS (SELECT *, {mark_sql('word')} AS mark FROM item_word),
item AS (
  SELECT item, label, listed, TRY_CAST(year_text AS INTEGER) AS year, NULLIF(substr(word, 1, IFNULL(mark - 1, 100)), '') AS sort,
         IF(substr(word, mark, 2) = 'РС', 'РС' || {digits_sql('substr(word, mark + 2)')}, substr(word, mark, 2)) AS reproduction,
         IF(contains(low, 'с поливом'), 'С поливом', IF(contains(low, 'без полива'), 'Без полива', NULL)) AS irrigation,
         NULLIF({digits_sql(after_sql('label', 'поле ', True))}, '') AS field,
         TRY_CAST(NULLIF({digits_sql(f"ltrim({after_sql('label', 'уч.', True)})")}, '') AS INTEGER) AS plot
  FROM item_mark)"""

WEIGHED_SQL = "," + PARTY_SQL + "," + ITEM_SQL + """,
place AS (SELECT party.*, sd_fields._id AS field_id FROM party LEFT JOIN sd_fields ON field_number = sd_fields.description),
weighed AS (
  SELECT sd_weighings._id AS ticket, doc_date AS at_time, CAST(year(doc_date) AS INTEGER) AS season_year, place.*,
         nomenklatura_id AS item, kuda_id AS target, vid_vzveshivaniya AS kind, ves_netto_kg AS net_kg
  FROM sd_weighings LEFT JOIN place ON node = otkuda_id WHERE _deletionmark IS NOT TRUE),
base AS (
  SELECT ticket AS src_doc_id, at_time AS doc_date, season_year AS god_urozhaya, field_id AS pole_id,
         field_number AS pole_nomer, label AS pole_party_name, item AS nomenklatura_id, net_kg AS kolichestvo_kg,
         target AS warehouse_id, crop_code, reproduction AS party_reproduction, plot AS party_plot, year AS party_year
  FROM weighed WHERE kind = 'СПоля'),
enr AS (
  SELECT base.*, i.label AS nomenklatura_name, known.crop AS kultura, IFNULL(i.sort, NULLIF(substr(crop_code, 3), '')) AS sort,
         IFNULL(IFNULL(i.reproduction, party_reproduction), '') AS reproduktsiya, IFNULL(i.irrigation, 'Не указан') AS poliv,
         CAST(IFNULL(i.plot, party_plot) AS VARCHAR) AS uchastok_nomer, IFNULL(i.year, party_year) AS god_1c
  FROM base LEFT JOIN (FROM item WHERE listed) i ON i.item = nomenklatura_id
  LEFT JOIN (VALUES ('Ка', 'Картофель')) known(prefix, crop) ON starts_with(crop_code, prefix)),
crops AS (
  SELECT *, IF(kultura IS NULL, '', kultura || ' / ') || IFNULL(sort, 'Сорт не указан') AS variety,
         (SELECT word FROM (VALUES (1, 'Белый'), (2, 'Красный')) shade(turn, word)
          WHERE contains(lower(concat(nomenklatura_name, chr(10), pole_party_name)), lower(word)) ORDER BY turn LIMIT 1) AS color,
         IF(reproduktsiya = '', NULL, reproduktsiya) AS reproduction, IF(poliv = 'Не указан', NULL, poliv) AS irrigation
  FROM enr)
"""


def hq(sql_tail: str) -> str:
    return WEIGHED_SQL + sql_tail


TONS_SQL = "ROUND(CAST(SUM(kolichestvo_kg) AS DOUBLE) / 1000, 6) AS tons"


@query("field_number_any", ["sd_structure", "sd_items"], f""",
texts AS (SELECT CAST(_id AS VARCHAR) AS src, description AS t FROM sd_structure
          UNION ALL SELECT 'item-' || CAST(_id AS VARCHAR), harvest_name FROM sd_items)
SELECT src, t, {number_sql('t', 'plain')} AS plain, {number_sql('t', 'named')} AS prefixed, {number_sql('t')} AS any_form
FROM texts""")
def field_number_query(t: Tables) -> DataFrame:
    """S-08..S-10: plain, prefixed and combined field-number parsers."""
    texts = t.sd_structure.select(F.col("_id").cast("string").alias("src"), F.col("description").alias("t")).unionByName(
        t.sd_items.select(F.concat(F.lit("item-"), F.col("_id").cast("string")).alias("src"),
                          F.col("harvest_name").alias("t")))
    return texts.select("src", "t", field_number_plain("t").alias("plain"),
                        field_number_prefixed("t").alias("prefixed"), field_number_any("t").alias("any_form"))


@query("party_name_parse", ["sd_structure"], "," + PARTY_SQL + """
SELECT node AS _id, plain_number AS field, crop_code, reproduction, method, plot, year, state,
       unused[3] || '-' || unused[2] || '-' || unused[1] AS unused_since
FROM party""")
def party_name_parse(t: Tables) -> DataFrame:
    """S-27: party / department name parser."""
    return t.sd_structure.select("_id", parse_party_name("description").alias("p")).select("_id", "p.*")


@query("item_name_parse", ["sd_items"], "," + ITEM_SQL + """
SELECT item AS _id, year, sort, reproduction, irrigation, field, plot FROM item""")
def item_name_parse(t: Tables) -> DataFrame:
    """S-28: harvest item-name parser."""
    return t.sd_items.select("_id", parse_item_name("harvest_name").alias("p")).select("_id", "p.*")


@query("computed_key_left_lookup", H_SD, hq("""
SELECT ticket AS _id, label AS otkuda_name, field_number AS pole_nomer, field_id AS pole_id, season_year AS god_urozhaya,
       IF(field_id IS NULL, 'unresolved', 'company_structure_description') AS pole_resolution_method FROM weighed"""))
def computed_key_left_lookup(t: Tables) -> DataFrame:
    """M-01 / J-02 / J-03 / S-26 / S-12: weighing -> structure name -> parsed field number -> field."""
    s = staging.stg_weighing(t.sd_weighings, t.sd_structure, t.sd_fields)
    return s.select("_id", "otkuda_name", "pole_nomer", "pole_id", "god_urozhaya", "pole_resolution_method")


@query("harvest_base", H_SD, hq("""
SELECT src_doc_id, CAST(doc_date AS VARCHAR) AS doc_date, god_urozhaya, pole_id, pole_nomer, pole_party_name,
       nomenklatura_id, CAST(kolichestvo_kg AS DOUBLE) AS kolichestvo_kg, warehouse_id, pole_id IS NOT NULL AS is_pole_resolved
FROM base"""))
def harvest_base_query(t: Tables) -> DataFrame:
    """M-02: from-field weighings only."""
    return harvest_base(t).select("src_doc_id", "doc_date", "god_urozhaya", "pole_id", "pole_nomer",
                                  "pole_party_name", "nomenklatura_id", "kolichestvo_kg", "warehouse_id",
                                  "is_pole_resolved")


@query("coverage_by_year", H_SD, hq("""
SELECT god_urozhaya, COUNT(*) AS rows, COUNT(pole_id) AS resolved,
       CAST(ROUND(100.0 * COUNT(pole_id) / COUNT(*), 1) AS DOUBLE) AS coverage_pct
FROM base GROUP BY 1 ORDER BY 1"""))
def coverage_by_year(t: Tables) -> DataFrame:
    """G-03 / K-04 / Q-07 / T-01: link coverage by harvest year, ordered by year."""
    return coverage_by(harvest_base(t), "god_urozhaya", "pole_id").orderBy("god_urozhaya")


@query("harvest_enriched", H_SD, hq("""
SELECT src_doc_id, pole_nomer, nomenklatura_id, nomenklatura_name, kultura, sort, reproduktsiya, poliv,
       uchastok_nomer, god_1c, god_urozhaya, ROUND(CAST(kolichestvo_kg AS DOUBLE) / 1000, 6) AS kolichestvo_t
FROM enr"""))
def harvest_enriched_query(t: Tables) -> DataFrame:
    """M-16: item name, crop, sort, reproduction, irrigation, plot, tonnes."""
    return enriched(t).select("src_doc_id", "pole_nomer", "nomenklatura_id", "nomenklatura_name", "kultura",
                              "sort", "reproduktsiya", "poliv", "uchastok_nomer", "god_1c", "god_urozhaya",
                              "kolichestvo_t")


@query("harvest_control_totals", H_SD, hq("""
SELECT COUNT(*) AS rows, COUNT(DISTINCT src_doc_id) AS docs,
       CAST(ROUND(SUM(kolichestvo_kg) / 1000, 3) AS DOUBLE) AS tons
FROM base WHERE pole_id IS NOT NULL"""))
def harvest_control_totals(t: Tables) -> DataFrame:
    """G-04 / Q-08: control totals of the loaded harvest fact (resolved rows)."""
    b = harvest_base(t).where(F.col("pole_id").isNotNull())
    return control_totals(b, "src_doc_id", "kolichestvo_kg")


@query("enrichment_fill", H_SD, hq("""
SELECT COUNT(*) AS rows, COUNT(pole_id) AS field_found, COUNT(kultura) AS crop_found,
       COUNT(nomenklatura_name) AS item_found, COUNT(sort) AS sort_found, COUNT(uchastok_nomer) AS plot_found,
       COUNT(*) FILTER (WHERE god_1c <> god_urozhaya) AS year_mismatch
FROM enr"""))
def enrichment_fill(t: Tables) -> DataFrame:
    """Q-09: enrichment fill report."""
    return quality.enrichment_fill(enriched(t))


@query("harvest_by_year", H_SD, hq(f"""
SELECT god_urozhaya, {TONS_SQL}, COUNT(*) AS weighings FROM enr GROUP BY 1"""))
def harvest_by_year(t: Tables) -> DataFrame:
    """R-01: gross harvest by year."""
    return reports.harvest_by_year(enriched(t))


@query("harvest_by_field", H_SD, hq(f"""
SELECT pole_nomer, {TONS_SQL} FROM enr GROUP BY 1"""))
def harvest_by_field(t: Tables) -> DataFrame:
    """R-02: harvest by field."""
    return reports.harvest_by_field(enriched(t))


@query("harvest_by_irrigation", H_SD, hq(f"""
SELECT poliv, {TONS_SQL} FROM enr WHERE god_urozhaya = {REPORT_YEAR} GROUP BY 1"""))
def harvest_by_irrigation(t: Tables) -> DataFrame:
    """R-03: one year, irrigated vs not."""
    return reports.harvest_by_irrigation(enriched(t), REPORT_YEAR)


@query("harvest_by_sort", H_SD, hq(f"""
SELECT sort, {TONS_SQL} FROM enr WHERE god_urozhaya = {REPORT_YEAR} GROUP BY 1"""))
def harvest_by_sort(t: Tables) -> DataFrame:
    """R-04: one year, by sort."""
    return reports.harvest_by_sort(enriched(t), REPORT_YEAR)


@query("harvest_detail", H_SD, hq(f"""
SELECT pole_nomer, uchastok_nomer, sort, reproduktsiya, poliv, {TONS_SQL}
FROM enr WHERE god_urozhaya = {REPORT_YEAR} GROUP BY 1, 2, 3, 4, 5"""))
def harvest_detail(t: Tables) -> DataFrame:
    """R-05: one year table by field, plot, sort, reproduction, irrigation."""
    return reports.harvest_detail(enriched(t), REPORT_YEAR)


@query("harvest_by_month", H_SD, hq(f"""
SELECT CAST(CAST(date_trunc('month', doc_date) AS DATE) AS VARCHAR) AS month, {TONS_SQL} FROM enr GROUP BY 1"""))
def harvest_by_month(t: Tables) -> DataFrame:
    """R-06: harvest by month."""
    return reports.harvest_by_month(enriched(t))


@query("harvest_sort_irrigation", H_SD, hq(f"""
SELECT god_urozhaya, sort, poliv, COUNT(*) AS weighings, {TONS_SQL} FROM enr GROUP BY 1, 2, 3"""))
def harvest_sort_irrigation(t: Tables) -> DataFrame:
    """R-07: sort x irrigation with weighing count and tonnes."""
    return reports.harvest_sort_irrigation(enriched(t))


@query("reception_by_day", H_SD, hq(f"""
SELECT CAST(CAST(doc_date AS DATE) AS VARCHAR) AS day, warehouse_id, COUNT(*) AS weighings, {TONS_SQL},
       COUNT(DISTINCT pole_id) AS fields
FROM enr GROUP BY 1, 2"""))
def reception_by_day(t: Tables) -> DataFrame:
    """R-22: reception dashboard by day and destination."""
    return reports.reception_by_day(enriched(t))


@query("field_sections", H_SD, hq("""
SELECT DISTINCT pole_nomer, uchastok_nomer FROM enr"""))
def field_sections(t: Tables) -> DataFrame:
    """M-19 / G-11: distinct field / plot pairs."""
    return dims.field_sections(enriched(t))


@query("crop_varieties", H_SD, hq("""
SELECT DISTINCT kultura, sort, reproduktsiya, poliv FROM enr"""))
def crop_varieties(t: Tables) -> DataFrame:
    """M-19 / G-11: distinct crop / sort / reproduction / irrigation."""
    return dims.crop_varieties(enriched(t))


def existing_crop_dim(t: Tables, e: DataFrame) -> DataFrame:
    """The crop dimension as loaded by an earlier run: the tuples of the first
    harvest year, keyed densely."""
    first = e.where(F.col("god_urozhaya") == 1995)
    return dense_keys(dims.crop_candidates(first), ["variety", "color", "reproduction", "irrigation"], "crop_sk")


# tuples as lists, which compare NULL with NULL; the load numbers what the first year has not
EXISTING_CROP_SQL = """,
tuples AS (SELECT [variety, color, reproduction, irrigation] AS t, bool_or(god_urozhaya = 1995) AS loaded FROM crops GROUP BY 1),
crop_dim AS (
  SELECT t, loaded, row_number() OVER (ORDER BY loaded DESC, t[1] NULLS FIRST, t[2] NULLS FIRST, t[3] NULLS FIRST,
                                                t[4] NULLS FIRST) AS crop_sk FROM tuples)
"""


@query("dim_crop_new", H_SD, hq(EXISTING_CROP_SQL + """
SELECT t[1] AS variety, t[2] AS color, t[3] AS reproduction, t[4] AS irrigation, crop_sk FROM crop_dim WHERE NOT loaded"""))
def dim_crop_new(t: Tables) -> DataFrame:
    """M-08 / J-09 / G-01 / M-SK / S-19 / S-20 / S-21: new crop tuples (null-safe NOT EXISTS) with
    keys continuing after the existing maximum."""
    e = enriched(t)
    return dims.dim_crop_new(e, existing_crop_dim(t, e))


@query("missing_item_technical_records", H_SD, hq("""
SELECT nomenklatura_id AS ref_key_1c, first(told ORDER BY doc_date DESC NULLS FIRST, src_doc_id) AS name_1c,
       'Техническая запись' AS nom_kind, 'Номенклатура не загружена из 1С' AS category, TRUE AS is_active
FROM (SELECT *, [n FOR n IN [nomenklatura_name, pole_party_name, 'Номенклатура из взвешивания без наименования'] IF n <> ''][1]
               AS told FROM enr)
WHERE nomenklatura_id IS NOT NULL GROUP BY nomenklatura_id HAVING count(nomenklatura_name) = 0"""))
def missing_item_technical_records(t: Tables) -> DataFrame:
    """M-09 / J-10 / G-02 / N13: technical item records for unknown item ids."""
    e = enriched(t)
    dim_nom = items_view(t).select(F.col("_id").alias("ref_key_1c"))
    return dims.missing_nomenclature(e, dim_nom, ["src_doc_id"])


def harvest_star(t: Tables):
    """Dimensions and fact rows of one harvest load.  The enriched rows, with
    their crop attributes, feed four dimension/fact steps, so they are written once and re-read; the
    dimensions are published before the fact that references them."""
    e = materialize(facts.crop_attributes(enriched(t)), "harvest_enriched")
    crop_old = existing_crop_dim(t, e)
    crop_dim = materialize(crop_old.unionByName(dims.dim_crop_new(e, crop_old)), "dim_crop")
    current = dense_keys(t.sd_fields.select(F.col("_id").alias("field_code_1c")), ["field_code_1c"], "field_sk")
    # an earlier, closed version of every field under a key of its own
    closed = current.select("field_code_1c", (-F.col("field_sk")).alias("field_sk"), F.lit(False).alias("is_current"))
    field_dim = materialize(current.withColumn("is_current", F.lit(True)).unionByName(closed), "dim_field")
    known = items_view(t).select(F.col("_id").alias("ref_key_1c"))
    nom_ids = known.unionByName(dims.missing_nomenclature(e, known, ["src_doc_id"]).select("ref_key_1c"))
    nom_dim = materialize(dense_keys(nom_ids.select(F.col("ref_key_1c").cast("string").alias("ref_key_1c")),
                                     ["ref_key_1c"], "nom_sk"), "dim_nomenclature")
    return e, field_dim, nom_dim, crop_dim


@query("harvest_fact", H_SD, hq(EXISTING_CROP_SQL + """,
field_no AS (SELECT _id, row_number() OVER (ORDER BY _id) AS field_sk FROM (SELECT DISTINCT _id FROM sd_fields)),
item_ids AS (SELECT CAST(item AS VARCHAR) AS id FROM item WHERE listed
             UNION SELECT CAST(nomenklatura_id AS VARCHAR) FROM enr WHERE nomenklatura_id IS NOT NULL),
item_no AS (SELECT id, row_number() OVER (ORDER BY id) AS nom_sk FROM item_ids)
SELECT CAST(CAST(doc_date AS DATE) AS VARCHAR) AS date_day, field_sk, crop_sk, nom_sk, uchastok_nomer AS plot_no,
       NULL::DOUBLE AS area_ha, kolichestvo_kg::DOUBLE AS weight_kg, src_doc_id AS src_doc_ref
FROM crops JOIN crop_dim ON t = [variety, color, reproduction, irrigation]
JOIN item_no ON id = CAST(nomenklatura_id AS VARCHAR) JOIN field_no ON _id = pole_id
QUALIFY god_urozhaya = 1995 OR NOT bool_or(god_urozhaya = 1995) OVER (PARTITION BY src_doc_id)"""))
def harvest_fact(t: Tables) -> DataFrame:
    """M-14 / J-06 / J-07 / J-08 / N12 / S-19 / S-20 / S-21 / P-08: fact rows keyed to the dimensions;
    the first year is the already-loaded fact and the load only appends
    documents not present yet."""
    e, field_dim, nom_dim, crop_dim = harvest_star(t)
    rows = facts.harvest_fact_rows(e, field_dim, nom_dim, crop_dim)
    existing = rows.where(F.year("date_day") == 1995)
    return facts.append_harvest(existing, rows)


@query("harvest_fact_routed", H_SD, hq(EXISTING_CROP_SQL + """,
field_no AS (SELECT _id, row_number() OVER (ORDER BY _id) AS field_sk FROM (SELECT DISTINCT _id FROM sd_fields)),
item_ids AS (SELECT CAST(item AS VARCHAR) AS id FROM item WHERE listed
             UNION SELECT CAST(nomenklatura_id AS VARCHAR) FROM enr WHERE nomenklatura_id IS NOT NULL),
item_no AS (SELECT id, row_number() OVER (ORDER BY id) AS nom_sk FROM item_ids),
wide AS (
  SELECT c.*, f.field_sk, n.nom_sk, k.crop_sk, CASE WHEN f.field_sk % 5 <> 0 THEN f.field_sk END AS ha
  FROM crops c LEFT JOIN crop_dim k ON k.t = [variety, color, reproduction, irrigation]
  LEFT JOIN item_no n ON n.id = CAST(c.nomenklatura_id AS VARCHAR) LEFT JOIN field_no f ON f._id = c.pole_id)
SELECT src_doc_id AS src_doc_ref, CAST(CAST(doc_date AS DATE) AS VARCHAR) AS date_day, kolichestvo_kg::DOUBLE AS weight_kg,
       CASE WHEN field_sk IS NULL OR nom_sk IS NULL THEN 'reject' WHEN field_sk % 2 = 0 THEN 'late fact' ELSE 'fact' END AS state,
       CASE WHEN field_sk IS NOT NULL AND nom_sk IS NOT NULL THEN field_sk END AS field_sk,
       CASE WHEN field_sk IS NOT NULL AND nom_sk IS NOT NULL THEN crop_sk END AS crop_sk,
       CASE WHEN field_sk IS NOT NULL AND nom_sk IS NOT NULL THEN nom_sk END AS nom_sk,
       CASE WHEN nom_sk IS NOT NULL AND ha > 0
            THEN (2 * CAST(kolichestvo_kg * 100 AS HUGEINT) + 1000 * ha) // (2000 * ha) / 100 END AS yield_t_ha,
       CASE WHEN field_sk IS NULL OR nom_sk IS NULL THEN concat_ws(', ',
         CASE WHEN pole_id IS NULL THEN 'no field' WHEN field_sk IS NULL THEN 'unknown field' END,
         CASE WHEN nomenklatura_id IS NULL THEN 'no item' WHEN nom_sk IS NULL THEN 'unknown item' END) END AS reasons
FROM wide"""))
def harvest_fact_routed(t: Tables) -> DataFrame:
    """M-14: every harvest row is a fact or a reject with all its reasons; half
    of the fields arrive after the first run, whose rejects are routed again.
    Rows in = facts + late facts + rejects."""
    e, field_dim, nom_dim, crop_dim = harvest_star(t)
    field_dim = field_dim.withColumn("area_ha", F.when(F.col("field_sk") % 5 != 0, F.col("field_sk")))
    routed = materialize(facts.route_harvest(e, field_dim.where("field_sk % 2 <> 0"), nom_dim, crop_dim), "harvest_routed")
    again = materialize(facts.route_harvest(facts.harvest_rejects(routed), field_dim, nom_dim, crop_dim), "harvest_again")
    cols = ["src_doc_ref", "date_day", "weight_kg", "state", "field_sk", "crop_sk", "nom_sk", "yield_t_ha", "reasons"]
    first, late = [facts.harvest_facts(r).withColumns({"state": F.lit(s), "reasons": F.lit(None).cast("string")}).select(*cols)
                   for r, s in ((routed, "fact"), (again, "late fact"))]
    left = facts.harvest_rejects(again).select(
        F.col("src_doc_id").cast("string").alias("src_doc_ref"), F.to_date("doc_date").alias("date_day"),
        F.col("kolichestvo_kg").cast("decimal(18,2)").alias("weight_kg"), F.lit("reject").alias("state"), F.array_join("reasons", ", ").alias("reasons"))
    return first.unionByName(late).unionByName(left, allowMissingColumns=True)


@query("net_weight_check", ["sd_weighings"], """
SELECT _id FROM sd_weighings WHERE ves_brutto_kg NOT IN (ves_netto_kg + ves_tary_kg)""")
def net_weight_check(t: Tables) -> DataFrame:
    """Q-13: net must equal gross minus tare."""
    return quality.net_weight_mismatch(t.sd_weighings).select("_id")


@query("harvest_by_season", H_SD, hq(f"""
SELECT concat(start, '-', start + 1) AS season_label, agro_phase, COUNT(*) AS weighings, {TONS_SQL}
FROM (SELECT *, CAST(year(doc_date - INTERVAL 6 MONTH) AS BIGINT) AS start, {list(AGRO_PHASES)}[month(doc_date)] AS agro_phase FROM enr)
GROUP BY 1, 2"""))
def harvest_by_season(t: Tables) -> DataFrame:
    """J-15 / S-17 / S-18: harvest rows joined to the calendar dimension on the
    day, reported by farm season and agronomic phase."""
    e = enriched(t).withColumn("date_day", F.to_date("doc_date"))
    bounds = e.agg(F.min("doc_date").alias("start"), F.max("doc_date").alias("end"))
    cal = dims.dim_date(bounds).select("date_day", "season_label", "agro_phase")
    j = e.join(cal, "date_day")
    return j.groupBy("season_label", "agro_phase").agg(F.count(F.lit(1)).alias("weighings"),
                                                       (F.sum("kolichestvo_kg") / 1000).alias("tons"))


@query("combine_slips", ["sd_slips", "sd_weighings"], """
SELECT s.doc_id, s.line_number, lower(s.pole_id) AS pole_id, CAST(s.massa_kg AS DOUBLE) AS massa_kg,
       CAST(w.doc_date AS VARCHAR) AS doc_date, CAST(year(w.doc_date) AS INTEGER) AS god_urozhaya
FROM sd_slips s JOIN sd_weighings w ON w._id = s.doc_id
WHERE s.tip_talona = 'ТалонКомбайнера' AND s.pole_id IS NOT NULL
  AND s.pole_id <> '00000000-0000-0000-0000-000000000000'""")
def combine_slips(t: Tables) -> DataFrame:
    """M-04 / P-06: combine-operator slips that carry a real field id, with
    their weighing's date and harvest year."""
    w = t.sd_weighings.select("_id", "doc_date", F.lit(None).cast("string").alias("doc_number"))
    s = staging.stg_slips(t.sd_slips, w)
    return s.select("doc_id", "line_number", "pole_id", "massa_kg", "doc_date", "god_urozhaya")
