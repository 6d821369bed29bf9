"""Declarative load of source entities: landed pages -> typed rows, lines, rejects.

An ``Entity`` says which fields the source sends, what they become, and by
which rule each is read; ``load`` does the rest for any of them:

* the page envelope and every document are parsed once, as text; a page that is
  torn or has no ``value`` is reported, not skipped;
* a document that lacks a mapped field is an error (the source sends every
  selected field, empty ones as null), never a silent NULL;
* fields nobody mapped are kept as JSON in ``_rest``, values a lenient rule could
  not read in ``_unparsed`` ({column: text});
* a row without key, or with a value its strict rule could not read, goes to the
  rejects with all its reasons and the document as sent;
* keys repeated across pages: the first or the last in page order, by entity;
* table parts become lines of the version that was kept, under the document's
  key; a missing or empty part gives none.

``read_lines`` reads a table part that the source exposes as an entity of its
own.  Everything is DataFrame expressions; a document is never regrouped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldbook import schemas
from fieldbook.constants import LOOKUP_BROADCAST_MAX_BYTES
from fieldbook.functions.normalize import norm_guid, norm_text
from fieldbook.operators.dedup import dedup_first_seen, last_writer_wins
from fieldbook.operators.joins import anti_join, broadcast_if_small, semi_join
from fieldbook.operators.upsert import upsert
from fieldbook.session import materialize_compact
from fieldbook.sources.pages import PAGE_TS_FORMAT

STRICT, LENIENT = "strict", "lenient"          # of numbers; other rules: text, guid, typed
NUMBER_START = r"^[\x00-\x20]*[-+.0-9NnIi]"    # blanks, then a sign, a point, a digit, or NaN or infinity


@dataclass(frozen=True)
class Part:
    """A table part: the array it is sent as, its raw table, {column: (field, rule)}."""
    array: str
    table: str
    fields: dict[str, tuple[str, str]]
    separator: str = "_"


@dataclass(frozen=True)
class Entity:
    source: str
    table: str
    fields: dict[str, tuple[str, str]]
    parts: tuple[Part, ...] = ()
    skip_folders: bool = False
    repeated: str = "last"
    key: tuple[str, ...] = ("_id",)

    def sent(self) -> list[str]:
        """The source fields asked for (``$select``)."""
        folder = ["IsFolder"] if self.skip_folders else []
        return list(dict.fromkeys([s for s, _ in self.fields.values()] + folder))

    def select(self) -> str:
        return ",".join(self.sent() + [p.array for p in self.parts])


# Names of the source's entities and fields (its interface).
_REF = {"_id": ("Ref_Key", "text"), "_deletionmark": ("DeletionMark", "typed")}
_CATALOG = {**_REF, "description": ("Description", "text")}
_PARENT = {**_CATALOG, "parent_id": ("Parent_Key", "text")}
_DOCUMENT = {**_REF, "_posted": ("Posted", "typed"), "doc_number": ("Number", "text"), "doc_date": ("Date", "typed")}

ENTITIES: dict[str, Entity] = {e.table: e for e in (
    Entity("Catalog_УпаковкиЕдиницыИзмерения", "units",
           {**_CATALOG, "code": ("Code", "text"), "weight_kg": ("Вес", STRICT), "volume_l": ("Объем", STRICT)}),
    Entity("Catalog_АпкМоделиСХТехники", "machine_models", {**_CATALOG, "power_hp": ("МощностьДвигателя", STRICT)}),
    Entity("Catalog_АпкПоля", "fields", {**_PARENT, "farm_id": ("Организация_Key", "text")}),
    Entity("Catalog_АпкКультуры", "crops", {**_PARENT, "crop_kind": ("КультураПоКлассификатору", "text")}, skip_folders=True),
    Entity("Catalog_АпкТопливныеКарты", "fuel_cards",
           {**_CATALOG, "card_number": ("Code", "text"), "owner_id": ("Держатель_Key", "text")}),
    Entity("Catalog_Сотрудники", "employees", {**_CATALOG, "individual_id": ("ФизическоеЛицо_Key", "text")}),
    Entity("Catalog_СтатьиДвиженияДенежныхСредств", "cashflow_items",
           {**_PARENT, "cashflow_kind": ("ВидДвиженияДенежныхСредств", "text")}),
    Entity("Catalog_АпкСевообороты", "crop_rotations", _CATALOG),
    Entity("Catalog_СтруктураПредприятия", "company_structure", {**_PARENT, "node_type": ("АпкТип", "text")}),
    Entity("Catalog_ТранспортныеСредства", "equipment",
           {**_CATALOG, "model_id": ("АпкМодель", "text"), "reg_number": ("АпкХозНомер", "text"),
            "equipment_type": ("АпкТипТС", "text")}, skip_folders=True),
    # items of calculation keep their folders
    Entity("Catalog_СтатьиКалькуляции", "expense_items", {**_PARENT, "expense_kind": ("ТипЗатрат", "text")}),
    Entity("Catalog_ВидыРаботСотрудников", "tech_operations", {**_PARENT, "operation_kind": ("Code", "text")}),
    Entity("Document_ДвижениеПродукцииИМатериалов", "movement",
           {**_DOCUMENT, "operaciya": ("ХозяйственнаяОперация", "text"), "sender_id": ("Отправитель", "text"),
            "recipient_id": ("Получатель", "text"), "cost_object_id": ("АпкОбъектЗатрат_Key", "text"),
            "work_type_id": ("АпкВидРаботы_Key", "text"), "kommentariy": ("Комментарий", "text")},
           (Part("Товары", "movement_lines",
                 {"pole_id": ("Поле_Key", "text"), "nomenklatura_id": ("Номенклатура_Key", "text"),
                  "edinica_id": ("ЕдиницаИзмерения_Key", "text"), "kolichestvo": ("Количество", STRICT),
                  "summa": ("Сумма", STRICT), "seriya": ("Серия", "text")}),)),
    Entity("Document_АпкПутевойЛистТракториста", "waybill",
           {**_DOCUMENT, "data_nachala": ("ДатаНачалаРабот", "typed"), "data_okonchaniya": ("ДатаОкончанияРабот", "typed"),
            "tehnika_id": ("Техника_Key", "text"), "voditel_id": ("Механизатор", "text"),
            "narabotka_moto_chas": ("МоточасовВсего", STRICT), "kommentariy": ("Комментарий", "text")}, repeated="first"),
    # the waybill's work lines, sent as an entity of their own
    Entity("Document_АпкПутевойЛистТракториста_ВыполненныеРаботы", "waybill_lines",
           {"doc_id": ("Ref_Key", "text"), "line_number": ("LineNumber", "typed"), "agr_operaciya_id": ("ВидРаботы_Key", "text"),
            "edinica_id": ("ЕдиницаДопОбъема_Key", "text"), "obem_rabot_ga": ("Гектаров", STRICT),
            "norma_vyrabotki": ("СменнаяНормаВыработки", STRICT)}, repeated="first", key=("doc_id", "line_number")),
    Entity("Document_АпкРегистрацияВзвешиванийНаТоку", "weighing",
           {**_DOCUMENT, "vid_vzveshivaniya": ("ВидВзвешивания", "text"), "otkuda_id": ("Откуда", "guid"),
            "kuda_id": ("Куда", "guid"), "nomenklatura_id": ("Номенклатура_Key", "guid"), "voditel_id": ("Водитель", "guid"),
            "avtomobil_id": ("Автомобиль", "guid"), "ves_tary_kg": ("ВесТары", LENIENT), "ves_brutto_kg": ("ВесБрутто", LENIENT),
            "ves_netto_kg": ("ВесНетто", LENIENT), "avtor_id": ("Автор_Key", "guid")},
           (Part("Талоны", "weighing_slips",
                 {"pole_id": ("Поле_Key", "guid"), "nomer_talona": ("НомерТалона", "text"), "tip_talona": ("ТипТалона", "text"),
                  "massa_kg": ("Масса", LENIENT), "kombayn_id": ("Комбайн_Key", "guid"), "mehanizator_id": ("Механизатор", "guid"),
                  "obem_bunkera": ("ОбъемБункера", LENIENT), "procent_zapolneniya": ("ПроцентЗаполнения", LENIENT)}, "-"),)),
    Entity("Document_АпкСписаниеСемянУдобренийИЯдов", "writeoff",
           {**_DOCUMENT, "otpravitel_text": ("Отправитель", "text"), "poluchatel_text": ("Получатель", "text"),
            "operaciya": ("ХозяйственнаяОперация", "text"), "otvetstvennyi_id": ("Ответственный", "text")},
           (Part("Материалы", "writeoff_lines",
                 {"nomenklatura_id": ("Номенклатура_Key", "text"), "kolichestvo": ("Количество", LENIENT),
                  "edinica_id": ("ЕдиницаИзмерения_Key", "text")}, "-"),)),
    Entity("Document_АпкСписаниеТоплива", "fuel_summary",
           {**_REF, "doc_number": ("Number", "text"), "doc_date": ("Date", "typed"), "period_start": ("НачалоПериода", "typed"),
            "period_end": ("ОкончаниеПериода", "typed"), "organization_id": ("Организация", "text"),
            "department_id": ("Подразделение", "text")},
           (Part("ГСМ", "fuel_summary_lines",
                 {"equipment_id": ("ТранспортноеСредство", "text"), "fuel_brand": ("МаркаТоплива", "text"),
                  "nachalny_ostatok_l": ("НачальныйОстаток", LENIENT), "zapravleno_l": ("Заправлено", LENIENT),
                  "fakticheskiy_rashod_l": ("ФактическийРасход", LENIENT), "konechny_ostatok_l": ("КонечныйОстаток", LENIENT)}),)),
)}


@dataclass(frozen=True)
class Loaded:
    """What one entity's pages hold.  ``rows`` and ``lines`` have the raw
    table's columns, then ``_rest`` and ``_unparsed``; ``rejects`` is (table,
    doc, reasons), ``pages`` the pages that could not be read."""
    rows: DataFrame
    rejects: DataFrame
    pages: DataFrame
    lines: dict[str, DataFrame] = field(default_factory=dict)


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(_page, _pos, doc): documents as sent; and the pages without any list of them."""
    raw = spark.read.text(path).select(
        F.concat_ws("#", "_metadata.file_path", F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"),
                    F.lpad(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("string"), 12, "0")).alias("_page"),
        "value", F.from_json("value", "value array<string>").getField("value").alias("docs"))
    torn = raw.where("docs is null and trim(value) <> ''").select("_page", F.col("value").alias("page"))
    return raw.select("_page", F.posexplode("docs").alias("_pos", "doc")), torn


def _typed(text: Column, rule: str, kind) -> Column:
    if rule == "text":
        return norm_text(text)
    if rule == "guid":
        return norm_guid(text)
    given = norm_text(text)
    if kind.simpleString().startswith("timestamp"):
        return F.coalesce(given.try_cast(kind), F.try_to_timestamp(given, F.lit(PAGE_TS_FORMAT)).try_cast(kind))
    if kind.simpleString().startswith("decimal") and rule == LENIENT:
        # text that cannot begin a number is not tried: a failed cast costs an exception
        return F.when(given.rlike(NUMBER_START), given.try_cast("double")).try_cast(kind)
    return given.try_cast(kind)


def _parsed(df: DataFrame, fields: dict[str, tuple[str, str]], table: str, arrays: list[str], source: str,
            also: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """``df`` (with ``doc``) and the typed columns of ``fields``, ``_rest``,
    ``_unparsed`` and ``_reasons``; a mapped field that is not sent is an error."""
    kinds = {f.name: f.dataType for f in schemas.RAW[table].fields}
    names = list(dict.fromkeys([s for s, _ in fields.values()] + list(also)))
    schema = ", ".join([f"`{n}` string" for n in names] + [f"`{a}` array<string>" for a in arrays])
    # parsed by generators: filters on the columns stay above them, so they read what was parsed and do not parse again
    out = df.select("*", F.inline(F.array(F.struct(F.from_json("doc", schema).alias("_s"), F.json_object_keys("doc").alias("_keys"))))).select(
        "*", F.inline(F.array(F.struct(F.array_except(F.array(*[F.lit(n) for n in names if n not in extra]), "_keys").alias("_absent"),
                                       F.size(F.array_except("_keys", F.array(*[F.lit(n) for n in [*names, *arrays]]))).alias("_more"))))).drop("_keys")
    out = out.where(F.when(F.size("_absent") > 0, F.raise_error(F.concat(
        F.lit(f"{source}: not sent: "), F.array_join("_absent", ", "))).cast("boolean")).otherwise(F.lit(True)))
    text = {c: F.col("_s").getField(s) for c, (s, _) in fields.items()}
    typed = {c: _typed(text[c], rule, kinds[c]) for c, (_, rule) in fields.items()}
    read_as_null = {c: norm_text(text[c]).isNotNull() & typed[c].isNull() for c, (_, rule) in fields.items() if rule not in ("text", "guid")}
    strict = [F.when(read_as_null[c], F.lit(c)) for c, (_, rule) in fields.items() if rule == STRICT]
    loose = [F.when(read_as_null[c], F.struct(F.lit(c).alias("key"), text[c].alias("value"))) for c in read_as_null
             if fields[c][1] != STRICT]
    none = F.array().cast("array<string>")
    rest = F.map_filter(F.from_json("doc", "map<string,string>"), lambda k, _: ~k.isin(*names, *arrays))
    return out.withColumns({
        **typed, **{a: F.col("_s").getField(a) for a in arrays}, **{a: F.col("_s").getField(a) for a in also},
        "_rest": F.when(F.col("_more") > 0, F.to_json(rest)),         # read again only if it sends more than is mapped
        "_unparsed": F.when(F.size(x := F.array_compact(F.array(*loose))) > 0, F.map_from_entries(x)) if loose
        else F.lit(None).cast("map<string,string>"),
        "_reasons": F.array_compact(F.array(*strict)) if strict else none}).drop("_s", "_absent", "_more")


def _rejected(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    missing = [F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in key]
    return df.withColumn("_reasons", F.array_compact(F.array(*missing, F.when(
        F.size("_reasons") > 0, F.concat(F.lit("not a number: "), F.array_join("_reasons", ", ")))))).withColumn("_table", F.lit(table))


def load(spark: SparkSession, path: str, entity: Entity) -> Loaded:
    """Read the JSON Lines pages under ``path`` as ``entity``."""
    docs, torn = _documents(spark, path)
    also = ["IsFolder"] if entity.skip_folders else []
    arrays = [p.array for p in entity.parts]
    read = _parsed(docs, entity.fields, entity.table, arrays, entity.source, also)
    if entity.skip_folders:
        read = read.where(F.coalesce(F.col("IsFolder").try_cast("boolean"), F.lit(False)) == F.lit(False)).drop("IsFolder")
    read = _rejected(read, entity.table, list(entity.key))
    good = read.where(F.size("_reasons") == 0)
    rejects = [read.where(F.size("_reasons") > 0)]
    if entity.parts:                               # read by the rows and by every part: pages are parsed once
        good = _standing(materialize_compact(good.drop("doc", "_reasons", "_table"), f"load_{entity.table}"), entity).drop("_page", "_pos")
    else:
        good = _chosen(good, entity)
    lines = {}
    for part in entity.parts:
        kept, refused = _lines(good, entity, part)
        lines[part.table] = kept
        rejects.append(refused)
    refused = rejects[0].select(F.col("_table").alias("table"), "doc", F.col("_reasons").alias("reasons"))
    for r in rejects[1:]:
        refused = refused.unionByName(r.select(F.col("_table").alias("table"), "doc", F.col("_reasons").alias("reasons")))
    return Loaded(_table(good, entity.table, []), refused, torn, lines)


def _chosen(df: DataFrame, entity: Entity) -> DataFrame:
    """The first or the last row of a key, in page order."""
    if entity.repeated == "first":
        return dedup_first_seen(df, list(entity.key))
    return last_writer_wins(df, list(entity.key), ["_page", "_pos"])


def _standing(df: DataFrame, entity: Entity) -> DataFrame:
    """``_chosen`` over a written copy: whole documents are not shuffled, only
    the keys, and the places of documents whose key is repeated."""
    keys, place = list(entity.key), ["_page", "_pos"]
    many = df.groupBy(*keys).count().where("count > 1").drop("count")
    repeated = materialize_compact(semi_join(df.select(*keys, *place), many, keys), f"repeated_{entity.table}")
    if repeated.isEmpty():
        return df
    passed = materialize_compact(anti_join(repeated, _chosen(repeated, entity), place), f"passed_{entity.table}")
    return anti_join(df, broadcast_if_small(passed, LOOKUP_BROADCAST_MAX_BYTES), place)


def _table(df: DataFrame, table: str, more: list[str]) -> DataFrame:
    """The raw table's columns (those the source does not send are NULL)."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.RAW[table].fields]
    return df.select(*cols, *more, "_rest", "_unparsed")


def _lines(docs: DataFrame, entity: Entity, part: Part) -> tuple[DataFrame, DataFrame]:
    """Lines of a table part and its rejects; a line's number is the one sent,
    else (none or zero) its place in the document."""
    ex = docs.select(F.col("_id").alias("doc_id"), F.posexplode(_column(part.array)).alias("_at", "doc"))
    read = _parsed(ex, part.fields, part.table, [], f"{entity.source}.{part.array}", ["LineNumber"], extra=("LineNumber",))
    sent = F.col("LineNumber").try_cast("int")
    read = read.withColumn("line_number", F.when(sent != 0, sent).otherwise(F.col("_at") + 1)).drop("LineNumber")
    read = _rejected(read, part.table, []).withColumn("line_key", F.concat_ws(part.separator, "doc_id", "line_number"))
    good = read.where(F.size("_reasons") == 0)
    return _table(good, part.table, ["line_key"]), read.where(F.size("_reasons") > 0)


def merge(target: DataFrame, loaded: DataFrame, keys) -> DataFrame:
    """Upsert loaded rows into a raw table (columns of the target)."""
    return upsert(target, loaded.select(*target.columns), keys)
