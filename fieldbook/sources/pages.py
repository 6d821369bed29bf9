"""Landed ERP pages -> typed document and line rows.

A page is one JSON object ``{"value": [doc, ...]}``; documents may carry their
table part as an array of structs.  Pages land as files (one object per file,
``multi_line=True``) or as JSON Lines (one page per line, splittable).  The
page order used for "first page wins" is the file path, then the line/position.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from fieldbook.constants import LOOKBACK_HOURS
from fieldbook.operators.dedup import dedup_first_seen
from fieldbook.operators.joins import anti_join, semi_join
from fieldbook.session import materialize_compact


# microsecond timestamps survive the JSON round trip (the default keeps millis)
PAGE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def envelope_schema(doc_schema: StructType) -> StructType:
    return StructType([StructField("value", ArrayType(doc_schema), True)])


def read_pages(spark: SparkSession, path: str, doc_schema: StructType,
               multi_line: bool = True) -> DataFrame:
    """All documents of all pages, with ``_page`` (file path + line) and ``_pos``.

    The schema is declared (no inference) and limited to the columns asked
    for, so the scan prunes everything else.  Empty pages yield no rows.
    """
    r = (spark.read.schema(envelope_schema(doc_schema))
         .option("timestampNTZFormat", PAGE_TS_FORMAT).option("timestampFormat", PAGE_TS_FORMAT + "XXX"))
    if multi_line:
        r = r.option("multiLine", True)
    raw = r.json(path).select(F.col("_metadata.file_path").alias("_file"),
                              F.col("_metadata.file_block_start").alias("_block"),
                              F.monotonically_increasing_id().alias("_line"), "value")
    docs = raw.select("_file", "_block", "_line", F.posexplode("value").alias("_pos", "doc"))
    # page order: file, split offset inside the file, line inside the split
    page = F.concat_ws("#", "_file", F.lpad(F.col("_block").cast("string"), 20, "0"),
                       F.lpad((F.col("_line").bitwiseAND(F.lit((1 << 33) - 1))).cast("string"), 12, "0"))
    return docs.select(page.alias("_page"), "_pos", "doc.*")


def project_entity(df: DataFrame, mapping: dict[str, Column | str]) -> DataFrame:
    """Source column selection and renaming: ``{target: source column or expression}``."""
    keep = [c for c in ("_page", "_pos") if c in df.columns]
    return df.select(*keep, *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def lookback(run_ts: datetime, hours: int = LOOKBACK_HOURS, date_from: datetime | None = None) -> datetime:
    """Explicit start, else ``run_ts - hours``."""
    return date_from if date_from is not None else run_ts - timedelta(hours=hours)


def since(df: DataFrame, col: str, ts) -> DataFrame:
    """Incremental predicate ``col >= ts`` (pushed into the scan)."""
    return df.where(F.col(col) >= F.lit(ts))


def explode_lines(df: DataFrame, array_col: str, doc_key: str, mapping: dict[str, Column | str],
                  line_col: str = "line_number") -> DataFrame:
    """Table part -> one row per line; a missing or empty part yields no lines.

    The line number is the source number when present and non-zero, else the
    1-based position inside the document (never a global running counter,
    which would depend on read order)."""
    ex = df.select(F.col(doc_key).alias("doc_id"), F.posexplode(array_col).alias("__pos", "__l"))
    src_no = F.col("__l.LineNumber") if "LineNumber" in ex.schema["__l"].dataType.names else F.lit(None)
    num = F.when(src_no.isNotNull() & (src_no.cast("int") != 0), src_no.cast("int")).otherwise(F.col("__pos") + 1)
    cols = [(F.col(f"__l.{v}") if isinstance(v, str) else v).alias(k) for k, v in mapping.items()]
    return ex.select("doc_id", num.alias(line_col), *cols)


def line_key(doc: str, line: str, sep: str = "_") -> Column:
    return F.concat_ws(sep, F.col(doc).cast("string"), F.col(line).cast("string"))


def drop_folders(df: DataFrame, flag: str = "IsFolder") -> DataFrame:
    """Catalog folder rows are skipped; a NULL flag means "not a folder"."""
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))


def first_seen(df: DataFrame, keys) -> DataFrame:
    """Keys repeated across pages (paging without stable order): first wins."""
    return dedup_first_seen(df, keys, "_page", "_pos")


def reconcile(headers: DataFrame, lines: DataFrame, repair: DataFrame | None = None,
              header_key: str = "_id", line_doc: str = "doc_id"):
    """Lines read from their own entity (filtered on another date) against headers.

    Returns ``(headers, kept_lines, orphan_lines)``: header keys missing for
    some lines are filled from ``repair`` (a re-read of those headers), then
    lines without a header are split off and can be counted.  Lines and headers
    are read several times, so both are written once."""
    lines = materialize_compact(lines, "reconcile_lines")
    if repair is not None:
        headers = materialize_compact(headers, "reconcile_headers")
        missing = anti_join(lines.select(line_doc).distinct(), headers, [(line_doc, header_key)])
        fetched = semi_join(repair, missing, [(header_key, line_doc)])
        headers = headers.unionByName(fetched, allowMissingColumns=True)
        headers = dedup_first_seen(headers, header_key) if "_page" in headers.columns else headers.dropDuplicates([header_key])
    headers = materialize_compact(headers, "reconcile_headers")
    kept = semi_join(lines, headers, [(line_doc, header_key)])
    orphans = anti_join(lines, headers, [(line_doc, header_key)])
    return headers, kept, orphans


def probe_schema(source: DataFrame, expected: StructType | list[str]) -> DataFrame:
    """Schema drift of ``source``, which must be read without a declared
    schema: expected columns that are missing, columns not expected, and (for a
    declared type) columns of another type.  Only the schema is read, no rows."""
    types = {f.name: f.dataType.simpleString() for f in source.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected} if isinstance(expected, StructType) else dict.fromkeys(expected)
    rows = [(c, "missing") for c in wanted if c not in types]
    rows += [(c, "extra") for c in types if c not in wanted and not c.startswith("_")]
    rows += [(c, "type") for c, t in wanted.items() if t and types.get(c, t) != t]
    return source.sparkSession.createDataFrame(rows, "column string, status string")


def page_keys(spark: SparkSession, path: str) -> DataFrame:
    """Field names of the first record of landed JSON Lines pages, as sent
    (one line is read)."""
    first = spark.read.text(path).where(F.get_json_object("value", "$.value[0]").isNotNull()).limit(1)
    return first.select(F.explode(F.json_object_keys(F.get_json_object("value", "$.value[0]"))).alias("column"))


def probe_pages(spark: SparkSession, path: str, expected: list[str]) -> DataFrame:
    """Mapped source fields that the pages do not send (a declared schema
    would read them as NULL without an error), and fields sent but not mapped."""
    sent, wanted = page_keys(spark, path), spark.createDataFrame([(c,) for c in expected], "column string")
    return (wanted.join(sent, "column", "left_anti").withColumn("status", F.lit("missing"))
            .unionByName(sent.join(wanted, "column", "left_anti").withColumn("status", F.lit("extra"))))


def write_pages(docs: DataFrame, path: str, page_col: str, doc_col: str = "doc", mode: str = "overwrite") -> str:
    """Land documents as JSON Lines pages ``{"value": [doc, ...]}``, one page
    per line.  ``page_col`` must bound the page size (e.g. a key range), so
    a page is a bounded group."""
    (docs.groupBy(page_col).agg(F.collect_list(doc_col).alias("value"))
         .select("value").write.mode(mode)
         .option("timestampNTZFormat", PAGE_TS_FORMAT).option("timestampFormat", PAGE_TS_FORMAT + "XXX")
         .json(path))
    return path


def lookback_column(run_ts, hours: int = LOOKBACK_HOURS) -> Column:
    """Column form of ``lookback`` for a run timestamp known only to Spark
    (e.g. the latest loaded timestamp as a scalar subquery)."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return ts - F.expr(f"INTERVAL {int(hours)} HOURS")
