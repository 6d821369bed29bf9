"""Landed page ingest (I-01 ... I-09, I-12) on fixture pages."""

import json
import os
import tempfile

from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from fieldbook.sources import pages
from tests.conftest import rows, shuffled_bytes

DOC = StructType([StructField("Ref_Key", StringType()), StructField("IsFolder", StringType()),
                  StructField("Items", ArrayType(StructType([StructField("LineNumber", IntegerType()),
                                                             StructField("Qty", StringType())])))])


def land(tmp, name, obj):
    with open(os.path.join(tmp, name), "w", encoding="utf-8") as f:
        json.dump(obj, f, ensure_ascii=False, indent=1)


def fixture_pages():
    tmp = tempfile.mkdtemp(prefix="pages-")
    land(tmp, "p1.json", {"value": [{"Ref_Key": "a", "Items": [{"LineNumber": 0, "Qty": "1"},
                                                              {"LineNumber": 3, "Qty": "2"}]},
                                    {"Ref_Key": "b", "Items": []}]})
    land(tmp, "p2.json", {"value": [{"Ref_Key": "a", "Items": [{"LineNumber": 1, "Qty": "9"}]},
                                    {"Ref_Key": "c"}]})           # repeated key, doc without table part
    land(tmp, "p3.json", {"value": []})                           # empty last page
    return tmp


def test_read_explode_and_first_seen(spark):
    docs = pages.read_pages(spark, fixture_pages(), DOC)
    assert docs.count() == 4
    first = pages.first_seen(docs, "Ref_Key")
    assert sorted(r.Ref_Key for r in first.collect()) == ["a", "b", "c"]
    lines = pages.explode_lines(first, "Items", "Ref_Key", {"qty": "Qty"})
    # missing number and 0 -> position; 3 kept; 'b' (empty part) and 'c' (no part) give no lines
    assert rows(lines) == [("a", 1, "1"), ("a", 3, "2")]


def test_reconcile_and_probe(spark):
    h = spark.createDataFrame([("a",)], "_id string")
    lines = spark.createDataFrame([("a", 1), ("b", 1), ("z", 1)], "doc_id string, n int")
    repair = spark.createDataFrame([("b",)], "_id string")
    heads, kept, orphans = pages.reconcile(h, lines, repair)
    assert heads.count() == 2 and kept.count() == 2 and rows(orphans) == [("z", 1)]
    drift = pages.probe_schema(h, ["_id", "doc_number"])
    assert rows(drift) == [("doc_number", "missing")]


def test_reconcile_reads_lines_and_headers_once(spark):
    tmp = tempfile.mkdtemp(prefix="reconcile-")
    with open(os.path.join(tmp, "lines.txt"), "w", encoding="utf-8") as f:
        f.write("a\nb\nz\n")
    heads, kept, orphans = pages.reconcile(spark.createDataFrame([("a",)], "_id string"), spark.read.text(tmp).withColumnRenamed("value", "doc_id"),
                                           spark.createDataFrame([("b",)], "_id string"))
    assert not any("FileScan text" in df._jdf.queryExecution().executedPlan().toString() for df in (heads, kept, orphans))
    assert rows(kept) == [("a",), ("b",)] and rows(orphans) == [("z",)]


def test_reconcile_leaves_no_shuffles(spark):
    lines = spark.range(20_000).selectExpr("concat('d', id % 5000) doc_id", "cast(id as int) line_number")
    headers = spark.range(5000).where("id % 3 > 0").selectExpr("concat('d', id) _id", "'h' number").distinct()
    repair = spark.range(5000).where("id % 6 = 0").selectExpr("concat('d', id) _id", "'r' number")
    before = shuffled_bytes(spark)
    heads, kept, orphans = pages.reconcile(headers, lines.distinct(), repair)
    assert shuffled_bytes(spark, most=before) <= before
    assert rows(heads.groupBy("number").count()) == [("h", 3333), ("r", 834)] and kept.count() == 4 * 4167 and orphans.count() == 4 * 833


def test_drop_folders(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "k string, IsFolder boolean")
    assert sorted(r.k for r in pages.drop_folders(df).collect()) == ["b", "c"]


def test_probe_pages_lists_the_fields_as_sent(spark):
    tmp = tempfile.mkdtemp(prefix="probe-")
    with open(os.path.join(tmp, "p.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps({"value": []}) + "\n" + json.dumps({"value": [{"Ref_Key": "a", "New": 1}]}) + "\n")
    assert rows(pages.probe_pages(spark, tmp, ["Ref_Key", "Weight"])) == [("New", "extra"), ("Weight", "missing")]


def test_probe_schema_sees_types(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    declared = StructType([StructField("k", StringType()), StructField("n", StringType())])
    assert rows(pages.probe_schema(df, declared)) == [("n", "type")]
