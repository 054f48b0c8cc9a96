"""The documents' JSON text is put together from pieces that the JVM compiles."""

import json
import re

from pyspark.sql import functions as F

from docshred.operators.shredder import occurring_items
from docshred.plans import nest
from docshred.plans.clinical import clinical_specs
from docshred.sources.documents import CORRUPT, MISFITS, read_documents, stage_documents
from tests.conftest import rows
from tests.test_plans import _plan
from tests.test_shred import DICTS, HAPPY

SF = "/root/testdata/sf0.001"
QUOTED = 'a"b\\c\td\u0002é'


def _tables(spark, folder, **names):
    n = {k: names.get(k, k) for k in ("c_name", "c_mktsegment", "n_name", "r_name", "s_name", "p_name", "p_brand", "p_type", "priority")}
    given = {
        "region": [(2, n["r_name"])], "nation": [(1, n["n_name"], 2)], "customer": [(5, n["c_name"], 1, n["c_mktsegment"])],
        "supplier": [(3, n["s_name"])], "part": [(4, n["p_name"], n["p_brand"], n["p_type"], 7)],
        "orders": [(64, 5, "O", n["priority"]), (-64, 5, "O", n["priority"])],
        "lineitem": [(64, 4, 3, 1, 2.0, "R", "O"), (-64, 4, 3, None, 2.0, "A", "F")]}
    schemas = {
        "region": "r_regionkey int, r_name string", "nation": "n_nationkey int, n_name string, n_regionkey int",
        "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", "supplier": "s_suppkey long, s_name string",
        "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"}
    for t, data in given.items():
        df = spark.createDataFrame(data, schemas[t])
        for day in {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"]}.get(t, []):
            df = df.withColumn(day, F.lit("1996-01-02").cast("timestamp"))
        df.write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


def _documents(spark, folder):
    texts = [r["value"] for r in nest.build_documents(spark, folder).collect()]
    return {d["assessments"][0]["assessmentData"]["L_ORDERKEY"]: d for d in map(json.loads, texts) if "assessments" in d
            and isinstance(d["assessments"], list)}


def test_texts_are_escaped(spark, tmp_path):
    d = _documents(spark, _tables(spark, tmp_path, c_name=QUOTED, n_name=QUOTED, s_name=QUOTED, p_name="é", p_type=QUOTED))["64"]
    assert d["demographics"]["name"]["first"] == QUOTED and d["demographics"]["emergencyContacts"] == [QUOTED] * 2
    assert d["diagnoses"][0]["description"] == "é" and d["diagnoses"][0]["code"] == "p_brand.7"
    assert d["documents"][0] == {"filename": "64-1.pdf", "displayFilename": f"{QUOTED} - {QUOTED}.pdf", "filetype": "pdf", "dataType": "wardReport"}
    assert d["dischargeInfo"]["destination"]["alternateIdentifiers"][0]["facility"] == QUOTED
    assert d["payors"][2] == {"policy": None, "companyName": "x-r_name"} and d["facility"]["name"] == QUOTED


def test_missing_and_null_texts(spark, tmp_path):
    """An SQL NULL is a missing key, the sentinel an explicit null."""
    d = _documents(spark, _tables(spark, tmp_path, c_name=None, s_name=None, c_mktsegment="FURNITURE", n_name=None, priority=None, p_name="\u0001"))["64"]
    assert list(d["demographics"]["name"]) == ["last", "title", "suffix"] and d["demographics"]["emergencyContacts"] == [None, None]
    assert d["dischargeInfo"] == {} and "patientClass" not in d["demographics"] and "displayFilename" not in d["documents"][0]
    assert d["diagnoses"][0]["description"] is None and d["payors"][1]["policy"]["payor"] == {"name": {}}


def test_dense_items_of_any_key(spark, tmp_path):
    docs = _documents(spark, _tables(spark, tmp_path))
    for key, kind in (("64", "oasis"), ("-64", "mds")):
        sql = nest.dense_items(kind).replace("l_orderkey", f"CAST({key} AS BIGINT)")
        want = json.loads("{" + spark.range(1).select(F.expr(sql).alias("x")).first()["x"] + "}")
        got = docs[key]["assessments"][0]["assessmentData"]
        assert len(want) > 100 and {k: v for k, v in got.items() if "_ITEM_" in k} == want
    assert len(docs["-64"]["assessments"]) == 3         # the second one twice
    keys = nest.with_dense_items(spark.range(64 * 500).selectExpr("id AS l_orderkey").where(nest.DENSE))
    for kind in ("oasis", "mds"):
        assert keys.where(f"more_{kind} IS DISTINCT FROM concat(',', {nest.dense_items(kind)})").count() == 0


def test_text_is_compiled(spark):
    """The JVM never compiles a method of over 8000 bytes."""
    key = "spark.sql.adaptive.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        plan = nest.build_documents(spark, SF)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        code = debug.codegenStringSeq(plan)
        sizes = [int(re.search(r"\((\d+)", str(code.apply(i)._3()))[1]) for i in range(code.size())]
    finally:
        spark.conf.set(key, was)
    assert len(sizes) > 5 and max(sizes) < 8000


def test_a_line_that_fits_is_parsed_once(spark, monkeypatch):
    lines = ['{"id":"a","version":"2.7","diagnoses":[{"code":"c"},null],"documents":[]}',
             '{"id":"b","diagnoses":[{"code":"d"},"bad"],"documents":"zz","demographics":{"identifiers":[{"id":"x"},7]}}',
             '{"id":"c","dischargeInfo":"text","payors":["x",{"companyName":"y"}]}']
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    docs = read_documents(spark, frame)
    assert rows(docs, "id", MISFITS) == [("a", ["diagnoses[]"]), ("b", ["documents", "demographics.identifiers[]", "diagnoses[]"]),
                                         ("c", ["dischargeInfo", "payors[]"])]
    assert [[d and d.code for d in r.diagnoses or []] for r in docs.orderBy("id").collect()] == [["c", None], ["d", None], []]
    assert {r.id: r[CORRUPT] is None for r in docs.collect()} == {"a": True, "b": False, "c": True}
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(diagnoses,ArrayType(StructType" in plan      # read in its own types first


def test_report_and_items_read_the_documents_once(spark, write_lines, tmp_path):
    from docshred.operators.quality import quality_report, row_count_checks
    staged = stage_documents(read_documents(spark, write_lines([HAPPY])), str(tmp_path / "q"))
    for df in (quality_report(staged, None, clinical_specs()), row_count_checks(staged, None, clinical_specs()),
               occurring_items(staged, clinical_specs(), DICTS)):
        assert _plan(df).count("FileScan parquet") == 1
