import json
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import annotate
from ledgerloom.sources import filings, vocabulary

CONCEPTS = [("x:A", "instant", "debit", "monetaryItemType"), ("x:R", "duration", "credit", "percentItemType")]


def concepts(spark):
    return spark.createDataFrame(CONCEPTS, "concept_id string, period_type string, balance string, data_type string")


def facts(spark):
    return spark.createDataFrame(
        [(1, "e1", "x:A", -5.7, None, "2024-12-31", None, None, None), (2, "e1", "x:R", 3.0, None, "2024-12-31", -3, None, None), (3, "e1", "x:Q", None, "a < b", "2023-12-31", 0, None, "instant"), (4, "e1", "x:A", None, "-12", "2024-12-31", 0, "EUR", None)],
        "fact_id int, e string, concept_id string, value_num double, value_text string, period_end string, decimals int, unit string, period_type string",
    )


def test_exchange_facts_and_document(spark):
    f = facts(spark)
    x = annotate.exchange_facts(f.drop("e"), concepts(spark), F.lit("2024-01-01"))
    got = {r.fact_id: (r.context_id, r.unit_id, r.element, r.shown, r.sign, r.decimals) for r in x.collect()}
    assert got[1] == ("ctx_instant_20241231", "unit_nok", "nonFraction", "5", "-", 0)
    assert got[2] == ("ctx_duration_20240101_20241231", "unit_pure", "nonFraction", "3", "", -3)
    assert got[3] == ("ctx_instant_20231231", "unit_nok", "nonNumeric", "a < b", "", 0)
    assert got[4] == ("ctx_instant_20241231", "unit_eur", "nonFraction", "-12", "", 0)
    assert annotate.contexts(x).count() == 3
    d = annotate.exchange_documents(x.join(f.select("fact_id", "e"), "fact_id"), "e", "s.xsd").first()
    root = ET.fromstring(d.document.encode())
    ns = {"ix": annotate.NAMESPACES["ix"], "x": annotate.NAMESPACES["xbrli"]}
    assert d.entity == "e1" and len(root.findall(".//ix:nonFraction", ns)) == 3 and len(root.findall(".//x:context", ns)) == 3 and len(root.findall(".//x:unit", ns)) == 3
    assert root.find(".//ix:nonNumeric", ns).text == "a < b"
    ids = {c.get("id") for c in root.findall(".//x:context", ns)}
    assert {e.get("contextRef") for e in root.iter() if e.get("contextRef")} <= ids


def test_concept_without_prefix(spark):
    f = facts(spark).withColumn("concept_id", F.lit("A")).drop("e")
    with pytest.raises(Exception, match="without prefix"):
        annotate.exchange_facts(f, concepts(spark), F.lit("2024-01-01")).collect()


def annotated(spark):
    f = spark.createDataFrame(
        [(1, "s.pdf", 2, (1.5, 2.0, 3.0, 4.0), "x:A", "300", ["a", "b"], 2, None, None, "2024-12-31", {"ax": "m"}), (2, "s.pdf", 1, None, "x:Z", "", None, 7, None, None, None, None)],
        "fact_id int, source string, page_no int, bbox struct<l:double,t:double,r:double,b:double>, concept_id string, value_text string, voters_hit array<string>, voters_total int, dropped array<string>, period_start string, period_end string, dimensions map<string,string>",
    )
    return annotate.annotations(f, concepts(spark))


def test_annotation_json(spark, tmp_path):
    lines = annotate.annotation_json(annotated(spark))
    a = {r.fact_id: json.loads(r.json) for r in lines.collect()}
    assert a[1]["registrum:cascadeConfidence"]["text"] == "unanimous" and a[1]["registrum:periodType"] == "instant" and a[1]["registrum:dimensions"] == {"ax": "m"}
    assert [s["type"] for s in a[1]["target"]["selector"]] == ["FragmentSelector", "SvgSelector", "TextQuoteSelector"]
    assert "<rect x='1.5' y='2' width='1.5' height='2'/>" in a[1]["target"]["selector"][1]["value"]
    assert "registrum:cascadeConfidence" not in a[2] and "registrum:balance" not in a[2] and [s["type"] for s in a[2]["target"]["selector"]] == ["FragmentSelector"]
    page = annotate.annotation_pages(annotated(spark).withColumn("k", F.lit("one")), "k").first()
    c = json.loads(page.json)
    assert c["total"] == 2 and [x["target"]["source"] for x in c["first"]["items"]] == ["s.pdf"] * 2
    assert filings.write_lines(lines, "json", str(tmp_path / "l")) == 2 and spark.read.text(str(tmp_path / "l")).count() == 2


def test_key_values(spark):
    f = spark.createDataFrame([("d", 5, "x:A", "1"), ("d", 2, "x:B", None)], "doc string, n int, concept_id string, value_text string")
    assert [(r.key_cell, r.key_text, r.value_cell, r.value_text) for r in annotate.key_values(f, "doc", "n").orderBy("key_cell").collect()] == [(0, "x:B", 1, ""), (2, "x:A", 3, "1")]


def test_provenance(spark):
    df = spark.createDataFrame([([(3, (1.0, 2.0, 3.0, 4.0))],), ([],)], "p array<struct<page_no:int,bbox:struct<l:double,t:double,r:double,b:double>>>")
    assert [(r.x.page_no, tuple(r.x.bbox)) for r in df.select(annotate.provenance(F.col("p")).alias("x")).collect()] == [(3, (1.0, 2.0, 3.0, 4.0)), (1, (0.0, 0.0, 0.0, 0.0))]


def test_truth_files(spark, tmp_path):
    for name, body in (("a", {"orgnr": "1", "key_metrics": {"x": 1.0}}), ("b", {"orgnr": "1", "key_metrics": {"x": 2.0}}), ("c", {"orgnr": "2"})):
        (tmp_path / f"{name}.json").write_text(json.dumps(body, indent=1))
    assert {r.orgnr: r.key_metrics for r in filings.read_truth(spark, str(tmp_path)).collect()} == {"1": {"x": 2.0}, "2": {}}
    with pytest.raises(Exception, match="without orgnr"):
        filings.truth_of_json(spark.createDataFrame([("{}",)], "j string"), "j").collect()


def test_diff_files(spark, tmp_path):
    df = spark.createDataFrame([], filings.DIFF)
    assert filings.write_diff(df, str(tmp_path / "e")) == 0 and len(spark.read.parquet(str(tmp_path / "e")).columns) == 8
    one = spark.createDataFrame([("1", "c", "p", "disagree", 0.0, 1.0, 1.0, float("inf"))], filings.DIFF)
    assert filings.write_diff(one, str(tmp_path / "o")) == 1 and spark.read.parquet(str(tmp_path / "o")).first().rel_delta == float("inf")


def test_ledger(spark, tmp_path):
    cells = spark.createDataFrame([("d", 1, "v", 0, "æ", 0.5, (0.0, 0.0, 1.0, 1.0), True)], "doc_id string, page_no int, voter string, cell_idx int, text string, confidence double, bbox struct<l:double,t:double,r:double,b:double>, from_ocr boolean")
    agreed = spark.createDataFrame([("d", 1, 0, "æ", 1.0)], "doc_id string, page_no int, cell_idx int, text string, confidence double")
    judged = spark.createDataFrame([("d", 1, "cluster:0", "æ", ["v"], ["v"])], "doc_id string, page_no int, cluster_id string, consensus_text string, voters_hit array<string>, voters_attempted array<string>")
    records = filings.ledger_records(cells, agreed, judged)
    filings.write_ledger(records, None)
    for _ in range(2):
        filings.write_ledger(records, str(tmp_path / "l"))
    back = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "l")).collect()]
    assert len(back) == 2 and back[0]["per_voter"]["v"][0]["text"] == "æ" and back[0]["diagnostics"]["cluster:0"]["voters_hit"] == ["v"] and back[0]["_meta"]["document_id"] == "d"


TURTLE = """@prefix x: <https://example.org/x#> .
PREFIX skos: <http://www.w3.org/2004/02/skos/core#>
# a comment
x:A a skos:Concept ; skos:prefLabel "Assets"@en, "Eiendeler"@nb ; x:abstract false ; x:periodType "instant" ; x:status "standard" ; x:dataType "monetaryItemType" ; skos:exactMatch ifrs:Assets .
x:B a skos:Concept ; skos:broader x:A ; skos:prefLabel "B \\"quoted\\""@nb ; x:periodType "instant" ; x:balance "debit" ; x:status "standard" ; x:dataType "t" .
x:Ax a skos:Concept, x:Axis ; skos:prefLabel "Akse"@nb .
x:M a skos:Concept, x:Member ; x:memberOf x:Ax ; skos:prefLabel "Ledd"@nb .
x:S sh:property [ sh:path x:p ; sh:in ( "a" "b" ) ] .
"""


def test_turtle(spark):
    t = vocabulary.turtle_tables(spark, TURTLE)
    assert sorted(r.concept_id for r in t["concepts"].collect()) == ["x:A", "x:B"]
    assert [(r.axis_id, r.member_id) for r in t["members"].collect()] == [("x:Ax", "x:M")] and t["axes"].count() == 1
    assert sorted((r.subject_kind, r.text) for r in t["labels"].collect()) == [("axis", "Akse"), ("concept", "Assets"), ("concept", 'B "quoted"'), ("concept", "Eiendeler"), ("member", "Ledd")]
    assert [(r.parent_id, r.child_id, r.weight_assumed) for r in t["arcs"].collect()] == [("x:A", "x:B", True)]
    assert [(r.subject_id, r.relation) for r in t["mappings"].collect()] == [("x:A", "exactMatch")]


def test_schema_elements(spark, tmp_path):
    p = tmp_path / "s.xsd"
    p.write_text('<xs:schema xmlns:xs="x" xmlns:xbrli="y"><xs:element name="A" type="t" xbrli:periodType="instant" xbrli:balance="debit"/><xs:element name="B" type="u" xbrli:periodType="duration"/></xs:schema>')
    assert sorted(tuple(r) for r in vocabulary.schema_elements(spark, str(p)).collect()) == [("A", "t", "instant", "debit"), ("B", "u", "duration", None)]
