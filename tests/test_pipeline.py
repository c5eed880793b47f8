from pyspark.sql import functions as F

from ledgerloom.operators.observe import Observer, VoteOptions
from ledgerloom.plans import pipeline

CELL = "doc_id string, page_no int, voter string, voter_ord int, cell_idx int, text string, confidence double, bbox struct<l:double,t:double,r:double,b:double>, from_ocr boolean"
TABLE = "doc_id string, table_idx int, row_idx int, col_idx int, text string, page_no int, bbox struct<l:double,t:double,r:double,b:double>"


def test_pages_in_all_modes(spark):
    box = (0.0, 0.0, 40.0, 10.0)
    rows = [("d", 1, v, i, 0, "12 345", 0.9, box, True) for i, v in enumerate(("doctr", "easyocr", "paddleocr"))] + [("d", 1, "pix2struct", 3, 0, "99", 0.9, box, True)]
    cells = spark.createDataFrame(rows, CELL)
    seen = tuple(Observer(n) for n in ("doctr", "easyocr", "paddleocr"))
    n = {}
    for mode in ("bbox", "token", "both"):
        out = pipeline.vote_pages(cells, VoteOptions(seen, 3, True, mode))
        n[mode] = [(r.text, r.confidence) for r in out["consensus"].collect()]
        assert out["ledger"].count() == 1 and out["summary"].count() == 1
    assert n == {"bbox": [("12 345", 1.0)], "token": [("12 345", 1.0)], "both": [("12 345", 1.0)] * 2}
    lazy = pipeline.vote_pages(cells, VoteOptions((*seen, Observer("pix2struct", lazy=True)), 4, False))
    assert [r.n_attempted for r in lazy["diagnostics"].collect()] == [4]


def test_document_with_a_wrong_total(spark):
    rows = []
    for d, total in (("good", "300"), ("bad", "500")):
        for i, (label, v) in enumerate((("Eiendeler", total), ("Anleggsmidler", "100"), ("Omløpsmidler", "200"), ("Ukjent tekst", "7"))):
            rows += [(d, 0, i, 0, label, 1, (0.0, 0.0, 5.0, 5.0)), (d, 0, i, 1, v, 1, None)]
    labels = spark.createDataFrame([(f"x:{t}", "concept", "nb", "standardLabel", t) for t in ("Eiendeler", "Anleggsmidler", "Omløpsmidler")], "subject_id string, subject_kind string, lang string, role string, text string")
    concepts = labels.select(F.col("subject_id").alias("concept_id"), F.lit("instant").alias("period_type"), F.lit("debit").alias("balance"))
    arcs = spark.createDataFrame([("x:Eiendeler", "x:Anleggsmidler", 1.0), ("x:Eiendeler", "x:Omløpsmidler", 1.0)], "parent_id string, child_id string, weight double")
    out = pipeline.convert(spark.createDataFrame(rows, TABLE), labels, concepts, F.lit("2024-12-31"), arcs=arcs)
    assert out["facts"].count() == 6 and tuple(out["counts"].first()) == (8, 6)
    assert [(r.doc_id, r.concept_id, [f.rule for f in r.failures]) for r in out["failing"].collect()] == [("bad", "x:Eiendeler", ["arc"])]
    assert tuple(pipeline.report(out).first()) == (5, 1, False)
    assert out["annotations"].count() == 6 and out["key_values"].count() == 6
