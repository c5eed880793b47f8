"""Every query of the package runs over the smallest tables and gives the columns that are asked for."""

import pytest

from ledgerloom.llm import queries

COLUMNS = {
    "p2_found": ["item_id", "label"],
    "p3_found": ["tab", "row_id", "line_no", "kind"],
    "p4_found": ["tab", "row_id"],
    "p7_found": ["query_id", "concept_id"],
    "p8_ids": ["doc_id", "ids"],
    "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    rows = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(rows) == len({str(r) for r in rows})
    if name == "p2_found":
        assert len(rows) == spark.read.parquet(f"{data}/token_consensus.parquet").select("item_id").distinct().count()
    if name == "p7_found":
        assert len(rows) == spark.read.parquet(f"{data}/resolutions.parquet").count()
    if name in ("p8_ids", "p10_scores"):
        assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()


def test_consistent_texts_of_both_tables(spark, data):
    """Every row of both tables has its text, and those that p4_found lists are the ones that differ."""
    texts = {(r.tab, r.row_id): r.consistent_text for r in queries.p4_texts(spark, data).collect()}
    given = {(t, r[0]): r[1] for t, k, c in queries.ENCODED for r in spark.read.parquet(f"{data}/{t}.parquet").select(k, c).collect()}
    assert {t for t, _ in given} == {"cells", "token_consensus"} and texts.keys() == given.keys()
    assert {k for k in texts if texts[k] != given[k]} == {tuple(r) for r in queries.p4_found(spark, data).collect()}
