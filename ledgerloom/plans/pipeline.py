"""Whole paths: pages to consensus (OP-C1), documents to checked facts (OP-C13, OP-N0), facts to a report (OP-K10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import parse_value
from ledgerloom.operators import annotate, cascade, resolve, validate, vote
from ledgerloom.operators.observe import VoteOptions
from ledgerloom.sources import filings

PAGE = ["doc_id", "page_no"]


def vote_pages(cells: DataFrame, options: VoteOptions, width: float = 1000.0) -> dict[str, DataFrame]:
    """Consensus cells, diagnostics, summary per document and ledger records of pages of cells.

    ``cells`` of observers that aren't enabled take no part. Lazy observers' cells join in where the
    others disagree, and on their sampled share of pages. In token mode clusters aren't formed, so lazy
    observers don't fire.
    """
    enabled = [o for o in options.observers if o.enabled]
    eager = [o.name for o in enabled if not o.lazy]
    lazy = [o.name for o in enabled if o.lazy]
    seen = cells.where(F.col("voter").isin(*eager))
    parts, tokens = [], None
    if options.mode in ("bbox", "both"):
        if lazy:
            diagnostics = cascade.lazy_vote(seen, cells.where(F.col("voter").isin(*lazy)), options.min_voters, max((o.sample_rate for o in enabled if o.lazy), default=0.0), width, options.column_drop_veto)
        else:
            diagnostics = vote.bbox_vote(seen, width, options.min_voters, veto=options.column_drop_veto)
        parts.append(diagnostics.where("committed").select(*PAGE, F.col("cluster_no").alias("cell_idx"), F.col("consensus_text").alias("text"), "confidence"))
    else:
        diagnostics = vote.bbox_vote(seen.limit(0), width, options.min_voters, veto=False)
    if options.mode in ("token", "both"):
        t = vote.voter_tokens(seen)
        tokens = vote.token_vote(t.select(*PAGE, "voter", F.explode("numbers").alias("token")), t.select(*PAGE, "voter"), min_voters=options.min_voters)
        parts.append(vote.consensus_cells(vote.sample_cells(tokens, seen)).select(*PAGE, "cell_idx", "text", "confidence"))
    consensus = cascade.both_modes(*parts) if len(parts) == 2 else parts[0].withColumn("source", F.lit(options.mode))
    summary = cascade.document_summary(diagnostics, options.min_voters)
    if tokens is not None:
        summary = summary.join(cascade.token_summary(tokens), "doc_id", "full_outer")
    return {"consensus": consensus, "diagnostics": diagnostics, "summary": summary, "ledger": filings.ledger_records(seen, consensus, diagnostics)}


def check_facts(facts: DataFrame, concepts: DataFrame, members: DataFrame | None = None, arcs: DataFrame | None = None, keys: tuple[str, ...] = ("doc_id", "period_end"), tolerance: float = 1.0) -> dict[str, DataFrame]:
    """Passing and failing facts by all rules that have their tables.

    ``facts``: fact_id, doc_id, ord, concept_id, value_text, period_start, period_end, dimensions.
    """
    known = facts.join(concepts.select("concept_id", "period_type"), "concept_id", "left").withColumn("value", parse_value(F.col("value_text")))
    found = [validate.period_rule(known)]
    if members is not None:
        found.append(validate.dimension_rule(known.where(F.col("dimensions").isNotNull()), members))
    if arcs is not None:
        found.append(validate.arc_rule(known, arcs, list(keys), tolerance))
    passing, failing = validate.split(known, found)
    return {"passing": passing, "failing": failing}


def report(checked: dict[str, DataFrame]) -> DataFrame:
    """One row: passing and failing facts, and whether all conform."""
    a = checked["passing"].agg(F.count("*").alias("n_passing"))
    b = checked["failing"].agg(F.count("*").alias("n_failing"))
    return a.crossJoin(b).withColumn("conforms", F.col("n_failing") == 0)  # one row each


def convert(table_cells: DataFrame, labels: DataFrame, concepts: DataFrame, period_end: Column, lang: str | None = None, members: DataFrame | None = None, arcs: DataFrame | None = None, use_fuzzy: bool = True) -> dict[str, DataFrame]:
    """Tables of documents to facts, annotations, key-value cells and the checks.

    ``table_cells``: doc_id, table_idx, row_idx, col_idx, text, page_no, bbox.
    """
    keys = ["doc_id", "table_idx"]
    first = table_cells.where("col_idx = 0").select(F.col("text").alias("label")).where("label IS NOT NULL").distinct().withColumn("lang_pref", F.lit(lang).cast("string"))
    resolved = resolve.resolve(first, labels, "label", "lang_pref", use_fuzzy)
    found = annotate.enrich(table_cells, resolved, keys, period_end)
    place = table_cells.where("col_idx = 0").groupBy(*keys, "row_idx").agg(F.min_by(F.struct(F.coalesce("page_no", F.lit(1)).alias("page_no"), "bbox"), "text").alias("p"))
    facts = found.join(place, [*keys, "row_idx"], "left").select(
        F.concat_ws(":", "doc_id", "table_idx", "row_idx", "col_no").alias("fact_id"),
        "doc_id",
        F.col("doc_id").alias("source"),
        F.struct("table_idx", "row_idx", "col_no").alias("ord"),
        "concept_id",
        "value_text",
        F.col("p.page_no").alias("page_no"),
        F.col("p.bbox").alias("bbox"),
        F.lit(None).cast("string").alias("period_start"),
        "period_end",
        F.lit(None).cast("map<string,string>").alias("dimensions"),
        F.lit(None).cast("array<string>").alias("voters_hit"),
        F.lit(None).cast("int").alias("voters_total"),
        F.lit(None).cast("array<string>").alias("dropped"),
    )
    return {"facts": facts, "annotations": annotate.annotations(facts, concepts), "key_values": annotate.key_values(facts, "doc_id", "ord"), "counts": annotate.label_counts(table_cells.where("col_idx = 0"), "text", resolved), **check_facts(facts, concepts, members, arcs)}
