"""Queries of the text problems (2, 3, 4, 7, 8, 9 and 10)."""

from __future__ import annotations

import hashlib
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import abuse, bpe, consensus, match, normal, packing, scan
from ledgerloom.session import spread
from ledgerloom.sources.tables import table

CONTAINER_TOKENS = 2048
#: Limits of containers for training: loss-bearing tokens, and segments.
MOST_LOSS, MOST_SEGMENTS = 1920, 16
MOST_LABELS = 200_000


def _reference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "concept_labels").where(F.col("subject_kind") == "concept").select("subject_id", "text")


def _labels(spark: SparkSession, d: str) -> list[str]:
    """The texts of the reference list, a fixed table of a few hundred rows; more than `MOST_LABELS` are an error, as they go to the driver."""
    rows = _reference(spark, d).select("text").distinct().limit(MOST_LABELS + 1).collect()
    if len(rows) > MOST_LABELS:
        raise ValueError(f"the reference list has more than {MOST_LABELS} texts")
    return sorted(r.text for r in rows if r.text)


def _known_words(spark: SparkSession, d: str) -> frozenset[str]:
    """The words of the reference list."""
    return frozenset(w for t in _labels(spark, d) for w in re.findall(r"[^\W\d_]+", t.lower()))


def _readings(spark: SparkSession, d: str):
    df = table(spark, d, "token_consensus").select(
        "item_id", "kind", F.coalesce(F.col("value").cast("string"), F.col("token")).alias("label"), "voters_hit", "voters_attempted", "column_dropped_voters"
    )
    return df, *consensus.fit(df, "item_id", "kind", "label", "voters_hit", "column_dropped_voters", attempted="voters_attempted")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_consensus(spark, d).select("item_id", "label")


def p2_consensus(spark: SparkSession, d: str) -> DataFrame:
    _, items, model = _readings(spark, d)
    return consensus.consensus(items, model).withColumnRenamed("item", "item_id")


def p2_voters(spark: SparkSession, d: str) -> DataFrame:
    df, _, model = _readings(spark, d)
    return consensus.reliability(df, model)


#: The tables with noise of scanned pages: table, key, text, whether a text is a page.
SCANNED = [("voter_tokens", "vt_id", "full_text", True), ("token_consensus", "tc_id", "sample_text", False)]


def _scanned(spark: SparkSession, d: str):
    parts = [(name, spread(table(spark, d, name).select(F.col(key).alias("row_id"), F.col(text).alias("text"))), pages) for name, key, text, pages in SCANNED]
    words = {w: scan.LEAST_COUNT for w in _known_words(spark, d)}
    return parts, scan.learn([(df, "text", pages) for _, df, pages in parts], spark, words)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    parts, known = _scanned(spark, d)
    found = [scan.damaged_lines(df, "row_id", "text", known, pages).select(F.lit(name).alias("tab"), "row_id", "line_no", "kind") for name, df, pages in parts]
    return found[0].unionByName(found[1])


def p3_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    parts, known = _scanned(spark, d)
    texts = [scan.repaired(df, "row_id", "text", known, pages).select(F.lit(name).alias("tab"), "row_id", "paragraphs") for name, df, pages in parts]
    return texts[0].unionByName(texts[1])


#: The tables with texts in mixed encoding: table, key, text.
ENCODED = [("cells", "cell_id", "text"), ("token_consensus", "tc_id", "sample_text")]


def _encoded(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, name).select(F.lit(name).alias("tab"), F.col(key).alias("row_id"), F.col(text).alias("text")) for name, key, text in ENCODED]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    known = _known_words(spark, d)
    parts = [normal.changed_rows(df, "text", known).select("tab", "row_id") for df in _encoded(spark, d)]
    return parts[0].unionByName(parts[1])


def p4_texts(spark: SparkSession, d: str) -> DataFrame:
    known = _known_words(spark, d)
    parts = [normal.with_consistent(df, "text", known).select("tab", "row_id", "consistent_text") for df in _encoded(spark, d)]
    return parts[0].unionByName(parts[1])


def _prefer(concept: str) -> tuple[bool, str]:
    return concept.endswith("Funksjon"), concept


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    return match.map_values(table(spark, d, "resolutions").select("query_id", "query"), "query", _reference(spark, d), "subject_id", "text", _prefer)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).select("query_id", F.coalesce("match_id", F.lit("none")).alias("concept_id"))


def p7_methods(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).groupBy("method").agg(F.count("*").alias("n"), F.round(F.avg("similarity"), 6).alias("mean_similarity"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(_documents(spark, d), "doc_id", "text")


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    return bpe.count_tokens(_documents(spark, d), "doc_id", "text")


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d)  # counted before they are encoded, else they would be encoded twice
    return packing.pack(bpe.count_tokens(docs, "doc_id", "text"), "doc_id", "n_tokens", CONTAINER_TOKENS, rows=docs.count())


def p9_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(p9_containers(spark, d), CONTAINER_TOKENS)


def p9_training(spark: SparkSession, d: str) -> DataFrame:
    """Containers for training on what writers say themselves: at most `MOST_LOSS` tokens outside of quoted lines and `MOST_SEGMENTS` segments."""
    docs = _documents(spark, d)
    return packing.pack(bpe.count_loss(docs, "doc_id", "text"), "doc_id", "n_tokens", CONTAINER_TOKENS, MOST_SEGMENTS, "n_loss", MOST_LOSS, rows=docs.count())


def p9_training_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(p9_training(spark, d), CONTAINER_TOKENS, MOST_LOSS)


def _classifier(spark: SparkSession, d: str) -> abuse.Net:
    """The classifier for these documents, trained once a session.

    Where ``spark.ledgerloom.models`` names a folder, the model is kept there and later sessions read it.
    """
    sc = spark.sparkContext
    kept = sc.__dict__.setdefault("_ledgerloom_models", {})
    if d not in kept:
        folder = sc.getConf().get("spark.ledgerloom.models")
        path = folder and os.path.join(folder.removeprefix("file://"), f"abuse-{hashlib.sha256(repr((d, abuse.EXAMPLES, abuse.frames())).encode()).hexdigest()[:16]}.npz")
        if path and os.path.exists(path):
            kept[d] = abuse.Net.load(path)
        else:
            kept[d] = abuse.fit(_documents(spark, d), "text", harmless=_labels(spark, d))
            if path:
                kept[d].save(path)
    return kept[d]


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.score_documents(_documents(spark, d), "doc_id", "text", _classifier(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).where("flagged").select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d)


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    scored = _scores(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return scored.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("flagged").cast("long")).alias("flagged"), F.round(F.avg(F.col("flagged").cast("double")), 6).alias("rate"))


QUERIES = {
    "p2_found": p2_found,
    "p2_consensus": p2_consensus,
    "p2_voters": p2_voters,
    "p3_found": p3_found,
    "p3_paragraphs": p3_paragraphs,
    "p4_found": p4_found,
    "p4_texts": p4_texts,
    "p7_found": p7_found,
    "p7_methods": p7_methods,
    "p8_ids": p8_ids,
    "p8_counts": p8_counts,
    "p9_containers": p9_containers,
    "p9_usage": p9_usage,
    "p9_training": p9_training,
    "p9_training_usage": p9_training_usage,
    "p10_found": p10_found,
    "p10_scores": p10_scores,
    "p10_rates": p10_rates,
}

SQL: dict[str, str] = {}
