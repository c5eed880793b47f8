"""Queries that put single operators of the reference to whole tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import geometry, text
from ledgerloom.functions.text import NN_TO_NB
from ledgerloom.operators import annotate, cascade, resolve, schemagen, validate, vote
from ledgerloom.plans import catalogue as c
from ledgerloom.session import _checkpoint_folder
from ledgerloom.sources import filings
from ledgerloom.sources.tables import table

PAGE = ["doc_id", "page_no"]


# clusters and lines ----------------------------------------------------

# cells of a page one after the other: the first cluster with a member that overlaps enough, else a new one
_CLUSTERS = """
RECURSIVE o AS (SELECT doc_id, page_no, voter, text, cell_id, bbox.l AS l, bbox.t AS t, bbox.r AS r, bbox.b AS b, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY voter_ord, cell_idx, voter, text, confidence) AS i
  FROM {cells} WHERE bbox.l IS NOT NULL AND bbox.t IS NOT NULL AND bbox.r IS NOT NULL AND bbox.b IS NOT NULL),
f AS (
  SELECT doc_id, page_no, 0::BIGINT AS i, []::STRUCT(k BIGINT, id BIGINT, v VARCHAR, l DOUBLE, t DOUBLE, r DOUBLE, b DOUBLE)[] AS m, 0::BIGINT AS n FROM o GROUP BY ALL
  UNION ALL
  SELECT doc_id, page_no, i, CASE WHEN hit IS NULL THEN list_append(m, {{'k': n, 'id': cell_id, 'v': voter, 'l': l, 't': t, 'r': r, 'b': b}})
      WHEN len(list_filter(m, lambda x: x.k = hit AND x.v = voter)) > 0 THEN m ELSE list_append(m, {{'k': hit, 'id': cell_id, 'v': voter, 'l': l, 't': t, 'r': r, 'b': b}}) END, CASE WHEN hit IS NULL THEN n + 1 ELSE n END
  FROM (SELECT f.m, f.n, o.*, list_min(list_transform(list_filter(f.m, lambda x: least(x.r, o.r) > greatest(x.l, o.l) AND least(x.b, o.b) > greatest(x.t, o.t)
      AND (least(x.r, o.r) - greatest(x.l, o.l)) * (least(x.b, o.b) - greatest(x.t, o.t)) >= 0.3 * (greatest(1.0, (o.r - o.l) * (o.b - o.t)) + greatest(1.0, (x.r - x.l) * (x.b - x.t)) - (least(x.r, o.r) - greatest(x.l, o.l)) * (least(x.b, o.b) - greatest(x.t, o.t)))), lambda x: x.k)) AS hit
    FROM f JOIN o ON o.doc_id = f.doc_id AND o.page_no = f.page_no AND o.i = f.i + 1)),
z AS (SELECT doc_id, page_no, unnest(m, recursive := true) FROM f QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY i DESC) = 1)
"""


def cluster_greedy(spark, d):
    out = vote.clusters(c._cells(spark, d))
    return out.select(*PAGE, F.col("cluster_no").cast("long").alias("cluster_no"), F.size("members").alias("n_members"), F.array_join(F.transform("members", lambda m: m["voter"]), ",").alias("voters"))


_GREEDY = f"WITH {_CLUSTERS.format(cells='cells')} SELECT doc_id, page_no, k AS cluster_no, count(*)::INT AS n_members, string_agg(v, ',' ORDER BY voter_ord, cell_idx) AS voters FROM z JOIN cells ON cell_id = id AND cells.doc_id = z.doc_id GROUP BY z.doc_id, z.page_no, k".replace("SELECT doc_id, page_no, k AS", "SELECT z.doc_id, z.page_no, k AS")


def box_vote(spark, d):
    """The whole vote by boxes, texts compared without compatibility forms, which SQL lacks."""
    out = vote.bbox_vote(c._cells(spark, d), min_voters=c.MIN_VOTERS, compatibility=False)
    side = lambda k: F.col(f"bbox.{k}").alias(k)
    return out.select(
        *PAGE, F.col("cluster_no").cast("long").alias("cluster_no"), "consensus_text", F.array_join("voters_hit", ",").alias("voters_hit"), F.array_join("voters_attempted", ",").alias("voters_attempted"), F.size("alternatives").alias("n_alternatives"), "committed",
        F.round("confidence", 9).alias("confidence"), F.array_join("column_dropped_voters", ",").alias("dropped"), *map(side, "ltrb"),
    )


_BOX_VOTE = f"""
WITH {_CLUSTERS.format(cells="(SELECT * FROM cells WHERE NOT EXISTS (SELECT 1 FROM drop_ d WHERE d.doc_id = cells.doc_id AND d.page_no = cells.page_no AND d.voter = cells.voter))").replace("RECURSIVE o AS", "RECURSIVE drop_ AS (" + c._DROP.strip() + "), o AS")},
n AS ({c._NORM.replace("text", "coalesce(text, '')")}),
e AS (SELECT z.*, n.norm FROM z JOIN n ON n.cell_id = z.id),
v AS (SELECT doc_id, page_no, k, norm, count(*) AS n, string_agg(v, ',' ORDER BY v) AS voters, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM e GROUP BY ALL),
a AS (SELECT doc_id, page_no, k, string_agg(v, ',' ORDER BY v) AS voters_attempted, count(*) AS tried, (count(DISTINCT norm) - 1)::INT AS n_alternatives FROM e GROUP BY ALL),
w AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, k ORDER BY n DESC, norm) = 1),
g AS (SELECT doc_id, page_no, string_agg(voter, ',' ORDER BY voter) AS dropped FROM drop_ GROUP BY ALL)
SELECT doc_id, page_no, k AS cluster_no, norm AS consensus_text, voters AS voters_hit, voters_attempted, n_alternatives, n >= {c.MIN_VOTERS} AS committed, round(n / tried, 9) AS confidence, coalesce(dropped, '') AS dropped, l, t, r, b
FROM w JOIN a USING (doc_id, page_no, k) LEFT JOIN g USING (doc_id, page_no)"""


def line_join(spark, d):
    return vote.joined_lines(c._cells(spark, d)).select(*PAGE, "voter", "text")


_LINE_JOIN = """
WITH RECURSIVE o AS (SELECT doc_id, page_no, voter, text AS tx, cell_idx, (bbox.t + bbox.b) / 2 AS y, (bbox.l + bbox.r) / 2 AS x, greatest(1.0, bbox.b - bbox.t) AS h,
    row_number() OVER (PARTITION BY doc_id, page_no, voter ORDER BY (bbox.t + bbox.b) / 2 NULLS FIRST, cell_idx, (bbox.l + bbox.r) / 2 NULLS FIRST, greatest(1.0, bbox.b - bbox.t) NULLS FIRST, text) AS i
  FROM cells WHERE bbox IS NOT NULL AND text IS NOT NULL),
f AS (
  SELECT o.*, y AS sy, h AS sh, 1 AS n, 0 AS line FROM o WHERE i = 1
  UNION ALL
  SELECT o.*, CASE WHEN fits THEN sy + o.y ELSE o.y END, CASE WHEN fits THEN sh + o.h ELSE o.h END, CASE WHEN fits THEN n + 1 ELSE 1 END, CASE WHEN fits THEN line ELSE line + 1 END
  FROM (SELECT f.sy, f.sh, f.n, f.line, coalesce(abs(p.y - f.sy / f.n) <= 0.5 * least(p.h, f.sh / f.n), false) AS fits, p.doc_id, p.page_no, p.voter, p.i FROM f JOIN o p ON p.doc_id = f.doc_id AND p.page_no = f.page_no AND p.voter = f.voter AND p.i = f.i + 1) q
    JOIN o ON o.doc_id = q.doc_id AND o.page_no = q.page_no AND o.voter = q.voter AND o.i = q.i),
l AS (SELECT doc_id, page_no, voter, line, string_agg(tx, ' ' ORDER BY x NULLS FIRST, cell_idx, tx) AS s FROM f GROUP BY ALL),
t AS (SELECT doc_id, page_no, voter, string_agg(s, chr(10) ORDER BY line) AS text FROM l GROUP BY ALL)
SELECT DISTINCT cells.doc_id, cells.page_no, cells.voter, coalesce(t.text, '') AS text FROM cells LEFT JOIN t ON t.doc_id = cells.doc_id AND t.page_no = cells.page_no AND t.voter = cells.voter"""


# tokens ----------------------------------------------------------------


def _won(spark, d):
    return vote.token_vote(c._cell_numbers(spark, d), c._cells(spark, d), min_voters=c.MIN_VOTERS)


def token_counts(spark, d):
    return vote.vote_counts(_won(spark, d))


def token_documents(spark, d):
    return cascade.token_summary(_won(spark, d))


def token_cells(spark, d):
    out = vote.consensus_cells(vote.sample_cells(_won(spark, d), c._cells(spark, d)))
    return out.select(*PAGE, "cell_idx", "text", F.round("confidence", 9).alias("confidence"), *[F.col(f"bbox.{k}").alias(k) for k in "ltrb"])


_TOKEN_CELLS = c._TOKEN_SAMPLE[: c._TOKEN_SAMPLE.rindex("SELECT doc_id")].replace("SELECT e.*, c.text,", "SELECT e.*, c.text, c.bbox,") + """, s AS (SELECT doc_id, page_no, token, text, bbox FROM f QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, token ORDER BY conf DESC, voter) = 1)
SELECT doc_id, page_no, (row_number() OVER (PARTITION BY doc_id, page_no ORDER BY token) - 1)::INT AS cell_idx, coalesce(s.text, CASE WHEN token < 0 THEN '-' ELSE '' END || replace(format('{:,}', abs(token)), ',', ' ')) AS text, round(n_hit / n_attempted, 9) AS confidence,
  CASE WHEN s.bbox IS NULL THEN 0.0 ELSE s.bbox.l END AS l, CASE WHEN s.bbox IS NULL THEN 0.0 ELSE s.bbox.t END AS t, CASE WHEN s.bbox IS NULL THEN 0.0 ELSE s.bbox.r END AS r, CASE WHEN s.bbox IS NULL THEN 0.0 ELSE s.bbox.b END AS b
FROM h JOIN a USING (doc_id, page_no) LEFT JOIN s USING (doc_id, page_no, token)"""


# labels ----------------------------------------------------------------


def label_forms(spark, d):
    return table(spark, d, "concept_labels").select("subject_id", "lang", "role", text.label_form(F.col("text")).alias("form"))


def _form_sql(x: str) -> str:
    out = rf"trim(regexp_replace(lower({x}), '{c.WS}+', ' ', 'g'))"
    steps = [f"SELECT * REPLACE (CASE WHEN contains(form, '{nn}') AND NOT contains(form, '{NN_TO_NB[nn]}') THEN replace(form, '{nn}', '{NN_TO_NB[nn]}') ELSE form END AS form) FROM " for nn in sorted(NN_TO_NB, key=lambda k: (-len(k), k))]
    return "".join(s + "(" for s in reversed(steps)) + f"SELECT *, {out} AS form FROM @" + ")" * len(steps)


_FORMS = f"SELECT subject_id, lang, role, form FROM ({_form_sql('text').replace('@', 'concept_labels')})"


def text_labels(spark, d):
    return annotate.text_labels(table(spark, d, "cells").select("cell_id", "text"), "text").select("cell_id")


_TEXT_LABELS = f"SELECT cell_id FROM cells WHERE trim(text) <> '' AND length(text) <= 80 AND cell_id NOT IN ({c._LOOKS})"


def label_counts(spark, d):
    """Cells that may be labels, and those of them that stand in the vocabulary word for word."""
    known = table(spark, d, "concept_labels").groupBy(F.col("text").alias("label")).agg(F.min("subject_id").alias("concept_id"))
    return annotate.label_counts(table(spark, d, "cells").select("text"), "text", known)


_LABEL_COUNTS = f"SELECT count(*) AS n_labels_seen, count(*) FILTER (text IN (SELECT text FROM concept_labels)) AS n_labels_resolved FROM cells WHERE cell_id IN ({_TEXT_LABELS})"


def one_concept(spark, d):
    known = table(spark, d, "concepts")
    return resolve.concept(known, known.agg(F.min("concept_id")).first()[0]).select("concept_id", "data_type", "status")


def axis_members(spark, d):
    m = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return resolve.axis_members(m.select(F.col("r_name").alias("axis_id"), F.col("n_name").alias("member_id"), F.col("n_nationkey").alias("order")), "ASIA")


def subject_labels(spark, d):
    labels = table(spark, d, "concept_labels")
    return resolve.of_subject(labels, labels.agg(F.max("subject_id")).first()[0]).select("subject_id", "lang", "role", "text")


def _arcs(spark, d):
    """The concepts of a data type as children of the first of them; debit counts against."""
    known = table(spark, d, "concepts").where("data_type IS NOT NULL")
    first = known.groupBy("data_type").agg(F.min("concept_id").alias("parent_id"))
    rows = known.join(first, "data_type").where(F.col("concept_id") != F.col("parent_id"))
    return rows.select(F.col("data_type").alias("role"), "parent_id", F.col("concept_id").alias("child_id"), F.when(F.col("balance") == "debit", -1.0).otherwise(1.0).alias("weight"), F.length("concept_id").alias("order"))


_ARCS = "a AS (SELECT data_type AS role, parent_id, concept_id AS child_id, CASE WHEN balance = 'debit' THEN -1.0 ELSE 1.0 END AS weight, length(concept_id) AS ord FROM concepts JOIN (SELECT data_type, min(concept_id) AS parent_id FROM concepts GROUP BY 1) USING (data_type) WHERE concept_id <> parent_id)"


def concept_cards(spark, d):
    """Cards of all concepts and of one that is unknown, read back from their JSON."""
    known = table(spark, d, "concepts")
    asked = known.select("concept_id").unionByName(spark.createDataFrame([("x:Unknown",)], "concept_id string"))
    cards = resolve.concept_cards(known, table(spark, d, "concept_labels"), _arcs(spark, d), asked=asked)
    shape = "concept_id string, data_type string, error string, labels array<struct<lang:string,role:string,text:string>>, calc_arcs array<struct<role:string,order:int,child:string,weight:double>>"
    j = F.from_json("card", shape)
    joined = lambda a, f: F.coalesce(F.array_join(F.array_sort(F.transform(j[a], lambda x: x[f])), "|"), F.lit(""))
    return cards.select("concept_id", j["data_type"].alias("data_type"), j["error"].isNotNull().alias("unknown"), joined("labels", "text").alias("labels"), joined("calc_arcs", "child").alias("children"), F.coalesce(F.aggregate(j["calc_arcs"], F.lit(0.0), lambda t, x: t + x["weight"]), F.lit(0.0)).alias("weights"))


_CARDS = f"""WITH {_ARCS}, l AS (SELECT subject_id, string_agg(text, '|' ORDER BY text) AS labels FROM concept_labels GROUP BY 1), k AS (SELECT parent_id, string_agg(child_id, '|' ORDER BY child_id) AS children, sum(weight)::DOUBLE AS weights FROM a GROUP BY 1)
SELECT concept_id, data_type, false AS unknown, coalesce(labels, '') AS labels, coalesce(children, '') AS children, coalesce(weights, 0.0) AS weights FROM concepts LEFT JOIN l ON subject_id = concept_id LEFT JOIN k ON parent_id = concept_id
UNION ALL SELECT 'x:Unknown', NULL, true, '', '', 0.0"""


def arc_fields(spark, d):
    """The fields of the schema generated for every parent of arcs."""
    rows = _arcs(spark, d).select("parent_id", "child_id", "weight", "order").collect()  # a vocabulary, a few hundred rows
    out = []
    for parent in sorted({r.parent_id for r in rows}):
        schema = schemagen.arc_schema([(r.child_id, r.weight, r.order) for r in rows if r.parent_id == parent], parent)
        out += [(parent, f.metadata["concept_id"], f.name, f.metadata.get("weight")) for f in schema.fields]
    return spark.createDataFrame(out, "parent_id string, concept_id string, field string, weight double")


_ARC_FIELDS = f"""WITH {_ARCS}, s AS ({c._SNAKE}), n AS (SELECT a.*, field, row_number() OVER (PARTITION BY parent_id, field ORDER BY ord, child_id) AS i FROM a JOIN s ON s.concept_id = child_id)
SELECT parent_id, child_id AS concept_id, CASE WHEN i > 1 THEN field || '_' || ord ELSE field END AS field, weight::DOUBLE AS weight FROM n UNION ALL SELECT DISTINCT parent_id, parent_id, 'sum_total', NULL::DOUBLE FROM a"""


# rules -----------------------------------------------------------------


def vocabulary_faults(spark, d):
    """A vocabulary made faulty on purpose breaks every rule of it."""
    n = F.length("concept_id")
    known = table(spark, d, "concepts").withColumn("period_type", F.when(n % 7 == 0, F.lit("forever")).otherwise(F.col("period_type"))).withColumn("status", F.when(n % 11 == 0, F.lit(None)).otherwise(F.col("status"))).withColumn("data_type", F.when(n % 13 == 0, F.lit(None)).otherwise(F.col("data_type")))
    known = known.withColumn("balance", F.when(n % 5 == 0, F.lit("both")).otherwise(F.col("balance"))).withColumn("scheme", F.when(n % 3 != 0, F.lit("s")))
    labels = table(spark, d, "concept_labels").where(F.length("subject_id") % 17 != 0).withColumn("role", F.when(F.length("subject_id") % 4 == 0, F.lit("standardLabel")).otherwise(F.col("role")))
    arcs = _arcs(spark, d).withColumn("weight", F.when(F.length("child_id") % 6 == 0, F.lit(0.5)).when(F.length("child_id") % 6 == 1, F.lit(None)).otherwise(F.col("weight")))
    return validate.vocabulary_failures(known, labels, arcs).groupBy("subject_id", "rule").agg(F.count("*").alias("n"))


_FAULTS = f"""
WITH {_ARCS}, k AS (SELECT concept_id, CASE WHEN length(concept_id) % 7 = 0 THEN 'forever' ELSE period_type END AS period_type, CASE WHEN length(concept_id) % 11 = 0 THEN NULL ELSE status END AS status, CASE WHEN length(concept_id) % 13 = 0 THEN NULL ELSE data_type END AS data_type, CASE WHEN length(concept_id) % 5 = 0 THEN 'both' ELSE balance END AS balance FROM concepts),
s AS (SELECT subject_id, lang, count(*) AS n FROM concept_labels WHERE length(subject_id) % 17 <> 0 AND (role = 'standardLabel' OR length(subject_id) % 4 = 0) GROUP BY ALL),
u AS (SELECT concept_id AS subject_id, 'label missing' AS rule FROM k WHERE concept_id NOT IN (SELECT subject_id FROM s)
UNION ALL SELECT subject_id, 'several labels in ' || lang FROM s WHERE n > 1
UNION ALL SELECT concept_id, 'data type missing' FROM k WHERE data_type IS NULL
UNION ALL SELECT concept_id, 'scheme missing' FROM k WHERE length(concept_id) % 3 = 0
UNION ALL SELECT concept_id, 'period_type not allowed' FROM k WHERE coalesce(period_type NOT IN ('instant', 'duration'), true)
UNION ALL SELECT concept_id, 'status not allowed' FROM k WHERE coalesce(status NOT IN ('candidate', 'standard', 'deprecated', 'retired'), true)
UNION ALL SELECT concept_id, 'balance not allowed' FROM k WHERE balance NOT IN ('debit', 'credit')
UNION ALL SELECT parent_id, 'weight not allowed' FROM a WHERE length(child_id) % 6 < 2)
SELECT subject_id, rule, count(*) AS n FROM u GROUP BY ALL"""


def body_parts(spark, d):
    """Bodies of facts with their parts in either order, some without one."""
    t = table(spark, d, "ixbrl_facts")
    none = F.lit(None).cast("string")
    tag = F.struct(F.lit("tagging").alias("purpose"), none.alias("source"), F.col("value_text").alias("value"))
    kind = F.struct(F.lit("classifying").alias("purpose"), F.col("concept_id").alias("source"), none.alias("value"))
    body = F.when(F.col("fact_id") % 3 == 0, F.array(tag, kind)).when(F.col("fact_id") % 3 == 1, F.array(kind, tag)).otherwise(F.array(kind))
    concept, value = validate.body_parts("body")
    return t.select("fact_id", body.alias("body")).select("fact_id", concept.alias("concept_id"), value.alias("value_text"))


def first_provenance(spark, d):
    """The place of a cell, with the defaults where it has none."""
    prov = F.when(F.col("cell_id") % 4 > 0, F.array(F.struct("page_no", "bbox")))
    p = annotate.provenance(F.col("prov"))
    return table(spark, d, "cells").select("cell_id", prov.alias("prov")).select("cell_id", p["page_no"].alias("page_no"), *[p["bbox"][k].alias(k) for k in "ltrb"])


# exchange and files ----------------------------------------------------


def xbrl_prefixes(spark, d):
    return c._exchanged(spark, d).groupBy("prefix", "element").agg(F.count("*").alias("n"))


def xbrl_document_parts(spark, d):
    """What stands in every exchange document: facts by element, contexts and units."""
    docs = c.xbrl_documents(spark, d)
    count = lambda tag: F.regexp_count("document", F.lit(f"<{tag}[ >]"))
    return docs.select("entity", count("ix:nonFraction").alias("numbers"), count("ix:nonNumeric").alias("texts"), count("xbrli:context").alias("contexts"), count("xbrli:unit").alias("units"), F.regexp_count("document", F.lit('sign="-"')).alias("negative"))


_PARTS = rf"""WITH {c._XBRL}, z AS (SELECT coalesce(orgnr || '/' || f.period_end, 'fact/' || fact_id) AS entity, context_id, 'unit_' || lower(y.unit) AS unit_id, y.value_num < 0 AS negative,
  CASE WHEN y.value_num IS NULL AND NOT coalesce(regexp_matches(y.value_text, '^\s*-?\d+(\.\d+)?\s*$'), false) THEN 'nonNumeric' ELSE 'nonFraction' END AS element FROM y JOIN ixbrl_facts f USING (fact_id))
SELECT entity, count(*) FILTER (element = 'nonFraction')::INT AS numbers, count(*) FILTER (element = 'nonNumeric')::INT AS texts, count(DISTINCT context_id)::INT AS contexts, count(DISTINCT unit_id)::INT AS units, count(*) FILTER (negative)::INT AS negative FROM z GROUP BY ALL"""


def _folder(spark, name: str) -> str:
    import uuid

    return f"{_checkpoint_folder(spark.sparkContext)}/{name}-{uuid.uuid4().hex}"


def written_diff(spark, d):
    """Diff entries written with the fixed schema and read back."""
    filings.write_diff(c.diff_entries(spark, d), to := _folder(spark, "diff"))
    return spark.read.parquet(to)


def written_lines(spark, d):
    """Truth records written as JSON lines, their number, and what reading them back gives."""
    t = table(spark, d, "brreg_filings").where("orgnr IS NOT NULL").select(F.to_json(F.struct("orgnr", "journalnr", "key_metrics")).alias("j"))
    n = filings.write_lines(t, "j", to := _folder(spark, "lines"))
    back = filings.truth_of_json(spark.read.text(to), "value")
    return back.groupBy("orgnr").agg(F.count("*").alias("records"), F.count("journalnr").alias("with_journal")).withColumn("written", F.lit(n).cast("long"))


def truth_files(spark, d):
    """One truth file per organisation, that of its last record, read from the folder."""
    t = table(spark, d, "brreg_filings").where("orgnr IS NOT NULL")
    last = t.groupBy("orgnr").agg(F.max_by(F.struct("orgnr", "journalnr", "period_from", "valuta"), "rec_id").alias("r"))
    to = _folder(spark, "truth")
    last.select(F.to_json("r").alias("value")).repartition(8).write.text(to)
    records = filings.truth_of_json(spark.read.text(to), "value")
    return records.select("orgnr", "journalnr", "period_from", "valuta", F.cardinality("key_metrics").alias("n_metrics"))


QUERIES = {
    "cluster_greedy": cluster_greedy,
    "box_vote": box_vote,
    "line_join": line_join,
    "token_counts": token_counts,
    "token_documents": token_documents,
    "token_cells": token_cells,
    "label_forms": label_forms,
    "text_labels": text_labels,
    "label_counts": label_counts,
    "one_concept": one_concept,
    "axis_members": axis_members,
    "subject_labels": subject_labels,
    "concept_cards": concept_cards,
    "arc_fields": arc_fields,
    "vocabulary_faults": vocabulary_faults,
    "body_parts": body_parts,
    "first_provenance": first_provenance,
    "xbrl_prefixes": xbrl_prefixes,
    "xbrl_document_parts": xbrl_document_parts,
    "written_diff": written_diff,
    "written_lines": written_lines,
    "truth_files": truth_files,
}

SQL = {
    "cluster_greedy": _GREEDY,
    "box_vote": _BOX_VOTE,
    "line_join": _LINE_JOIN,
    "token_counts": f"WITH {c._TOKENS} SELECT doc_id, page_no, count(*) AS n_committed, count(*) FILTER (n_hit = n_attempted) AS n_unanimous FROM h JOIN a USING (doc_id, page_no) GROUP BY ALL",
    "token_documents": f"WITH {c._TOKENS} SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (n_hit = n_attempted) AS n_unanimous_tokens FROM h JOIN a USING (doc_id, page_no) GROUP BY ALL",
    "token_cells": _TOKEN_CELLS,
    "label_forms": _FORMS,
    "text_labels": _TEXT_LABELS,
    "label_counts": _LABEL_COUNTS,
    "one_concept": "SELECT concept_id, data_type, status FROM concepts WHERE concept_id = (SELECT min(concept_id) FROM concepts)",
    "axis_members": "SELECT r_name AS axis_id, n_name AS member_id, n_nationkey AS \"order\" FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'",
    "subject_labels": "SELECT subject_id, lang, role, text FROM concept_labels WHERE subject_id = (SELECT max(subject_id) FROM concept_labels)",
    "concept_cards": _CARDS,
    "arc_fields": _ARC_FIELDS,
    "vocabulary_faults": _FAULTS,
    "body_parts": "SELECT fact_id, concept_id, CASE WHEN fact_id % 3 < 2 THEN value_text END AS value_text FROM ixbrl_facts",
    "first_provenance": "SELECT cell_id, CASE WHEN cell_id % 4 > 0 THEN page_no ELSE 1 END AS page_no, " + ", ".join(f"CASE WHEN cell_id % 4 > 0 THEN coalesce(bbox.{k}, 0.0) ELSE 0.0 END AS {k}" for k in "ltrb") + " FROM cells",
    "xbrl_prefixes": c._XBRL_FACTS[: c._XBRL_FACTS.index("SELECT fact_id, context_id")] + r"SELECT split_part(f.concept_id, ':', 1) AS prefix, CASE WHEN y.value_num IS NULL AND NOT coalesce(regexp_matches(y.value_text, '^\s*-?\d+(\.\d+)?\s*$'), false) THEN 'nonNumeric' ELSE 'nonFraction' END AS element, count(*) AS n FROM y JOIN ixbrl_facts f USING (fact_id) GROUP BY ALL",
    "xbrl_document_parts": _PARTS,
    "written_diff": f"{c._DIFF} SELECT * FROM e",
    "written_lines": "SELECT orgnr, count(*) AS records, count(journalnr) AS with_journal, (SELECT count(*) FROM brreg_filings WHERE orgnr IS NOT NULL) AS written FROM brreg_filings WHERE orgnr IS NOT NULL GROUP BY ALL",
    "truth_files": "SELECT orgnr, journalnr, period_from, valuta, 0 AS n_metrics FROM brreg_filings WHERE orgnr IS NOT NULL QUALIFY row_number() OVER (PARTITION BY orgnr ORDER BY rec_id DESC) = 1",
}
