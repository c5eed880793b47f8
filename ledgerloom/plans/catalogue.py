"""Queries of the reference operators over the tables of a data folder, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import geometry, text
from ledgerloom.functions.keys import concept_key, iso_day, org_number
from ledgerloom.operators import annotate, cascade, drift, observe, resolve, schemagen, score, validate, vote
from ledgerloom.plans.problems import _P6
from ledgerloom.session import checkpoint
from ledgerloom.sources import filings
from ledgerloom.sources.tables import table

PAGE = ["doc_id", "page_no"]
WS = r"[\p{Z}\t\n\x0B\f\r\x{85}]"  # what Java's Unicode \s is, for SQL
WS_OUT = WS.replace("\\", "\\\\")  # the same within a replacement
GROUPS = [["tesseract", "tesseract_tsv", "ocrmypdf", "docling_default"]]
MIN_VOTERS = 3


# facts -----------------------------------------------------------------


def _side(spark: SparkSession, d: str, source: str) -> DataFrame:
    facts = table(spark, d, "facts").where(F.col("source") == source)
    keyed = facts.select("ord", org_number(F.col("orgnr")).alias("orgnr"), concept_key(F.col("concept_id")).alias("concept_id"), iso_day(F.col("period_end")).alias("period_end"), "value")
    return keyed.where(F.col("orgnr").isNotNull() & F.col("concept_id").isNotNull() & F.col("period_end").isNotNull())


def _filing():
    """An organisation's filing of a period; unlike an organisation it doesn't grow with the data. A fact without either is on its own."""
    return F.coalesce(F.concat("orgnr", F.lit("/"), "period_end"), F.concat(F.lit("fact/"), F.col("fact_id").cast("string")))


def diff_entries(spark, d):
    return drift.diff_entries(_side(spark, d, "v1"), _side(spark, d, "v2"), "last", "last").withColumn("rel_delta", F.round("rel_delta", 6))


def drift_by_concept(spark, d):
    return drift.drift(diff_entries(spark, d), "concept_id").withColumn("agreement_rate", F.round("agreement_rate", 6))


def drift_by_org(spark, d):
    return drift.drift(diff_entries(spark, d), "orgnr").withColumn("agreement_rate", F.round("agreement_rate", 6))


def _dedup(policy):
    def run(spark, d):
        return drift.one_per_key(_side(spark, d, "v1"), policy)

    return run


_FACTS = _P6[: _P6.index("l AS (")].rstrip().rstrip(",").replace("WITH k AS", "k AS").strip()
_DIFF = f"""
WITH {_FACTS},
l AS (SELECT source, orgnr, concept_id, period_end, value FROM k QUALIFY row_number() OVER (PARTITION BY source, orgnr, concept_id, period_end ORDER BY ord DESC) = 1),
a AS (SELECT orgnr, concept_id, period_end, value AS v1_value, 1 AS in1 FROM l WHERE source = 'v1'),
b AS (SELECT orgnr, concept_id, period_end, value AS v2_value, 1 AS in2 FROM l WHERE source = 'v2'),
j AS (SELECT orgnr, concept_id, period_end, v1_value, v2_value, in1, in2, round_even(v1_value, 0) AS x, round_even(v2_value, 0) AS y FROM a FULL JOIN b USING (orgnr, concept_id, period_end)),
c AS (SELECT *, CASE WHEN in2 IS NULL THEN 'v1_only' WHEN in1 IS NULL THEN 'v2_only' WHEN x IS NOT DISTINCT FROM y THEN 'agree' ELSE 'disagree' END AS kind FROM j),
e AS (SELECT orgnr, concept_id, period_end, kind, v1_value, v2_value,
  CASE WHEN in1 = 1 AND in2 = 1 THEN CASE WHEN kind = 'agree' THEN 0.0 ELSE abs(y - x) END END AS abs_delta,
  round(CASE WHEN in1 = 1 AND in2 = 1 THEN CASE WHEN kind = 'agree' THEN 0.0 WHEN x = 0 THEN CASE WHEN y IS NOT NULL THEN 'inf'::DOUBLE END ELSE abs(y - x) / abs(x) END END, 6) AS rel_delta FROM c)
"""


def _drift_sql(by):
    kinds = ", ".join(f"count(*) FILTER (kind = '{k}') AS {k}" for k in drift.KINDS)
    return f"{_DIFF} SELECT {by}, {kinds}, round(count(*) FILTER (kind = 'agree') / nullif(count(*) FILTER (kind IN ('agree', 'disagree')), 0), 6) AS agreement_rate FROM e GROUP BY {by}"


def _dedup_sql(order):
    return f"WITH {_FACTS} SELECT orgnr, concept_id, period_end, ord, value FROM k WHERE source = 'v1' QUALIFY row_number() OVER (PARTITION BY orgnr, concept_id, period_end ORDER BY ord {order}) = 1"


# rules -----------------------------------------------------------------


def _order_facts(spark, d):
    """An order's lines by return flag as children A, N, R, and their weighted sum as parent, wrong by 100 for urgent orders."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_returnflag").alias("concept_id")).agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))
    parent = lines.groupBy("l_orderkey").agg(F.sum(F.col("value") * F.when(F.col("concept_id") == "R", -1.0).otherwise(1.0)).alias("value")).join(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    parent = parent.select("l_orderkey", F.lit("TOTAL").alias("concept_id"), (F.col("value") + F.when(F.col("o_orderpriority").startswith("1"), 100.0).otherwise(0.0)).alias("value"))
    return parent.unionByName(lines).select("l_orderkey", "concept_id", "value", F.lit(1).alias("ord"), F.concat_ws(":", F.col("l_orderkey").cast("string"), "concept_id").alias("fact_id"))


def arc_check(spark, d):
    arcs = spark.createDataFrame([("TOTAL", "A", 1.0), ("TOTAL", "N", 1.0), ("TOTAL", "R", -1.0)], "parent_id string, child_id string, weight double")
    return validate.arc_rule(_order_facts(spark, d), arcs, ["l_orderkey"]).select("fact_id", F.round("expected", 2).alias("expected"), F.round("actual", 2).alias("actual"), F.round("diff", 2).alias("diff"))


_ARC = """
WITH l AS (SELECT l_orderkey, l_returnflag, round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY ALL),
s AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN -value ELSE value END) AS expected, count(DISTINCT l_returnflag) AS n FROM l GROUP BY ALL),
p AS (SELECT s.*, expected + CASE WHEN o_orderpriority LIKE '1%' THEN 100 ELSE 0 END AS actual FROM s JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey::VARCHAR || ':TOTAL' AS fact_id, round(expected, 2) AS expected, round(actual, 2) AS actual, round(actual - expected, 2) AS diff FROM p WHERE n = 3 AND abs(actual - expected) > 1"""


def _periods(spark, d):
    return table(spark, d, "ixbrl_facts").select("fact_id", "period_type", "period_end", F.when(F.col("decimals").isNotNull(), F.concat(F.substring("period_end", 1, 4), F.lit("-01-01"))).alias("period_start"))


def period_failures(spark, d):
    return validate.period_rule(_periods(spark, d))


_PERIOD = """
WITH f AS (SELECT fact_id, period_type, period_end, CASE WHEN decimals IS NOT NULL THEN substr(period_end, 1, 4) || '-01-01' END AS period_start FROM ixbrl_facts)
SELECT fact_id, 'period' AS rule, 'instant concept without period end' AS message FROM f WHERE period_type = 'instant' AND coalesce(period_end, '') = ''
UNION ALL SELECT fact_id, 'period', 'duration concept without period end' FROM f WHERE period_type = 'duration' AND coalesce(period_end, '') = ''
UNION ALL SELECT fact_id, 'period', 'duration concept without period start' FROM f WHERE period_type = 'duration' AND coalesce(period_start, '') = ''"""


def _members(spark, d):
    return table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("axis_id"), F.col("n_name").alias("member_id"))


def _dimensions(spark, d):
    """Each customer's nation as the member, under the region of the customer's segment's length."""
    c = table(spark, d, "customer").join(table(spark, d, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    axes = table(spark, d, "region").select((F.col("r_regionkey") + 7).alias("size"), "r_name")
    c = c.join(axes, F.length("c_mktsegment") == F.col("size"), "left")
    return c.select(F.col("c_custkey").alias("fact_id"), F.create_map(F.coalesce("r_name", F.lit("NOWHERE")), F.col("n_name")).alias("dimensions"))


def dimension_failures(spark, d):
    return validate.dimension_rule(_dimensions(spark, d), _members(spark, d))


_DIMENSION = """
WITH m AS (SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT c_custkey, n_name, coalesce(r_name, 'NOWHERE') AS axis FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON length(c_mktsegment) = r_regionkey + 7)
SELECT c_custkey AS fact_id, 'dimension' AS rule, CASE WHEN axis NOT IN (SELECT r_name FROM m) THEN 'unknown axis: ' || axis ELSE 'member ' || n_name || ' not in axis ' || axis END AS message
FROM c WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.r_name = c.axis AND m.n_name = c.n_name)"""


def validate_split(spark, d):
    facts = _periods(spark, d)
    good, bad = validate.split(facts, [validate.period_rule(facts)])
    rows = good.select("period_type", F.lit(True).alias("passes"), F.lit(0).alias("n")).unionByName(bad.select("period_type", F.lit(False).alias("passes"), F.size("failures").alias("n")))
    return rows.groupBy("period_type", "passes").agg(F.count("*").alias("facts"), F.sum("n").alias("failures"))


_SPLIT = f"""
WITH p AS ({_PERIOD}), n AS (SELECT fact_id, count(*) AS n FROM p GROUP BY 1)
SELECT period_type, n.n IS NULL AS passes, count(*) AS facts, coalesce(sum(n.n), 0)::BIGINT AS failures FROM ixbrl_facts LEFT JOIN n USING (fact_id) GROUP BY ALL"""


def vocabulary_check(spark, d):
    return validate.vocabulary_failures(table(spark, d, "concepts"), table(spark, d, "concept_labels"))


_VOCABULARY = """
WITH s AS (SELECT subject_id, lang, count(*) AS n FROM concept_labels WHERE role = 'standardLabel' GROUP BY ALL)
SELECT concept_id AS subject_id, 'label missing' AS rule FROM concepts WHERE concept_id NOT IN (SELECT subject_id FROM s)
UNION ALL SELECT subject_id, 'several labels in ' || lang FROM s WHERE n > 1
UNION ALL SELECT concept_id, 'data type missing' FROM concepts WHERE data_type IS NULL
UNION ALL SELECT concept_id, 'period_type not allowed' FROM concepts WHERE coalesce(period_type NOT IN ('instant', 'duration'), true)
UNION ALL SELECT concept_id, 'status not allowed' FROM concepts WHERE coalesce(status NOT IN ('candidate', 'standard', 'deprecated', 'retired'), true)
UNION ALL SELECT concept_id, 'balance not allowed' FROM concepts WHERE balance NOT IN ('debit', 'credit')"""


# text ------------------------------------------------------------------


def parse_value(spark, d):
    return table(spark, d, "cells").select("cell_id", text.parse_value(F.col("text")).alias("number")).where(F.col("number").isNotNull())


_PARSE = rf"""
WITH a AS (SELECT cell_id, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS t FROM cells),
b AS (SELECT cell_id, t LIKE '(%)' AS neg, CASE WHEN t LIKE '(%)' THEN substr(t, 2, length(t) - 2) ELSE t END AS t FROM a),
c AS (SELECT cell_id, neg, regexp_replace(translate(replace(replace(t, ' ', ''), chr(160), ''), '‐‑‒–—−', '------'), '^{WS}+|{WS}+$', '', 'g') AS t FROM b),
e AS (SELECT cell_id, neg, CASE WHEN contains(t, '.') THEN t ELSE replace(t, ',', '.') END AS t FROM c)
SELECT cell_id, CASE WHEN neg THEN -t::DOUBLE ELSE t::DOUBLE END AS number FROM e WHERE regexp_matches(t, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')"""


def looks_numeric(spark, d):
    return table(spark, d, "cells").where(text.looks_numeric(F.col("text"))).select("cell_id")


_LOOKS = rf"SELECT cell_id FROM cells WHERE regexp_matches(trim(text), '^-?\(?[\p{{Nd}}\p{{Z}}\t\n\x0B\f\r\x{{85}}.,]+\)?$')"


def norm_text(spark, d):
    return table(spark, d, "cells").select("cell_id", text.normalise_text(F.col("text"), False).alias("norm"))


_NORM = rf"""
WITH a AS (SELECT cell_id, trim(regexp_replace(translate(text, '‐‑‒–—−', '------'), '{WS}+', ' ', 'g')) AS t FROM cells)
SELECT cell_id, CASE WHEN regexp_matches(t, '^\({WS}*[\p{{Nd}}\p{{Z}}\t\n\x0B\f\r\x{{85}}.,]+{WS}*\)$') THEN '-' || regexp_extract(t, '^\({WS}*([\p{{Nd}}\p{{Z}}\t\n\x0B\f\r\x{{85}}.,]+){WS}*\)$', 1) ELSE t END AS norm FROM a"""


def norm_nfkc(spark, d):
    return table(spark, d, "cells").select("cell_id", text.normalise_text(F.col("text")).alias("norm"))


def label_forms(spark, d):
    return table(spark, d, "concept_labels").select("subject_id", "lang", "role", text.nynorsk_to_bokmal(F.lower("text")).alias("form"))


def numeric_tokens(spark, d):
    return table(spark, d, "voter_tokens").select("vt_id", F.explode(text.numeric_tokens(F.col("full_text"))).alias("n"))


def production_tokens(spark, d):
    return table(spark, d, "voter_tokens").select("vt_id", F.explode(text.coarse_numbers(F.col("full_text"))).alias("n"))


# digit runs over blanks are joined by taking runs whole and cleaning them, which needs no look-around
_PRODUCTION = rf"""
WITH a AS (SELECT vt_id, unnest(regexp_extract_all(translate(full_text, '−–', '--'), '-?[0-9]+(?:[\p{{Z}}\t\n\x0B\f\r\x{{85}}]+[0-9]+)*')) AS r FROM voter_tokens)
SELECT DISTINCT vt_id, try_cast(regexp_replace(r, '{WS}', '', 'g') AS BIGINT) AS n FROM a WHERE abs(try_cast(regexp_replace(r, '{WS}', '', 'g') AS BIGINT)) >= 100"""


def word_tokens(spark, d):
    return table(spark, d, "voter_tokens").select("vt_id", F.explode(text.word_tokens(F.col("full_text"), 2, False)).alias("word"))


_WORDS = "SELECT DISTINCT vt_id, lower(w) AS word FROM (SELECT vt_id, unnest(regexp_extract_all(full_text, '[A-Za-zÀ-ſ]+')) AS w FROM voter_tokens) WHERE length(w) >= 2"


def grouped_number(spark, d):
    return table(spark, d, "token_consensus").where("value IS NOT NULL").select("tc_id", text.grouped(F.col("value")).alias("grouped"))


_GROUPED = "SELECT tc_id, CASE WHEN value < 0 THEN '-' ELSE '' END || replace(format('{:,}', abs(value)), ',', ' ') AS grouped FROM token_consensus WHERE value IS NOT NULL"


def snake_names(spark, d):
    return table(spark, d, "concepts").select("concept_id", text.snake_name(F.col("concept_id")).alias("field"))


_SNAKE = "SELECT concept_id, lower(regexp_replace(regexp_replace(concept_id, '^[^:]*:', ''), '([^A-Z])([A-Z])', '\\1_\\2', 'g')) AS field FROM concepts"


def engine_languages(spark, d):
    per = table(spark, d, "voter_tokens").groupBy("doc_id").agg(F.array_sort(F.collect_set("lang")).alias("langs"))
    return per.select("doc_id", text.engine_languages(F.col("langs")).alias("engine_langs"))


_ENGINE = """
WITH l AS (SELECT doc_id, lang, CASE WHEN lang IN ('no', 'nb', 'nn') THEN 'nor' WHEN lang = 'en' THEN 'eng' ELSE lang END AS e FROM voter_tokens),
f AS (SELECT doc_id, e, min(lang) AS first FROM l WHERE e IS NOT NULL GROUP BY ALL)
SELECT doc_id, coalesce(string_agg(e, '+' ORDER BY first), 'nor') AS engine_langs FROM (SELECT DISTINCT doc_id FROM voter_tokens) LEFT JOIN f USING (doc_id) GROUP BY doc_id"""


def split_lines(spark, d):
    pages = table(spark, d, "voter_tokens").select("vt_id", "full_text")
    return observe.split_lines(pages, "full_text").select("vt_id", "pos", "line", "confidence")


_LINES = rf"""
WITH a AS (SELECT vt_id, list_filter(list_transform(string_split(full_text, chr(10)), lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> '') AS ls FROM voter_tokens),
b AS (SELECT vt_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM a)
SELECT vt_id, pos::INT AS pos, line, 0.95::DOUBLE AS confidence FROM b"""


# boxes -----------------------------------------------------------------


def _cells(spark, d):
    return table(spark, d, "cells").select("cell_id", *PAGE, "voter", "voter_ord", "cell_idx", "text", "confidence", "bbox", "from_ocr")


BAND = 8.0


def iou_pairs(spark, d):
    """Overlapping cells of different voters on a page: an equality join on page and band, each cell in the bands it crosses."""
    c = _cells(spark, d).where(F.col("bbox.r").isNotNull() & F.col("bbox.b").isNotNull() & F.col("bbox.t").isNotNull() & F.col("bbox.l").isNotNull())
    first = F.floor(F.col("bbox.t") / BAND)
    banded = c.where(F.col("bbox.b") > F.col("bbox.t")).withColumn("band", F.explode(F.sequence(first, F.floor(F.col("bbox.b") / BAND))))
    a, b = banded.alias("a"), banded.alias("b")
    joined = a.join(b, (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.page_no") == F.col("b.page_no")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.voter_ord") < F.col("b.voter_ord")))
    # the pair is taken in the first band that both cross
    top = F.floor(F.greatest(F.col("a.bbox.t"), F.col("b.bbox.t")) / BAND)
    pairs = joined.where(F.col("a.band") == top).select(F.col("a.cell_id").alias("cell_a"), F.col("b.cell_id").alias("cell_b"), geometry.iou(F.col("a.bbox"), F.col("b.bbox")).alias("iou"))
    return pairs.where("iou >= 0.3").withColumn("iou", F.round("iou", 6))


_IOU = """
WITH c AS (SELECT cell_id, doc_id, page_no, voter_ord, bbox.l AS l, bbox.t AS t, bbox.r AS r, bbox.b AS b FROM cells WHERE bbox.b > bbox.t AND bbox.l IS NOT NULL AND bbox.r IS NOT NULL),
p AS (SELECT x.cell_id AS cell_a, y.cell_id AS cell_b, (least(x.r, y.r) - greatest(x.l, y.l)) * (least(x.b, y.b) - greatest(x.t, y.t)) AS i,
  greatest(1.0, (x.r - x.l) * (x.b - x.t)) AS a, greatest(1.0, (y.r - y.l) * (y.b - y.t)) AS b
  FROM c x JOIN c y ON x.doc_id = y.doc_id AND x.page_no = y.page_no AND x.voter_ord < y.voter_ord AND least(x.r, y.r) > greatest(x.l, y.l) AND least(x.b, y.b) > greatest(x.t, y.t))
SELECT cell_a, cell_b, round(i / (a + b - i), 6) AS iou FROM p WHERE i / (a + b - i) >= 0.3"""


def column_bins(spark, d):
    return vote.column_bins(_cells(spark, d)).withColumn("max_gap", F.round("max_gap", 4))


def column_drop(spark, d):
    return vote.column_drop(_cells(spark, d))


_BINS = """
x AS (SELECT doc_id, page_no, voter, voter_ord, (bbox.l + bbox.r) / 2 AS x FROM cells),
g AS (SELECT *, CASE WHEN x IS NOT NULL THEN x - lag(x) OVER (PARTITION BY doc_id, page_no, voter ORDER BY x NULLS FIRST) END AS gap FROM x),
b AS (SELECT doc_id, page_no, voter, min(voter_ord) AS voter_ord, ((count(x) > 0)::INT + count(*) FILTER (gap > 50))::INT AS bins, coalesce(max(gap), 0.0) AS max_gap, count(*) AS n_cells FROM g GROUP BY ALL)
"""
_DROP = f"""
WITH {_BINS},
u AS (SELECT doc_id, page_no, bins, count(*) AS n, min(voter_ord) AS first, max(n_cells) AS most FROM b GROUP BY ALL),
m AS (SELECT doc_id, page_no, bins AS mode, most FROM u QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY n DESC, first) = 1)
SELECT doc_id, page_no, voter FROM b JOIN m USING (doc_id, page_no) WHERE mode >= 2 AND bins < mode AND (max_gap > 150 OR n_cells < 0.7 * most)"""


def cluster_greedy(spark, d):
    return vote.clusters(_cells(spark, d)).select(*PAGE, "cluster_no", F.size("members").alias("n_members"), F.transform("members", lambda m: m["voter"]).alias("voters"))


def bbox_vote(spark, d):
    return vote.bbox_vote(_cells(spark, d), min_voters=MIN_VOTERS)


def vote_text(spark, d):
    """The vote on texts with the position of a cell within its voter's page as the cluster."""
    members = _cells(spark, d).where("text IS NOT NULL").withColumn("norm", text.normalise_text(F.col("text"), False))
    won = vote.vote_clusters(members, [*PAGE, "cell_idx"])
    return won.select(*PAGE, "cell_idx", "consensus_text", F.array_join("voters_hit", ",").alias("voters_hit"), F.array_join("voters_attempted", ",").alias("voters_attempted"), F.size("alternatives").alias("n_alternatives"))


_VOTE_TEXT = f"""
WITH n AS ({_NORM}), c AS (SELECT doc_id, page_no, cell_idx, voter, norm FROM cells JOIN n USING (cell_id) WHERE text IS NOT NULL),
v AS (SELECT doc_id, page_no, cell_idx, norm, count(*) AS n, string_agg(DISTINCT voter, ',' ORDER BY voter) AS voters FROM c GROUP BY ALL),
a AS (SELECT doc_id, page_no, cell_idx, string_agg(DISTINCT voter, ',' ORDER BY voter) AS voters_attempted FROM c GROUP BY ALL),
k AS (SELECT doc_id, page_no, cell_idx, (count(*) - 1)::INT AS n_alternatives FROM v GROUP BY ALL),
w AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, cell_idx ORDER BY n DESC, norm) = 1)
SELECT doc_id, page_no, cell_idx, norm AS consensus_text, voters AS voters_hit, voters_attempted, n_alternatives FROM w JOIN a USING (doc_id, page_no, cell_idx) JOIN k USING (doc_id, page_no, cell_idx)"""


def _diagnostics(spark, d):
    t = table(spark, d, "token_consensus")
    b = F.col("sample_bbox")
    box = F.when(F.size(b) >= 4, geometry.box(b[0], b[1], b[2], b[3]))
    return t.select("tc_id", *PAGE, "n_hit", "n_attempted", box.alias("bbox"), "voters_hit", "column_dropped_voters")


def disagreement_boxes(spark, d):
    return cascade.disagreement_boxes(_diagnostics(spark, d), MIN_VOTERS, "tc_id").select("tc_id")


_DISAGREE = f"""
SELECT tc_id FROM token_consensus WHERE n_hit < {MIN_VOTERS} AND len(sample_bbox) >= 4 AND sample_bbox[3] > sample_bbox[1] AND sample_bbox[4] > sample_bbox[2]
QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, round_even(sample_bbox[1], 1), round_even(sample_bbox[2], 1), round_even(sample_bbox[3], 1), round_even(sample_bbox[4], 1) ORDER BY tc_id) = 1"""


def document_summary(spark, d):
    return cascade.document_summary(_diagnostics(spark, d), MIN_VOTERS)


_SUMMARY = f"""
WITH s AS (SELECT doc_id, count(*) AS n_clusters, count(*) FILTER (n_hit >= {MIN_VOTERS}) AS n_committed, count(*) FILTER (n_hit = n_attempted) AS n_unanimous FROM token_consensus GROUP BY ALL)
SELECT doc_id, n_clusters, n_committed, n_clusters - n_committed AS n_minority, n_unanimous, round_even(n_committed / n_clusters, 4) AS committed_share, round_even(n_unanimous / n_clusters, 4) AS unanimous_share FROM s"""


def dropped_pages(spark, d):
    return cascade.dropped_pages(_diagnostics(spark, d), "column_dropped_voters")


_DROPPED = "SELECT doc_id, voter, count(DISTINCT page_no) AS n_pages FROM (SELECT doc_id, page_no, unnest(column_dropped_voters) AS voter FROM token_consensus) GROUP BY ALL"


def effective_voters(spark, d):
    t = table(spark, d, "token_consensus").where("voters_attempted IS NOT NULL").select("tc_id", F.transform("voters_attempted", lambda v: F.lower(F.trim(v))).alias("v"))
    return cascade.effective_voters(t, ["tc_id"], "v", GROUPS)


_EFFECTIVE = f"""
WITH v AS (SELECT tc_id, lower(trim(unnest(voters_attempted))) AS v FROM token_consensus)
SELECT tc_id, count(DISTINCT v) AS n_voters, count(DISTINCT CASE WHEN v IN ({", ".join(f"'{x}'" for x in GROUPS[0])}) THEN 'group' ELSE v END) AS n_effective FROM v WHERE v IS NOT NULL GROUP BY ALL"""


def sampled_pages(spark, d):
    return cascade.sampled(table(spark, d, "cells").select(*PAGE).distinct(), "document_ai", 0.1)


_SAMPLED = "SELECT DISTINCT doc_id, page_no FROM cells WHERE ('0x' || substr(md5(concat_ws('|', doc_id, page_no::VARCHAR, 'document_ai')), 1, 8))::BIGINT / 4294967296.0 < 0.1"

LAZY = "pix2struct"


def lazy_vote(spark, d):
    c = _cells(spark, d)
    out = cascade.lazy_vote(c.where(F.col("voter") != LAZY), c.where(F.col("voter") == LAZY), MIN_VOTERS, rate=0.05)
    return out.select(*PAGE, "cluster_no", "consensus_text", "n_hit", "n_attempted", "committed")


# tokens ----------------------------------------------------------------


def _cell_numbers(spark, d):
    """Cells that are one grouped integer, with its value."""
    t = text.plain_minus(F.col("text"))
    value = F.replace(t, F.lit(" "), F.lit("")).try_cast("long")
    return _cells(spark, d).where(t.rlike(r"^-?[0-9]{1,3}( [0-9]{3})*$")).withColumn("token", value)


def token_vote(spark, d):
    won = vote.token_vote(_cell_numbers(spark, d), _cells(spark, d), min_voters=MIN_VOTERS)
    return won.select(*PAGE, "token", F.array_join("voters_hit", ",").alias("voters_hit"), "n_hit", "n_attempted", "unanimous")


_TOKENS = r"""
t AS (SELECT doc_id, page_no, voter, replace(translate(text, '‐‑‒–—−', '------'), ' ', '')::BIGINT AS token FROM cells WHERE regexp_matches(translate(text, '‐‑‒–—−', '------'), '^-?[0-9]{1,3}( [0-9]{3})*$')),
h AS (SELECT doc_id, page_no, token, string_agg(DISTINCT voter, ',' ORDER BY voter) AS voters_hit, count(DISTINCT voter)::INT AS n_hit FROM t GROUP BY ALL HAVING count(DISTINCT voter) >= 3),
a AS (SELECT doc_id, page_no, count(DISTINCT voter)::INT AS n_attempted FROM cells GROUP BY ALL)
"""
_TOKEN_VOTE = f"WITH {_TOKENS} SELECT doc_id, page_no, token, voters_hit, n_hit, n_attempted, n_hit = n_attempted AS unanimous FROM h JOIN a USING (doc_id, page_no)"


def token_sample(spark, d):
    cells = _cells(spark, d)
    won = vote.sample_cells(vote.token_vote(_cell_numbers(spark, d), cells, min_voters=MIN_VOTERS), cells)
    return won.select(*PAGE, "token", F.col("sample.voter").alias("sample_voter"), F.col("sample.text").alias("sample_text"))


_TOKEN_SAMPLE = f"""
WITH {_TOKENS},
e AS (SELECT doc_id, page_no, token, unnest(string_split(voters_hit, ',')) AS voter, CASE WHEN token < 0 THEN '-' ELSE '' END || replace(format('{{:,}}', abs(token)), ',', ' ') AS g FROM h),
f AS (SELECT e.*, c.text, coalesce(c.confidence, 0) AS conf FROM e JOIN cells c USING (doc_id, page_no, voter)
  WHERE contains(translate(c.text, '‐‑‒–—−', '------'), g) OR contains(translate(c.text, '‐‑‒–—−', '------'), token::VARCHAR)
  QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, token, voter ORDER BY c.cell_idx) = 1)
SELECT doc_id, page_no, token, voter AS sample_voter, text AS sample_text FROM f QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, token ORDER BY conf DESC, voter) = 1"""


def token_cells(spark, d):
    cells = _cells(spark, d)
    won = vote.sample_cells(vote.token_vote(_cell_numbers(spark, d), cells, min_voters=MIN_VOTERS), cells)
    return vote.consensus_cells(won)


def line_join(spark, d):
    return vote.joined_lines(_cells(spark, d))


def page_tokens(spark, d):
    return vote.voter_tokens(_cells(spark, d)).select(*PAGE, "voter", F.size("numbers").alias("n_numbers"), F.size("words").alias("n_words"))


def line_vote(spark, d):
    """The vote on numbers from joined lines, so that line and word cells meet."""
    t = vote.voter_tokens(_cells(spark, d))
    return vote.token_vote(t.select(*PAGE, "voter", F.explode("numbers").alias("token")), t.select(*PAGE, "voter"), min_voters=MIN_VOTERS)


def word_vote(spark, d):
    t = table(spark, d, "voter_tokens").select(*PAGE, "voter", text.word_tokens(F.col("full_text"), 2, False).alias("words"))
    won = vote.token_vote(t.select(*PAGE, "voter", F.explode("words").alias("token")), t.select(*PAGE, "voter"), min_voters=2)
    return won.select(*PAGE, "token", F.array_join("voters_hit", ",").alias("voters_hit"), "n_hit", "n_attempted", "unanimous")


_WORD_VOTE = f"""
WITH w AS ({_WORDS}), t AS (SELECT doc_id, page_no, voter, word AS token FROM w JOIN voter_tokens USING (vt_id)),
h AS (SELECT doc_id, page_no, token, string_agg(DISTINCT voter, ',' ORDER BY voter) AS voters_hit, count(DISTINCT voter)::INT AS n_hit FROM t GROUP BY ALL HAVING count(DISTINCT voter) >= 2),
a AS (SELECT doc_id, page_no, count(DISTINCT voter)::INT AS n_attempted FROM voter_tokens GROUP BY ALL)
SELECT doc_id, page_no, token, voters_hit, n_hit, n_attempted, n_hit = n_attempted AS unanimous FROM h JOIN a USING (doc_id, page_no)"""


def vote_both(spark, d):
    cells = _cells(spark, d)
    boxes = vote.bbox_vote(cells, min_voters=MIN_VOTERS).where("committed").select(*PAGE, F.col("cluster_no").alias("cell_idx"), F.col("consensus_text").alias("text"), "confidence")
    return cascade.both_modes(boxes, token_cells(spark, d))


# engines ---------------------------------------------------------------


def line_words(spark, d):
    """Lines of an order as the words of a scanned line, quantity as confidence."""
    w = table(spark, d, "lineitem").select(
        "l_orderkey", "l_returnflag", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("o"), F.col("l_linestatus").alias("text"), F.col("l_quantity").alias("conf"),
        geometry.box(F.col("l_linenumber") * 10.0, F.lit(0.0), F.col("l_linenumber") * 10.0 + F.length("l_linestatus"), F.lit(12.0)).alias("bbox"),
    )
    out = observe.lines_of_words(w, ["l_orderkey", "l_returnflag"], "o", "text", "conf", "bbox")
    return out.select("l_orderkey", "l_returnflag", "text", F.round("confidence", 6).alias("confidence"), F.col("bbox.l").alias("l"), F.col("bbox.r").alias("r"))


_LINE_WORDS = """
SELECT l_orderkey, l_returnflag, string_agg(l_linestatus, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus) AS text, round(avg(l_quantity) / 100, 6) AS confidence, (min(l_linenumber) * 10.0)::DOUBLE AS l, max(l_linenumber * 10.0 + length(l_linestatus))::DOUBLE AS r
FROM lineitem WHERE trim(l_linestatus) <> '' AND l_quantity >= 0 GROUP BY ALL"""


def polygon_boxes(spark, d):
    """The first eight numbers of a vector, scaled, as a polygon of four points."""
    e = F.col("embedding")
    points = F.array(*[F.array(e[2 * i].cast("double") * 1000, e[2 * i + 1].cast("double") * 1000) for i in range(4)])
    b = geometry.polygon_box(points)
    return table(spark, d, "embeddings").select("vec_id", b.alias("b")).select("vec_id", "b.l", "b.t", "b.r", "b.b")


_POLYGON = """
WITH e AS (SELECT vec_id, list_transform(embedding[1:8], lambda x: x::DOUBLE * 1000) AS p FROM embeddings)
SELECT vec_id, trunc(least(p[1], p[3], p[5], p[7])) AS l, trunc(least(p[2], p[4], p[6], p[8])) AS t, trunc(greatest(p[1], p[3], p[5], p[7])) AS r, trunc(greatest(p[2], p[4], p[6], p[8])) AS b FROM e"""


# labels ----------------------------------------------------------------


def exact_resolve(spark, d):
    index = resolve.label_index(table(spark, d, "concept_labels"), False)
    return resolve.exact(_queries(spark, d), index).select("query_id", "concept_id")


def _queries(spark, d):
    return table(spark, d, "resolutions").select("query_id", "query", "lang_pref")


def fuzzy_resolve(spark, d):
    index = resolve.label_index(table(spark, d, "concept_labels"))
    return resolve.fuzzy(_queries(spark, d), index).select("query_id", "concept_id", F.round("score", 4).alias("score"))


def resolve_cascade(spark, d):
    out = resolve.resolve(_queries(spark, d), table(spark, d, "concept_labels"))
    return out.select("query_id", "concept_id", "method", F.round("confidence", 6).alias("confidence"), F.array_join("chain", ">").alias("chain"), F.array_join(F.transform("candidates", lambda c: c["concept_id"]), ",").alias("candidates"))


def resolve_vectors(spark, d):
    """Every tenth vector as a text that no label equals, all others as labels: the last stage decides."""
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    name = lambda p: F.concat(F.lit(p), F.col("vec_id").cast("string"))
    asked, listed = v.where("vec_id % 10 = 0"), v.where("vec_id % 10 <> 0")
    labels = listed.select(name("l").alias("subject_id"), F.lit("concept").alias("subject_kind"), F.lit("nb").alias("lang"), F.lit("standardLabel").alias("role"), name("label ").alias("text"))
    q = asked.select("vec_id", name("q").alias("query"), F.lit("nb").alias("lang_pref"))
    out = resolve.resolve(q, labels, vectors=(asked.select(text.label_form(name("q")).alias("form"), F.col("embedding").alias("vector")), listed.select(name("l").alias("subject_id"), F.col("embedding").alias("vector"))), vector_threshold=0.2)
    return out.select("vec_id", "concept_id", "method", F.round("confidence", 5).alias("confidence"), F.array_join("chain", ">").alias("chain"), F.array_join(F.transform("candidates", lambda c: c["concept_id"]), ",").alias("candidates"))


_VECTORS = """
WITH p AS (SELECT q.vec_id, 'l' || b.vec_id AS id, list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings q, embeddings b WHERE q.vec_id % 10 = 0 AND b.vec_id % 10 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, id) AS n FROM p QUALIFY n <= 5),
a AS (SELECT vec_id, max(c) AS best, min(id) FILTER (n = 1) AS first, string_agg(id, ',' ORDER BY n) FILTER (n > 1) AS rest FROM r GROUP BY 1)
SELECT vec_id, CASE WHEN best >= 0.2 THEN first END AS concept_id, CASE WHEN best >= 0.2 THEN 'embedding' ELSE 'none' END AS method, CASE WHEN best >= 0.2 THEN round(best, 5) END AS confidence,
  'exact>fuzzy>embedding' || CASE WHEN best >= 0.2 THEN '' ELSE '>none' END AS chain, CASE WHEN best >= 0.2 THEN rest ELSE '' END AS candidates FROM a"""


def resolve_json(spark, d):
    return resolve.resolve_envelope(resolve.resolve(_queries(spark, d), table(spark, d, "concept_labels")))


def embedding_resolve(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    out = resolve.nearest(v.where("vec_id % 100 = 0"), v, "vec_id", "embedding", threshold=0.2)
    return out.withColumn("cosine", F.round("cosine", 5))


_EMBEDDING = """
WITH q AS (SELECT vec_id AS query_key, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0),
p AS (SELECT query_key, vec_id, list_cosine_similarity(e, embedding::DOUBLE[]) AS c FROM q JOIN embeddings ON query_key <> vec_id),
r AS (SELECT query_key, vec_id, c, row_number() OVER (PARTITION BY query_key ORDER BY c DESC, vec_id)::INT AS rank FROM p QUALIFY rank <= 5)
SELECT query_key, vec_id, rank, round(c, 5) AS cosine FROM r WHERE query_key IN (SELECT query_key FROM r WHERE rank = 1 AND c >= 0.2)"""


def label_search(spark, d):
    return resolve.search_labels(table(spark, d, "concept_labels"), "Drivhus", whole=False).select("subject_id", "lang", "role", "text")


_SEARCH = "SELECT subject_id, lang, role, text FROM concept_labels WHERE contains(lower(text), 'drivhus')"


def standard_labels(spark, d):
    return resolve.standard_labels(table(spark, d, "concept_labels"), "nb")


_STANDARD = "SELECT subject_id, min(text) AS label FROM concept_labels WHERE lang = 'nb' AND role = 'standardLabel' GROUP BY 1"


def listed_concepts(spark, d):
    return resolve.list_concepts(table(spark, d, "concepts"), "standard").select("concept_id", "data_type")


def lookup_children(spark, d):
    """Nations below their regions as arcs below a parent."""
    m = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    arcs = m.select(F.lit("geo").alias("role"), F.col("r_name").alias("parent_id"), F.col("n_name").alias("child_id"), F.lit(1.0).alias("weight"), F.col("n_nationkey").alias("order"))
    return resolve.children(arcs, "EUROPE").select("child_id", "order")


def concept_cards(spark, d):
    arcs = spark.createDataFrame([], "role string, parent_id string, child_id string, weight double, `order` int")
    return resolve.concept_cards(table(spark, d, "concepts"), table(spark, d, "concept_labels"), arcs)


# scores ----------------------------------------------------------------


def _truth(spark, d):
    return score.truth_numbers(table(spark, d, "brreg_filings"), "orgnr", "key_metrics")


def truth_numbers(spark, d):
    return _truth(spark, d)


_TRUTH = "truth AS (SELECT DISTINCT orgnr, round_even(v, 0)::BIGINT AS n FROM (SELECT orgnr, unnest(map_values(key_metrics)) AS v FROM brreg_filings WHERE orgnr IS NOT NULL) WHERE v IS NOT NULL AND round_even(v, 0) <> 0)"


def _voter_texts(spark, d):
    return table(spark, d, "voter_tokens").select("orgnr", "voter", F.coalesce("full_text", F.lit("")).alias("text"))


def page_texts(spark, d):
    """Each voter's cells of a page as one text."""
    c = _cells(spark, d).withColumn("page", F.concat_ws("/", "doc_id", "page_no"))
    return score.voter_texts(c, "page", "text", ["cell_idx", "cell_id"])


_PAGE_TEXTS = "SELECT concat_ws('/', doc_id, page_no) AS page, voter, string_agg(coalesce(text, ''), chr(10) ORDER BY cell_idx, cell_id) AS text FROM cells GROUP BY ALL"


def _hits(spark, d):
    return score.hits(_truth(spark, d), _voter_texts(spark, d), "orgnr")


def number_present(spark, d):
    return _hits(spark, d)


def score_voters(spark, d):
    return score.score_voters(_hits(spark, d), "orgnr").select("orgnr", "voter", "hits", "total", F.round("recall", 6).alias("recall"), F.array_join(F.transform("missed", lambda x: x.cast("string")), ",").alias("missed"))


def score_consensus(spark, d):
    return score.score_consensus(_hits(spark, d), "orgnr", 2).withColumn("voters_hit", F.array_join("voters_hit", ","))


def score_fixture(spark, d):
    return score.score_fixture(_hits(spark, d), table(spark, d, "voter_tokens").select("orgnr"), "orgnr", 2)


def voter_recall(spark, d):
    return score.voter_recall(_hits(spark, d))


# a number's digits may have blanks between; a page is one text
_HITS = rf"""
{_TRUTH},
vt AS (SELECT orgnr, voter, translate(coalesce(full_text, ''), '‐‑‒–—−', '------') AS t FROM voter_tokens),
j AS (SELECT orgnr, n, voter, t, abs(n)::VARCHAR AS s FROM truth JOIN vt USING (orgnr)),
h AS (SELECT orgnr, n, voter, bool_or(regexp_matches(t, CASE WHEN n < 0 THEN '-' ELSE '' END || regexp_replace(s, '([0-9])', '\1{WS_OUT}*', 'g'))
  OR (n < 0 AND len(list_filter(regexp_extract_all(t, '\({WS}*([\p{{Nd}}\p{{Z}}\t\n\x0B\f\r\x{{85}}.,]+){WS}*\)', 1), lambda x: regexp_matches(x, regexp_replace(s, '([0-9])', '\1{WS_OUT}*', 'g')))) > 0)) AS hit FROM j GROUP BY ALL)
"""
_SCORE_CONSENSUS = "SELECT orgnr, n, coalesce(string_agg(voter, ',' ORDER BY voter) FILTER (hit), '') AS voters_hit, count(*) FILTER (hit)::INT AS n_hit, count(*) AS n_voters, count(*) FILTER (hit) = count(*) AS unanimous, count(*) FILTER (hit) >= 2 AS reliable FROM h GROUP BY ALL"


def voter_jaccard(spark, d):
    t = table(spark, d, "voter_tokens").select("voter", F.explode(text.coarse_numbers(F.col("full_text"))).alias("token"))
    return score.voter_jaccard(t).withColumn("jaccard", F.round("jaccard", 6))


_JACCARD = f"""
WITH p AS ({_PRODUCTION}), t AS (SELECT DISTINCT voter, n FROM p JOIN voter_tokens USING (vt_id)),
s AS (SELECT voter, count(*) AS c FROM t GROUP BY 1),
b AS (SELECT x.voter AS voter_a, y.voter AS voter_b, count(*) AS n_both FROM t x JOIN t y ON x.n = y.n AND x.voter < y.voter GROUP BY ALL)
SELECT voter_a, voter_b, n_both, a.c + z.c - n_both AS n_either, round(n_both / (a.c + z.c - n_both), 6) AS jaccard FROM b JOIN s a ON a.voter = voter_a JOIN s z ON z.voter = voter_b"""


def production_score(spark, d):
    t = table(spark, d, "voter_tokens").select("doc_id", "voter", F.explode_outer(text.coarse_numbers(F.col("full_text"))).alias("token"))
    return score.production_score(t, "doc_id", 2)


_PRODUCTION_SCORE = f"""
WITH p AS ({_PRODUCTION}), t AS (SELECT doc_id, n, count(DISTINCT voter) AS hit FROM p JOIN voter_tokens USING (vt_id) GROUP BY ALL),
v AS (SELECT doc_id, count(DISTINCT voter) AS n_voters FROM voter_tokens GROUP BY ALL)
SELECT doc_id, n_voters, count(*) AS n_tokens, count(*) FILTER (hit >= least(2, n_voters)) AS n_reliable FROM t JOIN v USING (doc_id) GROUP BY ALL"""


# annotations and exchange ---------------------------------------------


def _table_cells(spark, d):
    """Filing metrics as a table per record: label column, then the amount as text."""
    m = table(spark, d, "brreg_filings").select("rec_id", F.posexplode(F.map_entries("key_metrics")).alias("row_idx", "e"))
    label = m.select("rec_id", "row_idx", F.lit(0).alias("col_idx"), F.col("e.key").alias("text"))
    amount = m.select("rec_id", "row_idx", F.lit(1).alias("col_idx"), F.col("e.value").cast("decimal(20,0)").cast("string").alias("text"))
    return label.unionByName(amount)


def enrich_tables(spark, d):
    cells = _table_cells(spark, d)
    labels = cells.where("col_idx = 0").select(F.col("text").alias("label")).distinct().withColumn("concept_id", F.when(F.col("label").startswith("sum_"), F.concat(F.lit("x:"), "label")))
    return annotate.enrich(cells, labels, ["rec_id"], F.lit("2024-12-31")).select("rec_id", "label", "concept_id", "col_no", "value_text", "period_end")


_ENRICH = """
WITH m AS (SELECT rec_id, unnest(map_entries(key_metrics)) AS e FROM brreg_filings)
SELECT rec_id, e.key AS label, 'x:' || e.key AS concept_id, 1 AS col_no, e.value::DECIMAL(20,0)::VARCHAR AS value_text, '2024-12-31' AS period_end FROM m WHERE e.key LIKE 'sum\\_%' ESCAPE '\\' AND e.value IS NOT NULL"""


def key_values(spark, d):
    f = table(spark, d, "ixbrl_facts").select(_filing().alias("filing"), "fact_id", "concept_id", "value_text")
    return annotate.key_values(f, "filing", "fact_id")


_KEY_VALUES = """
WITH f AS (SELECT coalesce(orgnr || '/' || period_end, 'fact/' || fact_id) AS filing, fact_id, concept_id, coalesce(value_text, '') AS value_text, (row_number() OVER (PARTITION BY coalesce(orgnr || '/' || period_end, 'fact/' || fact_id) ORDER BY fact_id) - 1)::INT AS i FROM ixbrl_facts)
SELECT filing, i AS link_no, i * 2 AS key_cell, concept_id AS key_text, i * 2 + 1 AS value_cell, value_text FROM f"""


def _annotated(spark, d):
    t = table(spark, d, "ixbrl_facts")
    f = t.select(
        "fact_id", _filing().alias("source"), F.lit(1).alias("page_no"), geometry.box(F.lit(1.5), F.lit(2.0), F.lit(30.25), F.lit(12.0)).alias("bbox"), "concept_id", F.coalesce("value_text", F.col("value_num").cast("string")).alias("value_text"),
        F.array(F.lit("tesseract")).alias("voters_hit"), F.lit(1).alias("voters_total"), F.lit(None).cast("array<string>").alias("dropped"), F.lit(None).cast("string").alias("period_start"), "period_end", F.lit(None).cast("map<string,string>").alias("dimensions"),
    )
    return annotate.annotations(f, table(spark, d, "concepts"))


def annotate_json(spark, d):
    return annotate.annotation_json(_annotated(spark, d))


def collection_json(spark, d):
    a = _annotated(spark, d).withColumn("source", F.col("annotation.target.source"))
    return annotate.annotation_pages(a, "source")


def _exchanged(spark, d):
    t = table(spark, d, "ixbrl_facts")
    return annotate.exchange_facts(t.withColumn("filing", _filing()), table(spark, d, "concepts"), F.lit("2024-01-01"), keep=("filing",))


def xbrl_contexts(spark, d):
    return annotate.contexts(_exchanged(spark, d))


def xbrl_facts(spark, d):
    return _exchanged(spark, d).select("fact_id", "context_id", "unit_id", "element", "shown", "sign", "decimals")


_XBRL = r"""
x AS (SELECT fact_id, coalesce(f.period_type, c.period_type, 'duration') AS period_type, period_end, value_num, value_text, coalesce(decimals, 0) AS decimals,
  coalesce(unit, CASE WHEN data_type ILIKE '%monetary%' THEN 'NOK' WHEN data_type ILIKE '%shares%' THEN 'shares' WHEN regexp_matches(lower(data_type), 'decimal|pure|percent') THEN 'pure' ELSE 'NOK' END) AS unit
  FROM ixbrl_facts f LEFT JOIN concepts c USING (concept_id)),
y AS (SELECT *, replace(CASE WHEN period_type = 'instant' THEN 'ctx_instant_' || coalesce(period_end, '') ELSE 'ctx_duration_2024-01-01_' || coalesce(period_end, '') END, '-', '') AS context_id FROM x)
"""
_XBRL_FACTS = rf"""WITH {_XBRL} SELECT fact_id, context_id, 'unit_' || lower(unit) AS unit_id,
  CASE WHEN value_num IS NULL AND NOT coalesce(regexp_matches(value_text, '^\s*-?\d+(\.\d+)?\s*$'), false) THEN 'nonNumeric' ELSE 'nonFraction' END AS element,
  CASE WHEN value_num IS NOT NULL THEN abs(trunc(value_num)::BIGINT)::VARCHAR ELSE coalesce(value_text, '') END AS shown, CASE WHEN value_num < 0 THEN '-' ELSE '' END AS sign, decimals FROM y"""
_XBRL_CONTEXTS = f"WITH {_XBRL} SELECT context_id, min(period_type) AS period_type, '2024-01-01' AS period_start, min(period_end) AS period_end, count(*) AS n_facts FROM y GROUP BY 1"


def xbrl_documents(spark, d):
    return annotate.exchange_documents(_exchanged(spark, d), "filing", "schema.xsd")


# schemas and files -----------------------------------------------------


def unpivot_facts(spark, d):
    """The metrics of a filing as fields of a generated schema, and back to facts."""
    names = ["sum_eiendeler", "sum_egenkapital", "aarsresultat"]
    schema = T.StructType([T.StructField(n, T.DoubleType(), True, {"concept_id": f"x:{n}"}) for n in names] + [T.StructField("sum_total", T.DoubleType())])
    m = table(spark, d, "brreg_filings").select("rec_id", *[F.col("key_metrics")[n].alias(n) if n != "sum_total" else F.lit(1.0).alias(n) for n in schema.names])
    return schemagen.facts_of_fields(m, ["rec_id"], schema)


_UNPIVOT = "SELECT rec_id, 'x:' || e.key AS concept_id, e.value AS value FROM (SELECT rec_id, unnest(map_entries(key_metrics)) AS e FROM brreg_filings) WHERE e.key IN ('sum_eiendeler', 'sum_egenkapital', 'aarsresultat') AND e.value IS NOT NULL"


def hypercube(spark, d):
    """Order totals as a map of maps by status and priority, flattened again."""
    cell = table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    inner = cell.groupBy("o_orderstatus").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "v"))).alias("m"))
    cube = inner.agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "m"))).alias("total")).withColumn("concept", F.lit("total"))
    return schemagen.facts_of_cube(cube, ["concept"], "total")


_HYPERCUBE = "SELECT 'total' AS concept, o_orderstatus AS row_member, o_orderpriority AS col_member, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL"


def truth_records(spark, d):
    """Filings written as JSON records and read back by the truth reader."""
    t = table(spark, d, "brreg_filings").where("orgnr IS NOT NULL").select("rec_id", F.to_json(F.struct("orgnr", "journalnr", "period_from", "key_metrics")).alias("json"))
    return filings.truth_of_json(t, "json").select("rec_id", "orgnr", "journalnr", "period_from", F.cardinality("key_metrics").alias("n_metrics"))


_RECORDS = "SELECT rec_id, orgnr, journalnr, period_from, coalesce(cardinality(key_metrics), 0)::INT AS n_metrics FROM brreg_filings WHERE orgnr IS NOT NULL"


def ledger(spark, d):
    cells = _cells(spark, d)
    diagnostics = checkpoint(vote.bbox_vote(cells, min_voters=MIN_VOTERS))  # read twice
    agreed = diagnostics.where("committed").select(*PAGE, F.col("cluster_no").alias("cell_idx"), F.col("consensus_text").alias("text"), "confidence")
    records = filings.ledger_records(cells, agreed, diagnostics)
    return records.select("_meta.document_id", "_meta.page_no", F.size("_meta.voters").alias("n_voters"), F.coalesce(F.size("consensus"), F.lit(0)).alias("n_consensus"), F.coalesce(F.cardinality("diagnostics"), F.lit(0)).alias("n_diagnostics"))


QUERIES = {
    "diff_entries": diff_entries,
    "drift_by_concept": drift_by_concept,
    "drift_by_org": drift_by_org,
    "dedup_first": _dedup("first"),
    "dedup_last": _dedup("last"),
    "arc_check": arc_check,
    "period_failures": period_failures,
    "dimension_failures": dimension_failures,
    "validate_split": validate_split,
    "vocabulary_check": vocabulary_check,
    "parse_value": parse_value,
    "looks_numeric": looks_numeric,
    "norm_text": norm_text,
    "norm_nfkc": norm_nfkc,
    "numeric_tokens": numeric_tokens,
    "production_tokens": production_tokens,
    "word_tokens": word_tokens,
    "grouped_number": grouped_number,
    "snake_names": snake_names,
    "engine_languages": engine_languages,
    "split_lines": split_lines,
    "iou_pairs": iou_pairs,
    "column_bins": column_bins,
    "column_drop": column_drop,
    "bbox_vote": bbox_vote,
    "vote_text": vote_text,
    "vote_both": vote_both,
    "disagreement_boxes": disagreement_boxes,
    "document_summary": document_summary,
    "dropped_pages": dropped_pages,
    "effective_voters": effective_voters,
    "sampled_pages": sampled_pages,
    "lazy_vote": lazy_vote,
    "token_vote": token_vote,
    "token_sample": token_sample,
    "page_tokens": page_tokens,
    "line_vote": line_vote,
    "word_vote": word_vote,
    "line_words": line_words,
    "polygon_boxes": polygon_boxes,
    "exact_resolve": exact_resolve,
    "fuzzy_resolve": fuzzy_resolve,
    "resolve_cascade": resolve_cascade,
    "resolve_json": resolve_json,
    "embedding_resolve": embedding_resolve,
    "resolve_vectors": resolve_vectors,
    "label_search": label_search,
    "standard_labels": standard_labels,
    "listed_concepts": listed_concepts,
    "lookup_children": lookup_children,
    "truth_numbers": truth_numbers,
    "page_texts": page_texts,
    "number_present": number_present,
    "score_voters": score_voters,
    "score_consensus": score_consensus,
    "score_fixture": score_fixture,
    "voter_recall": voter_recall,
    "voter_jaccard": voter_jaccard,
    "production_score": production_score,
    "enrich_tables": enrich_tables,
    "key_values": key_values,
    "annotate_json": annotate_json,
    "collection_json": collection_json,
    "xbrl_contexts": xbrl_contexts,
    "xbrl_facts": xbrl_facts,
    "xbrl_documents": xbrl_documents,
    "unpivot_facts": unpivot_facts,
    "hypercube": hypercube,
    "truth_records": truth_records,
    "ledger": ledger,
}

SQL = {
    "diff_entries": f"{_DIFF} SELECT * FROM e",
    "drift_by_concept": _drift_sql("concept_id"),
    "drift_by_org": _drift_sql("orgnr"),
    "dedup_first": _dedup_sql("ASC"),
    "dedup_last": _dedup_sql("DESC"),
    "arc_check": _ARC,
    "period_failures": _PERIOD,
    "dimension_failures": _DIMENSION,
    "validate_split": _SPLIT,
    "vocabulary_check": _VOCABULARY,
    "parse_value": _PARSE,
    "looks_numeric": _LOOKS,
    "norm_text": _NORM,
    "production_tokens": _PRODUCTION,
    "word_tokens": _WORDS,
    "grouped_number": _GROUPED,
    "snake_names": _SNAKE,
    "engine_languages": _ENGINE,
    "split_lines": _LINES,
    "iou_pairs": _IOU,
    "column_bins": f"WITH {_BINS} SELECT doc_id, page_no, voter, voter_ord, bins, round(max_gap, 4) AS max_gap, n_cells FROM b",
    "column_drop": _DROP,
    "vote_text": _VOTE_TEXT,
    "disagreement_boxes": _DISAGREE,
    "document_summary": _SUMMARY,
    "dropped_pages": _DROPPED,
    "effective_voters": _EFFECTIVE,
    "sampled_pages": _SAMPLED,
    "token_vote": _TOKEN_VOTE,
    "token_sample": _TOKEN_SAMPLE,
    "word_vote": _WORD_VOTE,
    "line_words": _LINE_WORDS,
    "polygon_boxes": _POLYGON,
    "embedding_resolve": _EMBEDDING,
    "resolve_vectors": _VECTORS,
    "label_search": _SEARCH,
    "standard_labels": _STANDARD,
    "listed_concepts": "SELECT concept_id, data_type FROM concepts WHERE status = 'standard'",
    "lookup_children": "SELECT n_name AS child_id, n_nationkey AS \"order\" FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'",
    "page_texts": _PAGE_TEXTS,
    "truth_numbers": f"WITH {_TRUTH} SELECT * FROM truth",
    "number_present": f"WITH {_HITS} SELECT orgnr, n, voter, hit FROM h",
    "score_voters": f"WITH {_HITS} SELECT orgnr, voter, count(*) FILTER (hit) AS hits, count(*) AS total, round(count(*) FILTER (hit) / count(*), 6) AS recall, coalesce(string_agg(n::VARCHAR, ',' ORDER BY n) FILTER (NOT hit), '') AS missed FROM h GROUP BY ALL",
    "score_consensus": f"WITH {_HITS} {_SCORE_CONSENSUS}",
    "score_fixture": f"WITH {_HITS}, s AS ({_SCORE_CONSENSUS}) SELECT (SELECT count(DISTINCT orgnr) FROM voter_tokens) AS n_keys, count(*) AS n_truth_values, count(*) FILTER (unanimous) AS n_unanimous, count(*) FILTER (reliable) AS n_reliable, count(*) FILTER (n_hit = 0) AS n_universal_miss FROM s",
    "voter_recall": f"WITH {_HITS} SELECT voter, count(*) FILTER (hit) AS hits, count(*) AS total FROM h GROUP BY ALL",
    "voter_jaccard": _JACCARD,
    "production_score": _PRODUCTION_SCORE,
    "enrich_tables": _ENRICH,
    "key_values": _KEY_VALUES,
    "xbrl_contexts": _XBRL_CONTEXTS,
    "xbrl_facts": _XBRL_FACTS,
    "unpivot_facts": _UNPIVOT,
    "hypercube": _HYPERCUBE,
    "truth_records": _RECORDS,
}
