import math

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import annotate, drift, resolve, schemagen, score, validate

FACT = "orgnr string, concept_id string, period_end string, value double, ord long"


def sides(spark):
    v1 = spark.createDataFrame([("1", "a", "p", 100.4, 1), ("1", "b", "p", 5.0, 2), ("1", "c", "p", 7.0, 3), ("1", "z", "p", 0.0, 4)], FACT)
    v2 = spark.createDataFrame([("1", "a", "p", 100.3, 1), ("1", "b", "p", 9.0, 2), ("1", "e", "p", 7.0, 3), ("1", "z", "p", 3.0, 4)], FACT)
    return v1, v2


def test_diff_and_drift(spark):
    e = drift.diff_entries(*sides(spark))
    got = {r.concept_id: (r.kind, r.abs_delta, r.rel_delta) for r in e.collect()}
    assert got == {"a": ("agree", 0.0, 0.0), "b": ("disagree", 4.0, 0.8), "c": ("v1_only", None, None), "e": ("v2_only", None, None), "z": ("disagree", 3.0, math.inf)}
    (r,) = drift.drift(e, "orgnr").collect()
    assert (r.agree, r.disagree, r.v1_only, r.v2_only, r.agreement_rate) == (1, 2, 1, 1, 1 / 3)
    assert {r.concept_id: r.agreement_rate for r in drift.drift(e, "concept_id").collect()}["c"] is None


def test_repeated_keys(spark):
    df = spark.createDataFrame([("1", "a", "p", 1.0, 1), ("1", "a", "p", 2.0, 2)], FACT)
    assert drift.one_per_key(df, "first").first().value == 1.0 and drift.one_per_key(df, "last").first().value == 2.0
    with pytest.raises(Exception, match="repeated key"):
        drift.one_per_key(df).collect()
    assert drift.one_per_key(sides(spark)[0]).count() == 4
    with pytest.raises(ValueError, match="unknown policy"):
        drift.one_per_key(df, "some")


ARCS = [("P", "x", 1.0), ("P", "y", 1.0)]


@pytest.mark.parametrize(("total", "diff"), [(300.0, None), (500.0, 200.0), (301.0, None), (None, None)])
def test_arc_rule(spark, total, diff):
    f = spark.createDataFrame([(1, "P", total, 1, None), (2, "x", 100.0, 2, None), (3, "y", 200.0, 3, None), (4, "y", 999.0, 4, None)], "fact_id int, concept_id string, value double, ord int, period_end string")
    got = validate.arc_rule(f, spark.createDataFrame(ARCS, "parent_id string, child_id string, weight double"), ["period_end"]).collect()
    assert [r.diff for r in got] == ([] if diff is None else [diff])


def test_missing_child_is_not_judged(spark):
    f = spark.createDataFrame([(1, "P", 5.0, 1, "p"), (2, "x", 100.0, 2, "p")], "fact_id int, concept_id string, value double, ord int, period_end string")
    assert validate.arc_rule(f, spark.createDataFrame(ARCS, "parent_id string, child_id string, weight double"), ["period_end"]).count() == 0


def test_periods_dimensions_and_split(spark):
    f = spark.createDataFrame([(1, "instant", "", None, {"A": "m"}), (2, "duration", "e", "s", {"A": "n"}), (3, "duration", None, None, {"B": "m"}), (4, None, None, None, None)], "fact_id int, period_type string, period_end string, period_start string, dimensions map<string,string>")
    members = spark.createDataFrame([("A", "m")], "axis_id string, member_id string")
    p, d = validate.period_rule(f), validate.dimension_rule(f, members)
    assert sorted((r.fact_id, r.message) for r in d.collect()) == [(2, "member n not in axis A"), (3, "unknown axis: B")]
    good, bad = validate.split(f, [p, d])
    assert [r.fact_id for r in good.collect()] == [4] and {r.fact_id: len(r.failures) for r in bad.collect()} == {1: 1, 2: 1, 3: 3}


def test_body_parts(spark):
    df = spark.createDataFrame([([{"purpose": "tagging", "source": None, "value": "7"}, {"purpose": "classifying", "source": "x:A", "value": None}],)], "body array<struct<purpose:string,source:string,value:string>>")
    c, v = validate.body_parts("body")
    assert tuple(df.select(c, v).first()) == ("x:A", "7")


def test_vocabulary_shapes(spark):
    c = spark.createDataFrame([("x:A", "instant", "debit", "t", "standard"), ("x:B", "never", "up", None, None)], "concept_id string, period_type string, balance string, data_type string, status string")
    labels = spark.createDataFrame([("x:A", "nb", "standardLabel", "A"), ("x:A", "nb", "standardLabel", "B")], "subject_id string, lang string, role string, text string")
    arcs = spark.createDataFrame([("x:A", "x:B", 2.0)], "parent_id string, child_id string, weight double")
    got = {(r.subject_id, r.rule) for r in validate.vocabulary_failures(c, labels, arcs).collect()}
    assert got == {("x:A", "several labels in nb"), ("x:A", "weight not allowed"), ("x:B", "label missing"), ("x:B", "data type missing"), ("x:B", "period_type not allowed"), ("x:B", "balance not allowed"), ("x:B", "status not allowed")}


@pytest.mark.parametrize(("n", "t", "hit"), [(12345, "912 345", True), (-90488, "(90 488)", True), (-90488, "−90488", True), (0, "a 0 b", True), (0, "10", False), (1234, "1 2 3 4", True), (1234, "12 34x", True), (5, None, False), (2.5, "2", True), (77, "-77", True)])
def test_number_present(spark, n, t, hit):
    assert spark.createDataFrame([(float(n), t)], "n double, t string").select(score.number_present(F.col("n"), F.col("t")).alias("h")).first().h is hit


def test_shown_numbers_are_those_present(spark):
    """The join finds what the test of each number against each text finds."""
    import random

    rng = random.Random(6)
    texts = ["".join(rng.choices(["1", "2", "3", " ", " ", "-", "(", ")", ",", ".", "a", "\n", "−"], k=rng.randint(0, 30))) for _ in range(150)] + ["( 12 3 )", "-1 2", "(1,23)", "1" * 3000]
    numbers = [n for n in range(-130, 131) if n] + [1231, -2313]
    t = spark.createDataFrame([(str(i % 7), str(i), x) for i, x in enumerate(texts)], "k string, voter string, text string")
    truth = spark.createDataFrame([(str(k), n) for k in range(7) for n in rng.sample(numbers, 60)], "k string, n long")
    slow = truth.join(t, "k").select("k", "n", "voter", score.number_present(F.col("n"), F.col("text")).alias("hit"))
    assert sorted(map(tuple, score.hits(truth, t, "k").collect())) == sorted(map(tuple, slow.collect()))


def test_scores(spark):
    truth = spark.createDataFrame([("1", 100), ("1", 200), ("2", 300)], "k string, n long")
    texts = spark.createDataFrame([("1", "a", "100 og 200"), ("1", "b", "200"), ("2", "a", ""), ("3", "a", "x")], "k string, voter string, text string")
    h = score.hits(truth, texts, "k")
    assert {(r.n, r.n_hit, r.unanimous, r.reliable) for r in score.score_consensus(h, "k", 2).collect()} == {(100, 1, False, False), (200, 2, True, True), (300, 0, False, False)}
    assert tuple(score.score_fixture(h, texts, "k", 2).first()) == (3, 3, 1, 1, 1)
    assert {(r.k, r.voter): (r.hits, r.missed) for r in score.score_voters(h, "k").collect()}[("1", "b")] == (1, [100])
    t = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 2), ("c", None)], "voter string, token long")
    (r,) = score.voter_jaccard(t).collect()
    assert (r.voter_a, r.voter_b, r.jaccard) == ("a", "b", 0.5)


def test_resolution_stages(spark):
    labels = spark.createDataFrame([("x:AFunksjon", "concept", "nb", "standardLabel", "Sum eiendeler"), ("x:A", "concept", "nb", "standardLabel", "Sum Eiendeler"), ("x:B", "concept", "en", "standardLabel", "Total equity"), ("x:C", "axis", "nb", "standardLabel", "Akse")], "subject_id string, subject_kind string, lang string, role string, text string")
    q = spark.createDataFrame([(1, "sum  EIGEDELAR", "nb"), (2, "sum eiendeler", None), (3, "Equity total", "nb"), (4, "  ", "nb"), (5, "Akse", "nb"), (6, None, None)], "id int, query string, lang_pref string")
    got = {r.id: (r.concept_id, r.method, r.chain) for r in resolve.resolve(q, labels).collect()}
    assert got[1][:2] == ("x:A", "exact")
    assert got[2] == ("x:A", "exact", ["exact"]) and got[3] == ("x:B", "fuzzy", ["exact", "fuzzy"])
    assert got[4] == (None, "none", ["none"]) and got[5] == (None, "none", ["exact", "fuzzy", "none"]) and got[6] == (None, "none", ["none"])


def test_cascade_with_vectors_and_candidates(spark):
    labels = spark.createDataFrame([("x:A", "concept", "nb", "standardLabel", "Eiendeler"), ("x:AFunksjon", "concept", "nb", "standardLabel", "Eiendeler"), ("x:B", "concept", "nb", "standardLabel", "Gjeld")], "subject_id string, subject_kind string, lang string, role string, text string")
    q = spark.createDataFrame([(1, "Eiendeler", "nb"), (2, "eiendeler sum", "nb"), (3, "skyldnad", None), (4, "ukjent", "nb"), (5, None, "nb"), (6, " ", None), (7, "Gjeld", None)], "id int, query string, lang_pref string")
    vectors = spark.createDataFrame([("skyldnad", [0.0, 2.0]), ("ukjent", [0.0, 0.0])], "form string, vector array<double>"), spark.createDataFrame([("x:A", [1.0, 0.0]), ("x:B", [0.1, 1.0]), ("x:C", None)], "subject_id string, vector array<double>")
    got = {r.id: (r.concept_id, r.method, "".join(c[0] for c in r.chain), [c.concept_id for c in r.candidates], r.match_role) for r in resolve.resolve(q, labels, vectors=vectors).collect()}
    assert got[1] == ("x:A", "exact", "e", ["x:AFunksjon"], "standardLabel") and got[7] == ("x:B", "exact", "e", [], "standardLabel")
    assert got[2][:3] == ("x:A", "fuzzy", "ef") and got[2][3][0] == "x:AFunksjon"
    assert got[3] == ("x:B", "embedding", "efe", ["x:A"], None)
    assert got[4] == (None, "none", "efen", [], None)
    assert got[5] == got[6] == (None, "none", "n", [], None)
    again = {r.id: (r.concept_id, r.method) for r in resolve.resolve(q, labels, use_fuzzy=False).collect()}
    assert again[2] == (None, "none") and again[1] == ("x:A", "exact")
    assert resolve.resolve(q.limit(0), labels, vectors=vectors).count() == 0


def test_token_set_ratio():
    assert resolve.token_set_ratio("eiendeler totalt", "eiendeler") == 100.0
    assert resolve.token_set_ratio("a b", "c d") < 50 and resolve.token_set_ratio("", "x") == 0.0


def test_nearest_against_brute_force(spark):
    import numpy as np

    r = np.random.default_rng(1)
    m = r.normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(900, None), (901, [0.0] * 8)], "id long, e array<double>").repartition(5)
    got = {}
    for x in resolve.nearest(df.where("id % 100 = 0"), df, "id", "e", threshold=-1.0).collect():
        got.setdefault(x.query_key, {})[x.rank] = x.id
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in (0, 100, 200):
        s = u @ u[q]
        s[q] = -9
        assert [got[q][k] for k in range(1, 6)] == list(np.argsort(-s)[:5])


def test_vocabulary_lookups(spark):
    labels = spark.createDataFrame([("x:A", "concept", "nb", "standardLabel", "Sum Eiendeler")], "subject_id string, subject_kind string, lang string, role string, text string")
    assert resolve.search_labels(labels, " sum  eiendeler").count() == 1 and resolve.search_labels(labels, "eien", whole=False).count() == 1 and resolve.search_labels(labels, "eien").count() == 0
    c = spark.createDataFrame([("x:A", "standard")], "concept_id string, status string")
    arcs = spark.createDataFrame([("r", "x:A", "x:B", -1.0, 1)], "role string, parent_id string, child_id string, weight double, `order` int")
    cards = {r.concept_id: r.card for r in resolve.concept_cards(c, labels, arcs, asked=spark.createDataFrame([("x:A",), ("x:Q",)], "concept_id string")).collect()}
    assert '"child":"x:B"' in cards["x:A"] and "unknown concept: x:Q" in cards["x:Q"]


def test_schema_generation(spark):
    s = schemagen.arc_schema([("x:SumGjeld", 1.0, 2), ("y:SumGjeld", -1.0, 3)], "x:Total")
    assert s.names == ["sum_gjeld", "sum_gjeld_3", "sum_total"]
    df = spark.createDataFrame([(1, 5.0, None, 9.0)], "k int, sum_gjeld double, sum_gjeld_3 double, sum_total double")
    assert [tuple(r) for r in schemagen.facts_of_fields(df, ["k"], s).collect()] == [(1, "x:SumGjeld", 5.0)]
    with pytest.raises(ValueError, match="no children"):
        schemagen.arc_schema([], "x:P")
    assert schemagen.axis_schema(["x:AarsresultatMember"], "x:Axis").names == ["aarsresultat"]
    asked = spark.createDataFrame([(1, "gjeld 7")], "k int, t string")
    got = schemagen.extract(asked, ["k"], "t", "x:Total", s, lambda prompt, shape: {"sum_gjeld": 7, "unknown": 1, "sum_total": 7} if "gjeld 7" in prompt else {})
    assert [tuple(r) for r in got.collect()] == [(1, "x:SumGjeld", 7.0)]


def test_tables_to_facts(spark):
    c = spark.createDataFrame([(1, 0, 0, "Eiendeler"), (1, 0, 1, "300"), (1, 0, 2, "(1 2)"), (1, 1, 0, "x" * 90), (1, 1, 1, "5"), (1, 2, 0, "alone"), (1, 3, 0, None), (1, 3, 1, "7"), (1, 4, 0, "Gjeld"), (1, 4, 1, "tekst")], "t int, row_idx int, col_idx int, text string")
    labels = spark.createDataFrame([("Eiendeler", "x:A")], "label string, concept_id string")
    assert sorted((r.concept_id, r.col_no, r.value_text) for r in annotate.enrich(c, labels, ["t"], F.lit("p")).collect()) == [("x:A", 1, "300"), ("x:A", 2, "(1 2)")]
    assert tuple(annotate.label_counts(c, "text", labels).first()) == (4, 1)
