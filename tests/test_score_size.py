"""Scores of many texts: what their plans broadcast, and keys with many numbers."""

import pytest

import __spark_entry__
from ledgerloom.operators import score


def broadcast_rows_of_arrays(df):
    """Lines of the plan before it runs that broadcast rows made from arrays, with no exchange between."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    found = []
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            for k in range(i + 1, len(lines)):
                if depth[k] <= depth[i] or "Exchange" in lines[k]:
                    break
                if "Generate " in lines[k]:
                    found.append(x)
                    break
    return found


@pytest.mark.parametrize("query", ["score_consensus", "score_voters", "voter_recall", "number_present", "score_fixture"])
def test_numbers_of_texts_are_not_broadcast(spark, data, query):
    """The planner takes the numbers that texts show for no more bytes than the texts' file."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        assert not broadcast_rows_of_arrays(__spark_entry__.queries()[query](spark, data))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pieces_that_are_no_number_of_the_key_end_early(spark):
    """Of 30,000 pieces of a text few go on; of a key with very many numbers none is lost."""
    import random

    rng = random.Random(3)
    digits = "".join(rng.choices("0123456789", k=6000))
    many = sorted(rng.sample(range(10000, 100000), 20000))
    truth = spark.createDataFrame([("few", int("1" + digits[5:9])), ("few", -77777), *(("many", n) for n in many), ("none", 5)], "k string, n long")
    texts = spark.createDataFrame([("few", "a", digits), ("few", "b", None), ("many", "a", digits), ("other", "a", digits)], "k string, voter string, text string")
    named = truth.selectExpr("k", "n", "cast(n as string) AS __s")
    shown = score.shown_numbers(named, texts, "k")
    assert shown.where("k = 'few'").count() < 100
    got = {(r.k, r.n, r.voter): r.hit for r in score.hits(truth, texts, "k").collect()}
    assert {n for (k, n, _), hit in got.items() if k == "many" and hit} == {n for n in many if str(n) in digits}
    assert len(got) == len(many) + 4 and not any(hit for (k, _, v), hit in got.items() if v == "b")
    assert got["few", -77777, "a"] is False and got["few", int("1" + digits[5:9]), "a"] is (("1" + digits[5:9]) in digits)
