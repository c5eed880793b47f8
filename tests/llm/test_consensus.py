import math
import random

import pytest

from ledgerloom.llm import consensus

SCHEMA = "item long, kind string, label string, hit array<string>, dropped array<string>, item_text string"


def simulated(n=1500, seed=4):
    """Numbers read by five voters of their own and a family of four that share their slips."""
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        t = str(rng.randint(1000, 9_999_999))
        truth[i] = t
        wrong = lambda: (lambda k: t[:k] + {"0": "6", "1": "7", "3": "8", "4": "9", "8": "3"}.get(t[k], "5") + t[k + 1 :])(rng.randrange(len(t)))
        shared = wrong() if rng.random() < 0.14 else None
        said = {}
        for v, error in (("good", 0.03), ("fine", 0.05), ("fair", 0.1), ("poor", 0.3), ("worse", 0.4)):
            if rng.random() < 0.7:
                said[v] = t if rng.random() > error else wrong()
        for v in ("f1", "f2", "f3", "f4"):
            said[v] = shared or (t if rng.random() > 0.15 else wrong())
        by = {}
        for v, x in said.items():
            by.setdefault(x, []).append(v.upper() if rng.random() < 0.1 else v + " " * (rng.random() < 0.1))
        rows += [(i, "numeric", x, v, None, "own") for x, v in by.items()]
    return rows, truth


def test_family_does_not_outvote(spark):
    rows, truth = simulated()
    items, model = consensus.fit(spark.createDataFrame(rows, SCHEMA), "item", "kind", "label", "hit", "dropped")
    got = {r.item: r.label for r in consensus.consensus(items, model).collect()}
    majority = {}
    for i, _, x, v, _, _ in rows:
        majority[i] = max(majority.get(i, (0, "")), (len(v), x))
    right, plain = (sum(a[i] == truth[i] for i in truth) / len(truth) for a in (got, {i: m[1] for i, m in majority.items()}))
    assert plain + 0.05 < right and right > 0.93, (plain, right)
    skill = {r.voter: r.competence for r in consensus.reliability(items, model).collect()}
    assert min(skill["good"], skill["fine"]) > max(skill[f"f{k}"] for k in range(1, 5)) and len(skill) == 9
    assert model.joined("f1", "f2") > 3 * model.joined("good", "fine")


@pytest.mark.parametrize(("t", "r", "s"), [("100", "100", "same"), ("-5", "5", "sign"), ("1200", "1260", "0>6"), ("1200", "7260", "1>7|0>6"), ("1234567", "1234", "cut"), ("12", "121", "add"), ("123456", "999", "other"), ("kreditt", "kreclitt", "d>cl"), ("1243", "1234", "swap")])
def test_slips(t, r, s):
    assert consensus.slip(t, r) == s


def test_dropped_nulls_and_repeats(spark):
    rows = [
        (1, "numeric", "5", ["A", "a ", "b"], ["b"], "x"), (1, "numeric", "7", ["b"], None, "x"), (1, "numeric", "5", ["a"], [], "x"),
        (2, "numeric", "8", None, None, "x"), (3, "word", "ord", ["c"], ["c"], "x"), (4, "word", None, ["c"], None, "x"), (5, None, "z", [None, "c"], None, "x"),
    ]
    items, model = consensus.fit(spark.createDataFrame(rows, SCHEMA), "item", "kind", "label", "hit", "dropped", rounds=2)
    got = {r.item: (r.label, r.agreement, r.n_votes) for r in consensus.consensus(items, model).collect()}
    assert got == {1: ("5", 1.0, 1), 2: ("8", None, 0), 3: ("ord", 1.0, 1), 4: (None, None, 0), 5: ("z", 1.0, 1)}


def test_one_row_an_item_of_several_kinds(spark):
    rows = [(1, "numeric", "5", ["a"], None, "x"), (1, "word", "fem", ["b", "c"], None, "x"), (1, None, "5", ["d"], None, "x")]
    items, model = consensus.fit(spark.createDataFrame(rows, SCHEMA), "item", "kind", "label", "hit", "dropped", rounds=1)
    assert [(r.item, r.kind, r.n_votes) for r in consensus.consensus(items, model).collect()] == [(1, "word", 4)]


def plain_posterior(m, kind, voters, prior, slips):
    """The posterior of one item, written out."""
    n, logs = len(voters), []
    top = sum(prior) + 0.5 * n
    for t in range(n):
        x = math.log((prior[t] + 0.5) / top) if kind == "word" else 0.0
        for r in range(n):
            if r == t:
                x += sum(math.log(m.competence(v)) for v in voters[r])
                continue
            s = slips[t * n + r]
            group = sorted(voters[r], key=lambda v: -m.slipped(v, kind, s))
            for k, v in enumerate(group):
                miss = math.prod(1 - m.joined(u, v) for u in group[:k])
                x += math.log((1 - miss) + miss * m.slipped(v, kind, s))
        logs.append(x)
    e = [math.exp(x - max(logs)) for x in logs]
    return [x / sum(e) for x in e]


def test_arrays_agree_with_the_formula(spark):
    rows, _ = simulated(300, 9)
    items, model = consensus.fit(spark.createDataFrame(rows, SCHEMA), "item", "kind", "label", "hit", "dropped", rounds=3)
    want = {r.item: max(plain_posterior(model, r.kind, r.voters, r.prior, r.slips)) for r in items.collect()}
    got = {r.item: r.posterior for r in consensus.consensus(items, model).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_empty(spark):
    items, model = consensus.fit(spark.createDataFrame([], SCHEMA), "item", "kind", "label", "hit", "dropped", rounds=1)
    assert consensus.consensus(items, model).count() == 0 and consensus.reliability(items, model).count() == 0


def test_tie_goes_to_votes_then_order(spark):
    rows = [(1, "numeric", "3", ["a"], None, "x"), (1, "numeric", "8", ["b"], None, "x")]
    items, model = consensus.fit(spark.createDataFrame(rows, SCHEMA), "item", "kind", "label", "hit", "dropped", rounds=1)
    assert consensus.consensus(items, model).first().label in ("3", "8")


def test_attempts_without_a_reading_count(spark):
    rows = [(i, "numeric", "5", ["A"], ["d"], ["a", "B ", "b", "d", None]) for i in range(40)] + [(40, "numeric", "7", ["a"], None, None), (40, "numeric", "8", ["b"], None, ["c"]), (41, "numeric", "9", None, None, ["c"])]
    df = spark.createDataFrame(rows, "item long, kind string, label string, hit array<string>, dropped array<string>, tried array<string>")
    items, model = consensus.fit(df, "item", "kind", "label", "hit", "dropped", rounds=2, attempted="tried")
    got = {r.item: (r.agreement, r.n_votes, r.n_attempts) for r in consensus.consensus(items, model).collect()}
    assert got[0] == (0.5, 1, 2) and got[40][1:] == (2, 3) and got[41] == (0.0, 0, 1)
    voters = {r.voter: r for r in consensus.reliability(items, model).collect()}
    assert set(voters) == {"a", "b", "c"} and voters["a"].answered == 1.0 and voters["c"].reliability == 0.0
    assert (voters["b"].n_votes, voters["b"].n_attempts) == (1, 41) and voters["b"].reliability < 0.05 < voters["a"].reliability
