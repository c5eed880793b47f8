import random
import re

import numpy as np
import pytest

from held_out_abuse import ABUSIVE, HARMLESS, LATER_ABUSIVE, LATER_HARMLESS, sentences
from ledgerloom.llm import abuse
from ledgerloom.llm.abuse_examples import WORDS, examples, frames


@pytest.fixture(scope="module")
def fitted(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    return df, abuse.fit(df, "text")


@pytest.fixture(scope="module")
def threshold(fitted):
    return abuse.calibrate(fitted[1].held, {})


def flagged(net, threshold, text):
    w = abuse.windows(text)
    return any(p >= threshold[abuse.language(x)] for p, x in zip(net.score(w), w))


def test_held_out_examples(fitted, threshold):
    """Sentences filled anew, half of them disguised."""
    _, net = fitted
    rng = random.Random(77)
    made = [(abuse.disguise(s, rng) if i % 2 and y else s, y) for i, (_, s, y) in enumerate(examples(2000, 991))]
    hit = np.array([flagged(net, threshold, s) for s, _ in made])
    y = np.array([y for _, y in made], bool)
    assert hit[y].mean() > 0.93 and hit[~y].mean() < 0.03


@pytest.mark.parametrize(("bad", "good", "recall", "alarms"), [(ABUSIVE, HARMLESS, 0.9, 0.2), (LATER_ABUSIVE, LATER_HARMLESS, 0.9, 0.15)])
def test_sentences_of_another_hand(fitted, threshold, bad, good, recall, alarms):
    """Sentences that stand in no pattern."""
    _, net = fitted
    assert np.mean([flagged(net, threshold, s) for _, s in sentences(bad)]) >= recall
    assert np.mean([flagged(net, threshold, s) for _, s in sentences(good)]) <= alarms


def test_patterns_are_not_taken_from_the_documents(spark):
    """No fragment of 16 characters of a pattern or filler stands in the documents, or in the held-out sentences of either side's whole."""
    texts = [r.text.lower() for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null").select("text").distinct().collect()]
    known = {t[i : i + 16] for t in texts for i in range(len(t) - 15)}
    fragments = [f.lower() for _, x, _ in frames() for f in re.split(r"\{.\}", x)] + [f.lower() for w in WORDS.values() for v in w.values() for x in v.split("|") for f in re.split(r"\{.\}", x)]
    assert [f for f in fragments if any(f[i : i + 16] in known for i in range(len(f) - 15))] == []


def test_thresholds_follow_the_documents():
    """Many documents between harmless and abusive scores push the threshold above them; without documents the examples decide."""
    held = ([(0.9 + i / 1000, "nb") for i in range(90)], [(0.1, "nb")] * 100)
    crowd = {("nb", 10): 900, ("nb", 120): 300, ("nb", 190): 50}
    assert abuse.calibrate(held, crowd)["nb"] > 0.6
    assert 0.4 <= abuse.calibrate(held, {})["nb"] <= 0.7


def test_kept_model(tmp_path, fitted):
    _, net = fitted
    net.save(str(tmp_path / "m.npz"))
    again = abuse.Net.load(str(tmp_path / "m.npz"))
    some = [abuse.clear("Hold kjeft, din feite idiot"), ["takk"]]
    assert np.allclose(net.score(some), again.score(some), atol=0.02) and len(again.held[0]) == len(net.held[0])


def test_whole_words():
    """What stands at the end of a long word counts."""
    assert abuse.features("regnskapsavdelings" * 4 + "idiot")[-5:] != abuse.features("regnskapsavdelings" * 4 + "venner")[-5:]
    assert len(abuse.features("x" * 500)) > 900


@pytest.mark.parametrize(("text", "words"), [("du er r.å.t.t.e.n!", ["du", "er", "råtten"]), ("DR1TT$EKK", ["drittsekk"]), ("mоtб", ["motб"]), ("toskkkkk", ["tosk"]), ("i­diot", ["idiot"]), ("a**e", ["a**e"]), ("NOK 12 000", ["nok", "0", "0"]), ("naboen i 3B", ["naboen", "i", "3b"]), ("", [])])
def test_clear(text, words):
    assert abuse.clear(text) == words


def test_language():
    assert [abuse.language(abuse.clear(s)) for s in ("du er ikke her", "eg er ikkje her saman med dei", "you are not here", "du bist nicht der", "Sum")] == ["nb", "nn", "en", "other", "und"]


def test_windows_cover_long_sentences():
    w = abuse.windows(" ".join(f"ord{c}" for c in "abcdefghij" * 10))
    assert all(len(x) <= abuse.WINDOW for x in w) and len(w) > 3 and w[-1][-1] == "ordj"


def test_documents(spark, fitted):
    _, net = fitted
    long = "Regnskapet er godkjent av styret. " * 3000
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n", "a"), (4, long + "Hold kjeft, din feite idiot. " + long, "a"), (5, long, "a"), (6, "Hold kjeft, din feite idiot.", "a"), (6, "Hold kjeft, din feite idiot.", "a"), (7, "Vi vil takke kassereren for god innsats.", "a")]
    got = sorted((r.id, r.flagged) for r in abuse.score_documents(spark.createDataFrame(rows, "id int, t string, score string"), "id", "t", net).collect())
    assert got == [(1, False), (2, False), (3, False), (4, True), (5, False), (6, True), (6, True), (7, False)]
    assert abuse.score_documents(spark.createDataFrame([], "id int, t string"), "id", "t", net).count() == 0


def test_gradient():
    """A training step lowers the loss on the batch it is taken on."""
    net = abuse.Net(3)
    some = [["du", "er", "dum"], ["takk", "for", "sist"], ["a"], ["styret", "har", "vedtatt", "budsjettet"]]
    y = np.array([1, 0, 0, 0], np.float32)
    loss = lambda: float(-np.log(np.where(y == 1, p := net.score(some), 1 - p) + 1e-9).mean())
    before = loss()
    net.train(some, y, epochs=30)
    assert loss() < 0.5 * before


def test_fit_on_nothing(spark):
    net = abuse.fit(spark.createDataFrame([], "text string"), "text", sample=10, written=400)
    assert set(abuse.calibrate(net.held, {})) == set(abuse.LANGUAGES)
