import random

import numpy as np
import pytest

from ledgerloom.llm import scan

SENTENCES = ["Regnskapet viser at avskrivning av drivhus er redusert med tolv prosent", "styret har vedtatt at vedlikehold av kaianlegg skal utsettes til neste sommer", "selskapet fikk offentlige tilskudd utover vanlig leieinntekt denne perioden", "kundefordringer er klassifisert som usikre etter styrets vurdering"]
NAMES = ["Fjell Verft AS", "Strand Sag ANS", "Holmen Rør SA"]


def page(rng, damage=False, split=False, furniture=True):
    words = " ".join(x + "." for x in rng.choices(SENTENCES, k=rng.randint(6, 9))).split()[rng.randint(0, 8) :]
    rows = [words[i : i + 9] for i in range(0, len(words), 9)]
    truth = []
    lines = [" ".join(r) for r in rows]
    if split:
        head, tail = lines[1].rsplit(" ", 1)
        if len(tail) > 6:
            lines[1], lines[2] = f"{head} {tail[:4]}-", f"{tail[4:]} {lines[2]}"
            truth.append((1, "hyphen"))
    if damage:
        w = next((x for x in lines[3].split()[1:-1] if "n" in x and len(x) > 6), None)
        if w:
            lines[3] = lines[3].replace(w, w.replace("n", "ri", 1), 1)
            truth.append((3, "char"))
    top = 0
    if furniture:
        lines = [f"Årsrapport 2020 | {rng.choice(NAMES)}", *lines, f"Side {rng.randint(1, 40)}"]
        top = 1
        truth += [(-1, "header"), (len(lines) - 2, "page_number")]
    return "\n".join(lines), {(i + 1 + top, k) for i, k in truth}


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(3)
    return [page(rng, rng.random() < 0.3, rng.random() < 0.3) for _ in range(400)]


@pytest.fixture(scope="module")
def known(spark, pages):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(pages)] + [(900, None), (901, ""), (902, " \n ")], "id int, t string").repartition(3)
    return df, scan.learn([(df, "t", True)], spark)


def test_damaged_lines(known, pages):
    df, k = known
    got = {(r.id, r.line_no, r.kind) for r in scan.damaged_lines(df, "id", "t", k, True).collect()}
    want = {(i, n, kind) for i, (_, truth) in enumerate(pages) for n, kind in truth}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)


def test_repair(known):
    _, k = known
    text = "Årsrapport 2020 | Fjell Verft AS\nRegnskapet viser at avskriv-\nning av drivhus er redusert\nmed tolv proserit.\nSide 7"
    assert k.repair(text, True) == "Regnskapet viser at avskrivning av drivhus er redusert med tolv prosent."
    assert k.repair("", True) == ""


def test_repair_of_numbers(known):
    _, k = known
    assert k.repair("Den 31.12.2O23 er 9o0, (S00 000) og 202l redusert.", False) == "Den 31.12.2023 er 900, (500 000) og 2021 redusert."
    assert k.repair("Tapet er 12 ?OO 45O kroner, se note 5.", False) == "Tapet er 12 ?00 450 kroner, se note 5."
    assert k.repair("Boligen i Oslo er solgt\nfor 1I2 kroner", False) == "Boligen i Oslo er solgt for 112 kroner"


@pytest.mark.parametrize(("line", "yes"), [("Side 4", True), ("[12]", True), ("- 3 -", True), ("iv", True), ("3/22", True), ("000", False), ("12 kroner", False), ("Side", False)])
def test_page_numbers(known, line, yes):
    assert known[1].page_number(line) is yes


def test_numbers(known):
    k = known[1]
    assert k.number_damaged(["12", "S00", "000"], 1) and k.number_damaged(["?3", "600"], 0) and not k.number_damaged(["12", "500", "000"], 1) and not k.number_damaged(["31.12.2020"], 0)


def test_hanging_hyphen_is_none(spark):
    rng = random.Random(1)
    lines = ["her er lønns- og pensjonskostnader flyttet til note", "og lønns- og pensjonskostnader er uendret hele året"] * 30
    df = spark.createDataFrame([(1, "\n".join(rng.sample(lines, 60)))], "id int, t string")
    k = scan.learn([(df, "t", True)], spark)
    assert k.judge("fordi lønns-\nog pensjonskostnader er uendret", False) == []
    assert k.judge("fordi pensjons-\nkostnader er uendret", False) == [(1, "hyphen")]


def test_skip_grams_learn_company():
    """Words that share their neighbours get vectors that fit them better."""
    a = np.array([0, 0, 1, 1, 2, 2, 3, 3])
    b = np.array([4, 5, 4, 5, 6, 7, 6, 7])
    win, wout = scan.skip_grams(8, a, b, np.full(8, 50))
    assert win[0] @ wout[4] > win[0] @ wout[6] + 1 and win[2] @ wout[7] > win[2] @ wout[5] + 1


def test_other_texts_do_not_count_as_pages(spark):
    pages = spark.createDataFrame([(i, "Kontoret for kommunal revisjon\n" + "\n".join(f"ord{i}x{j} tekst." for j in range(12))) for i in range(12)], "id int, t string")
    others = spark.createDataFrame([(i, "Sum") for i in range(4000)], "id int, t string")
    k = scan.learn([(pages, "t", True), (others, "t", False)], spark)
    assert scan.shape("Kontoret for kommunal revisjon") in k.shapes


def test_empty(spark):
    df = spark.createDataFrame([], "id int, t string")
    k = scan.learn([(df, "t", True)], spark)
    assert scan.damaged_lines(df, "id", "t", k, True).count() == 0 and scan.repaired(df, "id", "t", k, True).count() == 0
    one = spark.createDataFrame([(1, "ord " * 30_000), (2, None)], "id int, t string")
    assert {r.id: r.paragraphs is None for r in scan.repaired(one, "id", "t", k, True).collect()} == {1: False, 2: True}


def test_words_of_a_count_stay_words_at_any_size(spark):
    """1.6 million words: one met four times is still a word, as in a small corpus."""
    from pyspark.sql import functions as F

    line = " ".join(["Regnskapet viser at avskrivning er redusert"] * 17) + "."
    df = spark.range(16_000).select(F.when(F.col("id") < 4, F.lit(line + "\nDet gjelder kornsilo her.")).otherwise(line).alias("t"))
    k = scan.learn([(df, "t", False)], spark)
    assert k.total > 1_500_000 and k.count("kornsilo") == 4 and k.words_table is None


def test_counts_by_blocks_give_the_same(spark, known, pages, monkeypatch):
    """Where the frequent words are too many to send, each block asks for its own; nothing else changes."""
    df, k = known
    monkeypatch.setattr(scan, "MOST_WORDS", 3)
    monkeypatch.setattr(scan, "BLOCK_TEXTS", 150)
    few = scan.learn([(df, "t", True)], spark, {"sjeldent": 4})
    assert few.words_table is not None
    some = df.where("id < 60 or id >= 900")
    for f in (scan.damaged_lines, scan.repaired):
        a, b = (sorted(map(str, f(some, "id", "t", x, True).collect())) for x in (k, few))
        assert a == b and a


def test_long_words_and_lines(known):
    """Whole words and lines count, however long."""
    _, k = known
    long = "anleggsmiddelverdi" * 12
    assert scan.whole_tokens([f"her er {long} skrevet."]) == ["her", "er", long, "skrevet"]
    assert len(scan.shape("ord " * 60)) > 200
    assert k.neighbours("rn" * 80) == [] and k.neighbours("c" * 5000) == []


def test_misreadings_of_misreadings():
    """A misreading met often enough to be frequent leads on to the word that was printed."""
    k = scan.Knowledge({"elektronisk": 900, "elelctronisk": 9}, 10_000, set())
    assert k.printed("elelctronislc") == "elektronisk" and k.printed("elelctronisk") == "elektronisk"


@pytest.fixture(scope="module")
def crowd(spark):
    """A million words and more, and a rare one that stands beside 30 others once each."""
    line = " ".join(["regnskapet viser avskrivning"] * 34) + "."
    rare = "\n".join(f"kornsilo {w} kornsilo." for w in [f"ord{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30)] for _ in range(2))
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(F.when(F.col("id") < 2, F.lit(rare)).otherwise(line).alias("t"))
    return df, scan.learn([(df, "t", False)], spark)


def test_every_frequent_word_has_a_vector_from_all_its_pairs(crowd):
    """However large the corpus, no word and no pair is left out, and texts that are no pages count too."""
    _, k = crowd
    assert k.total > 2_000_000 and k.at.keys() == {w for w, n in k.counts.items() if n >= scan.LEAST_COUNT}
    assert len(k.at) == 34 and k.affinity("kornsilo", ["ordaa"]) > k.affinity("kornsilo", ["viser"]) + 1


def test_vectors_by_blocks_are_the_same(spark, known, crowd, monkeypatch):
    """Words or pairs too many for the driver are trained by blocks on the executors, to the same vectors."""
    df, k = known
    few = scan._pair_counts(df, "t", None)
    got = few.where("a < 'h' and b < 'h'").toPandas().sort_values(["a", "b"])
    keys = sorted({*got["a"], *got["b"]})
    at = {w: i for i, w in enumerate(keys)}
    want = scan.skip_grams(len(keys), got["a"].map(at).to_numpy(), got["b"].map(at).to_numpy(), got["n"].to_numpy(), 1, start=scan._start(keys))
    monkeypatch.setattr(scan, "BLOCK_WORDS", max(1, len(keys) // 3))
    apart = scan._collected(scan.skip_grams_apart(spark.createDataFrame(got), 1))
    assert apart[0] == keys and all(np.allclose(a, b, atol=1e-5) for a, b in zip(apart[1:], want))


@pytest.mark.parametrize("bound", ["MOST_PAIRS", "MOST_TRAINED"])
@pytest.mark.parametrize("most_words", [3, 500_000])
def test_beyond_the_driver_no_pair_is_lost(spark, monkeypatch, bound, most_words):
    """Past either bound the whole table of pairs is handed on, whether words stay a table or not."""
    df = spark.createDataFrame([(i, "styret vedtok vedlikehold av kaianlegg.\nstyret utsatte kaianlegg.") for i in range(5)], "id int, t string")
    seen = []
    monkeypatch.setattr(scan, bound, 2)
    monkeypatch.setattr(scan, "MOST_WORDS", most_words)
    real = scan.skip_grams_apart
    monkeypatch.setattr(scan, "skip_grams_apart", lambda pairs: seen.extend(tuple(r) for r in pairs.collect()) or real(pairs, 0))
    k = scan.learn([(df, "t", True)], spark)
    n = {(a, b): c for a, b, c in seen}
    assert len(n) == 7 and set(n.values()) == {5} and n["utsatte", "kaianlegg"] == 5
    if most_words == 3:
        assert k.words_table.where("win is not null").count() == 5
    else:
        assert len(k.at) == 5 and k.win.shape == (5, scan.DIMENSIONS)


def test_vectors_by_blocks_of_texts(spark, monkeypatch):
    """Blocks of texts get the vectors of the words around a choice, and choose as the dictionary does."""
    rows = [(i, "båten ligger ved kaia land her.\nhuset eier stor hage lund der.") for i in range(12)] + [(50, "båten ligger ved kaia l@nd her."), (51, "huset eier stor hage l@nd der.")]
    df = spark.createDataFrame(rows, "id int, t string")
    k = scan.learn([(df, "t", False)], spark)
    monkeypatch.setattr(scan, "MOST_WORDS", 3)
    few = scan.learn([(df, "t", False)], spark)
    a, b = (sorted((r.id, r.paragraphs) for r in scan.repaired(df, "id", "t", x, False).collect()) for x in (k, few))
    assert a == b and "land her" in dict(a)[50]
