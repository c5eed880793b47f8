import random

import numpy as np
import pytest

from ledgerloom.llm import match

ENTRIES = [("x:AFunksjon", "Avskrivning drivhus"), ("x:A", "Avskrivning drivhus"), ("x:B", "Kortsiktig lån til ansatte"), ("x:C", "Langsiktig lån til ansatte"), ("x:D", "Festeavgift tomt"), ("x:E", "Utestående B-aksjer")]
CASES = [
    ("Avskrivning drivhus", "x:A"), ("DRIVHUS, AVSKRIVNING", None), ("drivhus, Avskrivning", "x:A"), ("Note 4: Avskrivning  drivhus 2022", "x:A"), ("Avskr. drivhus", "x:A"), ("Avskriv-\nning drivhus", "x:A"), ("Avskrivningdrivhus", "x:A"), ("Avtkrivning drvhus", "x:A"),
    ("Korts. lån til ansatte", "x:B"), ("ansatte, Langs. lån til", "x:C"), ("kortsiktig laan til ansatte", "x:B"), ("Festeavgjft otmt", "x:D"), ("Ｆｅｓｔｅａｖｇｉｆｔ ｔｏｍｔ", "x:D"), ("Utestaende B-aksjer.", "x:E"),
    ("Avskrivning helikopter", None), ("Langsiktig lån til kommunen", None), ("Diverse", None), ("", None), (None, None), ("???", None), ("17", None),
]
CASES[1] = ("DRIVHUS, AVSKRIVNING", "x:A")


@pytest.fixture(scope="module")
def ref():
    return match.Reference(ENTRIES, lambda i: (i.endswith("Funksjon"), i))


@pytest.mark.parametrize(("q", "i"), CASES)
def test_cases(ref, q, i):
    assert ref.resolve(q)[0] == i


def test_lcs_against_brute_force():
    rng = random.Random(3)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 90))) for _ in range(2))
        assert match.lcs(a, b) == plain(a, b)


def test_index_skips_no_entry():
    """Every string that reaches the threshold is among those the index names."""
    rng = random.Random(8)
    words = ["avskrivning", "drivhus", "kortsiktig", "lan", "ansatte", "tomt", "aaaa", "abab", "x1", "gevinst"]
    strings = ["".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(200)]
    index = match.PairIndex(strings)
    for _ in range(150):
        s = list(rng.choice(strings))
        for _ in range(rng.randint(0, 6)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randint(0, 1)] = rng.choice(("", "e", "aa"))
        q = "".join(s)
        near = set(index.near(q, match.LEAST).tolist())
        assert {n for n, x in enumerate(strings) if match.ratio(q, x) >= match.LEAST} <= near


def test_abbreviations_are_found_by_index(ref, monkeypatch):
    """The same as when every entry is tried."""
    values = ["avskr. drivhus", "korts. lan til ans.", "festeavg. tomt", "avskrjv. drivh.", "utest. b-aksj.", "langs. lan til ansatte.", "avskr. helik."]
    got = [ref.abbreviated(v) for v in values]
    monkeypatch.setattr(match.Reference, "_beginning", lambda self, start: range(len(self.keys)))
    monkeypatch.setattr(match.PairIndex, "shared", lambda self, strings: np.full(len(self.lengths), 99))
    assert got == [ref.abbreviated(v) for v in values] and got[0] == "x:A"


def test_further_words_around_all_of_an_entry(ref):
    assert ref.resolve("til ansatte: kortsiktig lån, rentefritt")[0] == "x:B"
    assert ref.resolve("tomt")[0] is None and ref.resolve("lån til noen")[0] is None


def test_golden(spark, data):
    labels = spark.read.parquet(f"{data}/concept_labels.parquet").where("subject_kind = 'concept'")
    golden = spark.read.parquet(f"{data}/golden_labels.parquet")
    out = match.map_values(golden, "label", labels, "subject_id", "text", lambda i: (i.endswith("Funksjon"), i)).collect()
    assert len(out) == 51 and all(r.match_id == r.concept_id for r in out)


def test_table(spark):
    ref = spark.createDataFrame([*ENTRIES, (None, "y"), ("x:Z", None)], "id string, text string")
    df = spark.createDataFrame([(1, "Festeavgift tomt", "m"), (1, "Festeavgift tomt", "m"), (2, None, None), (3, "x" * 50_000, "m")], "k int, q string, method string")
    got = sorted((r.k, r.match_id, r.method) for r in match.map_values(df, "q", ref, "id", "text").collect())
    assert got == [(1, "x:D", "mention"), (1, "x:D", "mention"), (2, None, "none"), (3, None, "none")]
    assert match.map_values(df.limit(0), "q", ref, "id", "text").count() == 0
    assert {r.match_id for r in match.map_values(df, "q", ref.limit(0), "id", "text").collect()} == {None}
    with pytest.raises(ValueError, match="more than 2"):
        match.map_values(df, "q", ref, "id", "text", most_entries=2)
