import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import normal

CASES = [
    ("Pr. 31.12", "Pr. 31.12"), ("Årsresultat", "Årsresultat"), ("Α̊rsresultat", "Årsresultat"), ("ΝΟΚ 5", "NOK 5"), ("В-aksjer", "B-aksjer"), ("β-νerdi", "β-verdi"),
    ("25 °С", "25 °C"), ("20Ι8", "20I8"), ("６５", "65"), ("Oﬀentlig", "Offentlig"), ("CO₂‑avgift", "CO₂-avgift"), ("0­00", "000"), ("e‍́", "é"), ("Kr", "Kr"), ("−１", "-1"), ("​", ""),
]
SAME = ["m²", "½ stilling", "ООО Северный", "Москва", "Мо'сква", "Ωμέγα", "Δ egenkapital", "  a  b ", "", "§ 6-1", "Zoë", "sti1ling"]


@pytest.mark.parametrize(("t", "v"), CASES)
def test_changes(t, v):
    assert normal.consistent(t) == v


@pytest.mark.parametrize("t", SAME)
def test_stays(t):
    assert normal.consistent(t) == t


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aÁ̊аАο​­Ａ  -'O0")), max_size=30))
def test_fixed_point(t):
    once = normal.consistent(t)
    assert normal.consistent(once) == once


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcåø é̊̈", max_size=40))
def test_segments_equal_the_whole(t):
    """Splicing normalised segments gives what normalising the whole text gives."""
    assert normal.consistent(t) == unicodedata.normalize("NFC", t)


def test_table(spark):
    df = spark.createDataFrame([(1, "a", 9), (2, None, 9), (3, "Ａ", 9), (3, "Ａ", 9), (4, " " * 100_000, 9), (5, "", 9)], "id int, t string, consistent_text int")
    assert sorted(r.id for r in normal.changed_rows(df, "t").collect()) == [3, 3, 4]
    out = normal.with_consistent(df, "t").collect()
    assert len(out) == 6 and {r.id: r.consistent_text for r in out if r.id != 4} == {1: "a", 2: None, 3: "A", 5: ""}
    assert normal.changed_rows(df.limit(0), "t").count() == 0


@pytest.mark.parametrize("text", ["\u1100\u1161\u11a8", "\u09c7\u09be", "\u09c7\u09d7 x", "a\u1100\u1161b", "\u0b47\u0b56", "\u1025\u102e"])
def test_marks_without_a_combining_class_compose(text):
    assert normal.consistent(text) == unicodedata.normalize("NFC", text) != text


def test_quick_check_agrees_with_normalisation():
    """A text of characters that all have *yes* is composed, whatever their order."""
    rng = random.Random(2)
    some = [chr(c) for c in (*range(0xA0, 0x600), *range(0x900, 0xA00), *range(0x1100, 0x1200), *range(0x1E00, 0x1F00), *range(0xAC00, 0xAC40)) if unicodedata.category(chr(c)) != "Cn"]
    yes = [c for c in some if normal.quick_check(c) == "yes" and not unicodedata.combining(c)]
    assert {normal.quick_check(c) for c in some} == {"yes", "no", "maybe"}
    for _ in range(3000):
        t = "".join(rng.choices(yes, k=4))
        assert unicodedata.is_normalized("NFC", t)
    assert all(not unicodedata.is_normalized("NFC", c) for c in some if normal.quick_check(c) == "no")


@pytest.mark.parametrize(("text", "want"), [("s\u03b1ldo", "saldo"), ("kred\u0131tt", "kreditt"), ("\u0501rift", "drift"), ("\u04bbus", "hus"), ("\u0251ksje", "aksje"), ("\u03b1-partikler", "\u03b1-partikler"), ("\u03bb\u03b1\u03bf\u03c2", "\u03bb\u03b1\u03bf\u03c2")])
def test_more_lookalikes(text, want):
    assert normal.consistent(text) == want


def test_a_long_neighbour_is_seen_whole():
    """The neighbouring word decides by a letter beyond any fixed window."""
    word = "\u0430\u0441"  # two letters that look like a and c
    far = "\u0440\u043e\u0441\u0441\u0438\u044f" + "\u0430" * 60
    assert normal.consistent(f"{far} {word}", frozenset({"ac"})) == f"{far} {word}"
    assert normal.consistent(f"bank {word}", frozenset({"ac"})) == "bank ac"


def test_one_scan(spark):
    df = spark.createDataFrame([("a",), (None,), ("\u212b",), ("",)], "t string")
    out = normal.with_consistent(df, "t")
    assert [r.consistent_text for r in out.collect()] == ["a", None, "\u00c5", ""]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1
