import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.functions.geometry import iou, polygon_box, scaled


def one(spark, fn, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("t", "v"), [("1 234 567", [1234567]), ("(90 488)", [-90488]), ("−5 og 5", [-5, 5]), ("12 345\n678", [12345678]), ("a12 0 00", []), ("12 345 678", [12345678]), ("", []), (None, None), ("9" * 30, [])])
def test_numeric_tokens(spark, t, v):
    assert one(spark, text.numeric_tokens, t) == v


@pytest.mark.parametrize(("t", "v"), [("(1 234)", -1234.0), ("−12,5", -12.5), ("1.5", 1.5), ("(-3)", 3.0), ("1d", None), ("", None), (None, None), ("1 000", 1000.0), ("1e3", 1000.0), ("nan", None)])
def test_parse_value(spark, t, v):
    assert one(spark, text.parse_value, t) == v


@pytest.mark.parametrize(("t", "v"), [("a‐b", "a-b"), ("  x   y ", "x y"), ("( 12 345 )", "-12 345 "), ("ﬁn", "fin"), (None, None), ("", "")])
def test_normalise(spark, t, v):
    assert one(spark, text.normalise_text, t) == v


def test_small_functions(spark):
    assert one(spark, text.grouped, -1234567, "long") == "-1 234 567"
    assert one(spark, text.grouped, 0, "long") == "0"
    assert one(spark, text.snake_name, "x:SumEiendelerIFRSTest") == "sum_eiendeler_ifrstest"
    assert one(spark, text.engine_languages, ["nb", "nn", "en", "fr"], "array<string>") == "nor+eng+fr"
    assert one(spark, text.engine_languages, [], "array<string>") == "nor"
    assert one(spark, text.nynorsk_to_bokmal, "rekneskap og eigedelar") == "regnskap og eiendeler"
    assert one(spark, text.nynorsk_to_bokmal, "rekneskap (regnskap)") == "rekneskap (regnskap)"
    assert one(spark, text.label_form, "  Eigedelar Ｘ ") == "eiendeler x"
    assert one(spark, text.word_tokens, "Sum A eiendeler SUM 12 ﬁn") == ["eiendeler", "fin", "sum"]
    assert one(spark, text.coarse_numbers, "kr 1 234, 99, −500") == [-500, 1234]
    assert one(spark, text.looks_numeric, "(1 2.3)") and one(spark, text.looks_numeric, ".") and not one(spark, text.looks_numeric, "−5")


@pytest.mark.parametrize(("v", "s"), [(10.0, "10"), (0.0, "0"), (1.5, "1.5"), (123456.0, "123456"), (1234567.0, "1.23457e+06"), (0.0001, "0.0001"), (-30.25, "-30.25")])
def test_short_number(spark, v, s):
    assert one(spark, text.short_number, v, "double") == s == f"{v:g}"


def test_boxes(spark):
    b = "struct<l:double,t:double,r:double,b:double>"
    df = spark.createDataFrame([((0.0, 0.0, 10.0, 10.0), (5.0, 0.0, 15.0, 10.0)), ((0.0, 0.0, 1.0, 1.0), (2.0, 2.0, 3.0, 3.0)), ((0.0, 0.0, 1.0, 1.0), None), ((0.0, 0.0, 0.0, 9.0), (0.0, 0.0, 0.0, 9.0))], f"a {b}, b {b}")
    assert [r.x for r in df.select(iou(F.col("a"), F.col("b")).alias("x")).collect()] == [50 / 150, 0.0, None, 0.0]
    p = spark.createDataFrame([([[1.9, 2.0], [5.5, 0.2]],)], "p array<array<double>>").select(polygon_box(F.col("p")).alias("b"))
    assert tuple(p.first().b) == (1.0, 0.0, 5.0, 2.0)
    assert tuple(df.select(scaled(F.col("a"), 3).alias("b")).first().b) == (0.0, 0.0, 30.0, 30.0)
