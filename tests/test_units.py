import pytest

from ledgerloom.operators import units

CASES = [
    ("monetaryItemType", 56869.0, None, "NOK", -3, 56869000 * 10**6, True),
    ("monetaryItemType", 97.4, None, "NOK mill.", -6, 97400000 * 10**6, True),
    ("monetaryItemType", 8299.9, None, "TNOK", -3, 8299900 * 10**6, True),
    ("monetaryItemType", None, "(3,2) mrd. kr", None, 0, -3200000000 * 10**6, True),
    ("monetaryItemType", None, "9421,6 (NOK 1000)", None, 0, 9421600 * 10**6, True),
    ("monetaryItemType", None, "-342,6 (i hele 1000)", None, 0, -342600 * 10**6, True),
    ("monetaryItemType", None, "utgjør 365,1 kr inkl. avdelinger", None, 0, 365100000, True),
    ("monetaryItemType", None, "660,6 kr per 31.12", None, 0, 660600000, True),
    ("monetaryItemType", None, "kr 0,3", None, 0, 300000, True),
    ("monetaryItemType", 155.4, "mill. kr", None, 0, 155400000 * 10**6, True),
    ("monetaryItemType", 695.09, None, "øre", 0, 6950900, True),
    ("monetaryItemType", 7501991.0, "7 501 991", None, 2, 7501991 * 10**6, False),
    ("monetaryItemType", 5.0, "oppgitt i kr", None, 0, 5 * 10**6, False),
    ("monetaryItemType", None, "se note 7", None, 0, None, False),
    ("monetaryItemType", None, "-", "NOK", 0, None, False),
    ("monetaryItemType", None, None, None, 0, None, False),
    ("energyItemType", 7545.5, None, "Wh", 0, 7545500, True),
    ("energyItemType", None, "1339,2 GJ", None, 0, 372000 * 10**6, True),
    ("energyItemType", 5.0, None, "kwh", 0, 5 * 10**6, False),
    ("massItemType", 334.8, None, "kt", 0, 334800000 * 10**6, True),
    ("massItemType", 2381.1, "alle tall i tonn CO2e", None, 0, 2381100 * 10**6, True),
    ("massItemType", 2.5, None, "Kg", -3, 2500000, False),
    ("areaItemType", 98757.0, "dekar", None, 0, 98757000 * 10**6, True),
    ("areaItemType", None, "111m2", None, 0, 111 * 10**6, True),
    ("percentItemType", 74.62, None, "prosent", 0, 746200, True),
    ("percentItemType", None, "‰ 99,37", None, 0, 99370, True),
    ("percentItemType", 0.1715, "0,1715", None, 0, 171500, False),
    ("sharesItemType", None, "3 235 (1000 aksjer)", None, 0, 3235000 * 10**6, True),
    ("sharesItemType", None, "240,8 mill. aksjer", None, 0, 240800000 * 10**6, True),
    ("stringItemType", None, "15 kroner", None, 0, None, False),
    (None, 1.0, None, None, None, None, False),
    ("monetaryItemType", 1.0, None, "furlongs", 0, None, False),
    ("monetaryItemType", None, "EUR 100", None, 0, None, False),
    ("monetaryItemType", None, "100 €", None, 0, None, False),
    ("massItemType", None, "5 lb", None, 0, None, False),
    ("massItemType", None, "5 lb", "kg", 0, 5 * 10**6, True),
    ("areaItemType", None, "12 (sq ft)", None, 0, None, False),
    ("massItemType", None, "utgjør 5", None, 0, 5 * 10**6, True),
    ("sharesItemType", None, "1 000", None, 0, 1000 * 10**6, True),
    ("monetaryItemType", 1e300, None, "NOK", 0, None, False),
]


@pytest.fixture(scope="module")
def result(spark):
    df = spark.createDataFrame([(i, *c[:5], "own") for i, c in enumerate(CASES)], "id int, kind string, n double, t string, u string, d int, up string")
    return {r.id: r for r in units.in_common_units(df, "kind", "n", "t", "u", "d").collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_cases(result, i):
    assert (result[i].amount_micro, result[i].converted) == CASES[i][5:], CASES[i]
    assert (result[i].common_unit is None) == (result[i].amount_micro is None)
    assert result[i].up == "own"  # an extra column named like an internal one stays


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], "kind string, n double, t string, u string, d int, amount_micro string")
    out = units.in_common_units(df, "kind", "n", "t", "u", "d")
    assert out.count() == 0 and dict(out.dtypes)["amount_micro"] == "bigint"


def test_long_text(spark):
    df = spark.createDataFrame([("monetaryItemType", None, "tekst " * 20000 + "12 kr", None, None)], "kind string, n double, t string, u string, d int")
    assert units.in_common_units(df, "kind", "n", "t", "u", "d").first().amount_micro == 12 * 10**6
