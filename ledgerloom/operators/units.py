"""Quantities in different units and scales to one unit per kind (problem 5).

A multi-pattern automaton finds unit aliases in the unit column and in the text, the longest match
at a place winning; the field's kind settles aliases that several kinds share; the conversion
factors are then joined from a small table.
"""

from __future__ import annotations

import re
from decimal import ROUND_HALF_EVEN, Decimal, localcontext
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The common unit of each kind of concept.
COMMON = {"monetaryItemType": "NOK", "energyItemType": "kWh", "massItemType": "kg", "areaItemType": "m2", "sharesItemType": "shares", "percentItemType": "pure"}

#: Aliases of each unit, as kind, numerator and denominator of the factor to the common unit, aliases.
UNITS = [
    ("monetaryItemType", 1, 1, ["nok", "kr", "kr.", "kroner", "norske kroner", "krone"]),
    ("monetaryItemType", 1, 100, ["øre"]),
    ("monetaryItemType", 1000, 1, ["tnok", "knok", "nok 1000", "nok 1 000", "1000 nok", "nok'000", "nok '000", "tkr", "kkr", "tusen kroner", "tusen kr", "kr 1000", "1000 kr", "i hele 1000", "hele 1000", "i hele tusen", "hele tusen", "tusen nok", "i tusen"]),
    ("monetaryItemType", 10**6, 1, ["mnok", "nok mill.", "nok mill", "mill. kr", "mill kr", "mill. kroner", "millioner kroner", "millioner", "mill. nok", "mill nok", "mill.", "mkr"]),
    ("monetaryItemType", 10**9, 1, ["mrd. kr", "mrd kr", "mrd. kroner", "milliarder kroner", "milliarder", "mrd. nok", "nok mrd.", "nok mrd", "mrdnok", "mrd."]),
    ("energyItemType", 1, 1000, ["wh"]),
    ("energyItemType", 1, 1, ["kwh"]),
    ("energyItemType", 1000, 1, ["mwh"]),
    ("energyItemType", 10**6, 1, ["gwh"]),
    ("energyItemType", 10**9, 1, ["twh"]),
    ("energyItemType", 10, 36, ["mj"]),
    ("energyItemType", 10**4, 36, ["gj"]),
    ("energyItemType", 10**7, 36, ["tj"]),
    ("massItemType", 1, 1000, ["g", "gram"]),
    ("massItemType", 1, 10, ["hg"]),
    ("massItemType", 1, 1, ["kg", "kilo", "kilogram", "kg co2e"]),
    ("massItemType", 1000, 1, ["t", "tonn", "tonne", "tonnes", "tonn co2e", "tonn co2", "t co2e"]),
    ("massItemType", 10**6, 1, ["kt", "tusen tonn", "1000 tonn", "kilotonn"]),
    ("massItemType", 10**9, 1, ["mt", "mill. tonn"]),
    ("areaItemType", 1, 1, ["m2", "m²", "kvm", "kvadratmeter"]),
    ("areaItemType", 1000, 1, ["dekar", "daa", "mål"]),
    ("areaItemType", 10**4, 1, ["ha", "hektar"]),
    ("areaItemType", 10**6, 1, ["km2", "km²", "kvadratkilometer"]),
    ("sharesItemType", 1, 1, ["shares", "aksjer", "aksje", "stk", "stk.", "andeler"]),
    ("sharesItemType", 1000, 1, ["1000 aksjer", "tusen aksjer", "tusen stk", "1000 stk"]),
    ("sharesItemType", 10**6, 1, ["mill. aksjer", "mill aksjer", "millioner aksjer", "mill. stk"]),
    ("percentItemType", 1, 1, ["pure", "ratio"]),
    ("percentItemType", 1, 100, ["%", "pct", "pct.", "prosent", "percent", "per cent"]),
    ("percentItemType", 1, 1000, ["‰", "promille"]),
    ("percentItemType", 1, 10**4, ["bps", "bp", "basispunkter", "basispunkt", "basis points"]),
]

#: What `decimals` means for money.
MONEY_DECIMALS = {-3: 1000, -6: 10**6}

#: Words that may stand next to a number without being its unit.
LINKING = set("ca cirka om lag utgjør utgjorde utgjer er var på til av fra frå i og per pr inkl ekskl totalt sum total beløp beløpet minus pluss antall tal alt samlet about is was of and the at to in approx amount value figure".split())

BLANKS = "\u00a0\u202f\u2009\u200b"
NUMBER = re.compile(r"(?<![\w.,])(?P<open>\(\s*)?(?P<sign>[-−–]\s*)?(?P<n>\d{1,3}(?:[ .]\d{3})+(?!\d)|\d+)(?:,(?P<d>\d+))?(?P<close>\s*\))?")


def factor_table(spark: SparkSession) -> DataFrame:
    """``kind, unit_id, up, down``: one row per unit, about thirty in all."""
    return spark.createDataFrame([(k, i, str(up), str(down)) for i, (k, up, down, _) in enumerate(UNITS)], "kind string, unit_id int, up string, down string")


@lru_cache(maxsize=1)
def alias_automaton():
    """The automaton over all aliases; a value is a list of (kind, unit id)."""
    import ahocorasick

    by: dict[str, list[tuple[str, int]]] = {}
    for i, (kind, _, _, aliases) in enumerate(UNITS):
        for a in aliases:
            by.setdefault(a, []).append((kind, i))
    found = ahocorasick.Automaton()
    for a, of in by.items():
        found.add_word(a, (len(a), of))
    found.make_automaton()
    return found


def _plain(text: str) -> str:
    t = re.sub(f"[{BLANKS}\\s]+", " ", text).strip().replace("’", "'").replace("−", "-").lower()
    return t


def unit_mentions(text: str, kind: str) -> list[tuple[int, int, int]]:
    """(start, end, unit id) of the units of a kind in a plain text: longest first, not overlapping.

    A match must not go on as a word on either side; a digit may stand directly before it, as in
    ``12kr``, unless the alias starts with a digit itself.
    """
    hits = []
    for end, (size, of) in alias_automaton().iter(text):
        start, stop = end - size + 1, end + 1
        before, after = text[start - 1 : start], text[stop : stop + 1]
        if before.isalpha() or before in ("'",) or (before.isdigit() and text[start].isdigit()):
            continue
        if text[stop - 1].isalnum() and after.isalnum() and not (text[stop - 1].isalpha() and after.isdigit() and size > 1):
            continue
        for k, i in of:
            if k == kind:
                hits.append((start, stop, i))
    hits.sort(key=lambda h: (h[0] - h[1], h[0]))
    kept: list[tuple[int, int, int]] = []
    for h in hits:
        if all(h[1] <= a or h[0] >= b for a, b, _ in kept):
            kept.append(h)
    return sorted(kept)


def _numbers(text: str, units: list[tuple[int, int, int]]) -> list[tuple[int, int, Decimal]]:
    masked = text
    for a, b, _ in units:
        masked = masked[:a] + "\0" * (b - a) + masked[b:]
    out = []
    for m in NUMBER.finditer(masked):
        after, before = masked[m.end() : m.end() + 1], masked[: m.start()]
        if after.isalpha() or re.match(r"\.\d", masked[m.end() :]) or re.search(r"\b(?:note|noter|notes|per|pr\.?|nr\.?)\s*$", before):
            continue  # dates, references to notes, numbers inside words
        value = Decimal(re.sub(r"[ .]", "", m["n"]) + ("." + m["d"] if m["d"] else ""))
        if m["sign"] or (m["open"] and m["close"]):
            value = -value
        out.append((m.start(), m.end(), value))
    return out


def _bare(text: str, number: tuple[int, int, Decimal]) -> bool:
    """Whether a number stands alone: no word or sign that could be a unit of any kind is next to it."""
    after = re.match(r"[\s(]*([^\W\d_]+|[^\w\s.,;:()\[\]\"'!?*/|<>=–-])", text[number[1] :])
    before = re.search(r"([^\W\d_]+|[^\w\s.,;:()\[\]\"'!?*/|<>=–-])[\s.:(]*$", text[: number[0]])
    return all(m is None or m[1] in LINKING for m in (after, before))


def read_quantity(kind, number, text, unit, decimals):
    """(value, unit id, decimals' scale, whether from text) of a fact, or None if it has no quantity.

    ``number`` counts before ``text``; of several numbers in a text the one nearest a unit counts, of
    equals the first. The unit comes from the unit column, else from the text, else is the common
    one. An unknown unit makes a fact unreadable; in a text without a unit column, so does any word or
    sign next to the number that is neither a known unit nor a linking word (``EUR 100``, ``5 lb``).
    """
    if kind not in COMMON:
        return None
    plain = _plain(text) if isinstance(text, str) else ""
    said = unit_mentions(plain, kind) if plain else []
    value, near, from_text = None, None, False
    if number is not None and number == number and abs(number) != float("inf"):
        value = Decimal(repr(float(number)))
        near = said[0][2] if said else None
    elif plain:
        numbers = _numbers(plain, said)
        if not numbers:
            return None
        gap = lambda n, u: max(u[0] - n[1], n[0] - u[1])
        n, u = min(((n, u) for n in numbers for u in said), key=lambda x: (gap(*x), x[0][0]), default=(numbers[0], None))
        value, near, from_text = n[2], u[2] if u else None, True
    if value is None:
        return None
    stated = isinstance(unit, str) and unit.strip()
    if from_text and near is None and not stated and not _bare(plain, n):
        return None
    if isinstance(unit, str) and unit.strip():
        own = _plain(unit)
        in_column = [h for h in unit_mentions(own, kind)]
        whole = [h for h in in_column if h[1] - h[0] >= len(own) - 1]
        if not whole:
            if not in_column:
                return None
            whole = in_column
        if near is None or UNITS[near][1:3] == (1, 1) or UNITS[whole[0][2]][1:3] != (1, 1):
            near = whole[0][2]
    scale = MONEY_DECIMALS.get(int(decimals), 1) if kind == "monetaryItemType" and decimals is not None and decimals == decimals else 1
    return value, near, scale, from_text


def read_quantities(df: DataFrame, kind: str, number: str, text: str, unit: str, decimals: str) -> DataFrame:
    """``df`` with ``__q``: struct of value (text of a decimal), unit_id (-1: none said), scale, from_text; null if unreadable."""
    schema = "value string, unit_id int, scale long, from_text boolean"

    @F.pandas_udf(schema)
    def run(k: pd.Series, n: pd.Series, t: pd.Series, u: pd.Series, d: pd.Series) -> pd.DataFrame:
        out = []
        for row in zip(k, n, t, u, d):
            q = read_quantity(*row)
            out.append((None, None, None, None) if q is None else (str(q[0]), -1 if q[1] is None else q[1], q[2], q[3]))
        return pd.DataFrame(out, columns=["value", "unit_id", "scale", "from_text"]).astype({"unit_id": "Int32", "scale": "Int64", "from_text": "boolean"})

    return df.withColumn("__q", run(F.col(kind), F.col(number).cast("double"), F.col(text), F.col(unit), F.col(decimals).cast("double")))


def micro(value: str, up: str, down: str, scale: int) -> int | None:
    """value x up / down in millionths, rounded half to even; None beyond 64 bits."""
    with localcontext() as ctx:
        ctx.prec = 60
        x = (Decimal(value) * int(up) * scale * 10**6 / int(down)).to_integral_value(ROUND_HALF_EVEN)
    return int(x) if -(2**63) <= x < 2**63 else None


def in_common_units(df: DataFrame, kind: str, number: str, text: str, unit: str, decimals: str) -> DataFrame:
    """``df`` with ``common_unit``, ``amount_micro`` and ``converted``.

    ``converted`` is true where the quantity can be read but is not already ``number`` in the common
    unit. A scale stated twice (by unit and decimals) is one scale. Null, empty and unreadable texts,
    references to notes, kinds without a unit and amounts beyond 64 bits give nulls and false. The
    factor table has some thirty rows and is broadcast. Columns of ``df`` named like the results are
    replaced, other columns stay.
    """
    spark = df.sparkSession
    df = df.drop("common_unit", "amount_micro", "converted")
    keep = df.columns
    q = read_quantities(df, kind, number, text, unit, decimals)
    factors = factor_table(spark).select(F.col("unit_id").alias("__id"), F.col("up").alias("__up"), F.col("down").alias("__down"))
    q = q.join(F.broadcast(factors), F.col("__q.unit_id") == F.col("__id"), "left")
    up, down = F.coalesce("__up", F.lit("1")), F.coalesce("__down", F.lit("1"))
    # money in a plain unit takes the scale from decimals; a scaled or split unit has stated it already
    scale = F.when((up == "1") & (down == "1"), F.col("__q.scale")).otherwise(F.lit(1).cast("long"))

    @F.pandas_udf("long")
    def amount(v: pd.Series, a: pd.Series, b: pd.Series, s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else micro(x, i, j, int(k)) for x, i, j, k in zip(v, a, b, s)], dtype="Int64")

    amount = amount.asNondeterministic()  # a filter on the result would have it computed once more

    common = F.create_map(*[F.lit(x) for kv in COMMON.items() for x in kv])
    changed: Column = F.col("__q.from_text") | (up != "1") | (down != "1") | (scale != 1)
    out = q.withColumn("amount_micro", amount(F.col("__q.value"), up, down, F.coalesce(scale, F.lit(1).cast("long"))))
    return out.select(
        *keep,
        F.when(F.col("amount_micro").isNotNull(), common[F.col(kind)]).alias("common_unit"),
        "amount_micro",
        F.coalesce(changed & F.col("amount_micro").isNotNull(), F.lit(False)).alias("converted"),
    )
