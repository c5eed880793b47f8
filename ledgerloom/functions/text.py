"""Text and number functions as columns; Arrow functions only where the JVM has no equivalent."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Six hyphens and dashes that count as a minus; blanks that group digits.
DASHES = "‐‑‒–—−"
GROUP_BLANKS = "\u00a0\u202f\u2009"

#: Word forms of one written standard and their counterpart in the other.
NN_TO_NB = {
    "eigedelar": "eiendeler",
    "eigedel": "eiendel",
    "eigenkapital": "egenkapital",
    "eigenkapitaltilskot": "egenkapitaltilskudd",
    "omløpsmidlar": "omløpsmidler",
    "rekneskap": "regnskap",
    "rekneskapsår": "regnskapsaar",
    "rekneskapsåret": "regnskapsaaret",
    "rekneskapsprinsipp": "regnskapsprinsipp",
    "lønskostnad": "lønnskostnad",
    "lønskostnader": "lønnskostnader",
    "salsinntekt": "salgsinntekt",
    "påverkar": "paavirker",
    "føresegn": "bestemmelse",
    "føresetnad": "forutsetning",
    "kvar": "hver",
    "kvart": "hvert",
    "ikkje": "ikke",
    "berre": "bare",
    "saman": "sammen",
    "synast": "synes",
    "vere": "være",
    "blei": "ble",
    "vart": "ble",
    "innan": "innen",
    "rekna frå": "regnet fra",
}

#: Language codes of the engines.
ENGINE_LANGUAGES = {"no": "nor", "nb": "nor", "nn": "nor", "en": "eng"}


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def _nfkc_casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).casefold())


def _beyond_ascii(c: Column, plain: Column, function) -> Column:
    """``plain`` for ASCII texts, in the JVM; only the others are sent to Python, nulls in place of the rest."""
    ascii_only = c.rlike(r"^\p{ASCII}*$")
    return F.when(c.isNull() | ascii_only, plain).otherwise(function(F.when(~ascii_only, c)))


def nfkc(c: Column) -> Column:
    """NFKC; ASCII texts come back as they are."""
    return _beyond_ascii(c, c, _nfkc)


def nfkc_casefold(c: Column) -> Column:
    """NFKC, then full case folding."""
    return _beyond_ascii(c, F.lower(c), _nfkc_casefold)


def plain_minus(c: Column) -> Column:
    """Dash variants as the ASCII minus (OP-T1)."""
    return F.translate(c, DASHES, "-" * len(DASHES))


def one_blank(c: Column) -> Column:
    """Runs of white space as one blank, without outer ones."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def whole_negative(c: Column) -> Column:
    """A text that is one parenthesised number, with a minus instead; the inner blanks stay."""
    inner = F.regexp_extract(c, r"(?U)^\(\s*([\d\s.,]+)\s*\)$", 1)
    return F.when(inner != "", F.concat(F.lit("-"), inner)).otherwise(c)


def normalise_text(c: Column, compatibility: bool = True) -> Column:
    """The form in which readings are compared (OP-V1); null stays null.

    ``compatibility=False`` leaves out NFKC and stays in the JVM.
    """
    return whole_negative(one_blank(plain_minus(nfkc(c) if compatibility else c)))


def digits_to_long(c: Column) -> Column:
    """An integer without its grouping blanks (OP-T2); null if it does not fit 64 bits."""
    return F.regexp_replace(c, rf"(?U)[\s{GROUP_BLANKS}]", "").try_cast("long")


_INT = rf"\d{{1,3}}(?:[\s{GROUP_BLANKS}]\d{{3}})+|\d+"


def numeric_tokens(c: Column) -> Column:
    """The distinct signed integers of a text, sorted (OP-T3).

    Parenthesised ones are negative; zero is left out; groups may go on over a line end. Null gives
    null, a text without numbers an empty array; numbers beyond 64 bits are left out.
    """
    t = plain_minus(c)
    in_parens = rf"(?U)\(\s*({_INT})\s*\)"
    negative = F.transform(F.regexp_extract_all(t, F.lit(in_parens), F.lit(1)), lambda x: -digits_to_long(x))
    rest = F.regexp_replace(t, in_parens, " ")
    signed = F.transform(F.regexp_extract_all(rest, F.lit(rf"(?U)(?<!\w)(-?(?:{_INT}))(?!\w)"), F.lit(1)), digits_to_long)
    both = F.array_union(negative, signed)
    return F.array_sort(F.filter(both, lambda x: x.isNotNull() & (x != 0)))


def coarse_numbers(c: Column, least: int = 100) -> Column:
    """Integers of a text after joining digit runs over blanks, from ``least`` on, sorted (OP-E8)."""
    t = F.translate(c, "−–", "--")
    joined = F.regexp_replace(t, rf"(?U)(?<=\d)[\s{GROUP_BLANKS[:2]}]+(?=\d)", "")
    found = F.transform(F.regexp_extract_all(joined, F.lit(r"(-?[0-9]+)"), F.lit(1)), lambda x: x.try_cast("long"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (F.abs(x) >= least))))


def word_tokens(c: Column, least: int = 2, compatibility: bool = True) -> Column:
    """The distinct words of a text in lower case, sorted (OP-T4); the length counts before folding."""
    t = nfkc(c) if compatibility else c
    found = F.regexp_extract_all(t, F.lit("([A-Za-zÀ-ſ]+)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda x: F.length(x) >= least), F.lower)))


def grouped(c: Column) -> Column:
    """An integer in groups of three digits parted by blanks (OP-T9)."""
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), F.translate(F.format_number(F.abs(c).cast("decimal(20,0)"), 0), ",", " "))


def nynorsk_to_bokmal(c: Column) -> Column:
    """Word forms rewritten inside the text, longest first, where the counterpart isn't there yet (OP-R2)."""
    pairs = F.array(*[F.struct(F.lit(nn).alias("nn"), F.lit(NN_TO_NB[nn]).alias("nb")) for nn in sorted(NN_TO_NB, key=lambda k: (-len(k), k))])
    # a fold: a chain of conditions would double the expression with every pair
    return F.aggregate(pairs, c.cast("string"), lambda t, p: F.when(F.contains(t, p["nn"]) & ~F.contains(t, p["nb"]), F.replace(t, p["nn"], p["nb"])).otherwise(t))


def label_form(c: Column, nynorsk: bool = True) -> Column:
    """The form in which labels are looked up (OP-R1)."""
    t = one_blank(nfkc_casefold(c))
    return nynorsk_to_bokmal(t) if nynorsk else t


def looks_numeric(c: Column) -> Column:
    """Whether a text looks like a number (OP-N1): ASCII minus, parentheses, digits, blanks, points, commas."""
    return F.trim(c).rlike(r"(?U)^-?\(?[\d\s .,]+\)?$")


def parse_value(c: Column) -> Column:
    """A number as it is printed, as a double (OP-A1); null if it can't be read.

    Outer parentheses negate, also a number with a minus; only blanks and no-break spaces group;
    commas become points where there is no point.
    """
    t = F.trim(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    parens = t.startswith("(") & t.endswith(")")
    t = F.when(parens, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)
    t = F.translate(plain_minus(t), " \u00a0", "")
    t = F.regexp_replace(t, r"(?U)^\s+|\s+$", "")
    t = F.when(~F.contains(t, F.lit(".")), F.replace(t, F.lit(","), F.lit("."))).otherwise(t)
    number = F.when(t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), t.try_cast("double"))
    return F.when(parens, -number).otherwise(number)


def engine_languages(codes: Column) -> Column:
    """Language codes as the engines name them, joined by ``+``; ``nor`` if there is none (OP-O12)."""
    table = F.create_map(*[F.lit(x) for kv in ENGINE_LANGUAGES.items() for x in kv])
    named = F.array_distinct(F.transform(F.filter(codes, lambda x: x.isNotNull()), lambda x: F.coalesce(F.try_element_at(table, x), x)))
    return F.when(F.size(named) > 0, F.array_join(named, "+")).otherwise(F.lit("nor"))


def snake_name(c: Column) -> Column:
    """A prefixed CamelCase name as snake case; none within runs of capitals (OP-G1)."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, "^[^:]*:", ""), r"(?U)(?<=[^\p{Lu}])(\p{Lu})", "_$1"))


def short_number(c: Column) -> Column:
    """A double with up to six significant digits and no trailing zeros, as ``%g`` prints it (part of OP-N7)."""
    a = F.abs(c)
    exponent = F.when(a == 0, F.lit(0)).otherwise(F.floor(F.log10(a))).cast("int")
    plain = F.regexp_replace(F.regexp_replace(F.format_string("%.10f", F.round(c * F.pow(F.lit(10.0), 5 - exponent), 0) / F.pow(F.lit(10.0), 5 - exponent)), "0+$", ""), r"\.$", "")
    return F.when((exponent >= -4) & (exponent < 6), plain).otherwise(F.regexp_replace(F.regexp_replace(F.format_string("%.5e", c), r"0+e", "e"), r"\.e", "e"))
