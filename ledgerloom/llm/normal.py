"""Visually identical text in one consistent form (problem 4).

A text is scanned once with quick-check properties: characters that are stable under composition and
are no variant of a plain one are skipped. What remains are unstable segments. Each is widened to its
boundary context (the starter before a combining mark, the word around a look-alike letter), brought
into form on its own and spliced into the unchanged rest.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that look like Latin ones, in the order of the Latin letters.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТХУаеорсухѕіј", "ABESIJKMHOPCTXYaeopcyxsij"))
CYRILLIC |= dict(zip("ԁһӏԛԝѵ", "dhlqwv"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοαιρ", "ABEZHIKMNOPTYXvoaip"))
LATIN = dict(zip("ɑɡı", "agi"))
LOOKALIKE = CYRILLIC | GREEK | LATIN

#: Hyphens and minus signs that look like the plain one, and quotes.
DASHES = "‐‑‒–—―−﹘﹣－"
QUOTES = {"‘": "'", "’": "'", "ʼ": "'", "′": "'", "“": '"', "”": '"', "″": '"'}

#: Words that may consist of look-alike letters alone and still be Latin: units, currencies, abbreviations and short words.
SHORT_WORDS = {"nok", "sek", "eur", "kr", "mva", "mnok", "tnok", "co", "a", "i", "e", "c", "b", "h", "k", "m", "t", "p", "o", "x", "ha", "kt", "mt", "as", "asa", "sa", "ba", "pr", "per", "kai", "eea", "jo", "ok"}

_INVISIBLE_CATEGORIES = {"Cf"}
_COMPAT_FOLDED = {"<wide>", "<narrow>", "<font>"}


@lru_cache(maxsize=65536)
def plain_of(ch: str) -> str:
    """The plain form of one character: itself if it has none, empty if it can't be seen."""
    if ch in DASHES:
        return "-"
    if ch in QUOTES:
        return QUOTES[ch]
    category = unicodedata.category(ch)
    if category in _INVISIBLE_CATEGORIES or "︀" <= ch <= "️" or ch in "͏ᅟᅠ឴឵ㅤ":
        return ""
    if category == "Zs":
        return " "
    kind = unicodedata.decomposition(ch).split(" ")[0]
    if kind in _COMPAT_FOLDED or "ﬀ" <= ch <= "ﬆ":
        return "".join(plain_of(x) if x != ch else x for x in unicodedata.normalize("NFKC", ch))
    if category == "Nd" and not ch.isascii():
        return str(unicodedata.digit(ch))
    return ch


@lru_cache(maxsize=1)
def joining() -> frozenset[str]:
    """The characters whose quick-check property for composed text is *maybe*: they may compose with what stands before them."""
    out = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}  # vowels and finals of Hangul syllables
    for c in range(0xA0, 0x30000):
        parts = unicodedata.decomposition(chr(c)).split(" ")
        if len(parts) == 2 and parts[0][:1] != "<" and unicodedata.is_normalized("NFC", chr(c)):
            out.add(chr(int(parts[1], 16)))
    return frozenset(out)


def quick_check(ch: str) -> str:
    """The quick-check property of a character for composed text: yes, no or maybe."""
    if not unicodedata.is_normalized("NFC", ch) and ch not in joining():
        return "no"
    return "maybe" if ch in joining() else "yes"


@lru_cache(maxsize=65536)
def is_stable(ch: str) -> bool:
    """``ch`` composes with nothing before it, is composed itself, plain and of no look-alike script."""
    return ch not in LOOKALIKE and unicodedata.combining(ch) == 0 and quick_check(ch) == "yes" and plain_of(ch) == ch


def _goes_on(ch: str) -> bool:
    """Whether ``ch`` may compose with what stands before it."""
    return unicodedata.combining(ch) > 0 or ch in joining()


_NON_ASCII = re.compile(r"[^\x00-\x7f]+")
#: ASCII and the composed Latin letters of Western Europe: stable by the quick check, passed over at once.
_SURELY_STABLE = re.compile(r"[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*\Z")
_WORD = re.compile(r"[^\W_]+")
_COMPOUND = re.compile(r"(?:[^\W_]|[\u0300-\u036f])+(?:[-'~^./|*](?:[^\W_]|[\u0300-\u036f])+)*")


def _script(ch: str) -> str:
    if ch.isascii():
        return "latin" if ch.isalpha() else ""
    name = unicodedata.name(ch, "")
    for s in ("LATIN", "CYRILLIC", "GREEK"):
        if name.startswith(s) or (s == "LATIN" and name in ("KELVIN SIGN", "ANGSTROM SIGN")):
            return s.lower()
    return "other" if ch.isalpha() else ""


_PIECE = re.compile(r"[^\W_]+(?:[\u0300-\u036f]+[^\W_]*)*")


def _strict_foreign(s: str) -> bool:
    return any(c not in LOOKALIKE and _script(c) in ("cyrillic", "greek", "other") for c in s)


def _word_before(text: str, i: int) -> str:
    """What stands before place ``i``, back to the beginning of a word."""
    k = i
    while k > 0 and text[k - 1].isspace():
        k -= 1
    while k > 0 and not text[k - 1].isspace():
        k -= 1
    return text[k:i]


def _word_after(text: str, j: int) -> str:
    k = j
    while k < len(text) and text[k].isspace():
        k += 1
    while k < len(text) and not text[k].isspace():
        k += 1
    return text[j:k]


def _word_form(word: str, compound: str, before: str, after: str, known) -> str:
    """A word with its look-alike letters made Latin, if it is a Latin word.

    ``compound`` is the word with what is tied to it by hyphens and marks, ``before`` and ``after``
    are the neighbouring texts.
    """
    if not any(c in LOOKALIKE for c in word) or _strict_foreign(word):
        return word  # letters that no Latin word has: truly of the other script
    if word in GREEK and word.islower() and compound != word:
        return word  # a lone letter is a symbol
    latin = unicodedata.normalize("NFC", "".join(LOOKALIKE.get(c, c) for c in word))
    if any(c.isdigit() or _script(c) == "latin" for c in word):
        return latin
    # look-alikes alone: what is tied to the word decides, then the neighbours, then whether it is a known word
    if _strict_foreign(compound):
        return word
    if any(_script(c) == "latin" for c in compound) or before[-1:] == "°":
        return latin
    near = (before.split()[-1:] + after.split()[:1]) if before[-1:].isspace() or after[:1].isspace() else []
    if any(_strict_foreign(w) for w in near):
        return word
    if set(latin.upper()) == {"O"} and len(latin) > 1:
        # zeros read as letters; the Cyrillic capitals alone are a company form
        numeric = any(re.fullmatch(r"[(-]*[\dA-Za-z|]*\d[\d.,)]*", w) for w in near)
        return latin if numeric or word != "\u041e" * 3 else word
    return latin if latin.lower() in SHORT_WORDS or latin.lower() in known else word


def consistent(text: str | None, known=frozenset()) -> str | None:
    """The text in the one consistent form; null stays null.

    Composed letters, plain blanks, hyphens, digits and punctuation, nothing invisible, Latin letters
    in Latin words. Words truly written in Greek or Cyrillic, raised digits, fractions and other signs
    that look different from every plain form stay, as do repeated and outer plain blanks. ``known``
    are words (lower case) that count as Latin even when every letter is a look-alike. The form is a
    fixed point.
    """
    if text is None or text.isascii() or _SURELY_STABLE.match(text):
        return text
    parts, at, changed = [], 0, False
    spots = []
    for run in _NON_ASCII.finditer(text):
        for i in range(run.start(), run.end()):
            if not is_stable(text[i]):
                spots.append(i)
    if not spots:
        return text
    # segments: unstable characters with the starter before them; close ones form one segment
    segments: list[list[int]] = []
    for i in spots:
        start = i
        while start > 0 and _goes_on(text[start]):
            start -= 1
        if plain_of(text[i]) == "" and start > 0:
            start -= 1  # what an invisible character parts may compose
            while start > 0 and (_goes_on(text[start]) or plain_of(text[start]) == ""):
                start -= 1
        end = i + 1
        while end < len(text) and (_goes_on(text[end]) or plain_of(text[end]) == ""):
            end += 1
        if segments and start <= segments[-1][1]:
            segments[-1][1] = max(segments[-1][1], end)
        else:
            segments.append([start, end])
    for start, end in segments:
        seg = text[start:end]
        form = unicodedata.normalize("NFC", "".join(map(plain_of, seg)))
        parts += [text[at:start], form]
        changed |= form != seg
        at = end
    out = "".join([*parts, text[at:]]) if changed else text
    if any(c in LOOKALIKE for c in out):
        pieces, at = [], 0
        for c in _COMPOUND.finditer(out):
            if c[0].isascii():
                continue
            for m in _PIECE.finditer(c[0]):
                w, i, j = m[0], c.start() + m.start(), c.start() + m.end()
                if w.isascii():
                    continue
                new = _word_form(w, c[0], _word_before(out, i), _word_after(out, j), known)
                if new != w:
                    pieces += [out[at:i], new]
                    at = j
        if pieces:
            out = "".join([*pieces, out[at:]])
    return out


def lookalike_words(text: str | None) -> list[str]:
    """The words of a text of which every letter is a look-alike, in Latin lower case."""
    if text is None or text.isascii():
        return []
    return ["".join(LOOKALIKE[c] for c in w).lower() for w in _WORD.findall(text) if len(w) > 1 and all(c in LOOKALIKE for c in w)]


def with_consistent(df: DataFrame, text: str, known: frozenset[str] = frozenset(), name: str = "consistent_text") -> DataFrame:
    """``df`` with the consistent form of column ``text`` as column ``name``.

    Nulls give nulls and empty texts empty texts; equal rows are treated alike; very long texts take
    time in proportion. ASCII texts are recognised in the JVM; in their place nulls are sent to Python.
    """

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        cache: dict = {}
        out = []
        for t in s:
            if t is not None and len(t) < 200:
                if t not in cache:
                    cache[t] = consistent(t, known)
                out.append(cache[t])
            else:
                out.append(consistent(t, known))
        return pd.Series(out, dtype=object)

    odd = ~F.col(text).rlike(r"^[\x00-\x7f]*$")
    return df.withColumn(name, F.when(odd, run(F.when(odd, F.col(text)))).otherwise(F.col(text)))


def changed_rows(df: DataFrame, text: str, known: frozenset[str] = frozenset()) -> DataFrame:
    """The rows of ``df`` whose text is not in the consistent form, with ``consistent_text``."""
    odd = df.where(F.col(text).isNotNull() & ~F.col(text).rlike(r"^[\x00-\x7f]*$"))
    return with_consistent(odd, text, known).where(~F.col("consistent_text").eqNullSafe(F.col(text)))
