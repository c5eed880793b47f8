"""Free-entered values to the entries of a reference list (problem 7).

An automaton over the folded names and aliases finds embedded mentions; the longest ones that do not
overlap win, and a value is settled where one mention covers all that counts in it. Words cut by a
point are looked up by their beginning. The remaining values go to token-set similarity with the
entries that share enough pairs of letters or all their words; an inverted index over these finds
every entry that can reach the threshold, so no value is held against the whole list. Each distinct
value is worked on once.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.normal import consistent
from ledgerloom.session import fan_out

#: Words around an account heading that do not belong to its name.
FILLERS = {"sum", "note", "noter", "nr", "nok", "tnok", "mnok", "kr", "total", "totalt", "samlet", "total", "av", "of", "the", "i", "hele", "tusen", "per", "pr"}

#: Least similarity of a value to an entry, and of each word of the entry to the value's nearest word.
LEAST, LEAST_WORD = 0.80, 0.60

_DIGIT_LETTERS = str.maketrans({"0": "o", "1": "l", "5": "s", "8": "b", "3": "e", "4": "a", "6": "b", "9": "g", "|": "l", "@": "a", "$": "s", "!": "i"})
_SPECIAL = str.maketrans({"ø": "o", "ö": "o", "å": "a", "ä": "a", "æ": "a", "ð": "d", "ß": "s"})


def fold(text: str) -> str:
    """Lower case without accents, look-alikes, invisible characters and Norwegian digraphs."""
    t = consistent(text) or ""
    t = unicodedata.normalize("NFKC", t).casefold().translate(_SPECIAL)
    t = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
    return t.replace("oe", "o").replace("aa", "a").replace("ae", "a")


def core(text: str) -> str:
    """A folded value without layout breaks, numbering, years, amounts' units and outer signs."""
    t = fold(text)
    t = re.sub(r"-\s*\n\s*|-\s+(?=[a-z])", "", t) if re.search(r"[a-z]-\s+[a-z]", t) else t
    t = re.sub(r"\s+", " ", t).strip()
    t = re.sub(r"\((?:i\s*)?(?:hele\s*)?(?:nok|tnok|mnok|kr|1000|\d[\d ]*|mill\.?|tusen|note\s*\d+|[ '/.])*\)", " ", t)
    t = re.sub(r"^\s*(?:note[rs]?\s*\d*\s*[:.)\-]?|(?:\d+(?:\.\d+)*|[a-h]|[ivx]+)\s*[.):]|\d+(?:\.\d+)+)\s+", "", t)
    t = re.sub(r"^(?:sum|total)\s+", "", t)
    t = re.sub(r"[\s,(:]*(?:note\s*)?\b\d[\d.,/ ]*\)?\s*$", "", t)
    t = re.sub(r"(?<=[a-z])[0-9|@$!](?=[a-z])|(?<=[a-z])[0-9|@$!](?=[a-z]?\b)", lambda m: m[0].translate(_DIGIT_LETTERS), t)
    t = re.sub(r"(?<=[a-z])['^~*`´](?=[a-z])", "", t)
    cut = "," in t and t.rstrip().endswith(".")  # a word cut by a point, put last by the comma
    t = t.strip(" -–:;.,*•·_/\\")
    return t + "." if cut else t


def squash(t: str) -> str:
    return re.sub(r"[^a-z0-9]", "", t)


def rotated(t: str) -> str | None:
    """``B, A`` as ``A B``."""
    if t.count(",") == 1:
        a, b = (x.strip() for x in t.split(","))
        if a and b:
            return f"{b} {a}"
    return None


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        m = where.get(c, 0)
        u = row & m
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Indel similarity of two strings: 1 for equal ones, 0 for ones without a common letter."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


class PairIndex:
    """Which of some strings share how many pairs of neighbouring letters with another."""

    def __init__(self, strings: list[str]):
        postings: dict[str, list[int]] = {}
        for n, s in enumerate(strings):
            for g in self.pairs(s):
                postings.setdefault(g, []).append(n)
        self.postings = {g: np.array(v, dtype=np.int32) for g, v in postings.items()}
        self.lengths = np.array([len(s) for s in strings], dtype=np.int32)

    @staticmethod
    def pairs(s: str) -> list[str]:
        """The pairs of ``s``, repeated ones told apart by their number."""
        seen: dict[str, int] = {}
        out = []
        for i in range(len(s) - 1):
            g = s[i : i + 2]
            seen[g] = k = seen.get(g, 0) + 1
            out.append(g if k == 1 else f"{g}{k}")
        return out

    def shared(self, strings: list[str]) -> np.ndarray:
        """For every string of the index the number of pairs in common with ``strings`` together."""
        found = [p for s in strings for g in self.pairs(s) if (p := self.postings.get(g)) is not None]
        return np.bincount(np.concatenate(found), minlength=len(self.lengths)) if found else np.zeros(len(self.lengths), dtype=np.int64)

    def near(self, s: str, least: float) -> np.ndarray:
        """All strings whose `ratio` to ``s`` can be ``least`` or more.

        A common subsequence of l letters of strings of a and b letters is broken at most a + b - 2l
        times, so it has at least 3l - (a + b) - 1 pairs that stand together in both.
        """
        both = self.lengths + len(s)
        return np.flatnonzero(self.shared([s]) >= np.maximum((1.5 * least - 1) * both - 1 - 1e-9, 0))


class Reference:
    """The reference list in folded form, with the automaton over it.

    ``entries`` are (id, text). Of ids that share a folded text the one that comes first by
    ``prefer`` (a sort key on the id) is meant.
    """

    def __init__(self, entries: Iterable[tuple[str, str]], prefer=lambda i: i):
        import ahocorasick

        best: dict[str, tuple[str, str]] = {}
        for i, text in entries:
            if i is None or text is None:
                continue
            t = re.sub(r"\s+", " ", fold(text)).strip()
            s = squash(t)
            if s and (s not in best or prefer(i) < prefer(best[s][0])):
                best[s] = (i, t)
        self.keys = sorted(best)
        self.ids = [best[s][0] for s in self.keys]
        self.words = [[w for w in re.findall(r"[a-z0-9]+", best[s][1])] for s in self.keys]
        self.exact = dict(zip(self.keys, self.ids))
        self.automaton = ahocorasick.Automaton()
        for n, s in enumerate(self.keys):
            self.automaton.add_word(s, n)
        if self.keys:
            self.automaton.make_automaton()
        self.sorted_keys = ["".join(sorted(w)) for w in self.words]
        self.by_pairs, self.by_sorted_pairs = PairIndex(self.keys), PairIndex(self.sorted_keys)
        self.by_word: dict[str, list[int]] = {}
        for n, ws in enumerate(self.words):
            for w in set(ws):
                self.by_word.setdefault(w, []).append(n)

    def mention(self, t: str) -> str | None:
        """The entry that covers all that counts in a value; longest mentions first, not overlapping."""
        if not self.keys:
            return None
        for form in (t, rotated(t)):
            if form is None:
                continue
            s = squash(form)
            if s in self.exact:
                return self.exact[s]
            hits = sorted(((end - len(self.keys[n]) + 1, end + 1, n) for end, n in self.automaton.iter(s)), key=lambda h: (h[0] - h[1], h[0]))
            if not hits:
                continue
            kept: list[tuple[int, int, int]] = []
            for h in hits:
                if all(h[1] <= a or h[0] >= b for a, b, _ in kept):
                    kept.append(h)
            a, b, n = kept[0]
            left = [w for w in re.findall(r"[a-z0-9]+", self._cut(form, a, b)) if w not in FILLERS and not w.isdigit()]
            if not left and len({self.ids[k] for _, _, k in kept}) == 1:
                return self.ids[n]
        return None

    @staticmethod
    def _cut(form: str, a: int, b: int) -> str:
        out, i = [], 0
        for c in form:
            if re.match("[a-z0-9]", c):
                out.append(" " if a <= i < b else c)
                i += 1
            else:
                out.append(c)
        return "".join(out)

    def abbreviated(self, t: str) -> str | None:
        """The one entry that a value with words cut by a point stands for; misreadings count against it."""
        for form in (t, rotated(t)):
            if form is None or not re.search(r"[a-z]\.", form):
                continue
            pieces = [squash(p) for p in re.split(r"(?<=[a-z])\.\s*", form)]
            if not pieces[0]:
                continue
            if not pieces[-1]:
                pieces = pieces[:-1] + [""]
            pattern = "[a-z]*".join(pieces)
            found = {self.ids[n] for n in self._beginning(pieces[0]) if re.fullmatch(pattern, self.keys[n])}
            if len(found) == 1:
                return found.pop()
            if not found and sum(map(len, pieces)) >= 10:
                near: dict[str, int] = {}
                errors = 1 if sum(map(len, pieces)) < 16 else 3
                fuzzy = regex.compile(f"(?:{pattern}){{e<={errors}}}", regex.BESTMATCH)
                # an error destroys two pairs of letters at most; pairs repeated in several pieces count once here
                wanted = len({g for p in pieces for g in PairIndex.pairs(p) if len(g) == 2}) - 2 * errors
                once = [g for g in dict.fromkeys(g for p in pieces for g in PairIndex.pairs(p) if len(g) == 2)]
                for n in np.flatnonzero(self.by_pairs.shared(once) >= wanted):
                    if m := fuzzy.fullmatch(self.keys[n]):
                        near[self.ids[n]] = min(sum(m.fuzzy_counts), near.get(self.ids[n], 99))
                least = [i for i, e in near.items() if e == min(near.values())]
                if len(least) == 1:
                    return least[0]
        return None

    def _beginning(self, start: str) -> range:
        """The places of the entries that begin with ``start``; entries are in order."""
        lo = bisect_left(self.keys, start)
        return range(lo, bisect_right(self.keys, start + "\x7f", lo))

    def _of_all_words(self, words: list[str]) -> list[int]:
        """Entries of two or more longer words all of whose words the value has."""
        have = Counter(n for w in set(words) for n in self.by_word.get(w, ()))
        return [n for n, k in have.items() if k == len(set(self.words[n])) and sum(len(w) > 3 for w in set(self.words[n])) >= 2]

    def similar(self, t: str) -> tuple[str, float] | None:
        """The nearest entry by token-set similarity, if it is near enough.

        The similarity is the greatest of: the words of both in order, with and without blanks; and the
        common words against those of the entry, which is 1 where the value has all of them and others
        besides. Values whose further words make another heading are left to `_every_word` of longer
        entries: of equal similarity the entry with more letters is meant.
        """
        s = squash(t)
        if len(s) < 4 or not self.keys:
            return None
        forms = {s}
        if r := rotated(t):
            forms.add(squash(r))
        words = re.findall(r"[a-z0-9]+", t)
        by_word = "".join(sorted(words))
        covered = set(self._of_all_words(words))
        near = {int(n) for f in forms for n in self.by_pairs.near(f, LEAST)} | {int(n) for n in self.by_sorted_pairs.near(by_word, LEAST)} | covered
        best: tuple[tuple, int] | None = None
        for n in near:
            key = self.keys[n]
            score = 1.0 if n in covered else max(*(ratio(f, key) for f in forms), ratio(by_word, self.sorted_keys[n]), 0.0)
            rank = (-score, -len(key) if n in covered else 0, key)
            if score >= LEAST and (best is None or rank < best[0]) and self._every_word(words, s, n):
                best = (rank, n)
        return (self.ids[best[1]], -best[0][0]) if best else None

    def _every_word(self, words: list[str], s: str, n: int) -> bool:
        """Whether each word of entry n has its counterpart in the value, however it is split there."""
        return all(self._word_in(w, words, s) for w in self.words[n] if len(w) > 3)

    @staticmethod
    def _word_in(w: str, words: list[str], s: str) -> bool:
        if w in s or any(ratio(w, x) >= LEAST_WORD for x in words if abs(len(x) - len(w)) <= len(w) // 2):
            near = [x for x in words if abs(len(x) - len(w)) <= 2]
            return w in s or max((ratio(w, x) for x in (near or words)), default=0.0) >= 0.70 or _window(w, s) >= 0.74
        return _window(w, s) >= 0.74

    def resolve(self, value: str | None) -> tuple[str | None, str, float]:
        """(id or None, method, similarity) of a value."""
        if value is None or not value.strip():
            return None, "none", 0.0
        t = core(value)
        if not re.search("[a-z]", t):
            return None, "none", 0.0
        if i := self.mention(t):
            return i, "mention", 1.0
        if i := self.abbreviated(t):
            return i, "abbreviation", 1.0
        if found := self.similar(t):
            return found[0], "similar", found[1]
        return None, "none", 0.0


def _window(w: str, s: str) -> float:
    """Best similarity of ``w`` to a piece of ``s`` of about its length."""
    best = 0.0
    for size in (len(w) - 1, len(w), len(w) + 1):
        for i in range(max(1, len(s) - size + 1)):
            best = max(best, ratio(w, s[i : i + size]))
    return best


def map_values(df: DataFrame, value: str, reference: DataFrame, ref_id: str, ref_text: str, prefer=lambda i: i, most_entries: int = 200_000) -> DataFrame:
    """``df`` with ``match_id`` (null if there is none), ``method`` and ``similarity``.

    Null and blank values and values without a letter have no match. Distinct values are resolved
    once and joined back, so a value that fills a third of the rows costs no more than another. The
    reference list goes to every executor and must not have more than ``most_entries`` rows (checked).
    An empty list matches nothing. Equal similarity goes to the entry that sorts first. Columns of
    ``df`` named like the results are replaced, other columns stay.
    """
    df = df.drop("match_id", "method", "similarity")
    rows = reference.select(ref_id, ref_text).distinct().limit(most_entries + 1).collect()
    if len(rows) > most_entries:
        raise ValueError(f"the reference list has more than {most_entries} entries")
    entries = [(r[0], r[1]) for r in rows]

    def run(batches):
        ref = Reference(entries, prefer)
        for pdf in batches:
            out = [ref.resolve(v) for v in pdf["__value"]]
            yield pd.DataFrame({"__value": pdf["__value"], "match_id": [o[0] for o in out], "method": [o[1] for o in out], "similarity": [o[2] for o in out]})

    distinct = df.select(F.col(value).alias("__value")).where(F.col("__value").isNotNull()).distinct()
    found = fan_out(distinct).mapInPandas(run, "__value string, match_id string, method string, similarity double")
    out = df.join(found, F.col(value) == F.col("__value"), "left").drop("__value")
    return out.withColumn("method", F.coalesce("method", F.lit("none"))).withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
