"""Noise in text from scanned pages (problem 3).

One pass over all texts counts words inside lines and the shapes of lines at the edge and in the body
of pages. Frequent words get skip-gram vectors, learned from their co-occurrence counts over all
texts. A rare word is linked to a frequent neighbour that plausible glyph edits turn it into; where
several fit, or the counts alone do not decide, the vectors of the words around it do. Lines are then
judged, words split by the layout are joined, furniture is dropped and the rest is reflowed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.normal import consistent
from ledgerloom.session import checkpoint

#: What a scan makes of letters, as (printed, read).
GLYPHS = [
    ("r", "i"), ("e", "c"), ("t", "f"), ("a", "@"), ("s", "5"), ("n", "ri"), ("i", "l"), ("k", "lc"), ("l", "|"), ("l", "1"), ("i", "1"), ("i", "|"),
    ("o", "0"), ("d", "cl"), ("g", "q"), ("g", "9"), ("v", "y"), ("u", "ii"), ("ø", "6"), ("ø", "o"), ("ø", "0"), ("m", "rn"), ("b", "6"), ("h", "b"), ("b", "h"), ("å", "ä"),
    ("å", "a"), ("å", "á"), ("rn", "m"), ("li", "h"), ("æ", "ae"), ("b", "8"), ("z", "2"), ("l", "i"), ("l", "I"), ("k", "|c"), ("s", "$"), ("c", "e"), ("cl", "d"), ("el", "d"),
]
MARKS = "^~.'`*"
SPLIT_MARKS = "-‐¬\xad"

#: A word counts as frequent from this count, whatever the size of the corpus.
LEAST_COUNT = 4
#: Frequent words go to every executor with their vectors up to this many; beyond it each block of texts gets those it asks for by joins.
MOST_WORDS, BLOCK_TEXTS = 500_000, 2_000
#: Glyph edits by length of a word: one below 5 letters, two below 10, three up to 100; longer ones are words run together, with one.
LONG_WORD = 100
#: A rarer word is a misreading of a frequent one that is this many times as frequent.
LEAST_RATIO = 4.0
#: The size and window of the vectors, which all frequent words have that stand beside another; and negatives a pair.
DIMENSIONS, WINDOW, NEGATIVES = 24, 3, 5
#: The driver trains up to this many words and pairs; beyond either the executors do, over pairs of blocks of about so many words.
MOST_TRAINED, MOST_PAIRS, BLOCK_WORDS = 10_000, 3_000_000, 2_000
#: A line shape is furniture from this share of pages at their edge, if it is rarely met in the body.
LEAST_SHAPE, LEAST_EDGE = 0.004, 0.95
EDGE = 3

_WORD = re.compile(r"[^\W\d_]")
_PAGE = re.compile(r"^(?:(?:side|page|s\.|p\.|pg\.)\s*)?[\[(]?\s*(?:[-–—]\s*)?(?P<n>[0-9oOlISBZgbA?|]{1,4}|[ivxl]{1,7})(?:\s*(?:/|av|of)\s*[0-9oOlISBZgbA?|]{1,4})?(?:\s*[-–—])?\s*[\])]?$", re.IGNORECASE)
_NUMBER = re.compile(r"^[(\-–]*(?:kr|nok)?\d[\d.,/:-]*\d?\)?[%.,:;)]*$", re.IGNORECASE)
_LIKE_DIGIT = "oOlISBZgbAGqT?|"
#: The digits that were printed for these letters; what ``?`` stands for can't be told.
_AS_DIGIT = str.maketrans("oOlISBZgbAGqT|", "00115829646971")
#: Words and company forms of such letters alone; between numbers they stay, known here or not.
_WORDS_OF_DIGIT_LETTERS = {"og", "bo", "go", "lo", "log", "ol", "bl", "To", "Al", "All", "AS", "ASA", "SA", "BA", "AG", "GB"}
_DIGITS = re.compile(r"(?=.*[0-9?])[0-9oOlISBZgbAGqT?|.,/-]+", re.IGNORECASE)
_STRIP = ".,;:!?()[]{}\"«»“”%–—"


def lines_of(text: str) -> list[str]:
    return [x.rstrip("\r") for x in text.split("\n")]


def bare(token: str) -> str:
    """A token without outer punctuation, in lower case."""
    return token.strip(_STRIP + "'").lower()


def shape(line: str) -> str:
    """The shape of a line: digits as 9, runs of capitalised words as N."""
    t = re.sub(r"\S*\d\S*", lambda m: m[0] if sum(c.islower() for c in m[0]) >= 3 else "9", line.strip())
    t = re.sub(r"(?<=\s)[oOlISBZ?]{1,3}(?=\s)", "9", t)
    t = re.sub(r"9(?:\s+9)+", "9 9", t)
    words, out = t.split(), []
    for i, w in enumerate(words):
        capital = w[:1].isupper() and w.strip(",") != "9"
        if capital and (i > 0 or (len(words) > 1 and words[1][:1].isupper())):
            if out and out[-1] == "N":
                continue
            out.append("N")
        else:
            out.append(w.lower())
    return " ".join(out)


def edge_places(lines: list[str]) -> set[int]:
    """The places of the first and last few lines that aren't blank."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    return set(full[:EDGE] + full[-EDGE:])


def whole_tokens(lines: list[str]) -> list[str]:
    """The words of lines that the layout can't have split, nor numbers with misread digits.

    Inside a line all words are whole; its first is if it starts with a capital, its last if the line
    ends with punctuation or is far shorter than the longest, as headings are.
    """
    widest = max(map(len, lines), default=0)
    out = []
    for line in lines:
        t = line.split()
        if not t:
            continue
        short = len(line) < 0.6 * widest and t[-1][-1] not in SPLIT_MARKS
        ends = short or t[-1][-1] in ".,;:!?)" or len(lines) == 1
        starts = t[0][:1].isupper() or len(lines) == 1
        if len(t) == 1:
            kept = t if starts and ends else []
        else:
            kept = t[0 if starts else 1 : len(t) if ends else -1]
        out += [w for x in kept if (w := _counted(x))]
    return out


@lru_cache(maxsize=200_000)
def _counted(token: str) -> str | None:
    """The word of a token that counts as one."""
    w = bare(token)
    return w if _WORD.search(w) and not _DIGITS.fullmatch(w) else None


def count_signs(df: DataFrame, text: str, pages: bool) -> DataFrame:
    """``what, key, n``: counts of inner words (w) and of line shapes at the edge (e) and in the body (b)."""

    def run(batches):
        for pdf in batches:
            n: Counter = Counter()
            for t in pdf[text]:
                if not isinstance(t, str) or not t.strip():
                    continue
                t = consistent(t)
                lines = lines_of(t)
                n["p", ""] += pages
                edges = edge_places(lines) if pages else set()
                words = whole_tokens(lines)
                n["t", ""] += len(words)
                for w in words:
                    n["w", w] += 1
                for i, line in enumerate(lines if pages else ()):
                    if line.strip():
                        n["e" if i in edges else "b", shape(line)] += 1
            yield pd.DataFrame([(a, b, c) for (a, b), c in n.items()], columns=["what", "key", "n"])

    return df.select(text).mapInPandas(run, "what string, key string, n long").groupBy("what", "key").agg(F.sum("n").alias("n"))


def _pair_counts(df: DataFrame, text: str, words: dict[str, int] | None) -> DataFrame:
    """``a, b, n``: how often two words stand near one another; by their numbers, or of all words, as text, without them."""
    sent = df.sparkSession.sparkContext.broadcast(words)
    kind = "string" if words is None else "int"

    def run(batches):
        at = sent.value
        for pdf in batches:
            n: Counter = Counter()
            for t in pdf[text]:
                if not isinstance(t, str):
                    continue
                for line in lines_of(consistent(t)):
                    ids = [_counted(x) if at is None else at.get(bare(x)) for x in line.split()]
                    for i, a in enumerate(ids):
                        if a is not None:
                            for b in ids[i + 1 : i + 1 + WINDOW]:
                                if b is not None:
                                    n[a, b] += 1
            yield pd.DataFrame([(a, b, c) for (a, b), c in n.items()], columns=["a", "b", "n"])

    return df.select(text).mapInPandas(run, f"a {kind}, b {kind}, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _slopes(win: np.ndarray, wout: np.ndarray, rows: np.ndarray, cols: np.ndarray, w: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gradients of some words in against some words out: pairs with their weights, and the noise in full."""
    d_in, d_out = np.zeros_like(win), np.zeros_like(wout)
    for lo in range(0, len(rows), 1 << 17):
        r, c = rows[lo : lo + (1 << 17)], cols[lo : lo + (1 << 17)]
        x, y = win[r], wout[c]
        g = w[lo : lo + (1 << 17)] * (1 - 1 / (1 + np.exp(-np.einsum("ij,ij->i", x, y))))
        for k in range(DIMENSIONS):
            d_in[:, k] += np.bincount(r, g * y[:, k], len(win))
            d_out[:, k] += np.bincount(c, g * x[:, k], len(wout))
    step = max(1, 1_000_000 // max(1, len(wout)))
    for lo in range(0, len(win), step):
        part = win[lo : lo + step]
        neg = -NEGATIVES * noise[None, :] / (1 + np.exp(-np.clip(part @ wout.T, -30, 30)))
        d_in[lo : lo + step] += neg @ wout
        d_out += neg.T @ part
    return d_in, d_out


def _climb(win, wout, gin, gout, d_in, d_out) -> tuple:
    """One step along the gradients; ``gin, gout`` hold their squares so far."""
    gin, gout = gin + d_in**2, gout + d_out**2
    return win + 0.35 * d_in / np.sqrt(gin), wout + 0.35 * d_out / np.sqrt(gout), gin, gout


def _start(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The vectors training begins with, the same for a word wherever it is trained."""
    both = np.array([np.random.default_rng(zlib.crc32(w.encode())).normal(0, 0.3, (2, DIMENSIONS)) for w in words]).reshape(-1, 2, DIMENSIONS)
    return both[:, 0].copy(), both[:, 1].copy()


def skip_grams(size: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, epochs: int = 12, seed: int = 7, start: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Skip-gram vectors with negative sampling, from pair counts: words in, words out.

    The expected gradient over all pairs and the noise distribution is taken in full each epoch, so
    no order and no sample of the text plays a part.
    """
    rng = np.random.default_rng(seed)
    win, wout = start or (rng.normal(0, 0.3, (size, DIMENSIONS)), rng.normal(0, 0.3, (size, DIMENSIONS)))
    if not len(n):
        return win, wout
    rows, cols, w = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([n, n]).astype(np.float64)
    total_r = np.bincount(rows, w, size)
    noise = np.bincount(cols, w, size) ** 0.75
    noise /= noise.sum()
    order = np.lexsort((w, cols, rows))
    rows, cols, w = rows[order], cols[order], w[order]
    w /= total_r[rows]
    gin, gout = np.full_like(win, 1e-8), np.full_like(wout, 1e-8)
    for _ in range(epochs * 4):
        win, wout, gin, gout = _climb(win, wout, gin, gout, *_slopes(win, wout, rows, cols, w, noise))
    return win.astype(np.float32), wout.astype(np.float32)


def skip_grams_apart(pairs: DataFrame, epochs: int = 12) -> DataFrame:
    """``key, win, wout``: the vectors of `skip_grams` from pairs of words ``a, b, n``, for more than the driver holds.

    Words are put into blocks. Each pass takes every pair of blocks for itself and sums their
    gradients, so all pairs and the noise count in full here too. Work grows with the square of the
    words; a task holds the vectors in of all words once.
    """
    spark = pairs.sparkSession
    sc = spark.sparkContext
    schema = "key string, win array<float>, wout array<float>"
    both = checkpoint(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")).groupBy("a", "b").agg(F.sum("n").alias("n")))
    totals = both.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("total"))
    size, mass = totals.agg(F.count("*"), F.sum(F.pow("total", F.lit(0.75)))).first()
    if not size:
        return spark.createDataFrame([], schema)
    blocks = -(-size // BLOCK_WORDS)
    ids = totals.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
    ids = checkpoint(ids.withColumn("i", F.row_number().over(Window.partitionBy("block").orderBy("key")) - 1))
    placed = both.join(ids.select(F.col("key").alias("a"), F.col("block").alias("x"), "i", "total"), "a").join(ids.select(F.col("key").alias("b"), F.col("block").alias("y"), F.col("i").alias("j")), "b")
    placed = placed.groupBy("x", "y").agg(F.array_sort(F.collect_list(F.struct("i", "j", (F.col("n") / F.col("total")).alias("w")))).alias("e"))
    names = ids.select(F.col("block").alias("x")).distinct()
    cells = names.crossJoin(names.withColumnRenamed("x", "y")).join(placed, ["x", "y"], "left")

    def cell(r):
        e = r.e or []
        return r.x, (r.y, np.array([v.i for v in e], np.int64), np.array([v.j for v in e], np.int64), np.array([v.w for v in e], np.float64))

    def begin(r):
        keys = [v.key for v in r.e]
        win, wout = _start(keys)
        return r.block, (keys, np.array([v.total for v in r.e], np.float64) ** 0.75 / mass, win, wout, np.full_like(win, 1e-8), np.full_like(wout, 1e-8))

    def slopes(e):
        y, ((x, rows, cols, w, win), (noise, wout)) = e
        d_in, d_out = _slopes(win, wout, rows, cols, w, noise)
        return [((x, 0), d_in), ((y, 1), d_out)]

    def climb(state, found):
        d = dict(found)
        return (*state[:2], *_climb(*state[2:], d[0], d[1]))

    cells = cells.rdd.map(cell).persist(StorageLevel.MEMORY_AND_DISK)
    state = ids.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("i", "key", "total"))).alias("e")).rdd.map(begin)
    parts = min(blocks, 4 * sc.defaultParallelism)
    kept = None
    for _ in range(epochs * 4):
        with_in = cells.join(state.mapValues(lambda s: s[2]), parts).map(lambda e: (e[1][0][0], (e[0], *e[1][0][1:], e[1][1])))
        found = with_in.join(state.mapValues(lambda s: (s[1], s[3])), parts).flatMap(slopes).reduceByKey(np.add, parts)
        state = state.join(found.map(lambda e: (e[0][0], (e[0][1], e[1]))).groupByKey(parts), parts).mapValues(lambda e: climb(*e)).persist(StorageLevel.MEMORY_AND_DISK)
        state.checkpoint()
        state.count()
        if kept is not None:
            kept.unpersist()
            path = sc._jvm.org.apache.hadoop.fs.Path(kept.getCheckpointFile())
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        kept = state
    cells.unpersist()
    rows = state.flatMap(lambda e: [(k, a.tolist(), b.tolist()) for k, a, b in zip(e[1][0], e[1][2], e[1][3])])
    got = checkpoint(spark.createDataFrame(rows, schema))
    state.unpersist()
    return got


class Knowledge:
    """Word counts, vectors and furniture shapes learned from all texts; what a worker judges lines with."""

    def __init__(self, counts: dict[str, int], total: int, shapes: set[str], vocabulary: dict[str, int] | None = None, win=None, wout=None):
        self.counts, self.total, self.shapes = counts, max(1, total), shapes
        self.words_table: DataFrame | None = None  # all frequent words with their vectors, where ``counts`` doesn't hold them
        self.at, self.win, self.wout = {} if vocabulary is None else vocabulary, win, wout
        self.linked: dict[str, list[tuple[str, int]]] = {}
        self.judged: dict[str, bool] = {}
        self.by_read: dict[str, list[str]] = defaultdict(list)
        for printed, read in GLYPHS:
            self.by_read[read.lower()].append(printed)
        self.firsts = {x[0] for x in self.by_read} | set(MARKS)

    def count(self, w: str) -> int:
        return self.counts.get(w, 0)

    def _edits(self, w: str) -> set[str]:
        out = set()
        for i, c in enumerate(w):
            if c not in self.firsts:
                continue
            for size in (1, 2):
                for printed in self.by_read.get(w[i : i + size], ()) if i + size <= len(w) else ():
                    out.add(w[:i] + printed + w[i + size :])
            if c in MARKS and 0 < i < len(w) - 1:
                out.add(w[:i] + w[i + 1 :])
        return out

    def neighbours(self, w: str) -> list[tuple[str, int]]:
        """Frequent words that one or two glyph edits (three in long words) turn into ``w``; (word, edits), best first."""
        if (got := self.linked.get(w)) is not None:
            return got
        own, found, seen, front = self.count(w), {}, {w}, {w}
        for k in range(1, 2 if len(w) < 5 or len(w) > LONG_WORD else 3 if len(w) < 10 else 4):
            front = {x for y in front for x in self._edits(y)} - seen
            seen |= front
            for x in front:
                n = self.count(x)
                if n and n >= LEAST_RATIO * max(own, 0.34):
                    found.setdefault(x, k)
            if found:
                break
        # a neighbour may be a misreading itself, met often enough to be frequent: then those it stands for are meant
        ends: dict[str, int] = {}
        for x, k in found.items():
            for y, more in self.neighbours(x) or [(x, 0)]:
                ends[y] = min(k + more, ends.get(y, k + more))
        got = sorted(ends.items(), key=lambda x: (x[1], -self.count(x[0]), x[0]))
        if len(self.linked) > 150_000:
            self.linked.clear()
        self.linked[w] = got
        return got

    def affinity(self, w: str, around: list[str]) -> float:
        """Mean dot product of a word's vector with those of the words around it; 0 if it has none."""
        if self.win is None or (i := self.at.get(w)) is None:
            return 0.0
        near = [j for x in around if (j := self.at.get(x)) is not None]
        return float(np.mean(self.wout[near] @ self.win[i])) if near else 0.0

    def printed(self, w: str, around: list[str] = ()) -> str | None:
        """The word that was printed where ``w`` is a misreading; None where it isn't one."""
        near = self.neighbours(w)
        if not near:
            return None
        best = max(near, key=lambda x: (-x[1], math.log(self.count(x[0])) + self.affinity(x[0], around), x[0])) if len(near) > 1 else near[0]
        own = self.count(best[0]) / max(self.count(w), 0.34)
        if self.count(w) >= LEAST_COUNT and own < 8 * LEAST_RATIO and len(w) <= 4 and self.affinity(best[0], around) + 0.5 < self.affinity(w, around):
            return None  # the words around it speak for a word of its own
        return best[0]

    def sound(self, token: str) -> bool:
        """Whether a token is undamaged whatever stands around it; remembered, as most tokens are."""
        if (got := self.judged.get(token)) is None:
            if len(self.judged) > 200_000:
                self.judged.clear()
            t = token.strip("()[]%:;,.").lstrip("-–(")
            if t and all(c.isdigit() or c in _LIKE_DIGIT or c in ".,/-" for c in t) and any(c in _LIKE_DIGIT for c in t):
                got = False
            elif _NUMBER.match(token):
                got = True
            else:
                w = bare(token)
                got = not w or not _WORD.search(w) or not self.neighbours(w) and not self.word_damaged(token, [])
            self.judged[token] = got
        return got

    def is_word(self, w: str) -> bool:
        return self.count(w) > 0 and not self.neighbours(w)

    def joined(self, a: str, b: str) -> tuple[bool, str | None]:
        """Whether the end ``a`` of a line and the start ``b`` of the next are one word; and the word."""
        marked = a[-1:] in SPLIT_MARKS
        head, tail = bare(a.rstrip(SPLIT_MARKS) if marked else a), bare(b)
        if not head or not tail or not _WORD.search(head[-1:]) or not (_WORD.match(tail) or not marked or tail[:1] in "@|1056$8"):
            return False, None
        if a[-1:] in ".,;:!?)" or not b[:1].isalnum() and b[:1] not in "@|":
            return False, None
        word = head + tail
        if marked and self.count(f"{head}-{tail}") > 0 and self.count(f"{head}-{tail}") * 3 >= self.count(word):
            return False, None  # the hyphen is part of the word
        if marked:
            known = self.count(word) > 0 or self.printed(word) is not None
            if known:
                return True, word
            if a[-1] != "-":
                return True, word
            # a hanging hyphen stays before a word of its own; a damaged compound keeps its hyphen too
            hanging = self.count(head + "-") > 0 or any(self.count(x + "-") > 0 for x, _ in self.neighbours(head))
            compound = self.printed(f"{head}-{tail}") is not None or any(c.isupper() for c in b[:1]) or a.rstrip("-").isupper()
            return (not hanging and not compound and not self.is_word(tail)), word
        if self.count(word) == 0 and (self.is_word(head) or self.is_word(tail) or self.printed(word) is None):
            return False, None
        alone = min(self.count(head) if self.is_word(head) else 0, self.count(tail) if self.is_word(tail) else 0)
        return self.count(word) > 8 * alone or (self.count(word) == 0 and not alone), word

    def number_damaged(self, tokens: list[str], i: int) -> bool:
        """Whether token i is a number that is no right number any more."""
        t = tokens[i].strip("()[]%:;,.").lstrip("-–(")
        if not t or not all(c.isdigit() or c in _LIKE_DIGIT or c in ".,/-" for c in t):
            return False
        odd = any(c in _LIKE_DIGIT for c in t)
        if not odd:
            return False
        if any(c.isdigit() for c in t):
            return not re.fullmatch(r"\d{1,3}[A-F]", t) or self.count(t.lower()) == 0
        if t.lower() in ("i", "as", "sa", "o", "a", "gb", "ba", "l") and self.count(t.lower()) > 0 or len(t) > 3 and t[:1] not in "?oO":
            return False
        side = [tokens[j].strip("()%,.") for j in (i - 1, i + 1) if 0 <= j < len(tokens)]
        numeric = [x for x in side if x and sum(c.isdigit() for c in x) * 2 >= len(x)]
        return bool(numeric) and (self.count(t.lower()) < max(1, 0.00002 * self.total) or set(t) <= set("oO?"))

    def word_damaged(self, token: str, around: list[str]) -> bool:
        """Whether a token is a word that is no right word any more."""
        w = bare(token)
        if not w or not _WORD.search(w):
            return False
        if "-" in w.strip("-") and self.count(w) == 0 and not self.neighbours(w):
            return any(self.word_damaged(p, around) for p in w.split("-") if len(p) > 2)
        if self.printed(w, around) is not None:
            return True
        if self.count(w) >= LEAST_COUNT:
            return False
        core = w.strip("-")
        mixed = re.search(r"[^\W\d_][0-9|@$^~][^\W\d_]|^[0-9|@$][^\W\d_]{2,}|[^\W\d_]{2,}[0-9|@$^~]$|[^\W\d_]['^~.][^\W\d_]", core)
        return bool(mixed) and len(core) > 2 and not re.fullmatch(r"\d+[.,]?\d*(?:kr|nok|kwh|kg|m2|%|[a-f])", core) and (self.count(w) == 0 or bool(re.search("[|@^~]", core))) and not re.search(r"[a-f0-9]*\d[a-f0-9]*-\d", core)

    def page_number(self, line: str) -> bool:
        t = line.strip()
        m = _PAGE.match(t)
        if not m:
            return False
        n = m["n"]
        if any(c.isdigit() for c in t):
            return t != n or not (n.startswith("0") or len(n) > 3)
        return bool(re.fullmatch(r"[ivxl]+", n)) or (t != n and n[:1] in "oOlISBZ?|")

    def running_line(self, line: str) -> bool:
        s = shape(line)
        if s in self.shapes:
            return True
        fixed = " ".join((_as_case(f, x) if (f := self.printed(b)) else x) if _WORD.search(b := bare(x)) and sum(map(str.isdigit, x)) <= 2 else x for x in line.split())
        if fixed != line and shape(fixed) in self.shapes:
            return True
        return any(_near(s, x) for x in self.shapes if abs(len(x) - len(s)) <= 4)

    def judge(self, text: str, pages: bool) -> list[tuple[int, str]]:
        """(line, kind) of the damaged lines of a text, lines counted from 1."""
        lines = lines_of(consistent_keeping_splits(text))
        out: list[tuple[int, str]] = []
        furniture: set[int] = set()
        if pages:
            full = [i for i, x in enumerate(lines) if x.strip()]
            for end in (full[:EDGE], full[::-1][:EDGE]):
                for i in end:
                    if i in furniture:
                        break
                    if self.page_number(lines[i]):
                        out.append((i + 1, "page_number"))
                    elif self.running_line(lines[i]):
                        out.append((i + 1, "header"))
                    else:
                        break
                    furniture.add(i)
        body = [i for i, x in enumerate(lines) if i not in furniture and x.strip()]
        tokens = {i: lines[i].split() for i in body}
        carried: dict[int, str] = {}
        skip_first: set[int] = set()
        for k, i in enumerate(body):
            t = tokens[i]
            kinds = set()
            skip_last = False
            if k + 1 < len(body) and body[k + 1] == i + 1 and tokens[i + 1]:
                nxt = tokens[i + 1][0]
                one, word = self.joined(t[-1], nxt)
                if one:
                    kinds.add("hyphen")
                    skip_last = True
                    skip_first.add(i + 1)
                    places = self._parted_damage(word, len(bare(t[-1].rstrip(SPLIT_MARKS))))
                elif t[-1][-1:] == "-" and len(t[-1]) > 1:
                    head = bare(t[-1].rstrip("-"))
                    compound = f"{head}-{bare(nxt)}"
                    places = self._parted_damage(compound, len(head) + 1) if self.count(compound) == 0 and self.printed(compound) is not None else set()
                    if places or self.count(compound) > 0:
                        skip_last = True
                        skip_first.add(i + 1)
                else:
                    places = set()
                if 0 in places:
                    kinds.add("char")
                if 1 in places:
                    carried[i + 1] = "char"
            elif pages is False and k + 1 >= len(body) and t and len(t[-1]) > 2 and t[-1][-1] in "¬\xad‐":
                kinds.add("hyphen")
            if i in carried:
                kinds.add("char")
            if "char" not in kinds:
                plain = None
                for j, x in enumerate(t):
                    if self.sound(x) or (j == 0 and i in skip_first) or (j == len(t) - 1 and skip_last):
                        continue
                    plain = plain or [bare(y) for y in t]
                    around = plain[max(0, j - WINDOW) : j] + plain[j + 1 : j + 1 + WINDOW]
                    if self.number_damaged(t, j) or (not _NUMBER.match(x) and self.word_damaged(x, around)):
                        kinds.add("char")
                        break
            out += [(i + 1, kind) for kind in sorted(kinds)]
        return out

    def _parted_damage(self, word: str, head: int) -> set[int]:
        """On which sides of place ``head`` a word parted there is misread: 0 before, 1 after."""
        if self.count(word) > 0 and not self.neighbours(word):
            return set()
        printed = self.printed(word)
        if printed is None:
            return {n for n, part in enumerate((word[:head], word[head:])) if re.search(r"[|@^~0-9]", part)}
        same = 0
        while same < min(len(word), len(printed)) and word[same] == printed[same]:
            same += 1
        tail = 0
        while tail < min(len(word), len(printed)) - same and word[-1 - tail] == printed[-1 - tail]:
            tail += 1
        return ({0} if same < head else set()) | ({1} if len(word) - tail > head else set())

    def _numbers(self, tokens: list[str], first: int, last: int) -> list[str]:
        """The tokens of a line with digits for the letters in misread numbers, from ``first`` to before ``last``."""
        out = list(tokens)
        for j in range(first, last):
            if tokens[j] != "|" and tokens[j].strip(_STRIP) not in _WORDS_OF_DIGIT_LETTERS and self.number_damaged(tokens, j) and not (any(c.isdigit() for c in tokens[j]) and _WORD.search(w := bare(tokens[j])) and self.printed(w)):
                out[j] = tokens[j].translate(_AS_DIGIT)
        return out

    def repair(self, text: str, pages: bool) -> str:
        """A text as running paragraphs: without furniture, broken words, misread words and misread digits.

        A ``?`` read for a digit stays, as nothing tells which digit it was, and so does a ``|`` on its
        own, which may part columns.
        """
        found = defaultdict(set)
        for i, kind in self.judge(text, pages):
            found[i].add(kind)
        paragraphs: list[str] = [""]
        glue = False
        for i, line in enumerate(lines_of(consistent_keeping_splits(text)), 1):
            if found[i] & {"header", "page_number"}:
                continue
            t = line.split()
            if not t:
                if paragraphs[-1]:
                    paragraphs.append("")
                glue = False
                continue
            t = self._numbers(t, int(glue), len(t) - ("hyphen" in found[i]))
            if "hyphen" in found[i]:
                t[-1] = t[-1].rstrip(SPLIT_MARKS)
            if glue:
                paragraphs[-1] += t.pop(0)
            paragraphs[-1] += (" " if paragraphs[-1] and t else "") + " ".join(t)
            glue = "hyphen" in found[i]
        return "\n\n".join(" ".join(self._mend(p)) for p in paragraphs if p)

    def _mend(self, paragraph: str) -> list[str]:
        t = paragraph.split()
        plain = [bare(x) for x in t]
        out = []
        for j, x in enumerate(t):
            w = plain[j]
            fix = self.printed(w, plain[max(0, j - WINDOW) : j] + plain[j + 1 : j + 1 + WINDOW]) if w and _WORD.search(w) and not _NUMBER.match(x) else None
            if fix:
                at = x.lower().find(w)
                fix = _as_case(fix, x[at : at + len(w)])
                x = x[:at] + fix + x[at + len(w) :]
            out.append(x)
        return out


def consistent_keeping_splits(text: str) -> str:
    """The consistent form, but with the soft hyphen at the end of a line kept as a mark."""
    if text.isascii():
        return text
    return consistent(re.sub(r"\xad(?=[ \t]*\r?(?:\n|$))", "¬", text)) if "\xad" in text else consistent(text)


def _as_case(word: str, like: str) -> str:
    if like.isupper() and len(like) > 1:
        return word.upper()
    return word[:1].upper() + word[1:] if like[:1].isupper() else word


def _near(a: str, b: str) -> bool:
    """Whether two line shapes of some length differ in a letter or two."""
    if len(b) < 12 or abs(len(a) - len(b)) > 2:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return len(b) - i - j <= 2 and len(a) - i - j <= 3


def _vectors(parts: list[tuple[DataFrame, str, bool]], words: DataFrame, n: int):
    """Vectors of all ``n`` frequent words that stand near one another, from all their pairs.

    Words and their vectors, where words and pairs are few enough for the driver; a table of
    `skip_grams_apart` else.
    """

    def pairs(at: dict[str, int] | None) -> DataFrame:
        return reduce(DataFrame.unionByName, [_pair_counts(df, text, at) for df, text, _ in parts]).groupBy("a", "b").agg(F.sum("n").alias("n"))

    if n <= MOST_TRAINED:
        keys = sorted(r.key for r in words.select("key").collect())
        got = pairs({w: i for i, w in enumerate(keys)}).limit(MOST_PAIRS + 1).toPandas()
        if len(got) <= MOST_PAIRS:
            used, ids = np.unique(np.concatenate([got["a"].to_numpy(), got["b"].to_numpy()]).astype(np.int64), return_inverse=True)
            keys = [keys[i] for i in used]
            return keys, *skip_grams(len(keys), ids[: len(got)], ids[len(got) :], got["n"].to_numpy(), start=_start(keys))
    frequent = pairs(None).join(words.select(F.col("key").alias("a")), "a").join(words.select(F.col("key").alias("b")), "b")
    return skip_grams_apart(frequent.select("a", "b", "n"))


def learn(parts: list[tuple[DataFrame, str, bool]], spark: SparkSession, extra_words: dict[str, int] | None = None) -> Knowledge:
    """What all texts tell, in two passes: counts and shapes, then pairs of frequent words.

    ``parts`` are (table, text column, whether its texts are pages). To the driver come words from a
    count of `LEAST_COUNT` and their vectors, if they are no more than `MOST_WORDS` (else they stay a
    table, see `_by_blocks`), shapes, bounded by their share, and all pairs of these words, if they are
    no more than `MOST_PAIRS` of `MOST_TRAINED` words (else see `skip_grams_apart`).
    """
    signs = None
    for df, text, pages in parts:
        one = count_signs(df, text, pages)
        signs = one if signs is None else signs.unionByName(one)
    signs = signs.groupBy("what", "key").agg(F.sum("n").alias("n")).persist()
    try:
        sizes = {r.what: r.n for r in signs.where(F.col("what").isin("p", "t")).collect()}
        total, pages_n = sizes.get("t", 0), sizes.get("p", 0)
        frequent = signs.where((F.col("what") == "w") & (F.col("n") >= LEAST_COUNT)).select("key", "n")
        listed = frequent.limit(MOST_WORDS + 1).collect()
        if few := len(listed) <= MOST_WORDS:
            counts, words_table = {r.key: r.n for r in listed}, None
        else:
            words_table = checkpoint(frequent)
            counts = {}
        shapes_n = (
            signs.where(F.col("what").isin("e", "b"))
            .groupBy("key")
            .agg(F.sum(F.when(F.col("what") == "e", F.col("n")).otherwise(0)).alias("edge"), F.sum("n").alias("n"))
            .where((F.col("edge") >= max(8.0, LEAST_SHAPE * pages_n)) & (F.col("edge") >= LEAST_EDGE * F.col("n")))
            .collect()
        )
    finally:
        signs.unpersist()
    if few:
        for w, n in (extra_words or {}).items():
            counts[w] = max(counts.get(w, 0), n)
    elif extra_words:
        words_table = words_table.unionByName(spark.createDataFrame(list(extra_words.items()), "key string, n long")).groupBy("key").agg(F.max("n").alias("n"))
    shapes = {r.key for r in shapes_n if not r.key.endswith((".", ",")) and re.search(r"[^\W\d_]{2}|N", r.key) and not _PAGE.match(r.key)}
    words = spark.createDataFrame([(w,) for w, n in counts.items() if n >= LEAST_COUNT], "key string") if few else words_table
    got = _vectors(parts, words, words.count())
    if few:
        keys, win, wout = got if isinstance(got, tuple) else _collected(got)
        return Knowledge(counts, total, shapes, {w: i for i, w in enumerate(keys)}, *((win, wout) if keys else (None, None)))
    if isinstance(got, tuple):
        got = spark.createDataFrame([(w, a.tolist(), b.tolist()) for w, a, b in zip(*got)], "key string, win array<float>, wout array<float>")
    known = Knowledge(counts, total, shapes)
    known.words_table = checkpoint(words_table.join(got, "key", "left"))
    return known


def _collected(vectors: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    got = vectors.orderBy("key").toPandas()
    return list(got["key"]), *(np.array([*got[c]], np.float32).reshape(-1, DIMENSIONS) for c in ("win", "wout"))


class Asked(dict):
    """Counts or places of words that note which words were asked for and aren't there yet."""

    def __init__(self, *a):
        super().__init__(*a)
        self.missing: set[str] = set()

    def get(self, w, default=None):
        if w not in self:
            self.missing.add(w)
        return super().get(w, default)

    def __contains__(self, w) -> bool:
        return super().__contains__(w)


def _by_blocks(df: DataFrame, key: str, text: str, knowledge: Knowledge, schema: str, work) -> DataFrame:
    """``work(knowledge, key, text)`` over all texts where the frequent words are too many for one dictionary.

    Texts are put into blocks. A round works through each block with the counts and vectors known so far
    and notes the words it lacks; theirs are joined in, 0 and none for words that aren't frequent. When no word is
    lacking the results stand. Each round shuffles the texts; there are about as many as glyph edits in
    a row plus four.
    """
    spark = df.sparkSession
    words_table = knowledge.words_table
    knowledge.words_table = None
    sent = spark.sparkContext.broadcast(knowledge)
    knowledge.words_table = words_table
    blocks = max(1, -(-df.count() // BLOCK_TEXTS))
    texts = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col(text).isNotNull()).withColumn("block", F.pmod(F.xxhash64("k"), F.lit(blocks)))
    known = spark.createDataFrame([], "block long, key string, n long, win array<float>, wout array<float>")

    def ready(words: pd.DataFrame) -> Knowledge:
        base = sent.value
        has = words["win"].notna()
        win, wout = (np.array([*words.loc[has, c]], np.float32).reshape(-1, DIMENSIONS) for c in ("win", "wout"))
        at = Asked(dict.fromkeys(words["key"]))
        at.update((w, i) for i, w in enumerate(words.loc[has, "key"]))
        return Knowledge(Asked(zip(words["key"], words["n"])), base.total, base.shapes, at, win, wout)

    def lacking(rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"block": [], "key": []}, dtype=object)
        know = ready(words)
        for k, t in zip(rows["k"], rows["t"]):
            work(know, k, t)
        block = int(rows["block"].iloc[0])
        return pd.DataFrame([(block, w) for w in sorted(know.counts.missing | know.at.missing)], columns=["block", "key"], dtype=object)

    def final(rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        know = ready(words)
        names = [x.split(" ")[0].strip("`") for x in schema.split(", ")]
        return pd.DataFrame([r for k, t in zip(rows["k"], rows["t"]) for r in work(know, k, t)], columns=names, dtype=object)

    while True:
        pairs = texts.groupBy("block").cogroup(known.groupBy("block"))
        asked = checkpoint(pairs.applyInPandas(lacking, "block long, key string").join(words_table, "key", "left").select("block", "key", F.coalesce("n", F.lit(0)).alias("n"), "win", "wout"))
        if asked.isEmpty():
            return pairs.applyInPandas(final, schema)
        known = known.unionByName(asked)


def damaged_lines(df: DataFrame, key: str, text: str, knowledge: Knowledge, pages: bool) -> DataFrame:
    """``key, line_no, kind``: the damaged lines of every text.

    Null, empty and blank texts have none; repeated rows are judged each. ``pages`` tells whether the
    texts are whole pages, with furniture at their edges.
    """
    kind = df.schema[key].dataType.simpleString()
    if knowledge.words_table is not None:
        return _by_blocks(df, key, text, knowledge, f"`{key}` {kind}, line_no int, kind string", lambda know, k, t: [(k, n, what) for n, what in know.judge(t, pages)] if t.strip() else [])
    sent = df.sparkSession.sparkContext.broadcast(knowledge)

    def run(batches):
        know = sent.value
        for pdf in batches:
            out = [(k, n, what) for k, t in zip(pdf[key], pdf[text]) if isinstance(t, str) and t.strip() for n, what in know.judge(t, pages)]
            yield pd.DataFrame(out, columns=[key, "line_no", "kind"])

    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, line_no int, kind string")


def repaired(df: DataFrame, key: str, text: str, knowledge: Knowledge, pages: bool) -> DataFrame:
    """``key, paragraphs``: every text as running paragraphs, parted by blank lines; null stays null."""
    kind = df.schema[key].dataType.simpleString()
    if knowledge.words_table is not None:
        some = _by_blocks(df, key, text, knowledge, f"`{key}` {kind}, paragraphs string", lambda know, k, t: [(k, know.repair(t, pages))])
        return some.unionByName(df.where(F.col(text).isNull()).select(key, F.lit(None).cast("string").alias("paragraphs")))
    sent = df.sparkSession.sparkContext.broadcast(knowledge)

    def run(batches):
        know = sent.value
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "paragraphs": [know.repair(t, pages) if isinstance(t, str) else None for t in pdf[text]]})

    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, paragraphs string")
