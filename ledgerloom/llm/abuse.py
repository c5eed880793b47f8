"""Abusive, hateful or sexual content (problem 10).

A convolutional text classifier in numpy: hashed embeddings of words and their letter groups, filters
of several widths, max pooling, one output. Texts are first cleared of disguises (look-alike letters,
digits for letters, letters set apart or repeated), cut into sentences and long sentences into
overlapping windows; a document's score is that of its worst window. Thresholds are calibrated by
language, with examples kept from training and the scores of all documents.
"""

from __future__ import annotations

import base64
import os
import random
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.abuse_examples import SMALL_WORDS, WORDS, examples, frames  # noqa: F401
from ledgerloom.llm.normal import LOOKALIKE, consistent
from ledgerloom.session import checkpoint

#: Size of the model, and of a window in words.
BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 17, 24, 40, (1, 2, 3)
WINDOW, STEP = 28, 18
#: Sentences for training: written examples, and unlabelled sentences of the corpus taken as harmless (a bounded sample),
#: and about how many documents those are taken from.
EXAMPLES, SAMPLE, SAMPLE_DOCUMENTS = 30_000, 10_000, 6_000
#: Harmless sentences of random words for training, and the public vocabulary those are taken from (optional).
SALADS, VOCABULARY = 8_000, "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: In training: share of words left out, and how much embeddings shrink.
LOSE_WORDS, DECAY = 0.2, 0.4
#: Sentences and words that a worker remembers.
KNOWN_SENTENCES, KNOWN_WORDS = 200_000, 40_000

#: Small words that tell the language of a sentence; other languages are one class.
SMALL = {
    "nb": set("jeg du er en og ikke det som på til av den vi dere din ditt deg meg fra noen burde være bare kan hvor hun sin om for med ut".split()),
    "nn": set("eg ikkje ein eit dei dykk nokon vere berre kvar ho frå såg auka vart saman si heile kjem veit utan til og er på som".split()),
    "en": set("the is are you and of to a i my me not that what who them they it all we for with your in on be was every".split()),
    "other": set("jag och att är inte jeg ikke af til dig mig hvad und der die das ist ich du nicht ein eine le la les des et est pas une que qui vous je el los las y es un una por no te se de".split()),
}
_ONLY_NN = set("eg ikkje ein eit dei nokon dykk ho frå vart kvar berre si heile saman".split())
_SPOKEN: dict[str, list[str]] = {}
for _lang, _words in (*SMALL.items(), ("nn", _ONLY_NN)):
    for _w in _words:
        _SPOKEN.setdefault(_w, []).append(_lang)
#: Classes of language with a threshold of their own; ``und`` are windows without small words.
LANGUAGES = (*SMALL, "und")

#: Slots of the abusive patterns that hold words abusive in themselves.
DEMEANING = set("JAVDSXHLCBFR")
_SMALL_WORDS = [t.split() for t in SMALL_WORDS.values()]

_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "b", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "€": "e", "|": "l", "#": "*", "+": "t"})
_LATIN = str.maketrans(LOOKALIKE)
_APART = re.compile(r"(?<![^\W_])([^\W\d_])([.\-_ ·])(?=[^\W_*])(?:[^\W_*]\2){1,40}[^\W_*](?![^\W_])")
_TOKEN = re.compile(r"[^\W_*]+(?:\*+[^\W_]*)*|\*+[^\W_]+")
_MIXED = re.compile(r"(?<![^\s.,;:?()\"<>/\\])[^\s.,;:?()\"<>/\\]*[0-9@$!€|#+*][^\s.,;:?()\"<>/\\]*")
_APART_HINT = re.compile(r"(?<![^\W_])[^\W\d_][.\-_ ·][^\W_*][.\-_ ·][^\W_*]")
_MIXED_HINT = re.compile(r"[^\W\d_][0-9@$!€|#+*]|[0-9@$!€|#+*][^\W\d_]|[@$!€|#+*]{2}")
_LOOKALIKE = re.compile(f"[{''.join(map(re.escape, LOOKALIKE))}]")
_REPEATED = re.compile(r"([^\W\d_])\1{2,}")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\r\n\t]+|<[^>]{1,60}>")


def _unleet(m: re.Match) -> str:
    if m[0].isdigit():
        return m[0]
    w = m[0].rstrip("!")
    letters = sum(c.isalpha() for c in w)
    odd = sum(c in "0134567890@$!€|#+*" for c in w)
    if not odd or letters < 1 or letters + odd < 3 or (letters < 2 and odd > 3) or re.fullmatch(r"\d+[.\-]?[a-zæøå]{1,3}", w):
        return w
    return w.translate(_LEET)


def clear(sentence: str) -> list[str]:
    """The words of a sentence without disguises, in lower case; numbers are one word."""
    s = sentence
    if not s.isascii():
        s = consistent(s) or ""
        if _LOOKALIKE.search(s):
            s = s.translate(_LATIN)
    s = s.lower()
    if _APART_HINT.search(s):
        s = _APART.sub(lambda m: m[0].replace(m[2], ""), s)
    if _MIXED_HINT.search(s):
        s = _MIXED.sub(_unleet, s)
    s = _REPEATED.sub(r"\1", s)
    return ["0" if t.isdigit() else t for t in _TOKEN.findall(s)]


def language(words: list[str]) -> str:
    """The class of language by small words, ``und`` where there are none; at a tie the first in the order of `SMALL`."""
    n = dict.fromkeys(SMALL, 0)
    for w in words:
        for lang in _SPOKEN.get(w, ()):
            n[lang] += 1
    best = max(SMALL, key=lambda x: n[x])
    return best if n[best] else "und"


def sentence_windows(sentence: str) -> list[list[str]]:
    """A sentence as lists of words, a long one as overlapping windows; none without words."""
    w = clear(sentence)
    if len(w) <= WINDOW:
        return [w] if w else []
    return [w[i : i + WINDOW] for i in range(0, len(w) - WINDOW + STEP, STEP)]


def split_sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()]


def windows(text: str) -> list[list[str]]:
    """The windows of all sentences of a text."""
    return [w for s in split_sentences(text) for w in sentence_windows(s)]


@lru_cache(maxsize=20_000)
def features(word: str) -> tuple[int, ...]:
    """Buckets of a word and of all its letter groups."""
    w = f"<{word}>"
    ids = [zlib.crc32(word.encode())]
    ids += [zlib.crc32(b"3" + w[i : i + 3].encode()) for i in range(len(w) - 2) if "*" not in w[i : i + 3] or len(word) < 4]
    ids += [zlib.crc32(b"4" + w[i : i + 4].encode()) for i in range(len(w) - 3)]
    return tuple(i % BUCKETS for i in ids)


def disguise(text: str, rng: random.Random) -> str:
    """A text with some words misspelled or disguised, as writers do who want to get past a filter."""
    words = text.split()
    for _ in range(rng.choice((0, 1, 1, 2, 3))):
        i = rng.randrange(len(words))
        w = words[i]
        if len(w) < 3:
            continue
        j = rng.randrange(1, len(w) - 1) if len(w) > 2 else 0
        how = rng.randrange(7)
        if how == 0:
            w = "".join({"a": "4", "e": "3", "i": "1", "o": "0", "s": "5", "t": "7", "l": "1", "g": "9"}.get(c, c) if rng.random() < 0.7 else c for c in w)
        elif how == 1:
            w = w[:1] + "*" * (len(w) - 2) + w[-1:]
        elif how == 2:
            w = "".join(("*" if rng.random() < 0.8 else "#") if c in "aeiouyæøå" else c for c in w)
        elif how == 3:
            w = rng.choice(".-_ ").join(w)
        elif how == 4:
            w = w[:j] + w[j] * rng.randint(2, 6) + w[j + 1 :]
        elif how == 5:
            w = w[:j] + w[j + 1 :]
        else:
            w = w[:j] + rng.choice("aeiourstl") + w[j + 1 :]
        words[i] = w
    out = " ".join(words)
    return out.upper() if rng.random() < 0.05 else out


def _sum_rows(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Rows summed up by their place; places without a row are zero."""
    order = np.argsort(at, kind="stable")
    places, start = np.unique(at[order], return_index=True)
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[places] = np.add.reduceat(rows[order], start)
    return out


class Vocabulary:
    """The words of some windows by number, with the buckets of each."""

    def __init__(self, some: list[list[str]]):
        self.words = list(dict.fromkeys(chain.from_iterable(some)))
        at = {w: i for i, w in enumerate(self.words)}
        self.lengths = np.array([len(s) for s in some], np.int64)
        self.ids = np.full((len(some), max([max(WIDTHS), *map(len, some)])), len(self.words), np.int32)  # the number after the last is no word
        for i, s in enumerate(some):
            self.ids[i, : len(s)] = [at[w] for w in s]
        each = [features(w) for w in self.words]
        self.start = np.cumsum([0] + [len(x) for x in each])
        self.buckets = np.fromiter(chain.from_iterable(each), np.int64, int(self.start[-1]))

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of some words one after the other, and how many each has."""
        size = self.start[words + 1] - self.start[words]
        first = np.cumsum(size) - size
        return self.buckets[np.arange(int(size.sum())) - np.repeat(first - self.start[words], size)], size


class Net:
    """Embeddings, filters and output of the classifier."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        self.e = r.normal(0, 0.03, (BUCKETS, SIZE)).astype(np.float32)
        self.w = [r.normal(0, (2 / (k * SIZE)) ** 0.5, (k * SIZE, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.o = r.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        #: Scores and classes of language of examples kept from training: abusive, harmless.
        self.held: tuple[list[tuple[float, str]], list[tuple[float, str]]] = ([], [])

    def save(self, path: str) -> None:
        """Keep the model in a file (``.npz``)."""
        held = {f"h{i}_{n}": np.array([x[j] for x in side]) for i, side in enumerate(self.held) for j, n in enumerate(("p", "lang"))}
        np.savez_compressed(path, e=self.e.astype(np.float16), o=self.o, c=self.c, **{f"w{i}": w for i, w in enumerate(self.w)}, **{f"b{i}": b for i, b in enumerate(self.b)}, **held)

    @classmethod
    def load(cls, path: str) -> Net:
        """A model kept by `save`."""
        with np.load(path) as z:
            net = cls()
            net.e, net.o, net.c = z["e"].astype(np.float32), z["o"], z["c"]
            net.w, net.b = ([z[f"{n}{i}"] for i in range(len(WIDTHS))] for n in "wb")
            net.held = tuple([(float(p), str(x)) for p, x in zip(z[f"h{i}_p"], z[f"h{i}_lang"])] for i in range(2))
        return net

    def vectors(self, buckets: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The vector of each word: the mean of its buckets."""
        return np.add.reduceat(self.e[buckets], np.cumsum(size) - size) / size[:, None] if len(size) else np.zeros((0, SIZE), np.float32)

    def projected(self, vec: np.ndarray) -> np.ndarray:
        """What each word adds to every filter, at every place under it."""
        return np.concatenate([vec @ w[i * SIZE : (i + 1) * SIZE] for k, w in zip(WIDTHS, self.w) for i in range(k)], axis=1)

    def _pooled(self, parts: np.ndarray, ids: np.ndarray, lengths: np.ndarray):
        """The largest answer of each filter over a window, and where it is."""
        n, length = ids.shape
        out, where, col = [], [], 0
        for k, b in zip(WIDTHS, self.b):
            span = length - k + 1
            y = np.zeros((n, span, FILTERS), np.float32)
            for i in range(k):
                y += parts[:, col : col + FILTERS][ids[:, i : span + i]]
                col += FILTERS
            y[np.arange(span)[None, :] >= np.maximum(lengths - k + 1, 1)[:, None]] = -1e9
            a = y.argmax(axis=1)
            where.append(a)
            out.append(np.maximum(np.take_along_axis(y, a[:, None, :], 1)[:, 0] + b, 0))
        return np.concatenate(out, axis=1), where

    def answer(self, h: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(h @ self.o + self.c, -30, 30)))

    def score(self, some: list[list[str]]) -> np.ndarray:
        """Chance of each window to be abusive."""
        return Scorer(self).score(some)

    def train(self, some: list[list[str]], labels: np.ndarray, epochs: int = 4, rate: float = 0.006, seed: int = 2, batch: int = 160) -> None:
        """Minibatch training with adaptive steps over windows of like length; the order of the batches is fixed by the seed."""
        rng = np.random.default_rng(seed)
        v = Vocabulary(some)
        parts = [self.e, *self.w, *self.b, self.o, self.c]
        m1, m2 = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        step, none = 0, len(v.words)
        for epoch in range(epochs):
            order = np.argsort(v.lengths + rng.random(len(some)) * 6)
            cuts = [order[i : i + batch] for i in range(0, len(order), batch)]
            for j in rng.permutation(len(cuts)):
                part = cuts[j]
                lengths = v.lengths[part]
                length = max(int(lengths.max()), max(WIDTHS))
                words, ids = np.unique(np.append(v.ids[part, :length].ravel(), none), return_inverse=True)
                ids = ids[:-1].reshape(len(part), length)
                ids = np.where(rng.random(ids.shape, np.float32) < LOSE_WORDS, len(words) - 1, ids)
                buckets, size = v.of(words[:-1])
                vec = np.concatenate([self.vectors(buckets, size), np.zeros((1, SIZE), np.float32)])
                h, where = self._pooled(self.projected(vec), ids, lengths)
                keep = (rng.random(h.shape, np.float32) > 0.3).astype(np.float32) / 0.7
                hd = h * keep
                g = ((self.answer(hd) - labels[part]) / len(part)).astype(np.float32)
                go, gc = hd.T @ g, g.sum(keepdims=True)
                gh = g[:, None] * self.o[None, :] * keep * (h > 0)
                gw, gb, gv = [], [], np.zeros_like(vec)
                rows = np.arange(len(part))[:, None]
                for f, (k, a) in enumerate(zip(WIDTHS, where)):
                    gk = gh[:, f * FILTERS : (f + 1) * FILTERS]
                    gb.append(gk.sum(0))
                    gi = []
                    for i in range(k):
                        at = ids[rows, a + i]  # the word under this place of each filter
                        # what comes back to each word from each filter, summed before it meets the weights
                        back = np.bincount((at * FILTERS + np.arange(FILTERS)).ravel(), gk.ravel(), len(vec) * FILTERS).reshape(len(vec), FILTERS).astype(np.float32)
                        gi.append(vec.T @ back)
                        gv += back @ self.w[f][i * SIZE : (i + 1) * SIZE].T
                    gw.append(np.concatenate(gi))
                rows_e, at = np.unique(buckets, return_inverse=True)
                add = _sum_rows(np.repeat(gv[:-1] / size[:, None], size, axis=0), at, len(rows_e))
                step += 1
                lr = rate * (1 - 0.8 * epoch / epochs)
                m1[0][rows_e] = 0.9 * m1[0][rows_e] + 0.1 * add
                m2[0][rows_e] = 0.99 * m2[0][rows_e] + 0.01 * add**2
                self.e[rows_e] -= lr * (m1[0][rows_e] / (np.sqrt(m2[0][rows_e]) + 1e-5) + DECAY * self.e[rows_e])
                for q, (param, grad) in enumerate(zip(parts[1:], [*gw, *gb, go, gc]), 1):
                    m1[q] = 0.9 * m1[q] + 0.1 * grad
                    m2[q] = 0.99 * m2[q] + 0.01 * grad**2
                    param -= lr * (m1[q] / (1 - 0.9**step)) / (np.sqrt(m2[q] / (1 - 0.99**step)) + 1e-6)


class Scorer:
    """Scores windows; what a word adds to the filters is worked out once."""

    def __init__(self, net: Net):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.parts = np.zeros((1024, sum(WIDTHS) * FILTERS), np.float32)  # row 0 is no word

    def _learn(self, some: list[list[str]]) -> None:
        new = [w for w in dict.fromkeys(chain.from_iterable(some)) if w not in self.at]
        if len(self.at) + len(new) > KNOWN_WORDS and self.at:
            self._forget()
            new = list(dict.fromkeys(chain.from_iterable(some)))
        if not new:
            return
        first = len(self.at) + 1
        if first + len(new) > len(self.parts):
            grown = np.zeros((max(first + len(new), 2 * len(self.parts)), self.parts.shape[1]), np.float32)
            grown[:first] = self.parts[:first]
            self.parts = grown
        each = [features(w) for w in new]
        size = np.array([len(x) for x in each])
        vec = self.net.vectors(np.fromiter(chain.from_iterable(each), np.int64, int(size.sum())), size)
        self.parts[first : first + len(new)] = self.net.projected(vec.astype(np.float32))
        self.at.update(zip(new, range(first, first + len(new))))

    def score(self, some: list[list[str]]) -> np.ndarray:
        out = np.zeros(len(some), np.float32)
        order = sorted(range(len(some)), key=lambda i: len(some[i]))
        for lo in range(0, len(order), 512):
            part = order[lo : lo + 512]
            chunk = [some[i] for i in part]
            self._learn(chunk)
            ids = np.zeros((len(part), max(len(chunk[-1]), max(WIDTHS))), np.int64)
            for i, s in enumerate(chunk):
                ids[i, : len(s)] = [self.at[w] for w in s]
            h, _ = self.net._pooled(self.parts, ids, np.array([len(s) for s in chunk]))
            out[part] = self.net.answer(h)
        return out


def corpus_sample(df: DataFrame, text: str, n: int = SAMPLE, documents: int = SAMPLE_DOCUMENTS) -> list[list[str]]:
    """Up to ``n`` different windows of the corpus, those with the smallest hashes: the same on every run.

    They come from about ``documents`` different texts, chosen by a hash: the same share of hashes on
    every size of corpus, all of a smaller one. Each task keeps its ``n`` smallest, so what comes to the
    driver is bounded whatever the corpus.
    """
    place = F.pmod(F.xxhash64(text), F.lit(1 << 20))
    total = df.agg(F.approx_count_distinct(text)).first()[0]
    chosen = df.select(text).where(place <= int((1 << 20) * min(1.0, documents / max(1, total))))

    def run(batches):
        best: dict[int, str] = {}
        seen: set[int] = set()  # copies of one text or sentence may be many
        for pdf in batches:
            for t in pdf[text]:
                if isinstance(t, str) and (h := hash(t)) not in seen:
                    seen.add(h)
                    for s in split_sentences(t):
                        if (h := hash(s)) not in seen:
                            seen.add(h)
                            for w in sentence_windows(s):
                                s = " ".join(w)
                                best[zlib.crc32(s.encode())] = s
            if len(best) > 2 * n:
                best = {k: best[k] for k in sorted(best)[:n]}
            if len(seen) > KNOWN_SENTENCES:
                seen.clear()
        yield pd.DataFrame(sorted(best.items())[:n], columns=["h", "s"])

    rows = chosen.mapInPandas(run, "h long, s string").distinct().orderBy("h", "s").limit(n).collect()
    return [r.s.split(" ") for r in rows]


def everyday_words(path: str) -> list[str]:
    """The whole words of a public vocabulary, without those that the abusive patterns use; none if there is no such file."""
    if not os.path.exists(path):
        return []
    with open(path, "rb") as f:
        tokens = [base64.b64decode(line.split()[0]).decode(errors="ignore") for line in f if line.strip()]
    loaded = {w for fill in WORDS.values() for k, v in fill.items() if k in DEMEANING for w in clear(v.replace("|", " "))}
    return sorted({w for t in tokens if len(t) > 3 and t[0] == " " and t[1:].isalpha() and (w := t[1:].lower()) not in loaded})


def _salad(words: list[str], rng: random.Random) -> list[str]:
    """A harmless sentence of everyday words and the small words of one language."""
    small = rng.choice(_SMALL_WORDS)
    return [rng.choice(small) if rng.random() < 0.35 else rng.choice(words) for _ in range(rng.randint(1, 14))]


def fit(df: DataFrame, text: str, sample: int = SAMPLE, documents: int = SAMPLE_DOCUMENTS, written: int = EXAMPLES, harmless: list[str] | None = None, seed: int = 5, vocabulary: str = VOCABULARY) -> Net:
    """The classifier trained on ``written`` examples and a bounded sample of the corpus.

    The bounds of the sample are parameters: ``sample`` windows of about ``documents`` texts. It is
    taken as harmless, but for what a model trained on the other half of it finds abusive. ``harmless`` are texts known to be so, such as a reference list; random words of a
    public ``vocabulary`` make `SALADS` more. A tenth of the examples is kept from training to
    calibrate the thresholds.
    """
    rng = random.Random(seed)
    calm = corpus_sample(df, text, sample, documents)
    labels = [w for t in harmless or [] if t for w in sentence_windows(t)]
    polite = [clear(s) for _, s, y in examples(1000, seed + 1) if not y] + labels
    everyday = everyday_words(vocabulary)
    salads = [_salad(everyday, rng) for _ in range(SALADS if everyday else 0)]
    made = []
    for _, s, y in examples(written, seed):
        if y and rng.random() < 0.5 or not y and rng.random() < 0.15:
            s = disguise(s, rng)
        w = clear(s)
        if (r := rng.random()) < 0.4:  # sentences without an end run into the next
            other = rng.choice(polite if not calm or rng.random() < 0.3 else calm)
            w = w + other[: rng.randint(2, 24)] if r < 0.3 else other[-rng.randint(1, 8) :] + w
        if w:
            made.append((w[:WINDOW], y))
    held, made = made[: len(made) // 10], made[len(made) // 10 :]

    def trained(quiet: list[list[str]], more: list[list[str]], epochs: int) -> Net:
        # headings and labels are short and repeated: each counts as often as a few sentences
        short = [s for s in quiet if len(s) <= 4] + labels
        some = [w for w, _ in made] + quiet + more + short * 3
        net = Net()
        net.train(some, np.array([y for _, y in made] + [0] * (len(some) - len(made)), np.float32), epochs=epochs)
        return net

    # each half of the sample is judged by a model that hasn't seen it, else abusive sentences in it would be learned as harmless
    halves = calm[::2], calm[1::2]
    kept = [s for own, other in (halves, halves[::-1]) if own for s, p in zip(own, trained(other, [], 1).score(own)) if p < 0.5]
    net = trained(kept, salads, 4)
    rated = [(float(p), language(w), y) for p, (w, y) in zip(net.score([w for w, _ in held]), held)]
    net.held = tuple([(p, lang) for p, lang, z in rated if z == y] for y in (1, 0))
    return net


#: Steps of the scores in histograms, and the thresholds to choose from.
BINS = 200
GRID = np.arange(0.4, 0.701, 0.01)


def calibrate(held: tuple[list[tuple[float, str]], list[tuple[float, str]]], histogram: dict[tuple[str, int], int]) -> dict[str, float]:
    """The threshold of each class of language, from examples kept from training and the scores of all documents.

    ``histogram`` counts documents by class and score bin. At a threshold t, the examples tell which
    share of abusive documents is reached; the documents above t beyond that share of the abusive ones
    are false alarms. How many are abusive follows from the documents with the highest scores. The
    threshold loses least in misses and false alarms together; examples alone decide where there are
    no documents.
    """
    out = {}
    for lang in LANGUAGES:
        bad, good = (np.array([p for p, x in side if x == lang] or [p for p, _ in side] or [0.5]) for side in held)
        reached = np.array([(bad >= t).mean() for t in GRID])
        alarms = np.array([(good >= t).mean() for t in GRID])
        counts = np.array([histogram.get((lang, b), 0) for b in range(BINS + 1)], float)
        above = np.array([counts[int(round(t * BINS)) :].sum() for t in GRID]) / max(1.0, counts.sum())
        abusive = above[-1] / max(reached[-1], 0.05)
        loss = abusive * (1 - reached) + np.maximum(0, above - abusive * reached) + 0.01 * (alarms + 1 - reached)
        out[lang] = float(GRID[int(np.argmin(loss))])
    return out


def score_documents(df: DataFrame, key: str, text: str, net: Net) -> DataFrame:
    """``key, score, spoken, flagged``: the score of every document's worst window.

    ``spoken`` is the class of language of that window. A document is flagged if a window reaches the
    threshold of its class; thresholds follow from the scores of all documents (`calibrate`). Null,
    empty and blank texts score 0 and are not flagged. Whole texts are scored, however long; copies
    score alike. One pass over the texts; the scores are written to the checkpoint folder.
    """
    sent = df.sparkSession.sparkContext.broadcast(net)
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        scorer = Scorer(sent.value)
        known: dict[str, dict[str, float]] = {}  # of a sentence, by class of language
        rated: dict[str, tuple[str, float]] = {}  # of a window; numbers are alike in it
        for pdf in batches:
            texts = pdf[text].tolist()
            for lo in range(0, len(texts), 500):
                chunk = [split_sentences(t) if isinstance(t, str) else [] for t in texts[lo : lo + 500]]
                if len(known) > KNOWN_SENTENCES:
                    known.clear()
                if len(rated) > KNOWN_SENTENCES:
                    rated.clear()
                new = [s for s in dict.fromkeys(chain.from_iterable(chunk)) if s not in known]
                flat = [(s, " ".join(w), w) for s in new for w in sentence_windows(s)]
                fresh = {k: w for _, k, w in flat if k not in rated}
                rated.update((k, (language(w), p)) for (k, w), p in zip(fresh.items(), scorer.score(list(fresh.values())).tolist()))
                known.update((s, {}) for s in new)
                for s, k, _ in flat:
                    lang, p = rated[k]
                    known[s][lang] = max(known[s].get(lang, 0.0), p)
                out = []
                for sentences in chunk:
                    worst: dict[str, float] = {}
                    for s in sentences:
                        for lang, p in known[s].items():
                            worst[lang] = max(worst.get(lang, 0.0), p)
                    out.append([{"spoken": lang, "score": round(p, 6)} for lang, p in sorted(worst.items())])
                yield pd.DataFrame({key: pdf[key].iloc[lo : lo + 500].to_numpy(), "__worst": out})

    scored = checkpoint(df.select(key, text).mapInPandas(run, f"`{key}` {kind}, __worst array<struct<spoken:string,score:double>>"))
    each = scored.select(F.explode("__worst").alias("w")).groupBy("w.spoken", F.floor(F.col("w.score") * BINS).cast("int").alias("bin")).count().collect()
    threshold = calibrate(net.held, {(r["spoken"], r["bin"]): r["count"] for r in each})
    of_class = F.create_map(*chain.from_iterable((F.lit(lang), F.lit(t)) for lang, t in threshold.items()))
    # the first of the highest scores; structs are ordered by their fields
    top = F.array_max(F.transform("__worst", lambda w: F.struct(w["score"].alias("score"), w["spoken"].alias("spoken"))))
    return scored.select(
        key,
        F.coalesce(top["score"], F.lit(0.0)).alias("score"),
        top["spoken"].alias("spoken"),
        F.exists("__worst", lambda w: w["score"] >= of_class[w["spoken"]]).alias("flagged"),
    )
