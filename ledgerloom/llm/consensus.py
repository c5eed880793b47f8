"""Consensus from several annotators' labels (problem 2).

Competence-and-spamming mixture: a label is the true one with the annotator's competence, else drawn
from the annotator's personal guess distribution; expectation-maximisation over all items gives both,
and from them a posterior over each item's candidate labels. Labels are open strings here, so guesses
are distributions over the kind of slip that turns one candidate into another (a letter for another, a
lost group of digits), which items share. Annotators that make the same slips (engines of one family)
would outvote the rest; how often a slip of one is shared by another is estimated as well. An attempt
that gave no reading is an outcome of its own: its chance depends on the annotator and not on which
label is true, so it lowers agreement and reliability but leaves the choice among candidates as it is.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint, fan_out

#: Parameters are kept on the driver up to this many; they grow with annotators, not with items.
MOST_PARAMETERS = 2_000_000

ITEM = "item string, kind string, labels array<string>, voters array<array<string>>, prior array<double>, failed array<string>, slips array<string>, given int"
_COUNTS = pa.schema([(n, pa.string()) for n in ("what", "voter", "kind", "extra")] + [("x", pa.float64())])
#: Least share of a slip, and the chance of further slips in one label.
FLOOR, AGAIN = 1e-4, 0.3


def slip(true: str, read: str) -> str:
    """The kind of slip that turns ``true`` into ``read``."""
    if true == read:
        return "same"
    if true.lstrip("-") == read.lstrip("-"):
        return "sign"
    a, b = true, read
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    if len(x) <= 2 and len(y) <= 2 and i + j > 0:
        if len(x) == len(y) == 2 and x == y[::-1]:
            return "swap"
        if not x and y.isalnum():
            return "add"
        return f"{x}>{y}"
    if len(a) == len(b) and 2 <= sum(p != q for p, q in zip(a, b)) <= 3:
        return "|".join(f"{p}>{q}" for p, q in zip(a, b) if p != q)
    if true.startswith(read) or true.endswith(read):
        return "cut"
    if read.startswith(true) or read.endswith(true):
        return "grown"
    return "twice" if 0 < i + j and i + j >= max(len(a), len(b)) - 3 else "other"


def items_of(df: DataFrame, item: str, kind: str, label: str, hit: str, dropped: str | None = None, attempted: str | None = None) -> DataFrame:
    """One row per item with its candidate labels, who gave each, and the label's share among all items.

    Annotator names are compared without case and outer blanks; repeated rows and names count once.
    Annotators listed in ``dropped`` on any row of an item are left out of that item, unless nobody
    would remain. Annotators listed in ``attempted`` on any row of an item that gave none of its
    readings and aren't dropped are ``failed``. A candidate with a null list of annotators stays, given
    by nobody; a null label is no candidate, and an item with nothing else has none. An item whose rows
    name several kinds has the one that sorts last; rows with a null item take no part.
    """
    names = lambda c: F.array_distinct(F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda v: F.lower(F.trim(v))), lambda v: v.isNotNull() & (v != "")))
    none = F.array().cast("array<string>")
    rows = df.where(F.col(item).isNotNull()).select(
        F.col(item).alias("item"), F.coalesce(F.col(kind), F.lit("")).alias("kind"), F.col(label).cast("string").alias("label"), names(hit).alias("hit"), (names(dropped) if dropped else none).alias("out"), (names(attempted) if attempted else none).alias("tried")
    )
    one = rows.groupBy("item", "label").agg(F.max("kind").alias("kind"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in ("hit", "out", "tried")])
    support = one.where((F.size("hit") >= 2) & F.col("label").isNotNull()).groupBy("kind", "label").agg(F.count("*").alias("support"))
    one = one.join(support, ["kind", "label"], "left").withColumn("support", F.coalesce("support", F.lit(0)))
    per = fan_out(one, "item").groupBy("item").agg(
        F.max("kind").alias("kind"),
        F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "hit", "support")))).alias("c"),
        F.array_distinct(F.flatten(F.collect_list("out"))).alias("out"),
        F.array_distinct(F.flatten(F.collect_list("tried"))).alias("tried"),
    )
    kept = F.transform("c", lambda x: F.filter(x["hit"], lambda v: ~F.array_contains(F.col("out"), v)))
    someone = F.exists(kept, lambda v: F.size(v) > 0)
    failed = F.array_sort(F.array_except(F.array_except("tried", F.flatten("c.hit")), "out"))
    return per.select(
        "item", "kind", F.col("c.label").alias("labels"), F.when(someone, kept).otherwise(F.col("c.hit")).alias("voters"), F.transform("c", lambda x: x["support"].cast("double")).alias("prior"), failed.alias("failed")
    )


def _with_slips(items: DataFrame, key_type: str) -> DataFrame:
    schema = f"item {key_type}, kind string, labels array<string>, voters array<array<string>>, prior array<double>, failed array<string>, slips array<string>"

    def run(batches):
        known = lru_cache(maxsize=100_000)(slip)
        for pdf in batches:
            pdf = pdf.copy()
            pdf["slips"] = [[known(t, r) for t in ls for r in ls] for ls in pdf["labels"]]
            pdf["voters"] = [[list(v) for v in vs] for vs in pdf["voters"]]
            yield pdf[["item", "kind", "labels", "voters", "prior", "failed", "slips"]]

    return items.mapInPandas(run, schema)


class Model:
    """Competence, failures and shared slips of every annotator, and its guesses per kind of item."""

    def __init__(self, right=None, wrong=None, guess=None, slips=None, shared=None, seen=None, strength: float = 20.0, families: bool = True, failed=None):
        self.right, self.wrong, self.guess = right or {}, wrong or {}, guess or {}
        self.slips, self.shared, self.seen, self.strength, self.families = slips or {}, shared or {}, seen or {}, strength, families
        self.failed = failed or {}
        self.total = {k: sum(v.values()) for k, v in self.slips.items()}
        self.guessed = {v: sum(g.values()) for v, g in self.guess.items()}
        r, w = sum(self.right.values()), sum(self.wrong.values())
        self.mean = (r + 8) / (r + w + 10)
        self.memo: dict = {}

    def competence(self, v: str) -> float:
        r, w = self.right.get(v, 0.0), self.wrong.get(v, 0.0)
        return min(0.999, max(0.02, (r + self.strength * self.mean) / (r + w + self.strength)))

    def votes(self, v: str) -> float:
        return self.right.get(v, 0.0) + self.wrong.get(v, 0.0)

    def answered(self, v: str) -> float:
        """Share of the annotator's attempts that gave a reading."""
        tried = self.votes(v) + self.failed.get(v, 0.0)
        return self.votes(v) / tried if tried else 1.0

    def slipped(self, v: str, kind: str, s: str) -> float:
        """Chance that v reads something else by slip ``s``; several letters read wrong are several slips."""
        if (got := self.memo.get((v, kind, s))) is None:
            if "|" in s and len(s) > 4:
                got = AGAIN
                for part in s.split("|"):
                    got *= self.slipped(v, kind, part) / (1 - self.competence(v))
                # not remembered: there are too many kinds of several slips
                return max(FLOOR * FLOOR, got * (1 - self.competence(v)))
            base = (self.slips.get(kind, {}).get(s, 0.0) + 0.5) / (self.total.get(kind, 0.0) + 200.0)
            own = self.guess.get((v, kind), {})
            share = (own.get(s, 0.0) + self.strength * base) / (self.guessed.get((v, kind), 0.0) + self.strength)
            got = self.memo[v, kind, s] = max(FLOOR * FLOOR, (1 - self.competence(v)) * share)
        return got

    def joined(self, u: str, v: str) -> float:
        """Chance that v shares a slip of u; held low where u has few slips among its votes."""
        if not self.families:
            return 0.0
        if (got := self.memo.get((u, v))) is None:
            votes = self.right.get(u, 0.0) + self.wrong.get(u, 0.0)
            got = self.memo[u, v] = min(0.98, self.shared.get((u, v), 0.0) / (self.seen.get((u, v), 0.0) + 20.0 + 0.03 * votes))
        return got

    def slip_table(self, voters: list[str], kinds: list[str], slips: list[str]) -> np.ndarray:
        """`slipped` of every voter (rows) for every pair of kind and slip (columns)."""
        return np.array([[self.slipped(v, k, s) for k, s in zip(kinds, slips)] for v in voters]).reshape(len(voters), len(slips))

    def joined_table(self, voters: list[str]) -> np.ndarray:
        return np.array([[self.joined(u, v) for v in voters] for u in voters]).reshape(len(voters), len(voters))


class Votes:
    """A batch of items as arrays: candidates, the pairs of a true and a read candidate, and who read it.

    All arithmetic of a round runs over these arrays at once. A pair is left out where nobody read its
    second candidate.
    """

    def __init__(self, batch: pa.RecordBatch):
        column = lambda n: batch.column(batch.schema.get_field_index(n))
        labels, voters, slips, failed = (column(n) for n in ("labels", "voters", "slips", "failed"))
        self.n = np.diff(labels.offsets.to_numpy())  # candidates of each item
        self.first = np.cumsum(self.n) - self.n
        self.item = np.repeat(np.arange(len(self.n)), self.n)
        self.prior = column("prior").flatten().to_numpy(zero_copy_only=False)
        kinds = column("kind").dictionary_encode()
        self.kind_names, kind = kinds.dictionary.to_pylist(), kinds.indices.to_numpy()
        groups = voters.flatten()
        self.size = np.diff(groups.offsets.to_numpy())  # voters of each candidate
        named = groups.flatten().dictionary_encode()
        self.names, self.voter = named.dictionary.to_pylist(), named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.candidate = np.repeat(np.arange(len(self.size)), self.size)
        self.failed = Counter(failed.flatten().to_pylist())
        self.word = np.array([k == "word" for k in self.kind_names], bool)[kind] if len(kind) else np.zeros(0, bool)
        # pairs of candidates of one item, in the order of the slips
        square = self.n.astype(np.int64) ** 2
        of = np.repeat(np.arange(len(self.n)), square)
        k = np.arange(int(square.sum())) - np.repeat(np.cumsum(square) - square, square)
        t, r = self.first[of] + k // np.maximum(self.n[of], 1), self.first[of] + k % np.maximum(self.n[of], 1)
        wrong = (t != r) & (self.size[r] > 0)
        self.true, self.read = t[wrong], r[wrong]
        coded = slips.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        both = kind[of[wrong]].astype(np.int64) * max(1, len(names)) + coded.indices.to_numpy(zero_copy_only=False)[wrong]
        distinct, self.slip = np.unique(both, return_inverse=True)
        self.slip_kinds = [self.kind_names[i // max(1, len(names))] for i in distinct]
        self.slips = [names[i % max(1, len(names))] for i in distinct]
        # the voters of each pair's second candidate, padded by -1
        wide = int(self.size[self.read].max()) if len(self.read) else 0
        start = (np.cumsum(self.size) - self.size)[self.read]
        at = np.arange(wide)[None, :]
        inside = at < self.size[self.read][:, None]
        self.group = np.where(inside, self.voter[np.where(inside, start[:, None] + at, 0)] if len(self.voter) else -1, -1)

    def sum_of(self, values: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(where, values, n)

    def shares(self, x: np.ndarray) -> np.ndarray:
        """``x`` of candidates as shares of their items; alike where an item has none."""
        total = self.sum_of(x, self.item, len(self.n))[self.item]
        return np.where(total > 0, x / np.where(total > 0, total, 1.0), 1.0 / np.maximum(self.n[self.item], 1))

    def majority(self) -> np.ndarray:
        return self.shares(self.size + 1e-3 * np.log1p(self.prior))

    def posterior(self, m: Model) -> np.ndarray:
        """The chance of every candidate to be the true one."""
        if not len(self.item):
            return np.zeros(0)
        top = self.sum_of(self.prior + 0.5, self.item, len(self.n))[self.item]
        x = np.where(self.word[self.item], np.log((self.prior + 0.5) / top), 0.0)
        right = np.log([m.competence(v) for v in self.names]) if self.names else np.zeros(0)
        x += self.sum_of(right[self.voter], self.candidate, len(x))
        if len(self.true):
            table = m.slip_table(self.names, self.slip_kinds, self.slips)
            alone = np.where(self.group >= 0, table[self.group, self.slip[:, None]], 0.0)
            order = np.argsort(-alone, axis=1, kind="stable")  # who slips so most often may have led the others
            group, alone = np.take_along_axis(self.group, order, 1), np.take_along_axis(alone, order, 1)
            joined = m.joined_table(self.names)
            gain = np.zeros(len(self.true))
            for k in range(group.shape[1]):
                miss = np.ones(len(gain))
                for u in range(k):
                    miss *= 1 - joined[group[:, u], group[:, k]]
                chance = (1 - miss) + miss * alone[:, k]
                gain += np.where(group[:, k] >= 0, np.log(np.where(group[:, k] >= 0, chance, 1.0)), 0.0)
            x += self.sum_of(gain, self.true, len(x))
        largest = np.full(len(self.n), -np.inf)
        np.maximum.at(largest, self.item, x)
        return self.shares(np.exp(x - largest[self.item]))

    def counts(self, p: np.ndarray) -> dict[tuple, float]:
        """Expected counts of the batch: right and wrong readings, slips, and slips that two voters share."""
        total: dict[tuple, float] = defaultdict(float)
        for v, x in self.failed.items():
            total["failed", v, "", ""] += x
        n = len(self.names)
        for v, x in zip(self.names, self.sum_of(np.where(p < 1e-3, 0.0, p)[self.candidate], self.voter, n)):
            total["right", v, "", ""] += float(x)
        weight = p[self.true] if len(self.true) else np.zeros(0)
        use = weight >= 1e-3
        group, weight, slips = self.group[use], weight[use], self.slip[use]
        if not len(weight):
            return total
        in_group = np.zeros((len(weight), n), np.float32)
        rows = np.arange(len(weight))
        for k in range(group.shape[1]):
            has = group[:, k] >= 0
            in_group[rows[has], group[has, k]] = 1.0
        everyone = np.zeros((len(self.n), n), np.float32)
        everyone[self.item[self.candidate], self.voter] = 1.0
        given = in_group * weight[:, None].astype(np.float32)
        seen, shared = given.T.astype(np.float64) @ everyone[self.item[self.true[use]]], given.T.astype(np.float64) @ in_group
        for a, v in enumerate(self.names):
            total["wrong", v, "", ""] += float(given[:, a].sum(dtype=np.float64))
            by_slip = np.bincount(slips, given[:, a], len(self.slips))
            for i in np.flatnonzero(by_slip):
                parts = self.slips[i].split("|") if "|" in self.slips[i] and len(self.slips[i]) > 4 else [self.slips[i]]
                for part in parts:
                    total["guess", v, self.slip_kinds[i], part] += float(by_slip[i]) / len(parts)
            for b, u in enumerate(self.names):
                if a != b and seen[a, b]:
                    total["seen", v, "", u] += float(seen[a, b])
                    if shared[a, b]:
                        total["shared", v, "", u] += float(shared[a, b])
        return total


def _statistics(items: DataFrame, model, first: bool) -> Model:
    """One pass over all items: expected counts, summed per task before the shuffle and again after it."""
    shared_model = items.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total: dict[tuple, float] = defaultdict(float)
        for b in batches:
            votes = Votes(b)
            for k, x in votes.counts(votes.majority() if first else votes.posterior(shared_model.value)).items():
                total[k] += x
        yield pa.RecordBatch.from_pydict({n: [k[i] for k in total] for i, n in enumerate(("what", "voter", "kind", "extra"))} | {"x": list(total.values())}, schema=_COUNTS)

    schema = "what string, voter string, kind string, extra string, x double"
    rows = items.mapInArrow(run, schema).groupBy("what", "voter", "kind", "extra").agg(F.sum("x").alias("x")).limit(MOST_PARAMETERS + 1).collect()
    if len(rows) > MOST_PARAMETERS:
        raise ValueError(f"more than {MOST_PARAMETERS} parameters: too many annotators for one model")
    right, wrong, failed, guess, slips, shared, seen = {}, {}, {}, defaultdict(dict), defaultdict(lambda: defaultdict(float)), {}, {}
    for r in rows:
        if r.what == "right":
            right[r.voter] = r.x
        elif r.what == "wrong":
            wrong[r.voter] = r.x
        elif r.what == "failed":
            failed[r.voter] = r.x
        elif r.what == "guess":
            guess[r.voter, r.kind][r.extra] = r.x
            slips[r.kind][r.extra] += r.x
        else:
            (seen if r.what == "seen" else shared)[r.voter, r.extra] = r.x
    return Model(right, wrong, dict(guess), {k: dict(x) for k, x in slips.items()}, shared, seen, failed=failed)


def fit(df: DataFrame, item: str, kind: str, label: str, hit: str, dropped: str | None = None, rounds: int = 6, attempted: str | None = None) -> tuple[DataFrame, Model]:
    """The items, written once, and the model after ``rounds`` of expectation-maximisation over all of them."""
    key_type = df.schema[item].dataType.simpleString()
    items = checkpoint(_with_slips(items_of(df, item, kind, label, hit, dropped, attempted), key_type))
    model = _statistics(items, None, True)
    for n in range(rounds):
        model.families = n >= 2  # first who is reliable, then who slips together
        model = _statistics(items, model, False)
    return items, model


def consensus(items: DataFrame, model: Model) -> DataFrame:
    """``item, kind, label, posterior, agreement, n_votes, n_attempts``: one row per item, with a null label where it has no candidate.

    ``agreement`` is the share of the attempts, the counted votes and those that gave no reading, that
    the label has; null if nobody tried. The most
    probable label wins, of equals the one with more votes, then the one that sorts first.
    """
    sent = items.sparkSession.sparkContext.broadcast(model)
    key_type = items.schema["item"].dataType.simpleString()

    def run(batches):
        for b in batches:
            votes = Votes(b)
            p = votes.posterior(sent.value)
            place = np.arange(len(p))
            order = np.lexsort((place, -votes.size, -np.round(p, 9), votes.item))  # labels are in order within an item
            best = order[np.searchsorted(votes.item[order], np.arange(len(votes.n)))] if len(order) else np.zeros(len(votes.n), np.int64)
            none = votes.n == 0
            best = np.where(none, 0, best)
            n = np.bincount(votes.item[votes.candidate], minlength=len(votes.n))
            failed = np.diff(b.column(b.schema.get_field_index("failed")).offsets.to_numpy())
            tried = n + failed
            hit = np.where(none, 0, votes.size[best] if len(votes.size) else 0)
            labels = b.column(b.schema.get_field_index("labels")).flatten()
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(b.schema.get_field_index("item")),
                    b.column(b.schema.get_field_index("kind")),
                    labels.take(pa.array(np.where(none, None, best).tolist(), pa.int64())),
                    pa.array(np.where(none, np.nan, p[best] if len(p) else np.nan), mask=none),
                    pa.array(hit / np.maximum(tried, 1), mask=(tried == 0) | none),
                    pa.array(n.astype(np.int32)),
                    pa.array(tried.astype(np.int32)),
                ],
                names=["item", "kind", "label", "posterior", "agreement", "n_votes", "n_attempts"],
            )

    return items.mapInArrow(run, f"item {key_type}, kind string, label string, posterior double, agreement double, n_votes int, n_attempts int")


def reliability(df: DataFrame, model: Model) -> DataFrame:
    """``voter, competence, answered, reliability, commonest_slip, n_votes, n_attempts``: one row per annotator.

    ``competence`` is how often a reading is right, ``answered`` how often an attempt gives a reading,
    ``reliability`` their product: how often an attempt gives the right reading.
    """
    rows = []
    for v in sorted(set(model.right) | set(model.wrong) | set(model.failed)):
        own: dict[str, float] = defaultdict(float)
        for (u, _), g in model.guess.items():
            if u == v:
                for k, x in g.items():
                    own[k] += x
        most = min(own, key=lambda k: (-own[k], k)) if own else None
        share = model.answered(v)
        rows.append((v, round(model.competence(v), 4), round(share, 4), round(model.competence(v) * share, 4), most, int(round(model.votes(v))), int(round(model.votes(v) + model.failed.get(v, 0.0)))))
    return df.sparkSession.createDataFrame(rows, "voter string, competence double, answered double, reliability double, commonest_slip string, n_votes long, n_attempts long")
