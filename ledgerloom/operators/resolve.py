"""Labels to concepts in stages: exact, fuzzy, by vectors (OP-R3 to R9), and lookups in the vocabulary (OP-K1 to K9).

Distinct labels are resolved once; costly stages see only what earlier ones left.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import label_form, nfkc_casefold, one_blank
from ledgerloom.session import fan_out

#: A label list goes to every executor; it must not be larger (checked).
MOST_LABELS = 50_000


def label_index(labels: DataFrame, nynorsk: bool = True) -> DataFrame:
    """Concept labels with their looked-up form, blank ones left out (OP-R3)."""
    return labels.where(F.col("subject_kind") == "concept").withColumn("form", label_form(F.col("text"), nynorsk)).where(F.coalesce("form", F.lit("")) != "")


def _of_equal_form(keys: DataFrame, index: DataFrame, top_k: int) -> DataFrame:
    """For ``__form, __lang`` that some label equals: the best label's concept, language and role, and the next ones."""
    rank = F.struct(
        (~F.coalesce(F.col("i.lang") == F.col("__lang"), F.lit(False))).cast("int").alias("a"), (F.col("i.role") != "standardLabel").cast("int").alias("b"), F.col("i.subject_id").endswith("Funksjon").cast("int").alias("c"), F.col("i.subject_id").alias("id"), F.col("i.lang").alias("lang"), F.col("i.role").alias("role")
    )
    hit = keys.alias("k").join(index.alias("i"), F.col("k.__form") == F.col("i.form")).groupBy("__form", "__lang").agg(F.array_sort(F.collect_list(rank)).alias("r"))
    return hit.select("__form", "__lang", F.col("r")[0]["id"].alias("concept_id"), F.col("r")[0]["lang"].alias("match_lang"), F.col("r")[0]["role"].alias("match_role"), F.transform(F.slice("r", 2, top_k - 1), lambda x: x["id"]).alias("others"))


def exact(queries: DataFrame, index: DataFrame, query: str = "query", lang: str | None = "lang_pref", top_k: int = 5) -> DataFrame:
    """``queries`` with ``concept_id``, ``match_lang``, ``match_role``, ``others`` by equal form (OP-R4).

    The preferred language wins, then the standard label, then the form not ending in Funksjon, then
    the id. ``others`` are the next up to ``top_k``. Queries without a match get nulls.
    """
    q = queries.withColumn("__form", label_form(F.col(query)))
    keys = q.select("__form", *([F.col(lang).alias("__lang")] if lang else [F.lit(None).cast("string").alias("__lang")])).where(F.coalesce("__form", F.lit("")) != "").distinct()
    found = _of_equal_form(keys, index, top_k)
    same = (F.col("q.__form") == F.col("f.__form")) & (F.col(f"q.{lang}").eqNullSafe(F.col("f.__lang")) if lang else F.lit(True))
    return q.alias("q").join(found.alias("f"), same, "left").select("q.*", "f.concept_id", "f.match_lang", "f.match_role", "f.others").drop("__form")


def token_set_ratio(a: str, b: str) -> float:
    """Similarity of two texts as sets of words, 0 to 100: 100 where one set holds the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_x or not only_y):
        return 100.0
    core = " ".join(both)
    s, t = (" ".join([core, *z] if core else z) for z in (only_x, only_y))
    best = _indel(s, t)
    if both:
        best = max(best, _indel(core, s), _indel(core, t))
    return 100.0 * best


def _indel(a: str, b: str) -> float:
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & where.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b)) if a or b else 1.0


def _label_list(index: DataFrame) -> list[tuple[str, str]]:
    rows = index.select("form", "subject_id").distinct().orderBy("form", "subject_id").limit(MOST_LABELS + 1).collect()
    if len(rows) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    return [(r[0], r[1]) for r in rows]


class _Labels:
    """A label list with what bounds the similarity of a text to each label from above."""

    def __init__(self, labels: list[tuple[str, str]]):
        self.labels = labels
        self.words = [" ".join(sorted(set(t.split()))) for t, _ in labels]
        self.of_word: dict[str, list[int]] = {}
        for n, w in enumerate(self.words):
            for x in w.split():
                self.of_word.setdefault(x, []).append(n)
        letters = sorted({c for w in self.words for c in w})
        self.at = {c: i for i, c in enumerate(letters)}
        self.counts = np.array([self._count(w) for w in self.words], dtype=np.int32).reshape(len(labels), len(letters))
        self.sizes = np.array([len(w) for w in self.words])

    def _count(self, text: str) -> list[int]:
        out = [0] * len(self.at)
        for c in text:
            if (i := self.at.get(c)) is not None:
                out[i] += 1
        return out

    def best(self, form: str, threshold: float, top_k: int) -> list[tuple[float, int]]:
        """The best labels of a text, if the first reaches the threshold.

        A label that shares no word can't be more similar than their letters in common allow; most are
        left out by that, without changing the result.
        """
        words = " ".join(sorted(set(form.split())))
        if not words or not self.labels:
            return []
        bound = 200.0 * np.minimum(self.counts, np.array(self._count(words))).sum(axis=1) / (self.sizes + len(words))
        bound[[n for w in words.split() for n in self.of_word.get(w, ())]] = 100.0
        top: list[tuple[float, int]] = []
        for n in np.argsort(-bound, kind="stable").tolist():
            # no label from here on can reach the threshold, or come among the best
            if bound[n] < threshold and (not top or -top[0][0] < threshold) or len(top) == top_k and bound[n] < -top[-1][0]:
                break
            insort(top, (-token_set_ratio(form, self.labels[n][0]), n))
            del top[top_k:]
        return top if top and -top[0][0] >= threshold else []


def fuzzy(queries: DataFrame, index: DataFrame, query: str = "query", threshold: float = 95.0, top_k: int = 5) -> DataFrame:
    """``queries`` with ``concept_id``, ``score``, ``others`` by token-set similarity (OP-R5).

    The best label must reach ``threshold``; equal scores go by label order. Each distinct form is
    compared once with the list.
    """
    labels = _label_list(index)

    def run(batches):
        known = _Labels(labels)
        for pdf in batches:
            out = []
            for f in pdf["__form"]:
                scored = known.best(f, threshold, top_k)
                out.append((f, labels[scored[0][1]][1], -scored[0][0], [labels[n][1] for _, n in scored[1:]]) if scored else (f, None, None, []))
            yield pd.DataFrame(out, columns=["__form", "concept_id", "score", "others"])

    q = queries.withColumn("__form", label_form(F.col(query)))
    forms = q.select("__form").where(F.coalesce("__form", F.lit("")) != "").distinct()
    return q.join(fan_out(forms).mapInPandas(run, "__form string, concept_id string, score double, others array<string>"), "__form", "left").drop("__form")


def nearest(queries: DataFrame, base: DataFrame, key: str, vector: str, threshold: float = 0.78, top_k: int = 5, block: int = 2048) -> DataFrame:
    """``query_key, key, rank, cosine``: the nearest base vectors of each query, if the best is near enough (OP-R6).

    The query set is a stated one and goes to every executor in blocks of matrix products against all
    rows; each task keeps its ``top_k`` a query, the rest is merged after one shuffle. A query does not
    match itself. Null and zero vectors match nothing; ties go to the smaller key.
    """
    asked = queries.where(F.col(vector).isNotNull()).select(key, vector).orderBy(key).limit(200_001).collect()
    if len(asked) > 200_000:
        raise ValueError("too many queries for one pass; split them")
    kind = base.schema[key].dataType.simpleString()
    ids = np.array([r[0] for r in asked])
    q = np.array([r[1] for r in asked], dtype=np.float64).reshape(len(ids), -1)
    norm = np.linalg.norm(q, axis=1, keepdims=True)
    sent = base.sparkSession.sparkContext.broadcast((ids, np.divide(q, norm, out=np.zeros_like(q), where=norm > 0)))

    def run(batches):
        ids_, q_ = sent.value
        best: dict[int, list] = {}
        for pdf in batches:
            pdf = pdf[pdf[vector].notna()]
            if not len(pdf) or not len(ids_):
                continue
            m = np.stack(pdf[vector].to_numpy()).astype(np.float64)
            n = np.linalg.norm(m, axis=1, keepdims=True)
            m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
            keys = pdf[key].to_numpy()
            for lo in range(0, len(ids_), block):
                sim = q_[lo : lo + block] @ m.T
                sim[ids_[lo : lo + block][:, None] == keys[None, :]] = -2
                top = np.argpartition(-sim, min(top_k, sim.shape[1] - 1), axis=1)[:, : top_k + 4]
                for i in range(len(sim)):
                    floor = np.sort(sim[i, top[i]])[::-1][min(top_k, len(top[i])) - 1]
                    near = np.flatnonzero(sim[i] >= floor)
                    k = lo + i
                    best[k] = sorted(best.get(k, []) + [(-sim[i, j], keys[j]) for j in near if sim[i, j] > -2])[:top_k]
        rows = [(ids_[k], j, -s) for k, v in best.items() for s, j in v]
        yield pd.DataFrame(rows, columns=["query_key", key, "cosine"])

    found = base.select(key, vector).mapInPandas(run, f"query_key {kind}, `{key}` {kind}, cosine double")
    order = Window.partitionBy("query_key").orderBy(F.desc("cosine"), key)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
    good = ranked.where((F.col("rank") == 1) & (F.col("cosine") >= threshold)).select("query_key")
    return ranked.join(good, "query_key", "left_semi").select("query_key", key, "rank", "cosine")


CANDIDATE = "struct<concept_id:string,confidence:double,method:string>"


class _Vectors:
    """The vectors of a label list, for products with those of queries."""

    def __init__(self, rows: list[tuple[str, list[float]]]):
        self.ids = [r[0] for r in rows]
        m = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), -1)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        self.m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    def best(self, vector, threshold: float, top_k: int) -> list[tuple[float, str]]:
        """The nearest labels, if the first is near enough; of equals the smaller id first."""
        if vector is None or not self.ids:
            return []
        v = np.asarray(vector, dtype=np.float64)
        n = float(np.linalg.norm(v))
        if not n:
            return []
        sims = self.m @ (v / n)
        floor = np.partition(-sims, min(top_k, len(sims)) - 1)[min(top_k, len(sims)) - 1]
        top = sorted((float(-sims[k]), self.ids[k]) for k in np.flatnonzero(-sims <= floor))[:top_k]
        return top if -top[0][0] >= threshold else []


def resolve(
    queries: DataFrame, labels: DataFrame, query: str = "query", lang: str | None = "lang_pref", use_fuzzy: bool = True, threshold: float = 95.0, top_k: int = 5,
    vectors: tuple[DataFrame, DataFrame] | None = None, vector_threshold: float = 0.78,
) -> DataFrame:
    """All stages (OP-R8, R9): ``queries`` with ``concept_id``, ``method``, ``confidence``, ``chain``, ``candidates``, ``match_lang``, ``match_role``.

    Each distinct form and language goes through the stages once, and a stage only sees what is left:
    equal forms, then token-set similarity, then, where ``vectors`` are given, the cosine of vectors.
    Those are two tables, ``form, vector`` of queries (forms as of `label_form`) and ``subject_id,
    vector`` of labels. ``candidates`` are the next best of the stage that matched, ``top_k`` with the
    match. Without a match the concept is null, there are no candidates and the chain ends in none; an
    empty text has the chain none alone.
    """
    index = label_index(labels)
    q = queries.withColumn("__form", label_form(F.col(query))).withColumn("__lang", F.col(lang) if lang else F.lit(None).cast("string"))
    keys = q.select("__form", "__lang").where(F.coalesce("__form", F.lit("")) != "").distinct()
    same = (F.col("k.__form") == F.col("f.__form")) & F.col("k.__lang").eqNullSafe(F.col("f.__lang"))
    first = keys.alias("k").join(_of_equal_form(keys, index, top_k).alias("f"), same, "left").select("k.__form", "k.__lang", "f.concept_id", "f.match_lang", "f.match_role", "f.others")
    if vectors is not None:
        first = first.join(vectors[0].groupBy(F.col("form").alias("__form")).agg(F.first("vector").alias("__vector")), "__form", "left")
    listed = _label_list(index) if use_fuzzy else []
    near = None
    if vectors is not None:
        rows = vectors[1].where(F.col("vector").isNotNull()).select("subject_id", "vector").orderBy("subject_id").limit(MOST_LABELS + 1).collect()
        if len(rows) > MOST_LABELS:
            raise ValueError(f"more than {MOST_LABELS} label vectors")
        near = [(r[0], r[1]) for r in rows]
    stages = ["exact", *(["fuzzy"] if use_fuzzy else []), *(["embedding"] if near is not None else [])]

    def run(batches):
        known = _Labels(listed) if use_fuzzy else None
        by_vector = _Vectors(near) if near is not None else None
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if isinstance(r.concept_id, str):
                    others = [] if r.others is None else [(c, 1.0, "exact") for c in r.others]
                    out.append((r[0], r[1], r.concept_id, "exact", 1.0, ["exact"], others, r.match_lang, r.match_role))
                    continue
                found, how = [], "none"
                if known is not None:
                    found, how = [(listed[n][1], -s / 100.0) for s, n in known.best(r[0], threshold, top_k)], "fuzzy"
                if not found and by_vector is not None:
                    found, how = [(c, -s) for s, c in by_vector.best(r[-1], vector_threshold, top_k)], "embedding"
                if not found:
                    out.append((r[0], r[1], None, "none", None, [*stages, "none"], [], None, None))
                    continue
                out.append((r[0], r[1], found[0][0], how, found[0][1], stages[: stages.index(how) + 1], [(c, s, how) for c, s in found[1:]], None, None))
            yield pd.DataFrame(out, columns=columns)

    columns = ["__form", "__lang", "concept_id", "method", "confidence", "chain", "candidates", "match_lang", "match_role"]
    schema = f"__form string, __lang string, concept_id string, method string, confidence double, chain array<string>, candidates array<{CANDIDATE}>, match_lang string, match_role string"
    done = fan_out(first).mapInPandas(run, schema)
    same = (F.col("q.__form") == F.col("d.__form")) & F.col("q.__lang").eqNullSafe(F.col("d.__lang"))
    joined = q.alias("q").join(done.alias("d"), same, "left").select("q.*", *[F.col(f"d.{c}") for c in columns[2:]]).drop("__form", "__lang")
    return joined.withColumn("method", F.coalesce("method", F.lit("none"))).withColumn("chain", F.coalesce("chain", F.array(F.lit("none")))).withColumn("candidates", F.coalesce("candidates", F.array().cast(f"array<{CANDIDATE}>")))


def resolve_envelope(resolved: DataFrame, query: str = "query") -> DataFrame:
    """Resolutions as JSON objects (OP-K9); absent members are left out."""
    return resolved.select(query, F.to_json(F.struct(F.col(query).alias("query"), "concept_id", "confidence", "method", "candidates", F.col("chain").alias("method_chain"))).alias("json"))


# the vocabulary --------------------------------------------------------


def concept(concepts: DataFrame, concept_id: str) -> DataFrame:
    """The concept with an id, or no row (OP-K1)."""
    return concepts.where(F.col("concept_id") == concept_id)


def list_concepts(concepts: DataFrame, status: str | None = None) -> DataFrame:
    """All concepts, or those of a status (OP-K2)."""
    return concepts if status is None else concepts.where(F.col("status") == status)


def axis_members(members: DataFrame, axis_id: str) -> DataFrame:
    """The members of an axis in order (OP-K3)."""
    return members.where(F.col("axis_id") == axis_id).orderBy("order", "member_id")


def standard_labels(labels: DataFrame, lang: str) -> DataFrame:
    """``subject_id, label``: each subject's standard label in a language, of several the first (OP-K4)."""
    return labels.where((F.col("lang") == lang) & (F.col("role") == "standardLabel")).groupBy("subject_id").agg(F.min("text").alias("label"))


def search_labels(labels: DataFrame, text: str, lang: str | None = None, role: str | None = None, whole: bool = True) -> DataFrame:
    """Labels equal to a text or holding it, without case and extra blanks (OP-K5)."""
    form, wanted = one_blank(nfkc_casefold(F.col("text"))), one_blank(nfkc_casefold(F.lit(text)))
    hit = (form == wanted) if whole else F.contains(form, wanted)
    out = labels.where(hit)
    out = out if lang is None else out.where(F.col("lang") == lang)
    return out if role is None else out.where(F.col("role") == role)


def children(arcs: DataFrame, parent: str, role: str | None = None) -> DataFrame:
    """The arcs below a parent in order (OP-K6)."""
    out = arcs.where(F.col("parent_id") == parent)
    return (out if role is None else out.where(F.col("role") == role)).orderBy("order", "child_id")


def of_subject(table: DataFrame, subject: str) -> DataFrame:
    """Mappings or references of a subject (OP-K7)."""
    return table.where(F.col("subject_id") == subject)


def concept_cards(concepts: DataFrame, labels: DataFrame, arcs: DataFrame, references: DataFrame | None = None, asked: DataFrame | None = None) -> DataFrame:
    """``concept_id, card``: a concept with its labels, arcs and references as JSON (OP-K8).

    Asked-for ids that are unknown have a card with an error.
    """
    gather = lambda df, key, cols, name: df.groupBy(F.col(key).alias("concept_id")).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    out = concepts.join(gather(labels, "subject_id", ["lang", "role", "text"], "labels"), "concept_id", "left").join(gather(arcs, "parent_id", ["role", "order", F.col("child_id").alias("child"), "weight"], "calc_arcs"), "concept_id", "left")
    if references is not None:
        out = out.join(gather(references, "subject_id", ["publisher", "document", "paragraph"], "references"), "concept_id", "left")
    out = out.select("concept_id", F.to_json(F.struct(*out.columns)).alias("card"))
    if asked is not None:
        error = F.to_json(F.struct(F.concat(F.lit("unknown concept: "), "concept_id").alias("error")))
        out = asked.select("concept_id").join(out, "concept_id", "left").select("concept_id", F.coalesce("card", error).alias("card"))
    return out
