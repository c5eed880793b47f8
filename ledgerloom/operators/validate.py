"""Rules over facts and over the vocabulary (OP-A2 to A8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILURE = ["fact_id", "rule", "message"]


def body_parts(body: str) -> tuple[Column, Column]:
    """The concept and the value text of a fact's body (OP-A2): the first classifying and the first tagging part."""
    first = lambda purpose, field: F.try_element_at(F.filter(body, lambda x: x["purpose"] == purpose), F.lit(1))[field]
    return first("classifying", "source"), first("tagging", "value")


def _missing(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def period_rule(facts: DataFrame) -> DataFrame:
    """Failures of facts whose period is incomplete (OP-A3): an instant needs an end, a duration both ends."""
    kind = F.col("period_type")
    found = F.array_compact(
        F.array(
            F.when((kind == "instant") & _missing("period_end"), F.lit("instant concept without period end")),
            F.when((kind == "duration") & _missing("period_end"), F.lit("duration concept without period end")),
            F.when((kind == "duration") & _missing("period_start"), F.lit("duration concept without period start")),
        )
    )
    return facts.select("fact_id", F.lit("period").alias("rule"), F.explode(found).alias("message"))


def dimension_rule(facts: DataFrame, members: DataFrame) -> DataFrame:
    """Failures of facts with an unknown axis or a member of another axis (OP-A4).

    ``facts``: fact_id and a map of axis to member; ``members``: axis_id, member_id.
    """
    pairs = facts.select("fact_id", F.explode("dimensions").alias("axis_id", "member_id"))
    axes = members.select("axis_id").distinct().withColumn("known", F.lit(True))
    inside = members.select("axis_id", "member_id").distinct().withColumn("inside", F.lit(True))
    out = pairs.join(axes, "axis_id", "left").join(inside, ["axis_id", "member_id"], "left").where(F.col("inside").isNull())
    message = F.when(F.col("known").isNull(), F.concat(F.lit("unknown axis: "), "axis_id")).otherwise(F.concat(F.lit("member "), F.coalesce("member_id", F.lit("null")), F.lit(" not in axis "), "axis_id"))
    return out.select("fact_id", F.lit("dimension").alias("rule"), message.alias("message"))


def arc_rule(facts: DataFrame, arcs: DataFrame, keys: list[str], tolerance: float = 1.0) -> DataFrame:
    """Failures of parents that differ from the weighted sum of their children (OP-A5).

    ``facts``: fact_id, concept_id, value, ord and ``keys`` (the filing and its period); of several
    readable values of a concept the first by ord counts. ``arcs``: parent_id, child_id, weight. Only
    parents all of whose children have a value are judged; null keys count as one empty key.
    """
    keyed = facts.select("fact_id", "concept_id", "value", "ord", *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]).where(F.col("value").isNotNull())
    one = keyed.groupBy(*keys, "concept_id").agg(F.min_by(F.struct("value", "fact_id"), "ord").alias("v"))
    parents = one.join(arcs.select(F.col("parent_id").alias("concept_id"), "child_id", "weight"), "concept_id")
    children = one.select(*keys, F.col("concept_id").alias("child_id"), F.col("v.value").alias("child_value"))
    sums = parents.join(children, [*keys, "child_id"], "left").groupBy(*keys, "concept_id", F.col("v.fact_id").alias("fact_id"), F.col("v.value").alias("actual")).agg(
        F.sum(F.col("weight") * F.col("child_value")).alias("expected"), F.count("child_value").alias("n"), F.count("*").alias("of")
    )
    bad = sums.where((F.col("n") == F.col("of")) & (F.abs(F.col("actual") - F.col("expected")) > tolerance))
    return bad.select("fact_id", F.lit("arc").alias("rule"), F.lit("parent differs from the sum of its children").alias("message"), "expected", "actual", (F.col("actual") - F.col("expected")).alias("diff"))


def split(facts: DataFrame, failures: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Passing facts, and failing ones with all their failures (OP-A6)."""
    found = reduce(DataFrame.unionByName, [f.select(*FAILURE) for f in failures])
    listed = found.groupBy("fact_id").agg(F.array_sort(F.collect_list(F.struct("rule", "message"))).alias("failures"))
    return facts.join(found.select("fact_id").distinct(), "fact_id", "left_anti"), facts.join(listed, "fact_id")


#: The values that a concept's attributes may have.
ALLOWED = {"period_type": ("instant", "duration"), "status": ("candidate", "standard", "deprecated", "retired"), "balance": ("debit", "credit")}


def vocabulary_failures(concepts: DataFrame, labels: DataFrame, arcs: DataFrame | None = None) -> DataFrame:
    """``subject_id, rule``: what the shapes of a vocabulary forbid (OP-A7).

    A concept needs a label, at most one preferred label a language, a period type, status and data
    type of the allowed values, and a scheme where ``concepts`` has that column; a balance may be missing;
    an arc weighs 1 or -1. No row means that all conform (OP-A8).
    """
    has = labels.where(F.col("role") == "standardLabel")
    rules = [
        concepts.join(has.select(F.col("subject_id").alias("concept_id")).distinct(), "concept_id", "left_anti").select(F.col("concept_id").alias("subject_id"), F.lit("label missing").alias("rule")),
        has.groupBy("subject_id", "lang").agg(F.count("*").alias("n")).where("n > 1").select("subject_id", F.concat(F.lit("several labels in "), "lang").alias("rule")),
        concepts.where(F.col("data_type").isNull()).select(F.col("concept_id").alias("subject_id"), F.lit("data type missing").alias("rule")),
    ]
    for c, allowed in ALLOWED.items():
        known = F.col(c).isin(*allowed)
        bad = ~F.coalesce(known, F.lit(c == "balance"))
        rules.append(concepts.where(bad).select(F.col("concept_id").alias("subject_id"), F.lit(f"{c} not allowed").alias("rule")))
    if "scheme" in concepts.columns:
        rules.append(concepts.where(F.col("scheme").isNull()).select(F.col("concept_id").alias("subject_id"), F.lit("scheme missing").alias("rule")))
    if arcs is not None:
        rules.append(arcs.where(~F.coalesce(F.col("weight").isin(1.0, -1.0), F.lit(False))).select(F.col("parent_id").alias("subject_id"), F.lit("weight not allowed").alias("rule")))
    return reduce(DataFrame.unionByName, rules)
