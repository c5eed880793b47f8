"""Two fact sets compared, and drift by concept or organisation (OP-D1 to D4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["orgnr", "concept_id", "period_end"]
KINDS = ["agree", "disagree", "v1_only", "v2_only"]


def one_per_key(facts: DataFrame, policy: str = "error", keys: list[str] | None = None, order: str = "ord") -> DataFrame:
    """One fact per key: the ``first`` or the ``last`` by ``order``, or an error on a repeated key (OP-D1)."""
    keys = keys or KEY
    rest = [c for c in facts.columns if c not in keys]
    if policy in ("first", "last"):
        pick = F.min_by if policy == "first" else F.max_by
        return facts.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("f")).select(*keys, "f.*")
    if policy != "error":
        raise ValueError(f"unknown policy {policy!r}; known: error, first, last")
    n = F.count("*").over(Window.partitionBy(*keys))
    # the check stands in a filter: an unused column with it would be pruned
    return facts.withColumn("__n", n).where(F.when(F.col("__n") > 1, F.raise_error(F.concat_ws(" ", F.lit("repeated key:"), *keys)).cast("boolean")).otherwise(True)).drop("__n")


def diff_entries(v1: DataFrame, v2: DataFrame, v1_policy: str = "error", v2_policy: str = "error") -> DataFrame:
    """``orgnr, concept_id, period_end, kind, v1_value, v2_value, abs_delta, rel_delta`` per key (OP-D2).

    Values agree if equal after rounding half to even. Deltas are those of the rounded values, 0 for
    agreement, null for one-sided keys or null values; relative to a rounded 0 they are infinite.
    """
    a = one_per_key(v1, v1_policy).select(*KEY, F.col("value").alias("v1_value"), F.lit(True).alias("in1"))
    b = one_per_key(v2, v2_policy).select(*KEY, F.col("value").alias("v2_value"), F.lit(True).alias("in2"))
    x, y = F.bround("v1_value", 0), F.bround("v2_value", 0)
    kind = F.when(F.col("in2").isNull(), "v1_only").when(F.col("in1").isNull(), "v2_only").when(x.eqNullSafe(y), "agree").otherwise("disagree")
    both = a.join(b, KEY, "full_outer").withColumn("kind", kind).withColumn("d", F.abs(y - x))
    two = F.col("in1") & F.col("in2")
    return both.select(
        *KEY,
        "kind",
        "v1_value",
        "v2_value",
        F.when(two, F.when(F.col("kind") == "agree", 0.0).otherwise(F.col("d"))).alias("abs_delta"),
        F.when(two, F.when(F.col("kind") == "agree", 0.0).when(x == 0, F.when(F.col("d").isNotNull(), F.lit(float("inf")))).otherwise(F.col("d") / F.abs(x))).alias("rel_delta"),
    )


def drift(entries: DataFrame, by: str) -> DataFrame:
    """Counts of each kind by a key, and the share of agreement among keys in both, null if none (OP-D3, D4)."""
    counts = entries.groupBy(by).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
    return counts.withColumn("agreement_rate", F.try_divide(F.col("agree").cast("double"), (F.col("agree") + F.col("disagree")).cast("double")))
