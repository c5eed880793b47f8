"""Readings against known truth (OP-E1 to E8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import plain_minus

#: Words of 64 bits that a key's numbers are marked in, and digits of the longest number.
WORDS, LONGEST = 32, 19


def number_pattern(n: Column) -> tuple[Column, Column]:
    """Patterns of a whole number: in groups of three, and digit by digit, blanks allowed between."""
    digits = F.abs(n).cast("decimal(20,0)").cast("string")
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit(""))
    by_group = F.replace(F.format_number(F.abs(n).cast("decimal(20,0)"), 0), F.lit(","), F.lit(r"\s*"))
    by_digit = F.regexp_replace(digits, r"(?<=\d)(?=\d)", r"\\s*")
    return F.concat(sign, by_group), F.concat(sign, by_digit)


def number_present(n: Column, text: Column) -> Column:
    """Whether a number stands in a text (OP-E1).

    Blanks may stand between groups or digits; there are no boundaries, so longer numbers hold shorter
    ones. A negative one may also stand in parentheses. 0 needs blanks or an end around it.
    """
    t = plain_minus(text)
    n = F.bround(n, 0).cast("long")
    g, d = number_pattern(n)
    pg, pd = number_pattern(F.abs(n))
    inside = F.regexp_extract_all(t, F.lit(r"(?U)\(\s*([\d\s.,]+)\s*\)"), F.lit(1))
    u = lambda p: F.concat(F.lit("(?U)"), p)
    found = F.rlike(t, u(g)) | F.rlike(t, u(d)) | ((n < 0) & F.exists(inside, lambda x: F.rlike(x, u(pg)) | F.rlike(x, u(pd))))
    zero = t.rlike(r"(?U)(?:^|\s)0(?:\s|$|[.,])")
    return F.coalesce(F.when(n == 0, zero).otherwise(found), F.lit(False))


def truth_numbers(df: DataFrame, key: str, metrics: str, drop_zero: bool = True) -> DataFrame:
    """``key, n``: the distinct whole numbers of a map of metrics per key, rounded half to even (OP-E6)."""
    each = df.where(F.col(key).isNotNull()).select(key, F.explode(F.map_values(metrics)).alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    out = each.select(key, F.bround("v", 0).cast("long").alias("n"))
    return (out.where(F.col("n") != 0) if drop_zero else out).distinct()


def voter_texts(cells: DataFrame, key: str, text: str, order: list[str]) -> DataFrame:
    """Per key and voter its texts in order, a line each (OP-E2)."""
    parts = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(text, F.lit("")).alias("__t"))))
    return cells.groupBy(key, "voter").agg(F.array_join(F.transform(parts, lambda x: x["__t"]), "\n").alias("text"))


def digit_runs(text: Column) -> Column:
    """``array<struct<sign, digits, first>>``: the runs of digits of a text whose pieces `number_present` finds.

    Digits with only blanks between form a run; any piece of a run is a number that is present. What
    stands in parentheses that hold nothing but an amount is negative too, and so is, after a minus,
    a piece that begins the run (``first``).
    """
    t = plain_minus(text)
    bare = lambda c: F.transform(c, lambda x: F.regexp_replace(x, r"(?U)\s", ""))
    runs = bare(F.regexp_extract_all(t, F.lit(r"(?U)(-?[0-9](?:[0-9\s]*[0-9])?)"), F.lit(1)))
    inner = bare(F.flatten(F.transform(F.regexp_extract_all(t, F.lit(r"(?U)\(\s*([\d\s.,]+)\s*\)"), F.lit(1)), lambda x: F.split(x, r"[.,]"))))
    run = lambda sign, digits, first: F.struct(F.lit(sign).alias("sign"), digits.alias("digits"), F.lit(first).alias("first"))
    digits = F.transform(runs, lambda r: run("", F.regexp_replace(r, "^-", ""), False))
    after_minus = F.transform(F.filter(runs, lambda r: r.startswith("-")), lambda r: run("-", F.regexp_replace(r, "^-", ""), True))
    in_parens = F.transform(F.filter(inner, lambda x: F.length(x) > 0), lambda x: run("-", x, False))
    return F.array_distinct(F.concat(digits, after_minus, in_parens))


def shown_numbers(named: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """``key, voter, __s``: numbers that a text shows, without most of those that are none of its key's.

    ``named``: key, n and ``__s``, n as text. Each key has the lengths of its numbers and `WORDS` words
    of bits by their hash, which end most pieces of a run before they are shuffled. The bits of a key with
    many thousand numbers let every piece of these lengths pass.
    """
    # explode_outer: from explode the planner infers a filter that finds the runs twice
    h = F.pmod(F.xxhash64("__s"), F.lit(64 * WORDS))
    word, bit = F.shiftright(h, 6).cast("int"), (h % 64).cast("int")
    bits = [F.bit_or(F.when(word == i, F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long"))) for i in range(WORDS)]
    known = named.groupBy(key).agg(F.collect_set(F.length(F.abs("n").cast("string"))).alias("__sizes"), F.array(*bits).alias("__bits"))  # 19 sizes at most
    runs = texts.select(key, "voter", digit_runs(F.col("text")).alias("__runs"))
    kept = [key, "voter", "__sizes", "__bits"]
    each = runs.join(known.hint("merge"), key).select(*kept, F.explode_outer("__runs").alias("__r")).select(*kept, "__r.sign", "__r.digits", F.when(F.col("__r.first"), 1).otherwise(F.length("__r.digits")).alias("__last"))
    tails = each.select(*kept, "sign", "digits", F.explode(F.sequence(F.lit(1), "__last")).alias("__i")).select(*kept, "sign", F.substring("digits", F.col("__i"), F.lit(LONGEST)).alias("__tail"))
    pieces = tails.select(key, "voter", "__bits", "sign", "__tail", F.explode("__sizes").alias("__n")).where(F.col("__n") <= F.length("__tail"))
    return pieces.select(key, "voter", "__bits", F.concat("sign", F.substring("__tail", F.lit(1), F.col("__n"))).alias("__s")).where(F.getbit(F.get("__bits", word), bit) == 1).select(key, "voter", "__s")


def hits(truth: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """``key, n, voter, hit`` for every true number and voter of its key; computed once for all scores.

    A voter hits a number that stands in one of its texts (a number does not go on into the next text).
    Texts are turned into the numbers they show and joined by equality, so a key with a tenth of all
    texts and numbers costs in proportion, not every number against every text. The planner takes rows
    made from an array for no more than those they come from; hence the hints, else it broadcasts them.
    """
    named = truth.select(key, "n", F.col("n").cast("string").alias("__s"))
    found = shown_numbers(named, texts, key).join(named.hint("merge"), [key, "__s"]).select(key, "n", "voter").distinct().withColumn("__hit", F.lit(True))
    grid = truth.join(texts.select(key, "voter").distinct().hint("merge"), key)
    return grid.join(found, [key, "n", "voter"], "left").select(key, "n", "voter", F.coalesce("__hit", F.lit(False)).alias("hit"))


def score_voters(found: DataFrame, key: str) -> DataFrame:
    """Per key and voter: hits, total, recall and the missed numbers (OP-E3)."""
    return found.groupBy(key, "voter").agg(
        F.count_if("hit").alias("hits"),
        F.count("*").alias("total"),
        (F.count_if("hit") / F.count("*")).alias("recall"),
        F.array_sort(F.collect_set(F.when(~F.col("hit"), F.col("n")))).alias("missed"),
    )


def score_consensus(found: DataFrame, key: str, min_voters: int = 7) -> DataFrame:
    """Per true number: who hit it, by all, by enough (OP-E4)."""
    return found.groupBy(key, "n").agg(F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("voter")))).alias("voters_hit"), F.count_distinct("voter").alias("n_voters")).select(
        key, "n", "voters_hit", F.size("voters_hit").alias("n_hit"), "n_voters", (F.size("voters_hit") == F.col("n_voters")).alias("unanimous"), (F.size("voters_hit") >= min_voters).alias("reliable")
    )


def score_fixture(found: DataFrame, keys: DataFrame, key: str, min_voters: int = 7) -> DataFrame:
    """One row of totals (OP-E5): all keys, also those without truth; numbers in all, unanimous, reliable, missed by all."""
    per = score_consensus(found, key, min_voters)
    totals = per.agg(F.count("*").alias("n_truth_values"), F.count_if("unanimous").alias("n_unanimous"), F.count_if("reliable").alias("n_reliable"), F.count_if(F.col("n_hit") == 0).alias("n_universal_miss"))
    return keys.agg(F.count_distinct(key).alias("n_keys")).crossJoin(totals)  # one row each


def voter_recall(found: DataFrame) -> DataFrame:
    """Per voter its hits and total over all keys (the other grain of OP-E5)."""
    return found.groupBy("voter").agg(F.count_if("hit").alias("hits"), F.count("*").alias("total"))


def voter_jaccard(tokens: DataFrame) -> DataFrame:
    """Pairs of voters with the overlap of their distinct tokens (OP-E7).

    ``tokens``: voter, token. Each token carries the voters that have it, so tokens are never paired
    with each other; pairs are of voters only.
    """
    sets = tokens.where(F.col("token").isNotNull()).groupBy("token").agg(F.array_sort(F.collect_set("voter")).alias("vs"))
    sizes = sets.select(F.explode("vs").alias("voter")).groupBy("voter").agg(F.count("*").alias("n"))
    both = sets.select(F.explode("vs").alias("voter_a"), "vs").select("voter_a", F.explode("vs").alias("voter_b")).where(F.col("voter_a") < F.col("voter_b")).groupBy("voter_a", "voter_b").agg(F.count("*").alias("n_both"))
    a, b = sizes.select(F.col("voter").alias("voter_a"), F.col("n").alias("n_a")), sizes.select(F.col("voter").alias("voter_b"), F.col("n").alias("n_b"))
    return both.join(a, "voter_a").join(b, "voter_b").select("voter_a", "voter_b", "n_both", (F.col("n_a") + F.col("n_b") - F.col("n_both")).alias("n_either"), (F.col("n_both") / (F.col("n_a") + F.col("n_b") - F.col("n_both"))).alias("jaccard"))


def production_score(tokens: DataFrame, key: str, enough: int = 5) -> DataFrame:
    """Per key: distinct tokens, and those that enough voters have, all voters being enough (OP-E8)."""
    n = tokens.groupBy(key).agg(F.count_distinct("voter").alias("n_voters"))
    per = tokens.where(F.col("token").isNotNull()).groupBy(key, "token").agg(F.count_distinct("voter").alias("hit"))
    return per.join(n, key).groupBy(key, "n_voters").agg(F.count("*").alias("n_tokens"), F.count_if(F.col("hit") >= F.least(F.lit(enough), F.col("n_voters"))).alias("n_reliable"))
