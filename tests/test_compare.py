import random

from pyspark.sql import functions as F

from ledgerloom.operators import compare


def brute(rows):
    last = {}
    for side, k, v, w, o in rows:
        if k is not None and ((side, k) not in last or last[side, k][0] < o):
            last[side, k] = (o, v, w)
    out = set()
    for k in {k for _, k in last}:
        a, b = last.get(("a", k)), last.get(("b", k))
        if b is None:
            out.add((k, "a_only"))
        elif a is None:
            out.add((k, "b_only"))
        else:
            out |= {(k, n) for n, x, y in (("v", a[1], b[1]), ("w", a[2], b[2])) if x != y}
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "side string, k string, v int, w string, o long")
    l, r = (compare.latest_rows(df.where(F.col("side") == s), ["k"], [F.col("v"), F.col("w")], "o") for s in "ab")
    return [tuple(x) for x in compare.compare_copies(l, r, ["k"], ("a_only", "b_only")).collect()]


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows, o = [], 0
    for side in "ab":
        for i in range(600):
            for _ in range(rng.choice((0, 1, 1, 1, 2))):
                o += 1
                rows.append((side, f"k{i}", rng.choice((None, i % 7, i % 7, 3)), rng.choice(("x", "x", None)), o))
    rows += [("a", None, 1, "x", o + 1), ("b", None, 2, "x", o + 2)]
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_null_fields_do_not_hide_each_other(spark):
    assert run(spark, [("a", "k", None, "1", 1), ("b", "k", 1, None, 2)]) != []


def test_empty_and_equal(spark):
    assert run(spark, [("a", "k", 1, "x", 1), ("b", "k", 1, "x", 2)]) == []
    assert set(run(spark, [("a", "k", 1, "x", 1)])) == {("k", "a_only")}
    assert run(spark, [("a", None, 1, "x", 1)]) == []


def test_keys_named_like_anything(spark):
    df = spark.createDataFrame([("a", "k", 1, 1), ("b", "k", 2, 2)], "side string, v string, a int, pos long")
    l, r = (compare.latest_rows(df.where(F.col("side") == s), ["v"], [F.col("a")], "pos") for s in "ab")
    assert [tuple(x) for x in compare.compare_copies(l, r, ["v"]).collect()] == [("k", "a")]


def test_ranges_grow_with_rows():
    assert compare.leaf_bits(0) == 1 and compare.leaf_bits(10**12) == compare.MAX_BITS > compare.leaf_bits(10**5) > compare.leaf_bits(10**3)
    assert compare.levels(5) == [5] and compare.levels(8) == [8] and compare.levels(17) == [8, 16, 17]


def copies(spark, n, changed):
    df = spark.range(n).select("id", F.lit("x").alias("w"), F.col("id").alias("o"))
    left = compare.latest_rows(df, ["id"], [F.col("w")], "o")
    return left, compare.latest_rows(df.withColumn("w", F.when(F.col("id").isin(changed), "y").otherwise("x")), ["id"], [F.col("w")], "o")


def test_only_ranges_that_differ_are_summed_again(spark):
    """Of 20,000 keys three differ: at most three coarse ranges, and as few of the finest, hold rows below the first level."""
    left, right = copies(spark, 20_000, [5, 77, 19_000])
    coarse = compare.mismatched_leaves(left, right, ["w"], compare.TOP_BITS)
    assert 1 <= coarse.count() <= 3
    rows = compare.within(left, coarse, compare.TOP_BITS).count()
    assert rows < 20_000 * 3 * 2 / 2**compare.TOP_BITS
    assert compare.mismatched_leaves(left, right, ["w"], 12).count() == 3
    assert sorted(tuple(r) for r in compare.compare_copies(left, right, ["id"], rows=20_000).collect()) == [(5, "w"), (77, "w"), (19_000, "w")]


def test_each_copy_is_shuffled_once(spark, data):
    from ledgerloom.plans import problems

    df = problems.p6_found(spark, data)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("FileScan parquet") == 2 and text.count("ReusedExchange") >= 3, plan
