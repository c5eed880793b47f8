"""Voting over cells: by box (OP-V4 to V7) and by value (OP-T5 to T12)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import grouped, normalise_text, numeric_tokens, plain_minus, word_tokens

PAGE = ["doc_id", "page_no"]


# columns ---------------------------------------------------------------


def column_bins(cells: DataFrame, width: Column | float = 1000.0) -> DataFrame:
    """Per page and voter: columns seen, widest gap, cells (first half of OP-V4).

    A new column starts where neighbouring x-centres are more than a twentieth of the page apart.
    Cells without a box count as cells but give no centre.
    """
    w = width if isinstance(width, Column) else F.lit(float(width))
    order = Window.partitionBy(*PAGE, "voter").orderBy("x")
    x = cells.select(*PAGE, "voter", "voter_ord", ((F.col("bbox.l") + F.col("bbox.r")) / 2).alias("x"))
    gaps = x.withColumn("gap", F.when(F.col("x").isNotNull(), F.col("x") - F.lag("x").over(order)))
    return gaps.groupBy(*PAGE, "voter").agg(
        F.min("voter_ord").alias("voter_ord"),
        (F.count("x").cast("boolean").cast("int") + F.count_if(F.col("gap") > w * 0.05)).cast("int").alias("bins"),
        F.coalesce(F.max("gap"), F.lit(0.0)).alias("max_gap"),
        F.count("*").alias("n_cells"),
    )


def column_drop(cells: DataFrame, width: float = 1000.0, min_columns: int = 2, gap_share: float = 0.15) -> DataFrame:
    """The voters that lost a column on a page: ``doc_id, page_no, voter`` (OP-V4).

    The usual number of columns is the commonest among the page's voters, of equals that of the voter
    that comes first. A page with fewer than ``min_columns`` drops nobody.
    """
    bins = column_bins(cells, width)
    usual = bins.groupBy(*PAGE, "bins").agg(F.count("*").alias("n"), F.min(F.struct("voter_ord", "voter")).alias("first"), F.max("n_cells").alias("most"))
    mode = usual.groupBy(*PAGE).agg(F.min_by(F.struct("bins", "most"), F.struct((-F.col("n")).alias("n"), "first")).alias("m"))
    lost = (F.col("bins") < F.col("m.bins")) & ((F.col("max_gap") > gap_share * width) | (F.col("n_cells") < 0.7 * F.col("m.most")))
    return bins.join(mode, PAGE).where((F.col("m.bins") >= min_columns) & lost).select(*PAGE, "voter")


# clusters --------------------------------------------------------------


def _first_fit(ls, ts, rs, bs, voters, least_iou: float) -> list[list[int]]:
    """Places of the cells of each cluster, taking the cells in their order."""
    members: list[list[int]] = []
    seen: list[set] = []
    areas = [max(1.0, (r - x) * (b - t)) for x, t, r, b in zip(ls, ts, rs, bs)]
    for i in range(len(ls)):
        left, top, right, bottom, area = ls[i], ts[i], rs[i], bs[i], areas[i]
        for k, of in enumerate(members):
            hit = False
            for j in of:
                w = min(right, rs[j]) - max(left, ls[j])
                if w <= 0:
                    continue
                h = min(bottom, bs[j]) - max(top, ts[j])
                if h > 0 and w * h >= least_iou * (area + areas[j] - w * h):
                    hit = True
                    break
            if hit:
                if voters[i] not in seen[k]:
                    seen[k].add(voters[i])
                    of.append(i)
                break
        else:
            members.append([i])
            seen.append({voters[i]})
    return members


def _pages(cells: DataFrame) -> DataFrame:
    """A row per page with its cells in voter and cell order (``all``); the one shuffle of the votes by box."""
    member = F.struct("voter_ord", "cell_idx", "voter", "text", "confidence", "bbox", *(["norm"] if "norm" in cells.columns else []))
    return cells.groupBy(*PAGE).agg(F.array_sort(F.collect_list(member)).alias("all"))


def _folded(pages: DataFrame, least_iou: float, *carried: str) -> DataFrame:
    """A row per page and cluster with its ``members``; cells without a whole box take no part."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def assign(ls: pd.Series, ts: pd.Series, rs: pd.Series, bs: pd.Series, vs: pd.Series) -> pd.Series:
        return pd.Series([_first_fit(*(x.tolist() for x in page), least_iou) for page in zip(ls, ts, rs, bs, vs)], dtype=object)

    assign = assign.asNondeterministic()  # else a filter on its result would have it, and what it reads, worked out once more
    whole = lambda m: m["bbox"]["l"].isNotNull() & m["bbox"]["t"].isNotNull() & m["bbox"]["r"].isNotNull() & m["bbox"]["b"].isNotNull()
    part = lambda k: F.transform("all", lambda m: m["bbox"][k])
    folded = pages.withColumn("all", F.filter("all", whole)).withColumn("k", assign(part("l"), part("t"), part("r"), part("b"), F.transform("all", lambda m: m["voter"])))
    each = folded.select(*PAGE, *carried, "all", F.posexplode("k").alias("cluster_no", "at"))
    return each.select(*PAGE, *carried, "cluster_no", F.transform("at", lambda i: F.get("all", i)).alias("members"))


def clusters(cells: DataFrame, least_iou: float = 0.3) -> DataFrame:
    """Cells of a page put into clusters, greedily in voter and cell order (OP-V5).

    A cell joins the first cluster with a member that overlaps enough; if its voter is there already,
    it is absorbed. One row per page and cluster: ``cluster_no`` and ``members``. Cells without a whole
    box take no part. The order decides, so a page is one unit of work; only its boxes go to Python
    (Arrow), the cells are picked by place in the JVM. A page is a bounded group.
    """
    return _folded(_pages(cells), least_iou)


def _ranked(members: Column, norm: str = "norm", voter: str = "voter") -> Column:
    """The readings of a cluster, most votes first, of equals the text that sorts first: (minus_n, text, voters)."""
    of = lambda x: F.filter(members, lambda m: m[norm].eqNullSafe(x))
    voters = lambda x: F.array_sort(F.array_distinct(F.transform(of(x), lambda m: m[voter])))
    return F.array_sort(F.transform(F.array_distinct(F.transform(members, lambda m: m[norm])), lambda x: F.struct((-F.size(of(x))).alias("minus_n"), x.alias("text"), voters(x).alias("voters"))))


def vote_members(voted: DataFrame, keys: list[str], members: str = "members") -> DataFrame:
    """Per cluster the winning text, its voters, all voters and the other readings (OP-V6), without a shuffle.

    ``members`` are structs with ``norm``, the form in which texts are compared, and ``voter``.
    """
    return voted.withColumn("ranked", _ranked(F.col(members))).select(
        *keys,
        F.col("ranked")[0]["text"].alias("consensus_text"),
        F.col("ranked")[0]["voters"].alias("voters_hit"),
        F.array_sort(F.array_distinct(F.transform(members, lambda m: m["voter"]))).alias("voters_attempted"),
        F.transform(F.slice("ranked", 2, F.size("ranked")), lambda x: F.struct(x["text"].alias("text"), x["voters"].alias("voters"))).alias("alternatives"),
    )


def vote_clusters(members: DataFrame, keys: list[str], text: str = "text", voter: str = "voter") -> DataFrame:
    """`vote_members` for rows of members, as where clusters are given by ``keys``.

    Texts are compared in their normal form; input is one row per member with ``norm``, the normal form.
    """
    votes = members.groupBy(*keys, "norm").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(voter)).alias("voters"))
    grouped_votes = votes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus_n"), F.col("norm").alias("text"), "voters"))).alias("ranked"))
    return grouped_votes.select(
        *keys,
        F.col("ranked")[0]["text"].alias("consensus_text"),
        F.col("ranked")[0]["voters"].alias("voters_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("ranked", lambda x: x["voters"])))).alias("voters_attempted"),
        F.transform(F.slice("ranked", 2, F.size("ranked")), lambda x: F.struct(x["text"].alias("text"), x["voters"].alias("voters"))).alias("alternatives"),
    )


def _page_drop(cells: str, width: float, min_columns: int = 2, gap_share: float = 0.15) -> Column:
    """`column_drop` within the row of a page: the voters that lost a column, sorted."""

    def of_voter(v):
        own = F.filter(cells, lambda m: m["voter"].eqNullSafe(v))
        xs = F.array_sort(F.filter(F.transform(own, lambda m: (m["bbox"]["l"] + m["bbox"]["r"]) / 2), lambda x: x.isNotNull()))
        return F.struct(v.alias("voter"), F.array_min(F.transform(own, lambda m: m["voter_ord"])).alias("voter_ord"), F.size(own).alias("n_cells"), xs.alias("xs"))

    def measured(s):
        gaps = F.when(F.size(s["xs"]) > 1, F.zip_with(F.slice(s["xs"], 2, F.size(s["xs"])), F.slice(s["xs"], 1, F.size(s["xs"]) - 1), lambda a, b: a - b)).otherwise(F.array().cast("array<double>"))
        bins = F.when(F.size(s["xs"]) > 0, 1).otherwise(0) + F.size(F.filter(gaps, lambda g: g > width * 0.05))
        return F.struct(s["voter"].alias("voter"), s["voter_ord"].alias("voter_ord"), s["n_cells"].alias("n_cells"), bins.alias("bins"), F.coalesce(F.array_max(gaps), F.lit(0.0)).alias("max_gap"))

    stats = F.transform(F.transform(F.array_distinct(F.transform(cells, lambda m: m["voter"])), of_voter), measured)

    def lost(all_of):
        def usual(s):
            same = F.filter(all_of, lambda o: o["bins"] == s["bins"])
            first = F.array_min(F.transform(same, lambda o: F.struct(o["voter_ord"].alias("o"), o["voter"].alias("v"))))
            return F.struct((-F.size(same)).alias("n"), first.alias("first"), s["bins"].alias("bins"), F.array_max(F.transform(same, lambda o: o["n_cells"])).alias("most"))

        mode = F.array_min(F.transform(all_of, usual))
        gone = F.filter(all_of, lambda s: (mode["bins"] >= min_columns) & (s["bins"] < mode["bins"]) & ((s["max_gap"] > gap_share * width) | (s["n_cells"] < 0.7 * mode["most"])))
        return F.array_sort(F.transform(gone, lambda s: s["voter"]))

    # the statistics are named once, by a fold over the one list of them
    return F.flatten(F.transform(F.array(stats), lost))


def bbox_vote(cells: DataFrame, width: float = 1000.0, min_voters: int = 7, least_iou: float = 0.3, veto: bool = True, compatibility: bool = True) -> DataFrame:
    """Diagnostics of every cluster, committed or not (OP-V7).

    The box is that of the winners only; ``committed`` where at least ``min_voters`` agree; confidence
    is the share of the cluster's voters. Cells are shuffled once, to their page; dropped voters,
    clusters and votes are worked out within the page's row. ``compatibility=False`` compares texts without NFKC.
    """
    pages = _pages(cells.withColumn("norm", normalise_text(F.coalesce("text", F.lit("")), compatibility)))
    if veto:
        pages = pages.withColumn("column_dropped_voters", _page_drop("all", width)).withColumn("all", F.filter("all", lambda m: ~F.coalesce(F.array_contains("column_dropped_voters", m["voter"]), F.lit(False))))
    else:
        pages = pages.withColumn("column_dropped_voters", F.array().cast("array<string>"))
    keys = [*PAGE, "cluster_no"]
    won = vote_members(_folded(pages, least_iou, "column_dropped_voters"), [*keys, "column_dropped_voters", "members"])
    hit = F.filter("members", lambda m: m["norm"].eqNullSafe(F.col("consensus_text")))
    side = lambda k, f: f(F.transform(hit, lambda m: m["bbox"][k])).alias(k)
    return won.select(
        *keys,
        F.concat(F.lit("cluster:"), F.col("cluster_no").cast("string")).alias("cluster_id"),
        "consensus_text",
        "voters_hit",
        "voters_attempted",
        F.size("voters_hit").alias("n_hit"),
        F.size("voters_attempted").alias("n_attempted"),
        "alternatives",
        F.struct(side("l", F.array_min), side("t", F.array_min), side("r", F.array_max), side("b", F.array_max)).alias("bbox"),
        (F.size("voters_hit") >= min_voters).alias("committed"),
        (F.size("voters_hit") / F.size("voters_attempted")).alias("confidence"),
        "column_dropped_voters",
    )


# tokens ----------------------------------------------------------------


def joined_lines(cells: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Per page and voter the text of its cells in reading order, a line each (OP-T5).

    Cells are taken by their middle's height; one joins the current line if it is no further from the
    line's mean than ``tolerance`` times the smaller of its height and the line's mean height, heights
    counting 1 at least. Cells without a box or text are left out; a voter without any has an empty text.
    """
    c = F.struct(((F.col("bbox.t") + F.col("bbox.b")) / 2).alias("y"), F.col("cell_idx").alias("i"), ((F.col("bbox.l") + F.col("bbox.r")) / 2).alias("x"), F.greatest(F.lit(1.0), F.col("bbox.b") - F.col("bbox.t")).alias("h"), F.col("text").alias("t"))
    page = cells.groupBy(*PAGE, "voter").agg(F.array_sort(F.collect_list(F.when(F.col("bbox").isNotNull() & F.col("text").isNotNull(), c))).alias("cs"))
    item = "struct<x:double,i:int,t:string>"
    start = F.expr(f"named_struct('lines', CAST(array() AS array<array<{item}>>), 'sy', 0.0D, 'sh', 0.0D, 'n', 0)")

    def step(a, e):
        one = F.struct(e["x"].alias("x"), e["i"].alias("i"), e["t"].alias("t"))
        fits = (a["n"] > 0) & (F.abs(e["y"] - a["sy"] / F.greatest(a["n"], F.lit(1))) <= tolerance * F.least(e["h"], a["sh"] / F.greatest(a["n"], F.lit(1))))
        grown = F.transform(a["lines"], lambda v, i: F.when(i == F.size(a["lines"]) - 1, F.array_append(v, one)).otherwise(v))
        return F.when(fits, F.struct(grown.alias("lines"), (a["sy"] + e["y"]).alias("sy"), (a["sh"] + e["h"]).alias("sh"), (a["n"] + 1).alias("n"))).otherwise(
            F.struct(F.array_append(a["lines"], F.array(one)).alias("lines"), e["y"].alias("sy"), e["h"].alias("sh"), F.lit(1).alias("n"))
        )

    def text(a):
        return F.array_join(F.transform(a["lines"], lambda v: F.array_join(F.transform(F.array_sort(v), lambda e: e["t"]), " ")), "\n")

    return page.select(*PAGE, "voter", F.aggregate("cs", start, step, text).alias("text"))


def voter_tokens(cells: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Per page and voter its text, numbers and words (OP-T6)."""
    return joined_lines(cells, tolerance).withColumn("numbers", numeric_tokens(F.col("text"))).withColumn("words", word_tokens(F.col("text")))


def token_vote(tokens: DataFrame, voters: DataFrame, token: str = "token", min_voters: int = 7) -> DataFrame:
    """Per page and token the voters that have it, if enough have (OP-T7; OP-T8 for words).

    ``tokens``: page, voter, token; ``voters``: every voter of a page, also those without tokens.
    """
    hits = tokens.where(F.col(token).isNotNull()).groupBy(*PAGE, token).agg(F.array_sort(F.collect_set("voter")).alias("voters_hit")).withColumn("n_hit", F.size("voters_hit")).where(F.col("n_hit") >= min_voters)
    all_of = voters.groupBy(*PAGE).agg(F.array_sort(F.collect_set("voter")).alias("voters_attempted"))
    return hits.join(all_of, PAGE).select(
        *PAGE, token, "voters_hit", "n_hit", "voters_attempted", F.size("voters_attempted").alias("n_attempted"), (F.col("n_hit") == F.size("voters_attempted")).alias("unanimous")
    )


def sample_cells(won: DataFrame, cells: DataFrame, token: str = "token") -> DataFrame:
    """``won`` with ``sample``: the most confident first cell of a hit voter that shows the value (OP-T10).

    Per voter the first cell in cell order whose text holds the value's digits, plain or grouped; of
    these the highest confidence, then the first voter by name. Null where the value is split over cells.
    """
    keys = [*PAGE, token]
    asked = won.select(*keys, F.explode("voters_hit").alias("voter"), grouped(F.col(token)).alias("g"), F.col(token).cast("string").alias("p"))
    shown = plain_minus(F.col("text"))
    seen = asked.join(cells.select(*PAGE, "voter", "cell_idx", "text", "confidence", "bbox"), [*PAGE, "voter"]).where(F.contains(shown, F.col("g")) | F.contains(shown, F.col("p")))
    first = seen.groupBy(*keys, "voter").agg(F.min_by(F.struct("cell_idx", "text", "confidence", "bbox"), "cell_idx").alias("c"))
    best = first.groupBy(*keys).agg(F.min_by(F.struct("voter", "c.*"), F.struct((-F.coalesce("c.confidence", F.lit(0.0))).alias("k"), "voter")).alias("sample"))
    return won.join(best, keys, "left")


def consensus_cells(won: DataFrame, token: str = "token") -> DataFrame:
    """Consensus values as cells (OP-T11): the sample's text and box, or made-up ones; confidence is the share of voters."""
    order = Window.partitionBy(*PAGE).orderBy(token)
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("l", "t", "r", "b")])
    return won.select(
        *PAGE,
        (F.row_number().over(order) - 1).alias("cell_idx"),
        F.coalesce("sample.text", grouped(F.col(token))).alias("text"),
        (F.col("n_hit") / F.col("n_attempted")).alias("confidence"),
        F.coalesce("sample.bbox", zero).alias("bbox"),
    )


def vote_counts(won: DataFrame) -> DataFrame:
    """Per page the committed and unanimous tokens (OP-T12)."""
    return won.groupBy(*PAGE).agg(F.count("*").alias("n_committed"), F.count_if("unanimous").alias("n_unanimous"))
