"""From votes on pages to documents (OP-C1 to C12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators import vote
from ledgerloom.operators.observe import OBSERVERS, Observer, VoteOptions
from ledgerloom.session import checkpoint

PAGE = ["doc_id", "page_no"]

_FULL = tuple(Observer(n) for n in OBSERVERS if n not in ("pix2struct", "document_ai", "docling_default")) + (Observer("pix2struct", enabled=False), Observer("docling_default", enabled=False), Observer("document_ai", enabled=False))
_CHEAP = tuple(Observer(n) for n in ("ocrmypdf", "tesseract", "tesseract_tsv"))

#: Option presets by kind of document.
PRESETS = {
    "brreg_template": VoteOptions(_FULL, 5, True),
    "konsernregnskap": VoteOptions(_FULL, 5, True),
    "auditor_report": VoteOptions(_CHEAP, 2, False),
    "tx_log": VoteOptions(_FULL, 5, True, strict_tables=True),
}


def preset(name: str) -> VoteOptions:
    """The options of a kind of document (OP-C12); an unknown kind is an error that lists the known ones."""
    if name not in PRESETS:
        raise ValueError(f"unknown preset {name!r}; known: {sorted(PRESETS)}")
    return PRESETS[name]


def both_modes(boxes: DataFrame, tokens: DataFrame) -> DataFrame:
    """Consensus cells of both votes in a row, box cells first, numbered anew (OP-C2)."""
    both = boxes.select(*PAGE, F.lit(0).alias("part"), "cell_idx", "text", "confidence").unionByName(tokens.select(*PAGE, F.lit(1).alias("part"), "cell_idx", "text", "confidence"))
    order = Window.partitionBy(*PAGE).orderBy("part", "cell_idx")
    return both.select(*PAGE, (F.row_number().over(order) - 1).alias("cell_idx"), F.when(F.col("part") == 0, F.concat(F.lit("cluster:"), F.col("cell_idx").cast("string"))).otherwise(F.concat(F.lit("token:"), F.col("cell_idx").cast("string"))).alias("source"), "text", "confidence")


def disagreement_boxes(diagnostics: DataFrame, threshold: int, order: str) -> DataFrame:
    """The boxes on which too few agree, once per page and rounded box (OP-C4).

    Boxes without an extent are left out; of boxes equal to one decimal the first by ``order`` stays.
    """
    few = diagnostics.where((F.col("n_hit") < threshold) & (F.col("bbox.r") > F.col("bbox.l")) & (F.col("bbox.b") > F.col("bbox.t")))
    near = [F.bround(f"bbox.{k}", 1).alias(f"k{k}") for k in "ltrb"]
    return few.select(*PAGE, *near, F.struct(F.col(order).alias("o"), "bbox").alias("c")).groupBy(*PAGE, "kl", "kt", "kr", "kb").agg(F.min_by("c", "c.o").alias("c")).select(*PAGE, F.col("c.o").alias(order), F.col("c.bbox").alias("bbox"))


def hash_share(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the columns only, the same in other engines: first 32 bits of MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in cols])), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sampled(pages: DataFrame, voter: str, rate: float) -> DataFrame:
    """The pages on which a voter runs anyway, by a hash of page and voter (OP-C5); rate 0 gives none."""
    return pages.where(hash_share(F.col("doc_id"), F.col("page_no"), F.lit(voter)) < rate)


def lazy_vote(eager: DataFrame, lazy: DataFrame, min_voters: int = 5, rate: float = 0.0, width: float = 1000.0, veto: bool = True) -> DataFrame:
    """Diagnostics after the second pass (OP-C6): lazy voters' cells join in on pages with a
    disagreement, and on a sampled share of the others; only those pages are voted on again."""
    first = checkpoint(vote.bbox_vote(eager, width, min_voters, veto=veto))  # read three times below
    open_pages = first.where(~F.col("committed")).select(*PAGE).distinct()
    chosen = open_pages
    if rate > 0:
        chosen = chosen.unionByName(sampled(eager.select(*PAGE).distinct(), "lazy", rate)).distinct()
    again = eager.join(chosen, PAGE, "left_semi").unionByName(lazy.join(chosen, PAGE, "left_semi"), allowMissingColumns=True)
    second = vote.bbox_vote(again, width, min_voters, veto=veto)
    return first.join(chosen, PAGE, "left_anti").unionByName(second)


def document_summary(diagnostics: DataFrame, threshold: int) -> DataFrame:
    """Per document the clusters in all, committed, in the minority and unanimous (OP-C8, C11).

    Unanimous within the cluster: one voter alone is unanimous. Shares are 0 for none, rounded half to
    even to four places.
    """
    n = F.count("*")
    share = lambda c: F.bround(F.when(n > 0, c / n).otherwise(0.0), 4)
    done, all_hit = F.count_if(F.col("n_hit") >= threshold), F.count_if(F.col("n_hit") == F.col("n_attempted"))
    return diagnostics.groupBy("doc_id").agg(
        n.alias("n_clusters"), done.alias("n_committed"), (n - done).alias("n_minority"), all_hit.alias("n_unanimous"), share(done).alias("committed_share"), share(all_hit).alias("unanimous_share")
    )


def token_summary(won: DataFrame) -> DataFrame:
    """Per document the committed and unanimous tokens (OP-C9)."""
    return won.groupBy("doc_id").agg(F.count("*").alias("n_tokens"), F.count_if("unanimous").alias("n_unanimous_tokens"))


def dropped_pages(df: DataFrame, dropped: str) -> DataFrame:
    """Per document and voter the pages on which it was dropped, each page once (part of OP-C8)."""
    return df.select(*PAGE, F.explode(dropped).alias("voter")).distinct().groupBy("doc_id", "voter").agg(F.count("*").alias("n_pages"))


def effective_voters(df: DataFrame, keys: list[str], voters: str, groups: list[list[str]]) -> DataFrame:
    """``keys, n_voters, n_effective``: voters of one correlated group count once (OP-C10)."""
    of = {v: f"group {i}" for i, g in enumerate(groups) for v in g}
    table = F.create_map(*[F.lit(x) for kv in of.items() for x in kv]) if of else None
    each = df.select(*keys, F.explode(voters).alias("voter"))
    as_one = F.coalesce(F.try_element_at(table, F.col("voter")), F.col("voter")) if of else F.col("voter")
    return each.groupBy(*keys).agg(F.count_distinct("voter").alias("n_voters"), F.count_distinct(as_one).alias("n_effective"))
