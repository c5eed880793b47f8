"""From the words of text engines to cells (OP-O1 to O11). The engines themselves are outside."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.geometry import box

#: The known observers in their usual order.
OBSERVERS = ["ocrmypdf", "tesseract", "tesseract_tsv", "paddleocr", "doctr", "easyocr", "pix2struct", "docling_default", "document_ai"]

CELLS = "doc_id string, page_no int, voter string, cell_idx int, text string, confidence double, bbox struct<l:double,t:double,r:double,b:double>, from_ocr boolean"


@dataclass(frozen=True)
class Observer:
    """An observer as configured: run or not, only on disagreement or not, and on which share of pages anyway."""

    name: str
    enabled: bool = True
    weight: float = 1.0
    timeout_s: float = 60.0
    lazy: bool = False
    sample_rate: float = 0.0


@dataclass(frozen=True)
class VoteOptions:
    """Options of the page vote (OP-C12 gives presets)."""

    observers: tuple[Observer, ...] = field(default_factory=tuple)
    min_voters: int = 7
    column_drop_veto: bool = True
    mode: str = "bbox"
    groups: tuple[tuple[str, ...], ...] = ()
    strict_tables: bool = False

    def __post_init__(self):
        if self.mode not in ("bbox", "token", "both"):
            raise ValueError(f"unknown vote mode: {self.mode}")


def build_observers(specs: list[Observer], available: set[str] | None = None) -> list[Observer]:
    """Those that are enabled, known and available, in order (OP-O2); the count is OP-C15."""
    return [o for o in specs if o.enabled and o.name in OBSERVERS and (available is None or o.name in available)]


def run_observer(pages: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str = CELLS) -> DataFrame:
    """Cells from a Python observer over pages (OP-O1, OP-C3). A page on which it fails gives no cells."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(len(pdf)):
                try:
                    yield run(pdf.iloc[i : i + 1])
                except Exception:  # noqa: BLE001 an observer may fail in any way; the page then has no cells
                    continue

    return pages.mapInPandas(over, schema)


def good_words(words: DataFrame, text: str, confidence: str) -> DataFrame:
    """Without blank words and those whose confidence is missing, no number or negative."""
    c = F.col(confidence).try_cast("double")
    return words.where(F.trim(text) != "").where(c.isNotNull() & ~F.isnan(c) & (c >= 0)).withColumn(confidence, c)


def words_as_cells(words: DataFrame, text: str, confidence: str) -> DataFrame:
    """One cell per word, confidence in shares (OP-O4)."""
    return good_words(words, text, confidence).withColumn(confidence, F.col(confidence) / 100)


def lines_of_words(words: DataFrame, keys: list[str], order: str, text: str, confidence: str, bbox: str, left: Column | None = None, top: Column | None = None, first_seen: bool = False, clamp: bool = False, min_confidence_words: bool = True) -> DataFrame:
    """Words grouped to line cells (OP-O3; O5 with ``first_seen`` and ``clamp``; O6 is the same).

    ``keys, seq, text, confidence, bbox``: the words in ``order`` joined by blanks, the box around
    them moved by the region's corner, the mean confidence in shares. ``seq`` numbers the lines by
    key, or by the first word.
    """
    w = good_words(words, text, confidence) if min_confidence_words else words.where(F.trim(text) != "")
    shown = F.trim(text) if first_seen else F.col(text)
    left, top = left if left is not None else F.lit(0.0), top if top is not None else F.lit(0.0)
    mean = F.avg(confidence) / 100
    lines = w.groupBy(*keys).agg(
        F.min(order).alias("first_word"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), shown.alias("t")))), lambda x: x["t"]), " ").alias("text"),
        (F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean)) if clamp else mean).alias("confidence"),
        F.min(F.col(f"{bbox}.l") + left).alias("l"),
        F.min(F.col(f"{bbox}.t") + top).alias("t"),
        F.max(F.col(f"{bbox}.r") + left).alias("r"),
        F.max(F.col(f"{bbox}.b") + top).alias("b"),
    )
    return lines.select(*keys, "first_word", "text", "confidence", box(F.col("l"), F.col("t"), F.col("r"), F.col("b")).alias("bbox"))


def split_lines(df: DataFrame, text: str, confidence: float = 0.95, name: str = "line") -> DataFrame:
    """A region's text as one cell per line that isn't blank (OP-O11); ``pos`` counts from 0."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")
    return df.select("*", F.posexplode(lines).alias("pos", name)).withColumn("confidence", F.lit(confidence))


def region_cell(df: DataFrame, text: str, confidence: float = 0.9) -> DataFrame:
    """One cell per region with a fixed confidence, blank ones left out (OP-O10)."""
    return df.where(F.trim(text) != "").withColumn("confidence", F.lit(confidence))
