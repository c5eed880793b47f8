"""Differences between two copies of a table by hierarchical checksums (problem 6).

Keys are placed on a line by a 64-bit digest, so ranges of the line hold about equally many keys
whatever the data, and one organisation with a third of all rows is spread evenly. From the top down,
each copy is summed into ranges; only rows in ranges whose count or checksum differ are summed again,
into finer ranges, and only rows in the finest ranges that differ are compared field by field. Each
copy is shuffled once, to find the latest row of each key; all levels read that one shuffle again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import BROADCAST_ROWS

#: Rows that a finest range should hold; bits of the coarsest ranges; most bits of the finest, so that all of them may be broadcast.
LEAF_ROWS, TOP_BITS, MAX_BITS = 8, 8, BROADCAST_ROWS.bit_length() - 1


def latest_rows(df: DataFrame, keys: list[str], fields: list[Column], order: str) -> DataFrame:
    """``keys``, ``__v`` and ``__pos``: the fields of the row with the highest ``order`` per key, and the key's place; null keys are left out.

    ``fields`` are already in comparable form and aliased. Partial aggregation comes before the
    shuffle, so repeated rows of one key do not pile up.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # the place is an aggregate too: a filter on it must stay above the shuffle, which then serves all levels
    place = F.max(F.xxhash64(*[F.col(k) for k in keys])).alias("__pos")
    return df.where(known).groupBy(*keys).agg(F.max_by(F.struct(*fields), F.col(order)).alias("__v"), place)


def _range(bits: int) -> Column:
    return F.shiftrightunsigned("__pos", 64 - bits)


def _sums(rows: DataFrame, fields: list[str], bits: int, sign: int) -> DataFrame:
    """Count and checksum of every range, with the side's sign."""
    # hashing skips nulls, so which fields are null is hashed as well
    parts = [x for f in fields for x in (F.col(f"__v.{f}"), F.col(f"__v.{f}").isNull())]
    digest = F.xxhash64("__pos", *parts)
    # halves are summed apart: sums of 32-bit numbers don't overflow, in whatever order they are added
    return rows.groupBy(_range(bits).alias("range")).agg(
        (F.count("*") * sign).alias("n"),
        (F.sum(digest.bitwiseAND(F.lit(0xFFFFFFFF))) * sign).alias("s1"),
        (F.sum(F.shiftrightunsigned(digest, 32)) * sign).alias("s2"),
    )


def within(rows: DataFrame, ranges: DataFrame | None, bits: int) -> DataFrame:
    """The rows in some ranges of so many bits; there are at most ``2 ** MAX_BITS``, few enough to broadcast."""
    return rows if ranges is None else rows.join(F.broadcast(ranges), _range(bits) == F.col("range"), "left_semi")


def levels(bits: int) -> list[int]:
    """Bits of the ranges of each level, from the coarsest to the finest."""
    return [*range(TOP_BITS, bits, TOP_BITS), bits]


def mismatched_leaves(left: DataFrame, right: DataFrame, fields: list[str], bits: int) -> DataFrame:
    """The finest ranges (column ``range``) in which the copies differ, found from the coarsest down."""
    totals = [F.sum(c).alias(c) for c in ("n", "s1", "s2")]
    differs = (F.col("n") != 0) | (F.col("s1") != 0) | (F.col("s2") != 0)
    found, above = None, 0
    for level in levels(bits):
        both = _sums(within(left, found, above), fields, level, 1).unionByName(_sums(within(right, found, above), fields, level, -1))
        found, above = both.groupBy("range").agg(*totals).where(differs).select("range"), level
    return found


def leaf_bits(rows: int) -> int:
    """Bits of a finest range for so many rows a copy."""
    return max(1, min(MAX_BITS, (max(1, rows) // LEAF_ROWS).bit_length()))


def compare_copies(left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str] = ("left_only", "right_only"), rows: int | None = None) -> DataFrame:
    """``keys, difference``: keys of one copy only (``names``), else one row per field that differs.

    Both sides come from `latest_rows`: one row per key, fields in struct ``__v``. Fields are equal
    null-safe. Two empty copies have no differences; a copy compared with an empty one is all
    one-sided. Extra columns take no part.
    """
    fields = left.schema["__v"].dataType.names
    left, right = ([d.select(*keys, "__v", "__pos") for d in (left, right)])
    bits = leaf_bits(rows if rows is not None else left.count())
    leaves = mismatched_leaves(left, right, fields, bits)
    a = within(left, leaves, bits).select(*keys, F.col("__v").alias("__a"))
    b = within(right, leaves, bits).select(*keys, F.col("__v").alias("__b"))
    both = a.join(b, keys, "full_outer")
    kinds = F.when(F.col("__b").isNull(), F.array(F.lit(names[0]))).when(F.col("__a").isNull(), F.array(F.lit(names[1]))).otherwise(
        F.array_compact(F.array(*[F.when(~F.col(f"__a.{f}").eqNullSafe(F.col(f"__b.{f}")), F.lit(f)) for f in fields]))
    )
    return both.select(*keys, F.explode(kinds).alias("difference"))
