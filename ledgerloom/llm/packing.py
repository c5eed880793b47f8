"""Items of varying length into containers of fixed capacity (problem 9).

Vector bin packing: a container is limited in tokens, in segments and in loss-bearing tokens at once.
It is filled with the item whose demand has the largest dot product with the room left, until none
fits. Items are spread over blocks by a hash and each block is packed on its own, so no group grows
with the data; a block wastes at most its last containers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import fan_out

#: Items that a block should hold.
BLOCK_ITEMS = 20_000


def fill(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: int) -> np.ndarray:
    """The container number of each item; every item fits an empty container.

    Items of equal demand are alike, so the search runs over distinct demands. Ties go to the larger
    demand and, within it, to the item that comes first.
    """
    n = len(tokens)
    out = np.full(n, -1, dtype=np.int64)
    if n == 0:
        return out
    order = np.lexsort((np.arange(n), -loss, -tokens))
    kinds, start, counts = np.unique(np.stack([-tokens[order], -loss[order]], axis=1), axis=0, return_index=True, return_counts=True)
    size = -kinds.astype(np.int64)
    room = np.array([capacity, max_loss], dtype=np.float64)
    demand = size / np.maximum(room, 1.0)
    left, taken = counts.copy(), np.zeros(len(counts), dtype=np.int64)
    weight = np.array([demand[:, d] @ counts / n for d in range(2)])  # a scarce dimension counts more
    container, todo = 0, n
    seg_demand, seg_weight = 1.0 / max_segments, 1.0 / max_segments
    alive = np.arange(len(counts))
    while todo:
        rest, segments = np.array([capacity, max_loss], dtype=np.int64), max_segments
        pool = alive
        while segments and len(pool):
            pool = pool[(size[pool, 0] <= rest[0]) & (size[pool, 1] <= rest[1]) & (left[pool] > 0)]
            if not len(pool):
                break
            score = demand[pool] @ (weight * rest / np.maximum(room, 1.0)) + seg_demand * seg_weight * segments
            k = int(pool[np.argmax(score)])
            out[order[start[k] + taken[k]]] = container
            taken[k] += 1
            left[k] -= 1
            rest -= size[k]
            segments -= 1
            todo -= 1
        container += 1
        if container % 64 == 0:
            alive = alive[left[alive] > 0]
    return out


def pack(df: DataFrame, key: str, tokens: str, capacity: int, max_segments: int = 256, loss: str | None = None, max_loss: int | None = None, block_items: int = BLOCK_ITEMS, rows: int | None = None) -> DataFrame:
    """``container, key, token_start, token_end`` (end exclusive), with ``loss`` if given: every item in containers.

    An item is split only if it alone exceeds ``capacity`` tokens or ``max_loss`` loss-bearing ones:
    into pieces as long as both allow and one rest, which are packed like other items. Items without tokens (also null
    counts) take one segment with an empty range. ``loss`` counts loss-bearing tokens and is all tokens
    if left out; of a split item it is spread evenly. Repeated keys are separate items. An empty table
    gives none. Container numbers are unique over all blocks. ``rows`` is about how many items there
    are; if left out they are counted, which works ``df`` out once more.
    """
    max_loss = capacity if max_loss is None else max_loss
    if capacity < 1 or max_segments < 1 or max_loss < 1:
        raise ValueError("capacity, max_segments and max_loss must be positive")
    blocks = max(1, -(-(df.count() if rows is None else rows) // block_items))
    items = df.select(
        F.col(key).alias("__key"),
        F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.lit(0)).alias("__n"),
        (F.col(loss).cast("long") if loss else F.col(tokens).cast("long")).alias("__loss"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).alias("__block"),
    )
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("container", T.LongType()), T.StructField(key, kind), T.StructField("token_start", T.LongType()), T.StructField("token_end", T.LongType()), *([T.StructField("loss", T.LongType())] if loss else [])])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__n", "__key"], ascending=[False, True], kind="stable").reset_index(drop=True)
        size = pdf["__n"].to_numpy(np.int64)
        bearing = np.clip(pdf["__loss"].fillna(0).to_numpy(np.int64), 0, size)
        some = np.maximum(size, 1)
        unit = np.where(bearing * capacity > max_loss * size, np.maximum(max_loss * size // np.maximum(bearing, 1), 1), capacity)
        parts = np.maximum(-(-size // unit), 1)
        i = np.repeat(np.arange(len(size)), parts)
        a = (np.arange(len(i)) - np.repeat(np.cumsum(parts) - parts, parts)) * unit[i]
        b = np.minimum(a + unit[i], size[i])
        own = bearing[i] * b // some[i] - bearing[i] * a // some[i]
        whole = b - a == capacity  # needs no search
        pick = np.flatnonzero(~whole)
        at = np.empty(len(i), np.int64)
        at[pick] = fill((b - a)[pick], own[pick], capacity, max_segments, max_loss)
        at[whole] = (int(at[pick].max()) + 1 if len(pick) else 0) + np.arange(int(whole.sum()))
        out = {"container": (int(pdf["__block"].iloc[0]) << 40) + at, key: pdf["__key"].to_numpy()[i], "token_start": a, "token_end": b}
        return pd.DataFrame(out | ({"loss": own} if loss else {}))

    return fan_out(items, "__block").groupBy("__block").applyInPandas(run, schema)


def usage(packed: DataFrame, capacity: int, max_loss: int | None = None) -> DataFrame:
    """One row: containers, tokens held, share of room used and the most segments in one container; of containers with ``loss`` also that."""
    with_loss = "loss" in packed.columns
    per = packed.groupBy("container").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("held"), F.count("*").alias("segments"), *([F.sum("loss").alias("loss")] if with_loss else []))
    share = lambda c, room: F.round(F.coalesce(F.sum(c), F.lit(0)) / F.greatest(F.count("*") * room, F.lit(1)), 6)
    return per.agg(
        F.count("*").alias("containers"),
        F.coalesce(F.sum("held"), F.lit(0)).alias("tokens"),
        share("held", capacity).alias("fill_rate"),
        F.coalesce(F.max("segments"), F.lit(0)).alias("most_segments"),
        *([share("loss", max_loss or capacity).alias("loss_rate"), F.coalesce(F.max("loss"), F.lit(0)).alias("most_loss")] if with_loss else []),
    )
