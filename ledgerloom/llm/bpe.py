"""Encoding of a corpus with a public byte-level vocabulary of ranked merges (problem 8).

Every piece of text is a doubly linked list of symbols; a priority queue holds the possible merges by
rank. A merge that was queued before one of its symbols changed is stale and skipped when it comes
up. Pieces repeat, so each distinct piece is merged once per worker.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the public vocabularies lie; every function takes another path.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the public pattern that splits text into pieces before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Distinct pieces that a worker remembers before it starts afresh.
REMEMBERED = 200_000


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: always the merge of lowest rank, leftmost first, until none is left."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    symbols: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    queue = []
    for i in range(n - 1):
        if (r := ranks.get(piece[i : i + 2])) is not None:
            queue.append((r, i, piece[i : i + 2]))
    heapq.heapify(queue)
    while queue:
        rank, i, joined = heapq.heappop(queue)
        left, j = symbols[i], after[i]
        if left is None or j < 0 or len(left) + len(symbols[j]) != len(joined) or left + symbols[j] != joined:
            continue  # stale: one of the symbols has been merged since
        symbols[i], symbols[j] = joined, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
            pair = joined + symbols[after[j]]
            if (r := ranks.get(pair)) is not None:
                heapq.heappush(queue, (r, i, pair))
        if (h := before[i]) >= 0:
            pair = symbols[h] + joined
            if (r := ranks.get(pair)) is not None:
                heapq.heappush(queue, (r, h, pair))
    return [ranks[s] for s in symbols if s is not None]


class Encoder:
    """A vocabulary with its piece cache."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.split, self.known = ranks, regex.compile(pattern).findall, {}

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text exactly as it stands, without special tokens; none for null and empty texts.

        Lone surrogates, which are no text, count as the replacement character.
        """
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for piece in self.split(text):
            out += known.get(piece) or self.encode_piece(piece)
        return out

    def encode_piece(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            ids = merge_piece(piece.encode("utf-8", "replace"), self.ranks)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(piece) < 200:
                self.known[piece] = ids
        return ids


def decode(ids: list[int], ranks: dict[bytes, int]) -> str:
    """The text of ids: their vocabulary strings in a row."""
    strings = {i: s for s, i in ranks.items()}
    return b"".join(strings[i] for i in ids).decode("utf-8", "replace")


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """The vocabulary of a rank file: a base64 string and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


@lru_cache(maxsize=2)
def _encoder(data: bytes) -> Encoder:
    return Encoder(parse_ranks(data))


def _shared(spark: SparkSession, vocabulary: str):
    with open(vocabulary, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # a fixed file of under a megabyte


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, ids``: the ids of every row's text; an empty list for empty and null texts.

    One row out for each row in, whatever repeats; no shuffle; an empty table gives an empty one.
    """
    data = _shared(df.sparkSession, vocabulary)

    def run(batches):
        enc = _encoder(data.value)
        for b in batches:
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            offsets = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(offsets[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, n_tokens``: the number of ids of every row's text; 0 for empty and null texts."""
    data = _shared(df.sparkSession, vocabulary)

    def run(batches):
        enc = _encoder(data.value)
        for b in batches:
            n = pa.array([len(enc.encode(t)) for t in b.column(1).to_pylist()], type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n], names=[key, "n_tokens"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long")


#: A line that quotes another text, as replies do.
_QUOTED = regex.compile(r"^[ \t]*>.*$", regex.MULTILINE)


def own_tokens(enc: Encoder, text: str | None) -> tuple[int, int]:
    """The number of ids of a text, and of those in lines that quote nobody; a piece counts where it begins."""
    n = len(enc.encode(text))
    if not text or ">" not in text:
        return n, n
    quoted = [m.span() for m in _QUOTED.finditer(text)]
    if not quoted:
        return n, n
    at, k, inside = 0, 0, 0
    for piece in enc.split(text):
        while k < len(quoted) and quoted[k][1] <= at:
            k += 1
        if k < len(quoted) and quoted[k][0] <= at:
            inside += len(enc.encode_piece(piece))
        at += len(piece)
    return n, n - inside


def count_loss(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, n_tokens, n_loss``: ids of every row's text, and those outside of quoted lines, which training bears loss on."""
    data = _shared(df.sparkSession, vocabulary)

    def run(batches):
        enc = _encoder(data.value)
        for b in batches:
            both = [own_tokens(enc, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([x[i] for x in both], type=pa.int64()) for i in range(2))], names=[key, "n_tokens", "n_loss"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, n_loss long")


def decode_column(df: DataFrame, ids: str, name: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with the text of its ids as column ``name``; null ids give null, empty ones an empty text."""
    data = _shared(df.sparkSession, vocabulary)

    @F.pandas_udf("string")
    def run(s):
        strings = {i: b for b, i in _encoder(data.value).ranks.items()}
        return s.map(lambda x: None if x is None else b"".join(strings[int(i)] for i in x).decode("utf-8", "replace"))

    return df.withColumn(name, run(F.col(ids)))
