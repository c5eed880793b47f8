import random

import pytest

from ledgerloom.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(bpe.VOCABULARY, "rb") as f:
        return bpe.parse_ranks(f.read())


@pytest.fixture(scope="module")
def other(ranks):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_as_the_public_library(ranks, other, spark, data):
    enc = bpe.Encoder(ranks)
    for r in spark.read.parquet(f"{data}/documents.parquet").select("text").where("text is not null").collect():
        ids = enc.encode(r.text)
        assert ids == other.encode_ordinary(r.text) and bpe.decode(ids, ranks) == r.text
    rng = random.Random(1)
    for _ in range(1500):
        t = "".join(rng.choice("aaabcå ø\n\t\U0001f600'st1٣…é<|endoftext|>") for _ in range(rng.randint(1, 90)))
        assert enc.encode(t) == other.encode_ordinary(t) and bpe.decode(enc.encode(t), ranks) == t


def test_merges_against_brute_force(ranks):
    """Scanning for the lowest pair again after each merge gives the same ids."""
    rng = random.Random(2)
    for _ in range(200):
        piece = bytes(rng.choice(b"abcdehilnorst ") for _ in range(rng.randint(1, 40)))
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not pairs:
                break
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.merge_piece(piece, ranks) == [ranks[p] for p in parts]


def test_long_piece(ranks, other):
    t = "a" * 100_000
    assert bpe.Encoder(ranks).encode(t) == other.encode_ordinary(t)


def test_table(spark):
    df = spark.createDataFrame([(1, "Hei", "x"), (2, None, "x"), (3, "", "x"), (1, "Hei", "x")], "k long, t string, ids string")
    got = sorted((r.k, list(r.ids)) for r in bpe.encode(df, "k", "t").collect())
    assert got[2:] == [(2, []), (3, [])] and got[0] == got[1] and len(got[0][1]) > 0
    assert sorted((r.k, r.n_tokens) for r in bpe.count_tokens(df, "k", "t").collect())[-2:] == [(2, 0), (3, 0)]
    assert bpe.encode(df.limit(0), "k", "t").count() == 0
    assert {r.k: r.text for r in bpe.decode_column(bpe.encode(df, "k", "t"), "ids").collect()} == {1: "Hei", 2: "", 3: ""}


def test_tokens_outside_of_quoted_lines(spark):
    texts = ["Hei\n> alt dette er sitert\nja", "> bare sitat", "a > b", None, "", "ingen", "  > sitat\n\n>> mer\nslutt"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: (r.n_tokens, r.n_loss) for r in bpe.count_loss(df, "id", "t").collect()}
    n = {r.id: r.n_tokens for r in bpe.count_tokens(df, "id", "t").collect()}
    assert {k: v[0] for k, v in got.items()} == n
    assert got[1][1] == 0 and got[3] == got[4] == (0, 0) and all(got[k][0] == got[k][1] for k in (2, 5)) and 0 < got[0][1] < got[0][0] and 0 < got[6][1] < got[6][0]
