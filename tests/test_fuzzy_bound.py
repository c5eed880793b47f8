import random

from ledgerloom.operators.resolve import _Labels, token_set_ratio


def test_bound_changes_nothing():
    """The bounded search gives what comparing with every label gives."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 5)))
    labels = [(" ".join(word() for _ in range(rng.randint(1, 3))), str(n)) for n in range(80)]
    known = _Labels(labels)
    for _ in range(400):
        q = " ".join(word() for _ in range(rng.randint(1, 3))) if rng.random() < 0.6 else rng.choice(labels)[0] + rng.choice(["", "x", " yy"])
        for threshold in (60.0, 95.0):
            full = sorted((-token_set_ratio(q, t), n) for n, (t, _) in enumerate(labels))[:5]
            assert known.best(q, threshold, 5) == (full if -full[0][0] >= threshold else [])
    assert _Labels([]).best("a", 95.0, 5) == []
