import random

import numpy as np
import pytest

from ticketmill.llm import edits


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("symbols, setup, blocks", [(150, 0, 4096), (2, 0, 4096), (150, 0, 7), (150, 60, 4096), (150, 1e9, 4096)])
def test_distances_of_many_pairs(monkeypatch, symbols, setup, blocks):
    monkeypatch.setattr(edits, "SYMBOLS", symbols)
    monkeypatch.setattr(edits, "SETUP", setup)
    monkeypatch.setattr(edits, "BLOCKS", blocks)
    monkeypatch.setattr(edits, "SLICE", 100)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdé\U0001f600") for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 130]))) for _ in range(25)]
    texts += [t[:len(t) // 2] + "x" + t[len(t) // 2 + rng.randint(0, 3):] for t in texts]
    held = edits.Texts(texts)
    left, right = (np.array([rng.randrange(50) for _ in range(150)]) for _ in range(2))
    want = np.array([distance(texts[i], texts[j]) for i, j in zip(left, right)])
    assert held.distances(left, right, left * 0 + 1000).tolist() == want.tolist()
    limits = held.limits(left, right, 0.8)
    got = held.distances(left, right, limits)
    assert ((got <= limits) == (want <= limits)).all() and (got == want)[got <= limits].all()
    possible = held.possible(left, right, limits)
    assert (want <= limits)[np.setdiff1d(np.arange(150), possible)].sum() == 0
    beginnings = held.distances(left, right, limits, 0.45)
    assert ((beginnings <= limits) | (want > limits)).all() and (beginnings > limits).sum() > 20
