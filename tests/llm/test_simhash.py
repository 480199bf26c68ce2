import random

import numpy as np
import xxhash

from ticketmill.llm import hamming, simhash
from ticketmill.llm.components import connected_components


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    out = 0
    for bit in range(64):
        n = sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams)
        out |= (2 * n > len(grams)) << bit
    return out


def groups_of(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


TEXTS = [None, "", "  \n", "One", "one", "a b", "a b c", "A B C d", "É é a b", "x\x0by\x1cz", "long " * 5000]


def test_prints():
    assert [simhash.fingerprint(t) for t in TEXTS] == [brute_print(t) for t in TEXTS]
    assert simhash.fingerprint("") == 0


def test_groups_against_all_pairs(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(60)) for _ in range(12)]
    texts = TEXTS + [" ".join(w if rng.random() > 0.01 else "new" for w in rng.choice(base).split(" ")) for _ in range(150)]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [rows[20]], "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS component_id")
    got = sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.groups(docs).collect())
    rows.sort()
    prints = [brute_print(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    want = [(d, p, rows[g][0]) for (d, _), p, g in zip(rows, prints, groups_of(len(rows), near))]
    assert len({w[2] for w in want}) < len(want) - 30
    again = next(w for w in want if w[0] == 1000 - 60)
    assert got == sorted([*want, again])


def test_large_bucket_is_cut_and_loses_no_link(spark):
    rng = np.random.default_rng(5)
    flips = rng.integers(0, 64, (6000, 3))
    values = np.full(6000, 0x0123456789ABCDEF, np.uint64)
    for k in range(3):
        values ^= np.uint64(1) << flips[:, k].astype(np.uint64)
    values = np.unique(values)
    assert len(values) > 2 * hamming.CHUNK
    prints = spark.createDataFrame([(int(v.astype(np.int64)),) for v in values], "fp long")
    links = hamming.near_links(prints, 2, 4).collect()
    place = {int(v.astype(np.int64)): i for i, v in enumerate(values)}
    got = groups_of(len(values), [(place[r["a"]], place[r["b"]]) for r in links])
    pairs = []
    for i in range(len(values)):
        pairs += [(i, int(j)) for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 2)[:1]]
        pairs += [(i, int(j)) for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 2)[1:]]
    assert got == groups_of(len(values), pairs)


def test_empty_and_alone(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(docs).count() == 0
    one = spark.createDataFrame([(5, None)], "doc_id long, text string")
    assert [tuple(r) for r in simhash.groups(one).collect()] == [(5, 0, 5)]


def test_components(spark):
    rng = random.Random(8)
    pairs = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7), (None, 3)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    want = groups_of(600, [p for p in pairs if None not in p])
    assert all(got.get(i, i) == want[i] for i in range(600))
