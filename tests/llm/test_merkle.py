"""The manifest against a plain recomputation of every tree, proof and fold."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ticketmill.llm import merkle
from ticketmill.operators import ranking

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row
    return h(*map(enc, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))


def tree(digests, k):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + k]) for i in range(0, len(last), k)])
    return levels


def path(levels, i, k):
    out = []
    for level in levels[:-1]:
        start = i // k * k
        out.append((level[start:i], level[i + 1:start + k]))
        i //= k
    return out


def brute(rows, k):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    by = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in by[x]], k) for x in langs}
    top = tree([trees[x][-1][0] for x in langs], k)
    out = []
    for j, lang in enumerate(langs):
        for i, row in enumerate(by[lang]):
            proof = path(trees[lang], i, k) + path(top, j, k)
            odd = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf(row, 1 if odd else 0)
            for left, right in proof:
                folded = h(*left, folded, *right)
            out.append((row[0], leaf(row), trees[lang][-1][0], top[-1][0], h(*(d for a, b in proof for d in a + b)),
                        folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n, seed=1):
    rng = random.Random(seed)
    rows = [(i * 3 + 1, rng.choice(["s", "", None]), rng.choice(["en", "en", "en", "é", "z", None]), rng.choice([5, 0, None]),
             rng.choice(["a text", "é 😀", "", None, "x" * 500])) for i in range(n)]
    return rows


@pytest.mark.parametrize("n, k", [(1, 2), (2, 2), (37, 2), (64, 2), (41, 3), (30, 5)])
def test_against_plain_trees(spark, n, k):
    rows = rows_of(n, n)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS idx", "2 AS tree", "'x' AS digest", "3 AS n").repartition(5)
    got = sorted(map(tuple, merkle.manifest(docs, k).select(*COLUMNS).collect()), key=str)
    assert got == brute(rows, k)


def test_tampering_is_found(spark):
    rows = [(i, "s", "en", 9, "t") for i in range(60)] + [(1000 + i, "s", "en", None, "t") for i in range(60)]
    got = {r["doc_id"]: r["verified"] for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    odd = {d for d in got if zlib.crc32(str(d).encode()) % 7 == 0}
    assert any(d < 1000 for d in odd) and any(d >= 1000 for d in odd)
    assert {d for d, ok in got.items() if not ok} == {d for d in odd if d < 1000}


def test_odd_rows(spark):
    twice = [(7, "s", "en", 1, "one"), (7, "s", "en", 1, "one"), (7, "s", "en", 1, "two"), (None, "s", "en", 1, "one"), (None,) * 5]
    docs = spark.createDataFrame(twice, SCHEMA)
    assert sorted(map(tuple, merkle.manifest(docs).select(*COLUMNS).collect()), key=str) == brute(twice, 2)
    assert merkle.manifest(docs.limit(0)).count() == 0
    long = [(1, "s", "en", 3, "word " * 400_000)]
    assert merkle.manifest(spark.createDataFrame(long, SCHEMA)).first()["leaf"] == leaf(long[0])
    with pytest.raises(ValueError):
        merkle.manifest(docs, 1)


def test_manifest_does_not_depend_on_partitions_or_broadcasts(spark, monkeypatch):
    rows = rows_of(50, 3)
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, merkle.manifest(docs.repartition(7)).select(*COLUMNS).collect()), key=str)
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)  # every proof join is shuffled
    out = merkle.manifest(docs.coalesce(1)).select(*COLUMNS)
    assert sorted(map(tuple, out.collect()), key=str) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "merge" in plan


def test_running_total(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", "", "zz"]), rng.randrange(1000), i, rng.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, i long, v long").repartition(6)
    want, sums = {}, {}
    for g, o, i, v in sorted(rows):
        n, s = sums.get(g, (0, 0))
        want[i] = (n, s)
        sums[g] = (n + 1, s + v)
    places = {r["i"]: r["p"] for r in ranking.running_total(df, "g", [F.col("o"), F.col("i")], name="p").collect()}
    totals = {r["i"]: r["s"] for r in ranking.running_total(df, "g", [F.col("o"), F.col("i")], "v", "s").collect()}
    assert {i: (places[i], totals[i]) for i in places} == want
    assert ranking.running_total(df.limit(0), "g", [F.col("o")]).count() == 0
