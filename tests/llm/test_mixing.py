"""The mix against a plain version, its targets against repeated sharing, and the sampling law."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ticketmill.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def shared(sizes, weights, total, cap=2):
    """Share, cap, and share the excess anew until none is above."""
    got, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        whole = sum(weights[i] for i in open_)
        trial = {i: left * weights[i] / whole for i in open_}
        over = {i for i in open_ if trial[i] > cap * sizes[i]}
        if not over:
            for i in open_:
                got[i] = trial[i]
            break
        for i in over:
            got[i] = cap * sizes[i]
            left -= got[i]
        open_ -= over
    return got


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 100, 1000, 5000]) for _ in range(rng.randint(1, 9))]
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    df = spark.createDataFrame(list(zip(range(len(sizes)), weights, sizes)), "i int, weight double, source_size long")
    got = {r["i"]: r["target"] for r in mixing.targets(df, 1.5 * sum(sizes)).collect()}
    want = shared(sizes, weights, 1.5 * sum(sizes))
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9, abs_tol=1e-9) for i in got)
    assert math.isclose(sum(got.values()), 1.5 * sum(sizes), rel_tol=1e-9)


def plain(rows, quality):
    size = [len((t or "").split()) for _, _, t in rows]
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    z = [sum(n for n, r in zip(size, rows) if r[1] == s) for s in names]
    goal = shared(z, [mixing.WEIGHTS[i % 3] for i in range(len(names))], 1.5 * sum(z))
    out = []
    for s, zs, t in zip(names, z, goal):
        epochs = int(t / zs) if zs else 0
        rest = math.floor(t + 0.5) - epochs * zs
        mine = []
        for (d, src, _), n in zip(rows, size):
            if src == s:
                digest = hashlib.sha256(f"mix:{'' if d is None else d}".encode()).hexdigest()
                mine.append((-math.log((int(digest[:13], 16) + 0.5) / 16 ** 13) / quality.get(d, 1.0), (d is not None, d or 0), n, d))
        for *_, n, d in sorted(mine):
            part = max(0, min(n, rest))
            rest -= n
            out.append((d, s, n, zs, round(t, 6), epochs * n + part, epochs))
    return sorted(out, key=str)


def collect(df):
    return sorted(((*r[:4], round(r[4], 6), *r[5:]) for r in map(tuple, df.collect())), key=str)


def test_against_plain_version(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a"] * 6 + ["b", "c", "é", "", None]), rng.choice([None, "", " \t\n", "w " * rng.randint(1, 40)])) for i in range(300)]
    rows += [(5, "a", "same words here"), (5, "a", "same words here"), (None, "b", "no id"), (900, "a", "long " * 200_000)]
    quality = {i: rng.choice([0.5, 2.0]) for i in range(0, 300, 2)}
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "'k' AS key", "2 AS target", "3 AS quality_weight").repartition(5)
    weights = spark.createDataFrame(list(quality.items()), "doc_id long, quality_weight double")
    first = collect(mixing.mix(docs, weights))
    assert first == plain(rows, quality)
    assert collect(mixing.mix(docs.coalesce(1), weights)) == first  # reruns agree, however the rows lie
    assert all(r[5] <= 2 * r[2] for r in first)
    for s in {r[1] for r in first}:
        mine = [r for r in first if r[1] == s]
        assert abs(sum(r[5] for r in mine) - mine[0][4]) <= 0.5


def test_better_documents_are_drawn_more(spark):
    rows = [(i, "a", "four words of text") for i in range(2000)] + [(5000 + i, "b", "w " * 40) for i in range(100)]
    quality = spark.range(0, 2000, 2).select(F.col("id").alias("doc_id"), F.lit(4.0).alias("quality_weight"))
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), quality, weights=(1.0, 1.0), share=0.5).filter("source = 'a' AND taken > 0")
    good = out.filter("doc_id % 2 = 0").count()
    assert out.count() == 750 and 0.6 < good / out.count() < 0.85


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, None, "")], SCHEMA)
    assert {tuple(r) for r in mixing.mix(blank).select("size", "source_size", "target", "taken").collect()} == {(0, 0, 0.0, 0)}
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r[0]: r[1] for r in mixing.label_weights(labels).collect()} == {1: 0.5, 2: 0.5, 3: 2.0}
