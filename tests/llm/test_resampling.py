"""CRC matrices against zlib, and the sample against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketmill.llm import resampling

SCHEMA = "doc_id long, text string"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=12), max_size=30))
def test_crcs(parts):
    text = np.frombuffer(b"".join(parts) + b" ", np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    assert resampling.crcs(text, np.cumsum(sizes) - sizes, sizes).tolist() == [zlib.crc32(p) for p in parts]


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text):
    ws = words(text)
    return [zlib.crc32(" ".join(ws[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def plain(rows, target):
    found = [features(t) for _, t in rows]
    raw, goal = Counter(b for f in found for b in f), Counter(b for t in target for b in features(t))
    s, t = sum(raw.values()), sum(goal.values())
    gain = {b: math.floor(1000 * math.log((goal[b] + 1) * (s + 10000) / ((raw[b] + 1) * (t + 10000)))) for b in raw}
    out = []
    for (d, text), f in zip(rows, found):
        weight, score = sum(gain[b] for b in f), None
        if d is not None:
            h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(words(text)), len(f), weight, score, None])
    may = sorted((x for x in out if x[1] >= 20 and x[4] is not None), key=lambda x: (-x[4], x[0], -x[3]))
    for k, x in enumerate(may[:5 * len(may) // 100]):
        x[5] = k + 1
    return sorted(map(tuple, out), key=str)


def test_against_plain_version(spark, monkeypatch):
    rng = random.Random(3)
    pool = ["Word", "the", "été", "x1", "über", "ÀB", "don't", "e-mail", "日本", "I"]
    rows = [(i, " ".join(rng.choice(pool) + rng.choice(["", "", ",", "\n", "A"]) for _ in range(rng.randint(0, 90)))) for i in range(400)]
    rows += [(5, rows[5][1]), (1000, None), (1001, ""), (1002, "., !"), (None, rows[7][1]), (1003, "one two"), (1004, "b c " * 60_000)]
    target = ["the Word was x1", None, "", "über 日本 the the"]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS weight", "'x' AS buckets", "2 AS rank", "3 AS n_words").repartition(4)
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    want = plain(rows, target)
    assert sorted(map(tuple, resampling.resample(docs, goal).collect()), key=str) == want
    monkeypatch.setattr(resampling, "STRETCH", 50)  # many flushes, and texts longer than a stretch
    monkeypatch.setattr(resampling, "CELLS", 30)
    assert sorted(map(tuple, resampling.resample(docs.coalesce(1), goal).collect()), key=str) == want
    assert sum(r[5] is not None for r in want) >= 15


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert resampling.resample(none, none).count() == 0
    one = spark.createDataFrame([(1, "only one text")], SCHEMA)
    assert tuple(resampling.resample(one, none).first())[:3] == (1, 3, 6)


def test_documents_like_the_target_are_drawn(spark):
    rng = random.Random(8)
    def text(kind):
        return " ".join(f"{kind}{rng.randint(0, 60)}" if rng.random() < 0.3 else f"common{rng.randint(0, 60)}" for _ in range(60))
    rows = [(i, text("near" if i % 20 == 0 else "far")) for i in range(1000)]
    goal = spark.createDataFrame([(text("near"),) for _ in range(100)], "text string")
    drawn = [r["doc_id"] for r in resampling.resample(spark.createDataFrame(rows, SCHEMA), goal).filter("rank IS NOT NULL").collect()]
    assert len(drawn) == 50 and sum(d % 20 == 0 for d in drawn) >= 45
