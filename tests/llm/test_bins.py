from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from ticketmill.llm import bins


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_pack_fits(lengths):
    placed = bins.pack(lengths, (16, 32, 64))
    by_bin = defaultdict(list)
    for (b, offset), n in zip(placed, lengths):
        by_bin[b].append((offset, offset + n))
    for parts in by_bin.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[-1][1] <= 64


def test_joint_sizes():
    assert len({b for b, _ in bins.pack([60, 4, 4], (16, 64))}) == 2
    # One long sequence costs less than two short ones of the same total.
    assert len({b for b, _ in bins.pack([16, 16, 16, 16], (16, 64))}) == 1


def test_every_token_once(spark):
    rows = [(i, (i * 37) % 150) for i in range(300)] + [(7, 999), (7, 999), (None, 5), (8, None)]
    lengths = spark.createDataFrame(rows, "doc_id long, n_tokens long").selectExpr("*", "1 AS bin", "2 AS piece")
    got = bins.pack_documents(lengths, (16, 32, 64), shard_pieces=100).collect()
    total = defaultdict(int)
    by_bin = defaultdict(list)
    for r in got:
        total[r["doc_id"]] += r["length"]
        by_bin[r["shard"], r["bin"]].append(r)
    want = defaultdict(int)
    for i, n in rows:
        want[i] += n or 0
    assert dict(total) == {k: v for k, v in want.items() if v}
    assert len({r["shard"] for r in got}) > 1
    for parts in by_bin.values():
        used = sum(r["length"] for r in parts)
        assert {r["capacity"] for r in parts} == {min(c for c in (16, 32, 64) if c >= used)}
        spans = sorted((r["offset"], r["offset"] + r["length"]) for r in parts)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    starts = sorted((r["start"], r["length"]) for r in got if r["doc_id"] == 7 and r["start"])
    assert starts[-2:] == [(960, 39)] * 2


def test_empty(spark):
    assert bins.pack_documents(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0
