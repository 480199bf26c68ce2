import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketmill.llm import fuzzy_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", max_size=25), st.text(alphabet="abc", max_size=25), st.sampled_from([0.5, 0.8, 0.9]))
def test_edit_similarity(a, b, similarity):
    limit = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    assert fuzzy_lines.edit_similar(a, b, similarity) == (distance(a, b) <= limit)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcé", max_size=20), st.lists(st.text(alphabet="abcé", max_size=20), min_size=1, max_size=6))
def test_distances_side_by_side(text, others):
    assert fuzzy_lines.distances(text, others) == [distance(text, x) for x in others]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bb", "cc dd", "e", "é"]), max_size=8), max_size=6))
def test_prints_do_not_depend_on_what_stands_around(lines):
    text = "\n".join(" \t".join(x) for x in lines).encode() + b"\n"
    number, words, digest, prints, keys = fuzzy_lines.prints_of(text)
    want = [(k, x.split()) for k, x in enumerate(text.split(b"\n")) if x.split()]
    assert number.tolist() == [k for k, _ in want] and words.tolist() == [len(w) for _, w in want]
    for i, (_, w) in enumerate(want):
        alone = fuzzy_lines.prints_of(b"\n \n" + b" ".join(w) + b"\n")
        assert (alone[2][0], alone[3][0], alone[4][0].tolist()) == (digest[i], prints[i], keys[i].tolist())
    same = {}
    assert all(same.setdefault(d, w) == w for d, (_, w) in zip(digest.tolist(), want))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=1, max_size=40), st.integers(1, 6), st.integers(0, 4))
def test_near_trees(values, width, radius):
    values = np.array(values, np.int64)
    groups = np.sort(np.arange(len(values)) // width)
    parent, root = fuzzy_lines.near_trees(values, groups, radius)
    up = list(range(len(values)))

    def find(x):
        return x if up[x] == x else find(up[x])

    for i in range(len(values)):
        for j in range(i):
            if groups[i] == groups[j] and np.bitwise_count(values[i] ^ values[j]) <= radius:
                up[max(find(i), find(j))] = min(find(i), find(j))
    assert [find(i) for i in range(len(values))] == [find(i) for i in root.tolist()]
    assert len(set(root.tolist())) == len({find(i) for i in range(len(values))})
    assert all(p == i and root[i] == i or np.bitwise_count(values[p] ^ values[i]) <= radius for i, p in enumerate(parent.tolist()))


def brute(rows, radius, similarity, min_words):
    """Kept lines by document, from all pairs of lines."""
    lines = []
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            words = line.encode().lower().split()
            if len(words) >= min_words and doc_id is not None:
                print_ = fuzzy_lines.prints_of(b" ".join(words) + b"\n")[3][0]
                lines.append((doc_id, k, b" ".join(words).decode(), print_))
    lines.sort(key=lambda x: x[:2])
    up = list(range(len(lines)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(lines):
        for j in range(i):
            b = lines[j]
            near = np.bitwise_count(a[3] ^ b[3]) <= radius and distance(a[2], b[2]) <= int((1 - similarity) * max(len(a[2]), len(b[2])) + 1e-9)
            if a[2] == b[2] or near:
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    gone = {lines[i][:2] for i in range(len(lines)) if find(i) != i}
    return {d: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}


def test_against_all_pairs(spark, monkeypatch):
    rng = random.Random(4)
    base = [" ".join(rng.choice(["ab", "cde", "fgh", "Ij", "k1"]) + str(rng.randint(0, 9)) for _ in range(25)) for _ in range(6)]

    def line():
        words = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "new" + str(rng.randint(0, 99))
        return rng.choice(["", " ", "\t"]).join(["", rng.choice(["  ", " "]).join(words)])

    rows = [(i, "\n".join(line() if rng.random() < 0.8 else rng.choice(["", "short one", "é " * 6]) for _ in range(rng.randint(1, 5)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, rows[5][1]), (103, rows[5][1] + "\n"), (None, base[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS removed", "2 AS line", "'x' AS kept").repartition(4)
    want = brute(rows, 8, 0.7, 5)
    got = {r["doc_id"]: r["kept"] for r in fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs, radius=8, blocks=9, similarity=0.7)).collect()}
    assert got == want
    monkeypatch.setattr(fuzzy_lines, "CHUNK", 10)  # groups larger than a chunk: pairs of chunks
    got = {r["doc_id"]: r["kept"] for r in fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs, radius=8, blocks=9, similarity=0.7)).collect()}
    assert got == want
    assert sum((a or "") != (b or "") for a, b in ((t, want[d]) for d, t in rows)) > 20


def test_counts_and_empty(spark):
    one = "the same five words here"
    docs = spark.createDataFrame([(2, f"{one}\nx\n{one}"), (1, one.upper()), (3, f"x\n{one}  ")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept"]) for r in fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs)).collect()}
    assert got == {1: (1, 0, one.upper()), 2: (3, 2, "x"), 3: (2, 1, "x")}
    assert fuzzy_lines.drop_lines(docs.limit(0), fuzzy_lines.removals(docs.limit(0))).count() == 0


def test_production_setting_against_all_pairs(spark, monkeypatch):
    """Lines of one word pool chain within 20 bits; what is verified must not depend on that."""
    rng = random.Random(11)

    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8)))

    rows, n = [], 0
    for _ in range(25):
        words = [word() for _ in range(rng.randint(6, 30))]
        for _ in range(rng.randint(1, 8)):
            other = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 6)):
                other[rng.randrange(len(other))] = word()
            rows.append((n, " ".join(other)))
            n += 1
            words = other if rng.random() < 0.5 else words
    rows += [(500 + i, "ha " * (20 + i)) for i in range(6)] + [(600, "ha " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, fuzzy_lines.RADIUS, fuzzy_lines.SIMILARITY, 5)
    got = {r["doc_id"]: r["kept"] for r in fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs)).collect()}
    assert all(want[d] == "" for d in got if got[d] == "")  # nothing that all pairs would keep is lost
    lost = [d for d in want if want[d] == ""]
    missed = [d for d in lost if got[d] != ""]
    # Up to a sixth of the words and one more are new here, the far end of what the band keys reach.
    assert len(lost) > 60 and len(missed) <= 0.1 * len(lost)
    monkeypatch.setattr(fuzzy_lines, "CHUNK", 5)
    assert {r["doc_id"]: r["kept"] for r in fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs)).collect()} == got


def test_repeated_doc_ids(spark):
    line = "the same five words here"
    cases = [
        ([(1, line), (2, line), (2, "short")], [(1, line), (2, ""), (2, "short")]),
        ([(1, line), (2, line), (2, None)], [(1, line), (2, ""), (2, None)]),
        ([(1, line + "\n" + line + " too"), (1, line + " too")], None),
        ([(1, line), (1, line)], [(1, line), (1, line)]),  # one document met twice
    ]
    for rows, want in cases:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = [(r["doc_id"], r["kept"]) for r in fuzzy_lines.drop_lines(docs, fuzzy_lines.removals(docs)).collect()]
        if want is None:  # two similar lines and an equal one, of which one stays
            assert sum(len((t or "").split("\n")) if t else 0 for _, t in got) == 1
        else:
            assert sorted(got, key=str) == sorted(want, key=str)


def test_lines_with_replaced_words_are_reached(spark):
    rng = random.Random(6)

    def word():
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(6))

    rows, n = [], 150
    for i in range(n):
        words = [word() for _ in range(rng.randint(10, 40))]
        other = list(words)
        for k in rng.sample(range(len(words)), len(words) // 8):
            other[k] = word()
        rows += [(i, " ".join(words)), (1000 + i, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r["doc_id"] for r in fuzzy_lines.removals(docs).collect()}
    assert all(d >= 1000 for d in gone) and len(gone) >= 0.97 * n


def test_queries_drop_equal_short_lines(spark, tmp_path):
    from corpus_pipeline import dedup_lines
    from ticketmill.llm.queries import QUERIES

    rows = [(1, "All rights reserved.\n\nx"), (2, "all  rights reserved.\n\ny"), (3, "All rights reversed.\n \nx")]
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"]: r["n_removed"] for r in QUERIES["op8_fuzzy_lines"](spark, str(tmp_path)).collect()} == {1: 0, 2: 1, 3: 1}
    assert {r["doc_id"]: r["text"] for r in dedup_lines(spark, docs, "").collect()} == {1: rows[0][1], 2: "\ny", 3: "All rights reversed.\n "}


def test_agreeing_in_two_blocks_by_chance_is_no_link(spark):
    """Such pairs grow with the square of the lines; half of them differ in 19 bits or fewer, within the radius."""
    from ticketmill.llm.hamming import block_buckets

    rng, rows = np.random.default_rng(3), []
    for _ in range(200):
        a = int(rng.integers(0, 1 << 63))
        rows += [(a,), (int(rng.integers(0, 1 << 63)) & ~((1 << 26) - 1) | a & (1 << 26) - 1,)]
    near = int(rng.integers(0, 1 << 63))
    rows += [(near,), (near ^ 0b111 << 30,)]
    blocks = block_buckets(spark.createDataFrame(rows, "fp long"), 3, 5).select("fp", fuzzy_lines.of_kind(F.col("bucket"), F.lit(0)).alias("bucket"))
    bands = spark.createDataFrame([(a, k // 2 * 2 + 1) for k, (a,) in enumerate(rows)], "fp long, bucket long")
    found = fuzzy_lines.bucket_groups(blocks, fuzzy_lines.RADIUS, fuzzy_lines.BLOCK_RADIUS)
    held = {r["fp"] for r in found.collect()}
    assert {near, near ^ 0b111 << 30} <= held and len(held) <= 12
    # The same lines met in a band are linked up to the radius.
    assert fuzzy_lines.bucket_groups(bands, fuzzy_lines.RADIUS, fuzzy_lines.BLOCK_RADIUS).count() > 100


def test_many_lines_against_one(monkeypatch):
    rng = random.Random(8)
    texts = []
    for _ in range(6):
        words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(12)]
        for _ in range(8):
            other = list(words)
            for k in rng.sample(range(12), rng.randint(0, 4)):
                other[k] = "".join(rng.choice("abcdef") for _ in range(5))
            texts.append(" ".join(other))
    prints = np.zeros(len(texts), np.int64)

    def groups():
        up = list(range(len(texts)))
        for i, j in fuzzy_lines.verified(prints, texts, list(range(len(texts))), 20, 0.8):
            x, y = up[i], up[j]
            up = [min(x, y) if u in (x, y) else u for u in up]
        return up

    monkeypatch.setattr(fuzzy_lines, "ALONE", 10**6)
    want = groups()
    for alone, at_once in ((0, 1), (0, 200), (1, 1 << 14)):
        monkeypatch.setattr(fuzzy_lines, "ALONE", alone)
        monkeypatch.setattr(fuzzy_lines, "AT_ONCE", at_once)
        assert groups() == want
    assert 6 <= len(set(want)) < len(texts)


def test_a_text_is_cut_into_lines_once(spark):
    """Cut again for each line that stays, this text alone takes minutes."""
    import time

    n = 30_000
    text = "\n".join(f"line {k}" for k in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    gone = docs.select("doc_id", fuzzy_lines.row_id(), F.sequence(F.lit(0), F.lit(n - 1), F.lit(2)).alias("removed"))
    began = time.monotonic()
    row = fuzzy_lines.drop_lines(docs, gone).first()
    assert time.monotonic() - began < 20
    assert (row["n_lines"], row["n_removed"]) == (n, n // 2) and row["kept"] == "\n".join(f"line {k}" for k in range(1, n, 2))


def test_buckets_travel_many_to_a_row(spark, monkeypatch):
    """All pairs within the radius that share a bucket stay connected, however parts are packed and crowded."""
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 6, 300)
    buckets = np.where(rng.random(300) < 0.4, 7, rng.integers(0, 12, 300))
    spread = spark.createDataFrame(list(zip(values.tolist(), buckets.tolist())), "fp long, bucket long").repartition(3)

    def groups(links):
        up = list(range(64))
        for a, b in links:
            x, y = up[a], up[b]
            up = [min(x, y) if u in (x, y) else u for u in up]
        return up

    want = groups([(a, b) for a, x in zip(values.tolist(), buckets.tolist()) for b, y in zip(values.tolist(), buckets.tolist())
                   if x == y and (a ^ b).bit_count() <= (1 if x % 2 else 0)])
    for packed, most, chunk in ((1 << 10, 1 << 21, 2048), (2, 8, 5)):
        monkeypatch.setattr(fuzzy_lines, "PACKED", packed)
        monkeypatch.setattr(fuzzy_lines, "PART_MOST", most)
        monkeypatch.setattr(fuzzy_lines, "CHUNK", chunk)
        found = fuzzy_lines.bucket_groups(spread, 1, 0).collect()
        assert all((r["fp"] ^ r["near"]).bit_count() <= 1 for r in found)
        assert groups([(r["fp"], r["near"]) for r in found]) == want


def test_a_family_joined_to_another_asks_no_more(monkeypatch):
    """Two groups that are connected already need one similar pair, not one of each member."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(20)]
    texts = [" ".join(words[:19] + [f"{k:06d}"]) for k in range(80)]
    asked, old = [], fuzzy_lines.similar_pairs
    monkeypatch.setattr(fuzzy_lines, "similar_pairs", lambda texts, i, j, s: asked.append(len(i)) or old(texts, i, j, s))
    assert len(fuzzy_lines.verified(np.zeros(80, np.int64), texts, [0] * 40 + [1] * 40, 20, 0.8)) == 1
    assert sum(asked) == 1
