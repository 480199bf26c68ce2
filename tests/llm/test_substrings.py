import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketmill.llm import substrings


def brute(rows, window):
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i:i + window]), doc_id)
    out = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[i:i + window])] < doc_id:
                gone.update(range(i, i + window))
        out[doc_id] = (len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


@pytest.mark.parametrize("shard_runs", [1, 3, 500])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_against_brute_force(spark, shard_runs, letters):
    rng = random.Random(shard_runs)
    passages = [[rng.choice(letters) * rng.randint(1, 2) for _ in range(30)] for _ in range(5)]
    rows = [(0, None), (1, ""), (2, "a b"), (None, "a b " * 30)]
    for i in range(3, 60):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 20)
            words += p[a:a + rng.randint(0, 20)] + [rng.choice("vwxyz") * 3 for _ in range(rng.randint(0, 3))]
        rows.append((i * 7 % 61 + 100, " ".join(words)))
    rows += [(500 + i, rows[10][1]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "'x' AS kept").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"])
           for r in substrings.remove_repeats(docs, window=8, gram=3, shard_runs=shard_runs).collect()}
    want = brute(rows, 8)
    assert got == want and sum(w[1] for w in want.values()) > 500


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=5), st.lists(st.sampled_from("abc"), max_size=20))
def test_automaton_matches(known, words):
    automaton = substrings.Automaton()
    for k in known:
        automaton.add(k)
    found = automaton.match(words, 4)
    held = {tuple(k[i:i + 4]) for k in known for i in range(len(k) - 3)}
    assert found == [i for i in range(3, len(words)) if tuple(words[i - 3:i + 1]) in held]


def test_periodic_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a " * 5000), (2, "a " * 60 + "b")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.remove_repeats(docs).collect()}
    assert got[2] == (61, 60, "b") and got[1][1] == 0
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shard_runs", [1, 500])
def test_repeated_doc_ids(spark, shard_runs):
    rng = random.Random(21)
    w = " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(30))
    near = w.split()[:24] + ["other"] + w.split()[25:]
    rows = [(1, w), (2, w), (2, "short"), (2, None), (3, " ".join(near)), (3, w), (3, w), (4, "x " + w), (4, " ".join(near) + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rid", "2 AS start", "'x' AS spans").drop("rid")
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substrings.remove_repeats(docs, 10, 4, shard_runs).collect()), key=str)
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").split()
        for i in range(len(words) - 9):
            first.setdefault(tuple(words[i:i + 10]), doc_id)
    want = []
    for doc_id, text in rows:
        words = (text or "").split()
        gone = {k for i in range(len(words) - 9) if first[tuple(words[i:i + 10])] < doc_id for k in range(i, i + 10)}
        want.append((doc_id, len(words), len(gone), " ".join(x for i, x in enumerate(words) if i not in gone)))
    assert got == sorted(want, key=str)
