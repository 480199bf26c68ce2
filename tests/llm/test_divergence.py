import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ticketmill.llm import divergence
from ticketmill.llm.substrings import WordHashes


def brute_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é\n\t#|", max_size=80))
def test_base_counts(text):
    data = text.encode()
    assert divergence.base_counts(text, data, data.split(), WordHashes()) == brute_counts(text)


def test_distance():
    import numpy as np

    got = divergence.distances(np.array([1.0, 0.0]), np.array([[0.0, 4.0], [3.0, 0.0], [1.0, 1.0]]))
    half = (1 * math.log2(1 / 0.75) + 0.5 * math.log2(0.5 / 0.75) + 0.5 * math.log2(0.5 / 0.25)) / 2
    assert np.allclose(got, [1, 0, math.sqrt(half)])


def test_references_against_brute_force(spark):
    rows = [(1, "The a the. B", "en"), (2, "a, a le", "fr"), (3, None, "en"), (4, "x", None), (5, "É9|", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = divergence.references(docs, common=2)
    assert got["en"]["words"] == {b"the": 2, b"a": 1}
    assert got["en"]["total"] == 5 and got["fr"] == {"classes": [4, 0, 0, 0, 2, 1, 0, 0], "words": {b"a": 2, b"le": 1}, "total": 3}
    assert got["en"]["classes"] == [6, 2, 1, 1, 3, 1, 1, 0]


def test_verdicts(spark):
    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    refs = divergence.references(plain)
    good = next(r["text"] for r in plain.filter("lang = 'en' and n_chars > 2000").orderBy("doc_id").collect())
    rows = [(1, good[:1900]), (2, "#%| " * 300), (3, None), (4, ""), (5, "one two three"), (6, "a b c d e f g h " * 20),
            (None, good[:900]), (7, " ".join(f"q{i}z" for i in range(200)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "'en' AS lang")
    got = {r["doc_id"]: r for r in divergence.judge(docs, refs).collect()}
    assert got[1]["kept"] and got[None]["kept"]
    assert [got[i]["base_failed"] for i in (2, 3, 4, 5, 6, 7)] == [True, True, True, True, True, False]
    assert not got[7]["kept"] and got[5]["char_distance"] is None and got[3]["n_words"] == 0
    assert divergence.judge(docs.limit(0)).count() == 0
    assert divergence.judge(docs.drop("lang").withColumn("lang", docs.text.substr(1, 0).try_cast("int").cast("string"))).count() == 8


def test_letters_without_a_common_word_fail(spark):
    refs = divergence.references(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    signs = "bcdfghjklm"
    rows = [(1, " ".join("".join(signs[int(d)] for d in f"{i * 7919 % 100000:05d}") for i in range(1, 201))), (2, " ".join(
        "x" + "".join(signs[int(d)] for d in f"{i * 104729 % 100000:05d}") for i in range(1, 201)))]
    got = {r["doc_id"]: r for r in divergence.judge(spark.createDataFrame(rows, "doc_id long, text string"), refs).collect()}
    assert [got[i]["base_failed"] for i in (1, 2)] == [False, False]
    assert all(got[i]["char_distance"] <= divergence.MAX_CHAR_DISTANCE for i in (1, 2))
    assert all(got[i]["word_distance"] <= divergence.MAX_WORD_DISTANCE for i in (1, 2))
    assert not got[1]["kept"] and not got[2]["kept"]
