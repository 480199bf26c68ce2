from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmill.llm import languages
from ticketmill.llm.encoding import vocabulary_path

VOCABULARY = vocabulary_path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    number = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4, "aba": 5}
    rng = np.random.default_rng(0)
    table = np.vstack([rng.random((6, 2)), [[0, 0], [1e-9, 1e-9]]])

    def brute(word, k):
        @cache
        def rest(s):
            if s == len(word):
                return 1.0
            total = 0.0
            for e in range(s + 1, len(word) + 1):
                i = number.get(word[s:e])
                if i is None and e == s + 1:
                    i = len(number) + 1
                if i is not None:
                    total += table[i, k] * rest(e)
            return total
        return rest(0)

    words = ["▁abab", "▁a", "▁xa", "▁aba"]
    got = languages.word_scores(words, number, table)
    assert np.allclose(np.exp(got), [[brute(w, k) for k in range(2)] for w in words])
    counts = languages.expected_counts(["▁ab"], [4], number, table[:, 0])
    ways = {("▁", "a", "b"): 0, ("▁", "ab"): 0, ("▁a", "b"): 0}
    chance = {w: np.prod([table[number[p], 0] for p in w]) for w in ways}
    for piece in ("▁", "ab", "▁a", "b"):
        assert np.isclose(counts[number[piece]], 4 * sum(c for w, c in chance.items() if piece in w) / sum(chance.values()))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(documents):
    model = languages.train(documents.filter(~languages.held_out(F.col("doc_id"))), VOCABULARY)
    found = languages.predict(documents, model, VOCABULARY).filter(languages.held_out(F.col("doc_id")))
    right, n = found.select(F.sum((F.col("lang_pred") == F.col("row.lang")).cast("int")), F.count("*")).first()
    assert n > 150 and right / n > 0.98


def test_edge_texts(spark, documents):
    model = languages.train(documents.limit(300), VOCABULARY, sample_docs=50)
    rows = [(1, None), (2, ""), (3, "12 -- 34²½"), (4, "the of and to " * 50_000), (None, "le la les des une"), (5, "z" * 5000), (5, "日本語")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "9 AS score", "'x' AS lang_pred", "1 AS row", "2 AS g")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in languages.predict(docs, model, VOCABULARY).collect()]
    assert [g for g in got if g[0] in (1, 2, 3)] == [(i, "und", 0.0) for i in (1, 2, 3)]
    assert (4, "en", 1.0) in got and len(got) == 7
    assert all(0 <= g[2] <= 1 for g in got) and next(g for g in got if g[0] is None)[1] == "fr"
    assert languages.predict(docs.limit(0), model, VOCABULARY).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = languages.train(docs, VOCABULARY)
    assert {r["lang_pred"] for r in languages.predict(docs, model, VOCABULARY).collect()} == {"und"}
