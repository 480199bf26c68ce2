import numpy as np

from ticketmill.llm import weak_labels


def test_agreement_finds_the_truth():
    rng = np.random.default_rng(2)
    accuracy, truth, counts, by_pattern = [0.9, 0.8, 0.75, 0.6, 0.95], rng.random(20_000) < 0.7, {}, {}
    for t in truth:
        p = "".join("." if rng.random() < 0.2 else "+" if (rng.random() < a) == t else "-" for a in accuracy)
        counts[p] = counts.get(p, 0) + 1
        by_pattern.setdefault(p, []).append(t)
    got = weak_labels.agree(counts)
    assert sum(((got[p] >= 0.5) == np.array(ts)).sum() for p, ts in by_pattern.items()) / len(truth) > 0.93
    large = [p for p in counts if counts[p] > 500]
    assert all(abs(got[p] - np.mean(by_pattern[p])) < 0.08 for p in large)
    assert weak_labels.agree({}) == {}


def test_scores_follow_the_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id < 4000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = weak_labels.score(docs).join(labels, "doc_id").select("kept", "quality").toPandas()
    good, bad = got[got.quality == 1].kept, got[got.quality == 0].kept
    assert good.mean() > 0.97 and bad.mean() < 0.2


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "!!! *** %%% ###"), (None, "a normal line of the text"), (3, "x " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS kept", "3 AS r", "4 AS p")
    got = weak_labels.score(docs).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= 0.5) for r in got)
    assert weak_labels.score(docs.limit(0)).count() == 0


def test_the_fit_is_plain_gradient_descent():
    rng = np.random.default_rng(3)
    posterior = {"+": 0.9, "-": 0.2}
    rows = [{"n": int(rng.integers(1, 5)), "p": rng.choice(["+", "-"]), "at": rng.choice(weak_labels.BUCKETS, 3, False).tolist(), "x": rng.random(3).tolist()} for _ in range(6)]
    got = weak_labels.descend(rows, posterior, 5)
    used = sorted({a for r in rows for a in r["at"]})
    w, bias = dict.fromkeys(used, 0.0), 0.0
    speed, square = dict.fromkeys([*used, "bias"], 0.0), dict.fromkeys([*used, "bias"], 1e-8)
    whole = sum(r["n"] for r in rows)
    for _ in range(5):
        slope = {a: weak_labels.RIDGE * w[a] for a in used} | {"bias": 0.0}
        for r in rows:
            z = bias + sum(x * w[a] for a, x in zip(r["at"], r["x"]))
            error = (1 / (1 + np.exp(-z)) - posterior[r["p"]]) * r["n"] / whole
            slope["bias"] += error
            for a, x in zip(r["at"], r["x"]):
                slope[a] += x * error
        for k, s in slope.items():
            speed[k] = 0.9 * speed[k] + 0.1 * s
            square[k] = 0.99 * square[k] + 0.01 * s * s
            step = 0.05 * speed[k] / (np.sqrt(square[k]) + 1e-8)
            if k == "bias":
                bias -= step
            else:
                w[k] -= step
    assert abs(got[-1] - bias) < 1e-9 and all(abs(got[a] - w[a]) < 1e-9 for a in used)


def test_scores_against_plain_sums(spark, monkeypatch):
    weights = np.random.default_rng(1).normal(size=weak_labels.BUCKETS + 1)
    monkeypatch.setattr(weak_labels, "fit", lambda *a: weights)
    texts = ["A line of the text, and more!", "x y z", None, "| menu | home |\nmenu"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in weak_labels.score(docs).collect()}
    for i, t in enumerate(texts):
        s, words = weak_labels.statistics(t, weak_labels._class_table())
        z = weights[-1] + 0.2 * sum(weights[b] for b in weak_labels.text_buckets(s))
        z += sum(weights[b] for w in words for b in weak_labels.word_buckets(w)) / max(1, len(words))
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_one_text_in_most_rows_is_one_row_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(weak_labels, "descend", lambda rows, posterior: seen.append(rows) or np.zeros(weak_labels.BUCKETS + 1))
    rows = [(i, "the same words " * 20) for i in range(500)] + [(i, " ".join(f"w{i}x{k}" for k in range(6000))) for i in range(500, 503)]
    weak_labels.score(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert sorted(r["n"] for r in seen[0]) == [1, 1, 1, 500]
    assert max(len(r["at"]) for r in seen[0]) <= weak_labels.FIT_FEATURES + 20
