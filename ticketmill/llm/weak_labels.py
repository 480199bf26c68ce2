"""Quality from weak labels: agreeing heuristics teach a hashed linear scorer.

Several heuristic labellers look at a text and vote good, bad or nothing. Expectation-
maximisation (Dawid and Skene 1979) estimates from their agreement alone how accurate each
is, on the counts of vote patterns over all documents, and so gives every pattern a posterior
probability of good. Those posteriors are the soft labels of a logistic scorer over hashed
words, word shapes and bucketed text statistics, fitted on a bounded sample: about
``SAMPLE_DOCS`` different texts at most, chosen by a hash of the text and weighed by how many rows
have them, each with its ``FIT_FEATURES`` commonest features (two parameters; the only sampling here).
So what the driver holds is bounded, however long texts are and however often one repeats.

Null and empty texts are bad by the length labeller; all labellers silent leave the prior. Rows that
repeat a doc_id are each scored by their own text, and equal texts get equal scores; a score of exactly
0.5 is kept. An empty table gives no rows; extra columns are ignored, whatever their names; very long texts
are scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.divergence import CLASSES, _class_table, char_classes

SAMPLE_DOCS = 4000
FIT_FEATURES = 4096
BUCKETS = 1 << 16
EM_ROUNDS = 50
FIT_ROUNDS = 300
RATE = 2.0
RIDGE = 1e-4
CACHE_WORDS = 300_000
GOOD, BAD, SILENT = "+", "-", "."
# Fixed word list: frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    b"the of and to in is that it was for on are as with by at be this from or an a der die und das den von zu mit ist "
    b"im nicht ein eine auf dem des sich auch es als la le les de et des en un une du que est pour dans qui sur par au il "
    b"el los las y del se por con una para no su al lo como".split())
_SHAPES = ((re.compile(r"[^\W\d_A-Z]+"), "a"), (re.compile(r"[A-Z]+"), "A"), (re.compile(r"\d+"), "9"))


def statistics(text: str | None, table) -> tuple[dict[str, float], list[bytes]]:
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    by = dict(zip(CLASSES, char_classes(data, table).tolist()))
    letters = by["lower"] + by["upper"] + by["beyond"]
    chars = max(1, sum(by.values()) - by["space"])
    lines = [x for x in data.split(b"\n") if x.strip()]
    lower = data.lower()
    return {
        "words": n,
        "symbols": by["symbol"] / chars,
        "upper": by["upper"] / max(1, letters),
        "letters": letters / chars,
        "digits": by["digit"] / chars,
        "shouts": lower.count(b"!") / max(1, n),
        "bars": (lower.count(b"|") + lower.count("•".encode())) / max(1, n),
        "distinct": len(set(words)) / max(1, n),
        "same_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "length": letters / max(1, n),
        "echo": sum(a == b for a, b in zip(words, words[1:])) / max(1, n),
        "top": max(Counter(words).values(), default=0) / max(1, n),
        "function": sum(w in FUNCTION_WORDS for w in lower.split()) / max(1, n),
    }, words


def votes(s: dict[str, float]) -> str:
    """One sign for each labeller, in a fixed order."""
    def rule(bad: bool, good: bool) -> str:
        return BAD if bad else GOOD if good else SILENT

    some, many = s["words"] >= 10, s["words"] >= 50
    return "".join((
        rule(s["words"] == 0, s["words"] >= 30),
        rule(s["symbols"] > 0.03, 0 < s["words"] and s["symbols"] < 0.005),
        rule(some and s["upper"] > 0.5, s["letters"] > 0 and s["upper"] < 0.25),
        rule(some and s["letters"] < 0.7, s["letters"] > 0.8),
        rule(some and s["shouts"] > 0.2, 0 < s["words"] and s["shouts"] < 0.02),
        rule(some and s["bars"] > 0.1, False),
        rule(many and s["distinct"] < 0.25, many and s["distinct"] > 0.4),
        rule(some and s["echo"] > 0.1, some and s["echo"] < 0.02),
        rule(many and s["top"] > 0.2, many and s["top"] < 0.15),
        rule(s["same_lines"] > 0.3, many and s["same_lines"] == 0),
        rule(some and s["function"] < 0.05, some and s["function"] > 0.15),
        rule(some and not 2.5 <= s["length"] <= 12, some and 3 <= s["length"] <= 9),
    ))


def agree(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """Posterior of good for every vote pattern, from pattern counts."""
    import numpy as np

    if not patterns:
        return {}
    names = list(patterns)
    count = np.array([patterns[p] for p in names], float)
    seen = np.array([[[v == s for s in (GOOD, BAD)] for v in p] for p in names], float)
    share = [(p.count(GOOD) + 1) / (p.count(GOOD) + 3 * p.count(BAD) + 2) for p in names]  # one bad vote outweighs several good
    good = np.array(share)
    for _ in range(rounds):
        # Chance of each vote given the class and that there is one, smoothed; silence tells nothing.
        by_class = [np.einsum("p,pks->ks", count * w, seen) + 1 for w in (good, 1 - good)]
        by_class = [c / c.sum(axis=1, keepdims=True) for c in by_class]
        prior = (count @ good + 1) / (count.sum() + 2)
        log = [np.einsum("pks,ks->p", seen, np.log(c)) for c in by_class]
        good = 1 / (1 + np.exp(np.clip(log[1] + np.log(1 - prior) - log[0] - np.log(prior), -500, 500)))
    return dict(zip(names, good.tolist()))


def bucket(name: str) -> int:
    return zlib.crc32(name.encode()) & (BUCKETS - 1)


def word_buckets(word: bytes) -> tuple[int, int]:
    """Buckets of a word in lower case and of its shape (runs of letters, capitals, digits)."""
    text = word.decode("utf-8", "replace")
    shape = text
    for pattern, sign in _SHAPES:
        shape = pattern.sub(sign, shape)
    return bucket("w" + text.lower()), bucket("s" + shape)


def text_buckets(s: dict[str, float]) -> list[int]:
    """Buckets of the text statistics, each cut into steps."""
    steps = [f"{k}:{min(19, int(v * 20))}" for k, v in s.items() if k not in ("words", "length")]
    return [bucket(x) for x in (*steps, f"length:{min(20, int(s['length']))}", f"words:{int(s['words']).bit_length()}")]


def patterns(docs: DataFrame) -> dict[str, int]:
    """Vote patterns over all documents; at most three to the number of labellers."""
    @F.pandas_udf("string")
    def vote(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:

        table = _class_table()
        for texts in parts:
            yield pd.Series([votes(statistics(t, table)[0]) for t in texts], dtype="object")

    rows = docs.select(vote("text").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["p"]: r["n"] for r in rows}


def fit(docs: DataFrame, posterior: dict[str, float], total: int, sample_docs: int = SAMPLE_DOCS):
    """Weights of the scorer: one for each bucket and the constant last."""
    import numpy as np

    place = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1_000_000)) / F.lit(1e6)
    chosen = docs.select(F.coalesce("text", F.lit("")).alias("text")).filter(place < min(1.0, sample_docs / max(1, total)))
    chosen = chosen.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))

    def features(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = _class_table()
        for batch in batches:
            for text, n in zip(*(c.to_pylist() for c in batch.columns)):
                s, words = statistics(text, table)
                flat = [b for w in words for b in word_buckets(w)]
                where, times = np.unique(np.array(flat, np.int64), return_counts=True)
                if len(where) > FIT_FEATURES:
                    most = np.sort(np.lexsort((where, -times))[:FIT_FEATURES])
                    where, times = where[most], times[most]
                extra = text_buckets(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int64()), pa.array([votes(s)]), pa.array([[*where.tolist(), *extra]], pa.list_(pa.int32())),
                     pa.array([[*(times / max(1, len(words))).tolist(), *[0.2] * len(extra)]], pa.list_(pa.float64()))],
                    names=["n", "p", "at", "x"])

    rows = chosen.select("text", "n").mapInArrow(features, "n long, p string, at array<int>, x array<double>").collect()
    rows.sort(key=lambda r: (r["p"], r["n"], r["at"], r["x"]))  # sums do not depend on the order of tasks
    if not rows:
        return np.zeros(BUCKETS + 1)
    return descend(rows, posterior)


def descend(rows, posterior: dict[str, float], rounds: int = FIT_ROUNDS):
    """The weights that fit posteriors of good to rows (n, p: votes, at, x: features) by gradient descent."""
    import numpy as np

    weights = np.zeros(BUCKETS + 1)
    y = np.array([posterior[r["p"]] for r in rows])
    sizes = np.array([len(r["at"]) for r in rows])
    at = np.concatenate([np.array(r["at"]) for r in rows])
    x = np.concatenate([np.array(r["x"]) for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    share = np.array([r["n"] for r in rows], float)
    share /= share.sum()
    squares, velocity = np.full(BUCKETS + 1, 1e-8), np.zeros(BUCKETS + 1)
    for _ in range(rounds):
        z = np.bincount(row, x * weights[at], len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-z)) - y) * share
        slope = np.r_[np.bincount(at, x * error[row], BUCKETS), error.sum()] + RIDGE * weights * np.r_[np.ones(BUCKETS), 0]
        velocity = 0.9 * velocity + 0.1 * slope
        squares = 0.99 * squares + 0.01 * slope * slope
        weights -= 0.05 * velocity / (np.sqrt(squares) + 1e-8)
    return weights


class _Gains(dict):
    """Word to its weight, looked up; emptied at a bounded size."""

    def __init__(self, weights):
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        a, b = word_buckets(word)
        self[word] = gain = float(self.weights[a] + self.weights[b])
        return gain


def score(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, votes, weak_good (posterior of its votes), score (the scorer's), kept (score of 0.5 or more)."""
    counts = patterns(docs)
    posterior = agree(counts)
    weights = fit(docs, posterior, sum(counts.values()), sample_docs)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # one number a bucket

    @F.pandas_udf("votes string, weak_good double, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np

        table, weights = _class_table(), shared.value
        gains = _Gains(weights)
        for texts in parts:
            out = []
            for text in texts:
                s, words = statistics(text, table)
                z = weights[-1] + sum(map(gains.__getitem__, words)) / max(1, len(words)) + 0.2 * weights[text_buckets(s)].sum()
                v = votes(s)
                out.append((v, posterior[v], float(1 / (1 + np.exp(-z)))))
            yield pd.DataFrame(out, columns=["votes", "weak_good", "score"])

    return docs.select(F.col("doc_id").cast("long"), run("text").alias("r")).select(
        "doc_id", "r.*", (F.col("r.score") >= 0.5).alias("kept"))
