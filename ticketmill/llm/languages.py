"""Language identification by piece unigrams, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability for each
piece; the likelihood of a word is the sum, over all ways to cut it into pieces, of the
products of their probabilities, computed by a forward pass. Words are runs of letters in
lower case with a start mark, cut every ``WORD_LETTERS`` letters. A text's score for a
language is the product over its words; languages are weighted equally, and the answer
carries its posterior probability. Null texts and texts without a letter are ``und``, score 0.

The probabilities are learned by expectation-maximisation on word counts of a bounded sample:
about ``SAMPLE_DOCS`` labelled rows of each language, chosen by a hash of doc_id (a parameter;
the only sampling here). Predictions use whole texts and read no other column. Languages are
expected to be few: a model holds vocabulary times languages numbers. Equal scores go to the first language by
name. Rows that repeat a doc_id are each judged by their own text; very long texts are read whole, each different
word once. Extra columns are kept beside the answer in ``row`` or ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import settle

SAMPLE_DOCS = 2000
ROUNDS = 3
PIECE_LETTERS = 12
WORD_LETTERS = 24
SMOOTHING = 0.05
UNKNOWN = 1e-9
CACHE_WORDS = 200_000
UNDEFINED = "und"
_LETTERS = re.compile(r"[^\W\d_]{1,%d}" % WORD_LETTERS)


@cache
def pieces(vocabulary: str) -> dict[str, int]:
    """Piece to number, for pieces that can occur in marked lower-case words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    fit = dict.fromkeys(p for p in found if len(p) <= PIECE_LETTERS and p == p.lower() and p.lstrip("▁").isalpha())
    return {p: i for i, p in enumerate(["▁", *(p for p in fit if p != "▁")])}


def lattice(words: list[str], number: dict[str, int]):
    """For words of one length: the piece at (word, start, letters - 1).

    One past the last piece means no piece, two past it an unknown single letter.
    """
    import numpy as np

    n, none = len(words[0]), len(number)
    width = min(n, PIECE_LETTERS)
    cuts = [(s, s + m) for s in range(n) for m in range(1, min(width, n - s) + 1)]
    get = number.get
    flat = [get(w[a:b], none) for w in words for a, b in cuts]
    out = np.full((len(words), n, width), none)
    rows = np.array(flat).reshape(len(words), -1)
    for k, (a, b) in enumerate(cuts):
        out[:, a, b - a - 1] = rows[:, k]
    single = out[:, :, 0]
    single[single == none] = none + 1
    return out


def forward(at, table):
    """Sums over segmentations up to each place; ``table`` is (pieces + 2) x languages."""
    import numpy as np

    words, n, width = at.shape
    alpha = np.zeros((words, n + 1, table.shape[1]))
    alpha[:, 0] = 1
    for e in range(1, n + 1):
        for m in range(1, min(width, e) + 1):
            alpha[:, e] += alpha[:, e - m] * table[at[:, e - m, m - 1]]
    return alpha


def word_scores(words: list[str], number: dict[str, int], table):
    """Log likelihood of each marked word in each language."""
    import numpy as np

    out = np.zeros((len(words), table.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for _, same in groupby(order, key=lambda i: len(words[i])):
        same = list(same)
        for k in range(0, len(same), 2000):
            some = same[k:k + 2000]
            out[some] = np.log(forward(lattice([words[i] for i in some], number), table)[:, -1])
    return out


def expected_counts(words: list[str], times: list[int], number: dict[str, int], column):
    """Expected uses of each piece over all segmentations, for words of one language."""
    import numpy as np

    table, total = column[:, None], np.zeros(len(column))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for _, same in groupby(order, key=lambda i: len(words[i])):
        same = list(same)
        for k in range(0, len(same), 2000):
            some = same[k:k + 2000]
            at = lattice([words[i] for i in some], number)
            alpha = forward(at, table)[:, :, 0]
            n, width = at.shape[1:]
            beta = np.zeros_like(alpha)
            beta[:, n] = 1
            for s in range(n - 1, -1, -1):
                for m in range(1, min(width, n - s) + 1):
                    beta[:, s] += beta[:, s + m] * column[at[:, s, m - 1]]
            weight = np.array([times[i] for i in some]) / alpha[:, n]
            for s in range(n):
                for m in range(1, min(width, n - s) + 1):
                    p = at[:, s, m - 1]
                    total += np.bincount(p, weight * alpha[:, s] * column[p] * beta[:, s + m], len(column))
    return total


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def train(labelled: DataFrame, vocabulary: str, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> tuple[list[str], object]:
    """Languages and the table (pieces + 2) x languages, from doc_id, text, lang; nulls are skipped."""
    import numpy as np

    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(rows)
    n_pieces = len(pieces(vocabulary))
    if not langs:
        return langs, np.full((n_pieces + 2, 0), 0.0)
    share = F.lit(None).cast("double")
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / rows[lang]))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) / F.lit(1e6)
    chosen = known.filter(place < share).select("lang", "text")

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                seen: dict[str, Counter] = {}
                for lang, text in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns)):
                    seen.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
                for lang, words in seen.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(words)), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())],
                        names=["lang", "word", "n"])

    words = settle(chosen.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")), "words")
    table = np.full((n_pieces + 2, len(langs)), 1 / n_pieces)
    for _ in range(rounds):
        table[n_pieces], table[n_pieces + 1] = 0, UNKNOWN

        def expect(batches: Iterator, table=table) -> Iterator:
            import numpy as np
            import pyarrow as pa

            number, total = pieces(vocabulary), np.zeros_like(table)
            for batch in batches:
                by: dict[str, list] = {}
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    by.setdefault(lang, []).append(("▁" + word, n))
                for lang, some in by.items():
                    k = langs.index(lang)
                    total[:, k] += expected_counts([w for w, _ in some], [n for _, n in some], number, table[:, k])
            piece, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(k), pa.array(total[piece, k])], names=["piece", "k", "n"])

        # At most pieces x languages rows.
        found = words.mapInArrow(expect, "piece long, k long, n double").groupBy("piece", "k").agg(F.sum("n").alias("n"))
        counts = np.zeros_like(table)
        got = found.toPandas()
        counts[got["piece"], got["k"]] = got["n"]
        counts = counts[:n_pieces] + SMOOTHING
        table = np.vstack([counts / counts.sum(axis=0), np.zeros((2, len(langs)))])
    table[n_pieces], table[n_pieces + 1] = 0, UNKNOWN
    return langs, table


class _Places(dict):
    """Word to row number; unseen words are listed for scoring."""

    def __init__(self):
        self.unseen: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.unseen.append("▁" + word)
        return at


def predict(docs: DataFrame, model: tuple[list[str], object], vocabulary: str) -> DataFrame:
    """doc_id, row (a struct of all input columns), lang_pred, score; reads only ``text``."""
    langs, table = model
    shared = docs.sparkSession.sparkContext.broadcast(table)  # vocabulary x languages

    @F.pandas_udf("lang string, score double")
    def guess(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np

        number, table = pieces(vocabulary), shared.value
        places, rows = _Places(), np.zeros((0, len(langs)))
        for texts in parts:
            names, scores = [], []
            for at in range(0, len(texts), 200):
                if len(places) > CACHE_WORDS:
                    places, rows = _Places(), np.zeros((0, len(langs)))
                spelled = [[] if t is None else _LETTERS.findall(t.lower()) for t in texts.iloc[at:at + 200]]
                found = [list(map(places.__getitem__, w)) for w in spelled]
                if places.unseen:
                    if len(places) > len(rows):  # room for twice as many, so that growing stays cheap
                        rows = np.concatenate([rows, np.zeros((len(places), len(langs)))])
                    rows[len(places) - len(places.unseen):len(places)] = word_scores(places.unseen, number, table)
                    places.unseen = []
                for words, lettered in zip(found, spelled):
                    # Number signs such as ² are word characters but no letters.
                    if not langs or not any(any(map(str.isalpha, w)) for w in lettered):
                        names.append(UNDEFINED)
                        scores.append(0.0)
                        continue
                    total = rows[words].sum(axis=0)
                    odds = np.exp(total - total.max())
                    names.append(langs[int(total.argmax())])
                    scores.append(float(1 / odds.sum()))
            yield pd.DataFrame({"lang": names, "score": scores})

    return docs.select(F.struct("*").alias("row"), guess("text").alias("g")).select(
        F.col("row.doc_id").alias("doc_id"), "row", F.col("g.lang").alias("lang_pred"), "g.score")
