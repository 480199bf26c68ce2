"""Quality rules by distribution divergence from language references.

Two histograms of a text, its character classes and its uses of the commonest words, are held
against references of each language by the Jensen-Shannon distance (square root of the
divergence to base 2, from 0 to 1). A reference is summed over all documents of the language.
The nearest reference counts, so a text in two languages is not punished for its label. A
distance is only judged on enough material: ``MIN_CHARS`` characters, ``MIN_WORDS`` words. The word
distance must also stay below ``WORDLESS`` times that of a text without any common word, which differs by reference.

Base counts (words are runs of anything but ASCII white space): see ``base_counts``. A text
fails the base rule with fewer than ten words or more than a fifth of them in repeated
five-word windows. Null and empty texts have no words and fail. With no reference at all
(empty table, no ``lang``) only the base rule judges. A distance equal to its bound passes; of equally near
references either gives the same distance. Rows that repeat a doc_id are each judged by their own text. Extra
columns are ignored, whatever their names; very long texts are read whole, in a task's memory.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.common import settle
from ticketmill.llm.substrings import WordHashes

COMMON_WORDS = 100
MIN_CHARS = 200
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.40
MAX_WORD_DISTANCE = 0.55
WORDLESS = 0.95
REPEAT_WINDOW = 5
COUNTER_WORDS = 100_000
SYMBOLS = "#*$%&|<>"
TRIM = b".,;:!?\"'()[]"
CLASSES = ("lower", "upper", "beyond", "digit", "space", "stop", "symbol", "other")


def _class_table():
    """Class of each byte of UTF-8; the first byte of a character beyond ASCII stands for it."""
    import numpy as np

    table = np.full(256, len(CLASSES))  # continuation bytes: no class
    table[:128] = CLASSES.index("other")
    for name, chars in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                        ("digit", b"0123456789"), ("space", b" \t\n\r\v\f"), ("stop", b".,;:!?'\"()-"),
                        ("symbol", SYMBOLS.encode())):
        table[list(chars)] = CLASSES.index(name)
    table[0xC0:] = CLASSES.index("beyond")
    return table


def char_classes(data: bytes, table):
    import numpy as np

    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    return np.bincount(table, by_byte, len(CLASSES) + 1)[:len(CLASSES)].astype(np.int64)


def plain_words(data: bytes) -> list[bytes]:
    """Words for the histogram: ASCII lower case, punctuation at the ends cut."""
    return [w.strip(TRIM) for w in data.lower().split()]


def base_counts(text: str, data: bytes, words: list[bytes], hashes: WordHashes) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text.

    Code points inside words; symbol characters; lines with a word that equal an earlier line;
    words inside five-word windows that occur twice or more in the text, the first included.
    """
    import numpy as np

    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(line for line in data.split(b"\n") if line.strip(b" \t\n\v\f\r"))
    repeats = sum(lines.values()) - len(lines)
    n, repeated = len(words) - REPEAT_WINDOW + 1, 0
    if n > 1:
        h = hashes.of(words)
        grams = np.zeros(n, np.uint64)
        for k in range(REPEAT_WINDOW):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
        order = np.argsort(grams)
        ranked = grams[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            twice = np.zeros(n, bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            step = np.zeros(len(words) + 1, np.int64)
            step[:n] += twice
            step[REPEAT_WINDOW:REPEAT_WINDOW + n] -= twice
            repeated = int((np.cumsum(step)[:-1] > 0).sum())
    return chars, symbols, repeats, repeated


def references(docs: DataFrame, common: int = COMMON_WORDS) -> dict[str, dict]:
    """By language: ``classes`` (counts), ``words`` (the commonest, with counts), ``total`` words.

    Counted over all documents with a ``lang``; the driver gets ``common`` rows a language.
    """
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table, words, classes = _class_table(), {}, {}

        def emit():
            out = [(lang, 0, w, n) for lang, c in words.items() for w, n in c.items() if n]
            out += [(lang, 1, str(k).encode(), int(n)) for lang, c in classes.items() for k, n in enumerate(c)]
            words.clear()
            classes.clear()
            cols = list(zip(*out)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.int64())], names=["lang", "kind", "word", "n"])

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                words.setdefault(lang, Counter()).update(plain_words(data))
                classes[lang] = classes.get(lang, np.zeros(len(CLASSES), np.int64)) + char_classes(data, table)
                if sum(map(len, words.values())) > COUNTER_WORDS:
                    yield emit()
        yield emit()

    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counted = known.mapInArrow(count, "lang string, kind int, word binary, n long").filter("length(word) > 0")
    totals = settle(counted.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")), "counts")
    sums = {r["lang"]: r["n"] for r in totals.filter("kind = 0").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    best = totals.filter("kind = 0").withColumn(
        "at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).filter(F.col("at") <= common)
    out: dict[str, dict] = {}
    for r in best.orderBy("lang", "at").collect():
        out.setdefault(r["lang"], {"classes": [0] * len(CLASSES), "words": {}, "total": sums[r["lang"]]})
        out[r["lang"]]["words"][bytes(r["word"])] = r["n"]
    for r in totals.filter("kind = 1").collect():
        if r["lang"] in out:
            out[r["lang"]]["classes"][int(bytes(r["word"]))] = r["n"]
    return out


def distances(one, many):
    """Jensen-Shannon distances of a histogram from each row of ``many``; all sum to more than 0."""
    import numpy as np

    p, q = one / one.sum(), many / many.sum(axis=1, keepdims=True)
    m = (p + q) / 2

    def part(a):
        return np.sum(np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0), axis=1)

    return np.sqrt(np.clip((part(np.broadcast_to(p, q.shape)) + part(q)) / 2, 0, 1))


def judge(
    docs: DataFrame, refs: dict[str, dict] | None = None, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE
) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, char_distance and word_distance (null if not judged)."""
    refs = references(docs) if refs is None else refs
    langs = sorted(refs)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table, hashes = _class_table(), WordHashes()
        class_refs = np.array([refs[x]["classes"] for x in langs], float).reshape(len(langs), len(CLASSES))
        known = [refs[x]["words"] for x in langs]
        word_refs = [np.array([[*k.values(), refs[x]["total"] - sum(k.values())]], float) for x, k in zip(langs, known)]
        bounds = [min(max_word, WORDLESS * float(distances(np.eye(r.shape[1])[-1], r)[0])) for r in word_refs]
        places = [{w: i for i, w in enumerate(k)} for k in known]
        union: dict[bytes, None] = dict.fromkeys(w for k in known for w in k)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                out = []
                for text in some.column(1).to_pylist():
                    text = text or ""
                    data = text.encode()
                    words = data.split()
                    counts = base_counts(text, data, words, hashes)
                    char = word = None
                    usual = True
                    if langs and len(text) >= MIN_CHARS:
                        char = float(distances(char_classes(data, table), class_refs).min())
                    if langs and len(words) >= MIN_WORDS:
                        used = Counter(filter(union.__contains__, plain_words(data)))
                        each = []
                        for ref, place in zip(word_refs, places):
                            mine = np.zeros(ref.shape[1])
                            for w, n in used.items():
                                if w in place:
                                    mine[place[w]] = n
                            mine[-1] = len(words) - mine.sum()
                            each.append(float(distances(mine, ref)[0]))
                        word = min(each)
                        usual = any(d <= bound for d, bound in zip(each, bounds))
                    failed = len(words) < 10 or 100 * counts[3] > 20 * len(words)
                    fine = not failed and (char is None or char <= max_char) and usual
                    out.append((len(words), *counts, char, word, failed, fine))
                kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
                cols = list(zip(*out)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "char_distance", "word_distance", "base_failed", "kept"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "char_distance double, word_distance double, base_failed boolean, kept boolean").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")
