"""Repeated passages: suffix automata of reference shards, matched by streaming documents.

A window is ``WINDOW`` consecutive words (runs of anything but ASCII white space) of one
document. A word is removed if a window over it also starts in a document with a smaller
doc_id, judged on the input. With automata of the whole corpus every document would have to
pass every shard; here the corpus is cut so that each window can only match in one shard:

1. Each window belongs to the smallest hash among its runs of ``GRAM`` words. Consecutive
   windows with the same one form a *run*; equal windows always meet under the same hash.
2. Hashes seen in one document only are dropped by an aggregate. Runs of equal content are
   counted once: later holders are removed whole, the first one stands for all.
3. The runs of a hash are a reference shard. A task streams them in doc_id order through a
   suffix automaton of the earlier documents, takes the matching statistics (length of the
   longest match that ends at each word), marks windows where it reaches ``WINDOW``, and
   then adds what is new to the automaton.
4. A hash with more than ``SHARD_RUNS`` different runs (what surrounds a passage that very
   many documents share) is cut finer: by the hash of each whole window, met in an aggregate.

Null and short texts lose nothing, an empty table gives no rows. A row without a doc_id neither takes
nor gives. Rows that repeat a doc_id are each judged by their own text, and take nothing from each other,
since neither doc_id is the smaller; windows that repeat inside one document stay. Extra columns are
ignored, whatever their names; long texts are read whole. Hashes have 64 bits; runs meet on two of them
(2), whole windows of crowded hashes on one (4), windows in a shard word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import join_checked, settle, shuffle_width

WINDOW = 50
GRAM = 8
SHARD_RUNS = 500
RUN_WINDOWS = 256
WORD_CACHE = 300_000
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class WordHashes(dict):
    """64-bit hashes of words, looked up; emptied at a bounded size."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]):
        import numpy as np

        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def stretches(h, starts, ends):
    """Content hashes of the word ranges [start, end), whatever their place."""
    import numpy as np

    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(h), _ODD, np.uint64)], dtype=np.uint64)
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(h), pow(_ODD, -1, 1 << 64), np.uint64)], dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(h * powers[:-1], dtype=np.uint64)]
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(h, window: int = WINDOW, gram: int = GRAM):
    """Arrays (hash, content, start, windows) of one document's runs, from its word hashes."""
    import numpy as np

    n = len(h) - window + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    grams = np.zeros(len(h) - gram + 1, np.uint64)
    for k in range(gram):
        grams = grams * np.uint64(_ODD) + h[k:k + len(grams)]
    least, span, width = mix(grams), 1, window - gram + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[width - span:width - span + n])
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    sizes = np.diff(np.r_[starts, n])
    if (sizes > RUN_WINDOWS).any():  # periodic text: cut at fixed places of the run
        pieces = -(-sizes // RUN_WINDOWS)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = np.repeat(starts + sizes, pieces)
        starts = np.repeat(starts, pieces) + within * RUN_WINDOWS
        sizes = np.minimum(ends - starts, RUN_WINDOWS)
    return least[starts], stretches(h, starts, starts + sizes + window - 1), starts, sizes


class Automaton:
    """Suffix automaton of several word sequences (Blumer et al. 1985), grown online."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def match(self, words: list, floor: int) -> list[int]:
        """Places where the longest match that ends there has ``floor`` words or more."""
        nexts, link, length = self.next, self.link, self.length
        state = size = 0
        found = []
        for i, w in enumerate(words):
            while state and w not in nexts[state]:
                state = link[state]
                size = length[state]
            if w in nexts[state]:
                state = nexts[state][w]
                size += 1
                if size >= floor:
                    found.append(i)
        return found

    def _clone(self, state: int, w, to: int) -> int:
        self.next.append(dict(self.next[to]))
        self.link.append(self.link[to])
        self.length.append(self.length[state] + 1)
        copy = len(self.next) - 1
        while state != -1 and self.next[state].get(w) == to:
            self.next[state][w] = copy
            state = self.link[state]
        self.link[to] = copy
        return copy

    def add(self, words: list) -> None:
        last = 0
        for w in words:
            to = self.next[last].get(w)
            if to is not None:
                last = to if self.length[to] == self.length[last] + 1 else self._clone(last, w, to)
                continue
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            new, state = len(self.next) - 1, last
            while state != -1 and w not in self.next[state]:
                self.next[state][w] = new
                state = self.link[state]
            if state != -1:
                to = self.next[state][w]
                self.link[new] = to if self.length[to] == self.length[state] + 1 else self._clone(state, w, to)
            last = new


def spans(places) -> list[int]:
    """Sorted places as flat [first, past last, ...] pairs."""
    import numpy as np

    places = np.asarray(places, np.int64)
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1)
    return np.stack([places[np.r_[0, cut + 1]], places[np.r_[cut, len(places) - 1]] + 1], 1).ravel().tolist()


def row_id():
    """Tells rows of one doc_id apart by their texts."""
    return F.xxhash64("text").alias("rid")


def _all_runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                ids, rids, parts = [], [], []
                for doc_id, rid, text in zip(*(c.to_pylist() for c in some.columns)):
                    words = (text or "").encode().split()
                    if len(words) >= window:
                        parts.append(runs(hashes.of(words), window, gram))
                        ids.append(np.full(len(parts[-1][0]), doc_id))
                        rids.append(np.full(len(parts[-1][0]), rid))
                if ids:
                    mh, cd, start, n = (np.concatenate(c) for c in zip(*parts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mh.view("<i8")), pa.array(cd.view("<i8")), pa.array(np.concatenate(ids)),
                         pa.array(np.concatenate(rids)), pa.array(start.astype("<i4")), pa.array(n.astype("<i4"))],
                        names=["mh", "cd", "doc_id", "rid", "start", "n"])

    return docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), row_id(), "text").mapInArrow(
        cut, "mh long, cd long, doc_id long, rid long, start int, n int")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """doc_id, rid, spans: flat pairs [first word, past last word) to remove, unsorted and overlapping."""
    every = settle(_all_runs(docs, window, gram), "runs")
    shared = every.groupBy("mh").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    shared = settle(shared.select("mh"), "shared")
    live = settle(join_checked(every, shared, "mh", "left_semi", 16), "live")
    content = settle(live.groupBy("mh", "cd").agg(
        F.min(F.struct("doc_id", "rid", "start", "n")).alias("first"), F.max("doc_id").alias("hi")), "content")
    later = content.filter(F.col("hi") > F.col("first.doc_id")).select("mh", "cd", F.col("first.doc_id").alias("lo"))
    whole = live.join(later, ["mh", "cd"]).filter(F.col("doc_id") > F.col("lo")).select(
        "doc_id", "rid", F.array(F.col("start"), F.col("start") + F.col("n") + (window - 1)).alias("span"))

    # First holders of different contents under one hash may still share windows.
    variety = content.groupBy("mh").agg(F.count(F.lit(1)).alias("variety")).filter("variety > 1")
    asked = content.join(variety, "mh").select(
        "mh", "cd", "first.*", (F.col("variety") > shard_runs).alias("finer"))
    per_doc = settle(asked.groupBy("doc_id", "rid").agg(
        F.collect_list(F.struct("mh", "cd", "start", "n", "finer")).alias("asked")), "asked")

    def fetch(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        schema = pa.schema([("mh", pa.int64()), ("cd", pa.int64()), ("doc_id", pa.int64()), ("words", pa.binary()),
                            ("windows", pa.list_(pa.int64()))])
        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, text, asked = (c[0].as_py() for c in batch.slice(row, 1).columns)
                words, out, h = text.encode().split(), [], None
                for a in asked:
                    upto = a["start"] + a["n"] + window - 1
                    if a["finer"]:
                        h = hashes.of(words) if h is None else h
                        at = np.arange(a["start"], a["start"] + a["n"])
                        held = (None, stretches(h, at, at + window).view("<i8").tolist())
                    else:
                        held = (b" ".join(words[a["start"]:upto]), None)
                    out.append((a["mh"], a["cd"], doc_id, *held))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long"), row_id(), "text")
    held = join_checked(texts, per_doc, ["doc_id", "rid"], "inner", "32 + 32 * cast(size(asked) as bigint)")
    fetched = settle(held.select("doc_id", "text", "asked").mapInArrow(
        fetch, "mh long, cd long, doc_id long, words binary, windows array<bigint>"), "fetched")

    def shard(batches: Iterator) -> Iterator:
        import pyarrow as pa

        current, doc, automaton, waiting = None, None, Automaton(), []
        for batch in batches:
            keys, found = [], []
            for mh, cd, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if mh != current:
                    current, automaton, waiting = mh, Automaton(), []
                elif doc_id != doc:
                    for words in waiting:
                        automaton.add(words)
                    waiting = []
                doc, words = doc_id, text.split()
                ends = automaton.match(words, window)
                if ends:
                    keys.append((mh, cd))
                    found.append(spans([e - window + 1 for e in ends]))
                if len(ends) < len(words) - window + 1:
                    waiting.append(words)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(k, pa.int64()) for k in zip(*keys)), pa.array(found, pa.list_(pa.int32()))],
                    names=["mh", "cd", "hit"])

    width = shuffle_width(docs.sparkSession)
    in_shards = fetched.filter(F.col("words").isNotNull()).select("mh", "cd", "doc_id", "words").repartition(
        width, "mh").sortWithinPartitions("mh", "doc_id", "cd").mapInArrow(shard, "mh long, cd long, hit array<int>")
    single = settle(fetched.filter(F.col("windows").isNotNull()).select(
        "mh", "cd", "doc_id", F.posexplode("windows").alias("at", "wh")), "single")
    earliest = single.groupBy("mh", "wh").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    alone = single.join(earliest.select("mh", "wh", "lo"), ["mh", "wh"]).filter(F.col("doc_id") > F.col("lo")).select(
        "mh", "cd", F.array(F.col("at"), F.col("at") + 1).alias("hit"))
    hits = in_shards.union(alone).join(
        content.select("mh", "cd", F.col("first.doc_id").alias("doc_id")), ["mh", "cd"])
    partial = live.join(hits, ["mh", "cd", "doc_id"]).select(
        "doc_id", "rid", F.transform("hit", lambda x, k: x + F.col("start") + F.when(k % 2 == 1, window - 1).otherwise(0)).alias("span"))
    return whole.union(partial).groupBy("doc_id", "rid").agg(F.flatten(F.collect_list("span")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space), removed (flat word spans)."""
    found = settle(repeated_windows(docs, window, gram, shard_runs), "spans")

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                out = []
                for text, ranges in zip(some.column(1).to_pylist(), some.column(2).to_pylist()):
                    words = (text or "").encode().split()
                    gone: list[int] = []
                    if ranges:
                        step = np.zeros(len(words) + 1, np.int64)
                        np.add.at(step, ranges[::2], 1)
                        np.add.at(step, ranges[1::2], -1)
                        keep = np.cumsum(step)[:-1] == 0
                        gone = spans(np.flatnonzero(~keep))
                        kept = [w for w, k in zip(words, keep.tolist()) if k]
                    else:
                        kept = words
                    out.append((len(words), len(words) - len(kept), b" ".join(kept).decode(), gone))
                cols = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.string()), pa.array(cols[3], pa.list_(pa.int32()))],
                    names=["doc_id", "n_words", "n_removed", "kept", "removed"])

    joined = join_checked(docs.select(F.col("doc_id").cast("long"), row_id(), "text"), found, ["doc_id", "rid"], "left",
                          "32 + 4 * cast(size(spans) as bigint)")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string, removed array<int>")
