"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

Words are runs of digits, ASCII letters (A-Z in lower case) and all characters above ASCII.
A window is ``WINDOW`` consecutive words of an item; a shorter item with words is one window.
A document word inside any occurrence of a window is hit.

Every window is a set of shingles of ``SHINGLE`` words (fewer if the window is shorter). A
document that holds the window holds every shingle of it, so it is enough to look for one:
the rarest, by the number of times that it occurs in the documents. Shingles are ordered by
that number, the rarest is the window's necessary prefix, and its place in the window fixes
where in the document the window must begin (positional bound) and that it must end within
the document (length bound). What is left is compared word by word.

Documents or items without words (null and empty texts too) have no hits. Repeated items
share their windows, so each of them is reported. ``doc_id`` is a key: of rows that repeat it
the hits are merged, and a row without one counts as free of hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import LETTERS, join_checked, settle

WINDOW = 10
SHINGLE = 3
# Separators: U+0000-U+002F, U+003A-U+0060 (but A-Z) and U+007B-U+007F.
SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null counts as empty."""
    plain = F.translate(F.coalesce(text, F.lit("")), LETTERS + SEPARATORS, LETTERS.lower() + " " * len(SEPARATORS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """item_id, w: the distinct windows of every item as word arrays."""
    listed = items.select("item_id", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0)
    last = F.greatest(F.size("ws") - window, F.lit(0))
    return listed.select(
        "item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("ws", i + 1, window))).alias("w")
    ).distinct()


def shingles_of(ws: Column, n: int) -> Column:
    """Every run of ``n`` words as a struct w0, w1, ..., without lambdas over words."""
    size = F.size(ws)
    parts = [F.slice(ws, k + 1, F.greatest(size - n + 1, F.lit(0))) for k in range(n)]
    return F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(parts)])


def occurrences(ids: DataFrame, key: str, ws: str, n: int) -> DataFrame:
    """(key, pos, h): all shingles of ``n`` words with their places."""
    zipped = ids.select(key, F.posexplode(shingles_of(F.col(ws), n)).alias("pos", "s"))
    return zipped.select(key, "pos", F.xxhash64(*[F.col("s").getField(f"w{k}") for k in range(n)]).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, hit (sorted word positions), items (sorted item ids as strings)."""
    listed = docs.select("doc_id", words(F.col("text")).alias("ws"))
    of_item = settle(item_windows(items, window).withColumn("wid", F.xxhash64("w")), "item-windows")
    distinct = settle(of_item.select("wid", "w").distinct(), "windows")

    # All places in documents where any shingle of any window stands, by shingle size; sizes
    # below the full one only occur if some item is that short.
    found: DataFrame | None = None
    placed: DataFrame | None = None
    sizes = [r[0] for r in distinct.select(F.least(F.size("w"), F.lit(shingle)).alias("n")).distinct().collect()]
    for n in sorted(sizes):
        of_size = distinct.filter(F.least(F.size("w"), F.lit(shingle)) == n)
        in_windows = settle(occurrences(of_size, "wid", "w", n).withColumn("n", F.lit(n)), "window-shingles")
        wanted = settle(in_windows.select("h").distinct(), "wanted")
        here = join_checked(occurrences(listed, "doc_id", "ws", n), wanted, "h", "left_semi", 16).withColumn("n", F.lit(n))
        found = here if found is None else found.union(here)
        placed = in_windows if placed is None else placed.union(in_windows)
    if found is None or placed is None:
        return listed.select(
            "doc_id", F.size("ws").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<int>").alias("hit"), F.array().cast("array<string>").alias("items"),
        )
    found = settle(found, "found")

    # Rarity order; the first shingle of a window in that order is its necessary prefix.
    rarity = found.groupBy("n", "h").agg(F.count(F.lit(1)).alias("times"))
    ranked = placed.join(rarity, ["n", "h"], "left")
    complete = ranked.groupBy("wid").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "n", "h", "pos")).alias("p")
    ).filter("p.times > 0")
    prefix = complete.select("wid", F.col("p.n").alias("n"), F.col("p.h").alias("h"), F.col("p.pos").alias("offset"))
    starts = found.join(prefix, ["n", "h"]).select("doc_id", "wid", (F.col("pos") - F.col("offset")).alias("start"))
    length = distinct.select("wid", F.size("w").alias("m"))
    starts = starts.filter("start >= 0").join(length, "wid")

    # Verification meets a document's words once, with all of its candidates. Their number is
    # bounded by the document's length and the distinct windows. What has the hash of its
    # window is then compared with the window's words.
    per_doc = settle(starts.groupBy("doc_id").agg(F.collect_set(F.struct("start", "m", "wid")).alias("c")), "per-doc")
    ws = F.col("ws")
    checked = join_checked(
        docs.select("doc_id", "text"), per_doc, "doc_id", "inner", "32 + 24 * cast(size(c) as bigint)"
    ).select("doc_id", words(F.col("text")).alias("ws"), "c")
    alike = checked.select("doc_id", F.explode(F.transform(
        F.filter("c", lambda x: (x.start + x.m <= F.size(ws)) & (F.xxhash64(F.slice(ws, x.start + 1, x.m)) == x.wid)),
        lambda x: F.struct(x.start.alias("start"), x.m.alias("m"), x.wid.alias("wid"), F.slice(ws, x.start + 1, x.m).alias("v")),
    )).alias("x")).select("doc_id", "x.*")
    equal = alike.join(distinct, "wid").filter(F.col("v") == F.col("w"))
    hits = settle(equal.groupBy("doc_id").agg(F.collect_set(F.struct("start", "m", "wid")).alias("c")), "hits")

    spans = F.flatten(F.transform("c", lambda x: F.sequence(x.start, x.start + x.m - 1)))
    hit = hits.select("doc_id", F.explode(spans).alias("i")).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("i")).alias("hit"))
    named = hits.select("doc_id", F.explode("c.wid").alias("wid")).distinct().join(
        of_item.select("wid", F.col("item_id").cast("string").alias("item")), "wid")
    items_of = named.groupBy("doc_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    result = settle(hit.join(items_of, "doc_id", "left"), "result")
    counted = listed.select("doc_id", F.size("ws").cast("long").alias("n_words"))
    joined = join_checked(
        counted, result, "doc_id", "left", "48 + 4 * cast(size(hit) as bigint) + 24 * cast(size(items) as bigint)")
    return joined.select(
        "doc_id", "n_words", F.when(F.col("hit").isNull(), 0).otherwise(F.size("hit")).cast("long").alias("n_hit"),
        F.coalesce("hit", F.array().cast("array<int>")).alias("hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
