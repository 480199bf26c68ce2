"""Merkle manifest of a dataset: leaves, subtree and root digests, and a proof for every row.

Hashes are lowercase hex SHA-256 of concatenated inputs, digests as hex text. A leaf hashes
doc_id, source, lang, n_chars and text, each as ``-`` if null and else as its UTF-8 byte
count, a colon and its value, so no two rows share an encoding. The leaves of a language
ascend by doc_id; while a level has several nodes, every ``arity`` consecutive ones, the last
run perhaps fewer, become one parent. The subroots, ordered by language (null first,
bytewise), are the leaves of one more tree, whose root stands for the dataset.

Every level is one table (tree, idx, digest). It joins itself on computed sibling indices:
``idx XOR 1`` for arity 2, and for wider trees one join for each slot offset, ``idx`` less its
slot plus ``(slot + offset) % arity``. The rows in slot zero then hold all of a run and emit the
parent. Keys (tree, idx) are unique, so no join is skewed however large one language is. Proofs
come down again: the proof of a node is its siblings followed by its parent's proof, one
join a level, shipped whole only where the size of the level proves it small.

Null texts and other null columns hash as ``-``; rows that repeat a doc_id stand in the order of
their leaf hashes (equal rows are interchangeable); a null doc_id sorts first. Extra columns are
ignored, whatever their names; very long texts are hashed whole; an empty table has no rows,
no subroot and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import join_checked, settle
from ticketmill.operators.ranking import running_total
from ticketmill.session import BROADCAST_BYTES

ARITY = 2
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(hex_or_text: Column) -> Column:
    return F.unhex(F.sha2(hex_or_text, 256))


def as_hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def field(value: Column) -> Column:
    """One input of a leaf: ``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The leaf digest (binary) of a row, with some columns replaced."""
    return digest(F.concat(*(field(changed.get(name, F.col(name))) for name in FIELDS)))


def parents(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (tree, idx, n, digest, ...) with ``sibs``: the digests of the run's others, left to right."""
    slot = F.pmod("idx", F.lit(arity))
    found = nodes
    for offset in range(1, arity):
        # Seen from the sibling: the index of the node whose sibling at this offset it is.
        asker = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else (
            F.col("idx") - slot + F.pmod(slot - offset, F.lit(arity)))
        side = nodes.select("tree", asker.alias("idx"), F.col("digest").alias(f"_s{offset}"))
        found = found.join(side, ["tree", "idx"], "left")
    # By slot: offsets that run past the end of the run come round to its left.
    ordered = F.array_sort(F.array(*(
        F.struct(F.pmod(slot + o, F.lit(arity)).alias("at"), F.col(f"_s{o}").alias("d")) for o in range(1, arity))))
    empty = F.to_binary(F.lit(""), F.lit("utf-8"))
    sibs = F.aggregate(ordered, empty, lambda acc, x: F.concat(acc, F.coalesce(x["d"], empty))) if arity > 2 else (
        F.coalesce("_s1", empty))
    return found.select(*nodes.columns, sibs.alias("sibs"))


@dataclass
class Forest:
    """Levels of the trees, leaves first; ``sizes[l]`` bounds the rows of level ``l``."""

    levels: list[DataFrame]
    sizes: list[int]
    arity: int

    def roots(self) -> DataFrame:
        """tree, digest of the last node of every tree."""
        alone = [level.filter("n = 1").select("tree", "digest") for level in self.levels]
        out = alone[0]
        for more in alone[1:]:
            out = out.union(more)
        return out

    def proofs(self) -> DataFrame:
        """The leaves with ``path``: sibling digests from the leaf's level up to its root."""
        path = None
        for depth in reversed(range(len(self.levels))):
            level = self.levels[depth]
            if path is None:
                path = level.withColumn("path", F.col("sibs")).drop("sibs")
                continue
            above = path.select("tree", F.col("idx").alias("_up"), F.col("path").alias("_above"))
            height = len(self.levels) - depth - 1
            bytes_above = self.sizes[depth + 1] * (40 + DIGEST * (self.arity - 1) * height)
            above = F.broadcast(above) if bytes_above <= BROADCAST_BYTES // 8 else above.hint("merge")
            joined = level.withColumn("_up", F.expr(f"idx div {self.arity}")).join(above, ["tree", "_up"], "left")
            path = joined.withColumn(
                "path", F.concat("sibs", F.coalesce("_above", F.to_binary(F.lit(""), F.lit("utf-8"))))).drop("sibs", "_up", "_above")
        return path


def grow(leaves: DataFrame, arity: int = ARITY) -> Forest:
    """All levels over ``leaves``: tree long, idx long from 0, n long (leaves of the tree), digest, and more columns."""
    if arity < 2:
        raise ValueError("a run has two nodes or more")
    total, largest, trees = leaves.agg(
        F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0)), F.count_if(F.col("idx") == 0)).first()
    levels, sizes, nodes = [], [], leaves
    while True:
        level = settle(parents(nodes, arity), "merkle-level")
        levels.append(level)
        sizes.append(total)
        if largest <= 1:
            return Forest(levels, sizes, arity)
        nodes = level.filter((F.col("n") > 1) & (F.pmod("idx", F.lit(arity)) == 0)).select(
            "tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest(as_hex(F.concat("digest", "sibs"))).alias("digest"))
        largest, total = -(-largest // arity), total // arity + trees


def fold(start: Column, idx: Column, n: Column, path: Column, levels: int, arity: int = ARITY) -> Column:
    """The root (hex) that a node's digest (hex) and its proof lead to; ``n`` is the size of its tree.

    Works from the row alone: slots and run sizes follow from ``idx`` and ``n``.
    """
    def step(acc, _):
        slot = F.pmod(acc["idx"], F.lit(arity))
        others = F.least(F.lit(arity).cast("long"), acc["n"] - acc["idx"] + slot) - 1
        left = acc["rest"].substr(F.lit(1), (slot * DIGEST).cast("int"))
        right = acc["rest"].substr((slot * DIGEST + 1).cast("int"), ((others - slot) * DIGEST).cast("int"))
        up = F.struct(
            F.sha2(F.concat(as_hex(left), acc["at"], as_hex(right)), 256).alias("at"),
            F.floor(acc["idx"] / arity).cast("long").alias("idx"), F.ceil(acc["n"] / arity).cast("long").alias("n"),
            acc["rest"].substr((others * DIGEST + 1).cast("int"), F.length(acc["rest"])).alias("rest"))
        return F.when(acc["n"] > 1, up).otherwise(acc)

    first = F.struct(start.alias("at"), idx.cast("long").alias("idx"), n.cast("long").alias("n"), path.alias("rest"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, levels))), first, step, lambda acc: acc["at"])


def tampered(doc_id: Column) -> Column:
    """Whether a row stands among those that the check changes; never a row without doc_id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 0, F.lit(False))


def manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """doc_id, lang, leaf, idx, n (place in and size of the language's tree), subroot, root, proof (binary), proof_sha256,
    folded_root, verified: the root refolded from the row's leaf after one was added to ``n_chars`` of tampered rows."""
    hashed = settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # Null first, and bytewise as strings are: a mark before the value.
        F.when(F.col("lang").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("lang"))).alias("key"),
        leaf().alias("digest"),
        F.when(tampered(F.col("doc_id")) & F.col("n_chars").isNotNull(), leaf(n_chars=F.col("n_chars") + 1)).alias("changed")), "leaves")
    placed = running_total(hashed, "key", [F.col("doc_id"), F.col("digest")], name="idx")
    sizes = settle(hashed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit("")), "sizes")
    trees = settle(running_total(sizes, "all", [F.col("key")], name="tree").select("key", "n", "tree"), "trees")
    leaves = settle(join_checked(placed, trees, "key", "inner", "24 + octet_length(key)"), "placed")
    forest = grow(leaves.select("tree", "idx", "n", "digest", "doc_id", "key", "changed"), arity)

    roots = forest.roots().withColumnRenamed("digest", "subroot")
    n_trees = trees.count()
    top = grow(roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"),
                            F.lit(n_trees).cast("long").alias("n"), F.col("subroot").alias("digest")), arity)
    upper = top.proofs().select(F.col("idx").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("upper"))
    root = top.roots().select(F.col("digest").alias("root"))
    upper = settle(upper.join(F.broadcast(root)), "subroots")  # the root is one row
    both = join_checked(forest.proofs(), upper, "tree", "inner", "80 + octet_length(upper)").withColumn(
        "proof", F.concat("path", "upper"))
    mine = as_hex(F.coalesce("changed", "digest"))
    subroot = fold(mine, F.col("idx"), F.col("n"), F.col("path"), len(forest.levels), arity)
    folded = fold(subroot, F.col("tree"), F.lit(n_trees), F.col("upper"), len(top.levels), arity)
    return both.select(
        "doc_id", F.when(F.col("key") != "0", F.substring("key", 2, 1 << 30)).alias("lang"), as_hex(F.col("digest")).alias("leaf"),
        "idx", "n", as_hex(F.col("subroot")).alias("subroot"), as_hex(F.col("root")).alias("root"), "proof",
        F.sha2(as_hex(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
