"""Merkle dataset manifest: postorder append logs, and proofs by closed-form positions.

A tree has ``ARITY`` children a node; the last run of a level may be shorter, even a single
node. Leaves of a tree are dealt to builders by aligned blocks of ``ARITY ** levels``. A
builder takes its leaves in order and appends each node to its log at the moment its last
child is there, so a log is its subtree in postorder and never needs to be rewritten. The
roots of the blocks are the leaves of the next tier, built the same way, until a tree is one
block. Roots of the trees, in the order of their names, are the leaves of a last tree.

Before node (level, index) come all nodes that end no later, so its place in a log is a sum
of quotients of where its leaves begin and end: no index is kept, siblings of a proof are
read at their computed places. Proofs go down the tiers: each block gets the path above its
root once, and its leaves add their own levels.

Only keys and digests are shuffled, never texts. Ranks come from a range sort with counts
per partition; equal leaves are dealt over partitions by a last sort key, so a row repeated
any number of times makes no large task. A block holds at most 4,096 leaves.

Cases: NULL fields are ``-``; a NULL tree name is a tree of its own and the first, a NULL key
comes first in its tree, and is not tampered with; rows with equal keys are in the order of
their leaves, rows repeated whole are leaves of their own; empty and very long texts are
hashed whole; other columns, whatever they are called, are left out; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront.llm.common import land, ship
from storefront.llm.streams import Output, rows

ARITY = 8
LEVELS = 4  # of a builder's block
DIGEST = 32

_SHARED = (1 << 33) - 1  # monotonically_increasing_id: the partition above, the row below


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def position(level: int, index: int, n: int, top: int) -> int:
    """Place of a node in the postorder log of ``n`` leaves below a root at level ``top``."""
    begin, end = index * ARITY**level, min(n, (index + 1) * ARITY**level)
    ended = sum(-(-end // ARITY**i) for i in range(level + 1))
    return ended + sum(begin // ARITY**i for i in range(level + 1, top + 1)) - 1


def append_log(leaves: Sequence[str], top: int) -> list[str]:
    """All nodes in the order in which they are complete; ``top``: the level of the root."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(top + 1)]

    def add(level: int, node: str) -> None:
        log.append(node)
        runs[level].append(node)
        if level < top and len(runs[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        node = digest(runs[level])
        runs[level].clear()
        add(level + 1, node)

    for leaf in leaves:
        add(0, leaf)
    for level in range(top):
        if runs[level]:
            close(level)
    return log


def levels_of(log: Sequence[str], n: int, top: int) -> list[list[str]]:
    """The nodes of each level, read at their places in the log."""
    return [[log[position(k, j, n, top)] for j in range(-(-n // ARITY**k))] for k in range(top + 1)]


def path(levels: Sequence[Sequence[str]], index: int) -> tuple[list[str], list[str]]:
    """For each level below the root, the siblings before and after a leaf's ancestor."""
    before, after = [], []
    for nodes in levels[:-1]:
        start = index - index % ARITY
        run = nodes[start : start + ARITY]
        before.append("".join(run[: index - start]))
        after.append("".join(run[index - start + 1 :]))
        index //= ARITY
    return before, after


def fold(leaf: str, before: Sequence[str], after: Sequence[str]) -> str:
    """The root that a leaf and the siblings of its path give."""
    for left, right in zip(before, after):
        leaf = digest((left, leaf, right))
    return leaf


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as its length in bytes and its text, or ``-``."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def ranked(df: DataFrame, tree: str, order: Sequence[str], label: str) -> DataFrame:
    """``df`` with ``rank`` (from 0) and ``total`` within each tree, in ascending order of ``order``."""
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order, "_salt")]
    sorted_ = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = land(sorted_.drop("_salt").withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counted = placed.groupBy(F.col(tree).alias("_tree"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # a row per partition and tree: as many rows of a tree as there are partitions
    whole = Window.partitionBy("_tree")
    offsets = counted.select(
        "_tree", "_p", "_first", F.sum("_n").over(whole).alias("total"),
        (F.sum("_n").over(whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_ahead"),
    )
    joined = placed.join(offsets, placed[tree].eqNullSafe(offsets._tree) & (placed._part == offsets._p))
    rank = F.col("_at") - F.col("_first") + F.col("_ahead")
    return joined.withColumn("rank", rank).drop("_at", "_part", "_tree", "_p", "_first", "_ahead")


_BLOCKS = pa.schema(
    [("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("n", pa.int32()), ("top", pa.int32()), ("log", pa.binary()),
     ("root", pa.string()), ("keys", pa.list_(pa.int64())), ("changed", pa.list_(pa.binary()))]
)
_BLOCKS_SQL = (
    "tree string, block long, total long, n int, top int, log binary, root string, keys array<long>, changed array<binary>"
)


def _logs(nodes: DataFrame, most: int, label: str) -> DataFrame:
    """One row per block of ``ARITY ** most`` leaves with its log; ``nodes``: tree, rank, total, node, key, changed."""
    size = ARITY**most

    def run(batches):
        out, held, now = Output(_BLOCKS), [], None

        def built():
            tree, block, total = now
            top = most if total > size else height(len(held))
            log = append_log([x[0].hex() for x in held], top)
            packed = b"".join(map(bytes.fromhex, log))
            keys, changed = [x[1] for x in held], [x[2] for x in held]
            return (tree, block, total, len(held), top, packed, log[-1], keys, changed), len(packed) + 48 * len(held)

        for tree, block, total, node, key, changed in rows(batches, ["tree", "block", "total", "node", "key", "changed"]):
            if now != (tree, block, total):
                if held:
                    yield from out.add(*built())
                now, held = (tree, block, total), []
            held.append((node, key, changed))
        if held:
            yield from out.add(*built())
        yield from out.rest()

    ship(nodes.sparkSession)
    placed = nodes.select("tree", F.expr(f"rank div {size}").alias("block"), "rank", "total", "node", "key", "changed")
    dealt = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    return land(dealt.drop("rank").mapInArrow(run, _BLOCKS_SQL), label)


def _tiers(nodes: DataFrame, most: int, label: str) -> list[DataFrame]:
    """The logs of all tiers, the leaves' first; each tree is one block in the last one."""
    size = ARITY**most
    tiers = [_logs(nodes, most, f"{label}-0")]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        roots = tiers[-1].select(
            "tree", F.col("block").alias("rank"), F.expr(f"(total + {size - 1}) div {size}").alias("total"),
            F.unhex("root").alias("node"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("binary").alias("changed"),
        )
        tiers.append(_logs(roots, most, f"{label}-{len(tiers)}"))
    return tiers


def _read(log: bytes, n: int, top: int) -> list[list[str]]:
    return levels_of([log[i : i + DIGEST].hex() for i in range(0, len(log), DIGEST)], n, top)


_PATHS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])


def _below(blocks: DataFrame, most: int) -> DataFrame:
    """The paths of the leaves of ``blocks`` (with ``before`` and ``after``, their own paths)."""
    size = ARITY**most

    def run(batches):
        out = Output(_PATHS, 500)
        for tree, block, n, top, log, before, after in rows(batches, ["tree", "block", "n", "top", "log", "before", "after"]):
            levels = _read(log, n, top)
            for i in range(n):
                left, right = path(levels, i)
                yield from out.add((tree, block * size + i, left + before, right + after))
        yield from out.rest()

    return blocks.mapInArrow(run, "tree string, block long, before array<string>, after array<string>")


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The blocks of a tier, each with the path above its root."""
    above = paths.withColumnsRenamed({"tree": "_tree", "block": "_block"})
    met = blocks.tree.eqNullSafe(above._tree) & (blocks.block == above._block)
    return blocks.join(above, met).drop("_tree", "_block")


_PROOFS = pa.schema(
    [("tree", pa.string()), ("key", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
     ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())]
)


def _proofs(blocks: DataFrame) -> DataFrame:
    """A row per leaf: its proof, and the root that its (changed) leaf gives along it."""

    def run(batches):
        out = Output(_PROOFS)
        names = ["tree", "n", "top", "log", "keys", "changed", "before", "after", "subroot", "top_root"]
        for tree, n, top, log, keys, changed, before, after, subroot, root in rows(batches, names):
            levels = _read(log, n, top)
            # the levels above the block are the same for all its leaves
            above = "".join(x + y for x, y in zip(before, after))
            intact = fold(levels[-1][0], before, after)
            for i in range(n):
                left, right = path(levels, i)
                proof = sha256("".join(x + y for x, y in zip(left, right)).encode())
                proof.update(above.encode())
                other = changed[i].hex() if changed[i] is not None else levels[0][i]
                inner = fold(other, left, right)
                folded = intact if inner == levels[-1][0] else fold(inner, before, after)
                yield from out.add((tree, keys[i], levels[0][i], subroot, root, proof.hexdigest(), folded, folded == root))
        yield from out.rest()

    return blocks.mapInArrow(
        run,
        "tree string, key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def _roots(tiers: list[DataFrame]) -> DataFrame:
    return tiers[-1].select("tree", "root")


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """tree, key, leaf, subroot, root, proof_sha256, folded_root, verified for each leaf.

    ``leaves``: tree (string), key (long), leaf and changed (SHA-256 as binary; ``changed`` is
    what is to be verified in place of the leaf, NULL for the leaf itself). A builder gets
    blocks of ``ARITY ** levels`` leaves; the result does not depend on it.
    """
    nodes = leaves.select("tree", "key", F.col("leaf").alias("node"), "changed")
    tiers = _tiers(ranked(nodes, "tree", ["key", "node"], "merkle-leaves"), levels, "merkle")
    subroots = _roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.unhex("root").alias("node"))
    named = land(ranked(subroots, "tree", ["name"], "merkle-names"), "merkle-ranks")
    nothing = [F.lit(None).cast("long").alias("key"), F.lit(None).cast("binary").alias("changed")]
    upper = _tiers(named.select("tree", "rank", "total", "node", *nothing), levels, "merkle-top")

    none = F.array().cast("array<string>")
    paths = _roots(upper).select("tree", F.lit(0).cast("long").alias("block"), none.alias("before"), none.alias("after"))
    for blocks in reversed(upper):
        paths = _below(_with_paths(blocks, paths), levels)
    # what was the rank of a tree is its name again
    paths = paths.join(named.select("name", "rank"), F.col("block") == F.col("rank")).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "before", "after"
    )
    for blocks in reversed(tiers[1:]):
        paths = _below(_with_paths(blocks, paths), levels)
    top = _roots(upper).select(F.col("root").alias("top_root")).scalar()
    own = _roots(tiers).select(F.col("tree").alias("_name"), F.col("root").alias("subroot"))
    held = _with_paths(tiers[0].drop("root"), paths)
    held = held.join(own, held.tree.eqNullSafe(own._name)).withColumn("top_root", top)
    return _proofs(held.select("tree", "n", "top", "log", "keys", "changed", "before", "after", "subroot", "top_root"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """The leaves of ``documents`` by lang; every third doc_id by CRC-32 has its text lower-cased."""
    text = F.col("text")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fields = lambda t: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return docs.select(
        F.col("lang").cast("string").alias("tree"),
        F.col("doc_id").cast("long").alias("key"),
        F.unhex(leaf_digest(fields(text))).alias("leaf"),
        F.when(tampered, F.unhex(leaf_digest(fields(F.translate(text, upper, lower))))).alias("changed"),
    )
