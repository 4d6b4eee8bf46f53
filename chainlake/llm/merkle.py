"""Merkle dataset manifest by checkpoint and recompute.

Each row is a leaf; the leaves of a group, in order of their ids, form a tree of FAN children a node, and the groups' roots one more.
Only every EVERY-th level is written. The nodes between are made anew where they are needed: a proof takes an aligned
subtree's stored descendants, at most FAN^EVERY of them, hashes the levels between from them, hands each descendant its siblings and
forgets them. So no task holds more than one such subtree, whatever a group's share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import saved
from chainlake.llm.order import numbered
from chainlake.session import configured

FAN = 8
EVERY = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Siblings to the left and right of a node on its way up, one pair a level, nearest the leaf first.
PATH = "array<struct<left:string,right:string>>"


@dataclass(frozen=True)
class Manifest:
    """`leaves` (id, tree, pos, n, digest, shown) and the stored levels above, `levels[0]` being the leaves' own; the same for the
    tree over the groups' roots; `root` is null where there are no rows. `n` counts the nodes of a tree's level."""

    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def digest_of(columns: list[Column]) -> Column:
    """SHA-256, lowercase hex, of the values: a null is '-', any other its length in UTF-8 bytes, ':' and itself."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tree_key(group: Column) -> Column:
    """A key without nulls in the groups' order: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def tampered(id_column: str, text_column: str) -> tuple[Column, Column]:
    """(whether a row is tampered with, its text then): where 3 divides the CRC-32 of the decimal id, A-Z are lower-cased."""
    hit = F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return hit, F.translate(F.col(text_column), UPPER, LOWER)


# ======== building ========


def _joined(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, "").cast("binary"), 256)


def _runs(digests: Column, fan: int) -> Column:
    """Each run of `fan` neighbours hashed; the last may be shorter."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(digests) / fan).cast("int") - 1, F.lit(0))),
        lambda run: _joined(F.slice(digests, run * fan + 1, fan)),
    )


def _interior(block: DataFrame, fan: int, every: int) -> DataFrame:
    """Columns d1 to d<every> beside d0, the digests of a subtree's stored descendants: the levels between, made anew."""
    for level in range(1, every + 1):
        block = block.withColumn(f"d{level}", _runs(F.col(f"d{level - 1}"), fan))
    return block


def _open(n: Column, level: int, fan: int) -> Column:
    """Whether a level `level` above one of `n` nodes still has several nodes, so that they are hashed."""
    return n > fan**level


def _blocks(nodes: DataFrame, fan: int, every: int, payload: list[str]) -> DataFrame:
    """(tree, block, n, members, d0): the nodes of each aligned subtree in order."""
    member = F.struct("pos", "digest", *payload)
    grouped = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {fan**every}").alias("block")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(member)).alias("members")
    )
    return grouped.withColumn("d0", F.col("members.digest"))


def _lifted(nodes: DataFrame, fan: int, every: int) -> DataFrame:
    """(tree, pos, n, digest) of the next stored level, or of the root where it comes before."""
    block = _interior(_blocks(nodes, fan, every, []), fan, every)
    top = F.col("d1")
    for level in range(1, every):
        top = F.when(_open(F.col("n"), level, fan), F.col(f"d{level + 1}")).otherwise(top)
    left = F.ceil(F.col("n") / fan**every).cast("long")
    return block.select("tree", F.col("block").alias("pos"), left.alias("n"), F.element_at(top, 1).alias("digest"))


def stored_levels(nodes: DataFrame, fan: int = FAN, every: int = EVERY) -> list[DataFrame]:
    """The given nodes (tree, pos, n, digest, ...) and every `every`-th level above them, until each tree has one node."""
    levels = [nodes]
    while not levels[-1].where("n > 1").isEmpty():
        levels.append(saved(_lifted(levels[-1], fan, every), "level"))
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of each tree's last node."""
    ends = [level.where("n = 1").select("tree", "digest") for level in levels]
    every = ends[0]
    for end in ends[1:]:
        every = every.unionByName(end)
    return every


def _positioned(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with pos, a row's place in its tree, and n, the tree's rows."""
    placed = saved(numbered(rows, ["tree", *order], "place"), "placed")
    starts = saved(placed.groupBy("tree").agg(F.min("place").alias("start"), F.count("*").alias("n")), "trees")
    # Both sides are plain scans: a tree of very many rows is split by AQE.
    joined = placed.join(starts, "tree").withColumn("pos", F.col("place") - F.col("start"))
    return saved(joined.drop("place", "start"), "leaves")


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_column: str = "doc_id",
    group_column: str = "lang", shown: Column | None = None, fan: int = FAN, every: int = EVERY,
) -> Manifest:
    """The manifest of all rows: leaves over `columns`, a tree for each value of `group_column` (null is one), one over their roots.

    Leaves follow each other by id, null first, those of one id by their digests; equal rows are leaves of their own. `shown` is the digest
    that a row has now, if it may differ from the recorded one (null: the recorded one). No other column is read. An empty table gives no
    leaves and a null root; a group of one row has that leaf as its root.
    """
    configured(docs.sparkSession)
    digest = digest_of([F.col(c) for c in columns])
    leaf = docs.select(F.col(id_column).cast("long").alias("id"), tree_key(F.col(group_column)).alias("tree"), digest.alias("digest"), (F.lit(None).cast("string") if shown is None else shown).alias("shown"))
    # The texts are read once, here; what is sorted and grouped from now on are digests.
    leaf = saved(leaf.withColumn("shown", F.coalesce("shown", "digest")), "leaf")
    levels = stored_levels(_positioned(leaf, ["id", "digest"]), fan, every)
    trees = _roots(levels).select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    top = stored_levels(_positioned(trees, ["group"]), fan, every)
    root = _roots(top).first()
    return Manifest(levels, top, root["digest"] if root else None)


# ======== proofs ========


def _steps(i: Column, n: Column, fan: int, every: int) -> Column:
    """PATH from descendant `i` of a subtree to the subtree's root, through the levels made anew."""
    steps = []
    for level in range(every):
        digests, at = F.col(f"d{level}"), F.floor(i / fan**level).cast("int")
        first = F.floor(at / fan).cast("int") * fan
        left = F.array_join(F.slice(digests, first + 1, at - first), "")
        right = F.array_join(F.slice(digests, at + 2, fan - 1 - (at - first)), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right"))).cast(PATH)
        steps.append(step if level == 0 else F.when(_open(n, level, fan), step).otherwise(F.array().cast(PATH)))
    return F.concat(*steps)


def _paths(levels: list[DataFrame], above: DataFrame, payload: list[str], fan: int, every: int) -> DataFrame:
    """(tree, pos, digest, payload, subroot, path) of the nodes of levels[0]; `above` has (tree, subroot, path) of each tree's root."""
    found = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes, extra = levels[depth], payload if depth == 0 else []
        # A node is its tree's last: its path is the tree's own.
        ends = nodes.where("n = 1").join(above, "tree").select("tree", "pos", "digest", *extra, "subroot", "path")
        if found is None:
            found = ends
        else:
            parent = saved(found, "paths").select("tree", F.col("pos").alias("block"), "subroot", F.col("path").alias("up"))
            block = _interior(_blocks(nodes, fan, every, extra), fan, every - 1).join(parent, ["tree", "block"])
            path = lambda i: F.concat(_steps(i, F.col("n"), fan, every), F.col("up"))
            member = F.transform("members", lambda m, i: F.struct(m.alias("m"), path(i).alias("path")))
            below = block.select("tree", "subroot", F.explode(member).alias("one"))
            found = ends.unionByName(below.select(
                "tree", "one.m.pos", "one.m.digest", *(f"one.m.{c}" for c in extra), "subroot", F.col("one.path").alias("path")
            ))
    return found


def proofs(made: Manifest, fan: int = FAN, every: int = EVERY) -> DataFrame:
    """(id, leaf, shown, subroot, path) of every row: the siblings on the way from its leaf to the manifest's root."""
    nowhere = made.top[0].select("tree").distinct().withColumns({"subroot": F.lit(None).cast("string"), "path": F.array().cast(PATH)})
    of_trees = saved(_paths(made.top, nowhere, ["group"], fan, every), "tree-paths")
    above = of_trees.select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "path")
    found = _paths(made.levels, above, ["id", "shown"], fan, every)
    return found.select("id", F.col("digest").alias("leaf"), "shown", "subroot", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, leaf, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]).cast("binary"), 256))


def verified(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_column: str = "doc_id",
    group_column: str = "lang", shown: Column | None = None, fan: int = FAN, every: int = EVERY,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: `folded_root` is what the digest that the row has now and its
    recorded siblings give, `verified` whether that is the recorded root. Rows as in `manifest`; an empty table gives no rows."""
    made = manifest(docs, columns, id_column, group_column, shown, fan, every)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    found = proofs(made, fan, every).select(
        F.col("id").alias(id_column), "leaf", "subroot", F.lit(made.root).alias("root"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded(F.col("shown"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
