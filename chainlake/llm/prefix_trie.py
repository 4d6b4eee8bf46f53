"""Prefix trie of conversations by the Euler-tour technique.

Conversations that begin with the same turns share a node for each of these. A node is known by the XOR of its turns' digests, each taken with
its depth, so prefixes are compared without their texts and one conversation's prefixes are a running XOR. Every node has an
arc in and an arc out; the arc that follows each is known from the node's first child, next sibling and parent alone. Ranking that list of
arcs gives the tour, and what lies in a subtree is the difference of two prefix sums along it, however deep or wide the trie is.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.llm.common import arrow_step, saved, tuned, values
from chainlake.llm.list_rank import BLOCK, prefix_sums
from chainlake.llm.order import numbered

# So many turns of a conversation, numbers of a node's children or ids of its last members are put together at once.
CHUNK = 4096
GROUP = 100
MOST = 6


# ======== conversations ========


def ordered_turns(
    turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """(conv, i, digest, chars) of every turn: its place in its conversation, the MD5 of role and text, the text's code points.

    Turns follow each other by number, null first, those of one number by their digests. Null roles and texts are empty. Rows
    without a conversation's id belong to none and are left out. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.select(
        F.col(id_column).cast("long").alias("conv"), F.col(turn_column).cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars")
    ).where("conv IS NOT NULL")
    # Texts are read once; from here on there are digests only.
    placed = saved(numbered(saved(rows, "digests"), ["conv", F.asc_nulls_first("turn"), "digest"], "place"), "turns")
    starts = saved(placed.groupBy("conv").agg(F.min("place").alias("start")), "starts")
    # Both sides are plain scans: a conversation of very many turns is split by AQE.
    joined = placed.join(starts, "conv")
    return saved(joined.select("conv", (F.col("place") - F.col("start")).alias("i"), "digest", "chars"), "ordered")


def rebuilt(ordered: DataFrame, group: int = GROUP, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """((conv, size), (conv, j, chars, hi, lo)): every conversation, and its turns when rebuilt: the first h turns of the first conversation of
    its `group` (as many as it has), then its own after its first h, h being the CRC-32 of its decimal id modulo `most`. hi and lo are the halves
    of a digest of a turn and its place."""
    base = F.col("conv") - F.col("conv") % group
    borrowed = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    sizes = ordered.groupBy("conv").agg(F.count("*").alias("own")).select("conv", "own", borrowed.alias("h"), base.alias("base"))
    # At most `most` turns a conversation.
    first = ordered.where(F.col("i") < most).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("i", "digest", "chars"))).alias("first")
    )
    taken = F.coalesce(F.slice("first", 1, F.col("h")), F.array().cast("array<struct<i:long,digest:string,chars:long>>"))
    convs = saved(
        sizes.join(first, "base", "left").select("conv", "own", "h", taken.alias("taken")).withColumn("k", F.size("taken").cast("long")), "convs"
    )
    theirs = convs.select("conv", F.explode("taken").alias("t")).select("conv", F.col("t.i").alias("j"), "t.digest", "t.chars")
    own = ordered.join(convs.select("conv", "h", "k"), "conv").where("i >= h")
    turns = theirs.unionByName(own.select("conv", (F.col("i") - F.col("h") + F.col("k")).alias("j"), "digest", "chars"))
    size = (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long")
    mixed = F.md5(F.concat(F.col("j").cast("string"), F.lit(":"), F.col("digest")).cast("binary"))
    halves = turns.select("conv", "j", "chars", mixed.alias("m")).select(
        "conv", "j", "chars", _long(F.substring("m", 1, 16)).alias("hi"), _long(F.substring("m", 17, 16)).alias("lo")
    )
    return convs.select("conv", size.alias("size")), saved(halves, "rebuilt")


# ======== nodes ========


def _long(digits: Column) -> Column:
    return F.conv(digits, 16, -10).cast("long")


def running_xor(rows: DataFrame, key: str, index: str, names: list[str], chunk: int = CHUNK) -> DataFrame:
    """`rows` with `r_<name>`: the XOR of each column over the rows of its key up to its own; `index` counts each key's rows from 0.

    Windows are over chunks; what chunks add up to is taken together in the same way, chunk by chunk."""
    part = F.expr(f"{index} div {chunk}")
    upto = W.partitionBy(key, "_part").orderBy(index)
    local = rows.withColumn("_part", part).withColumns({f"r_{n}": F.bit_xor(n).over(upto) for n in names})
    if rows.where(F.col(index) >= chunk).isEmpty():
        return local.drop("_part")
    local = saved(local, "chunks")
    totals = saved(rows.groupBy(key, part.alias("_chunk")).agg(*(F.bit_xor(n).alias(n) for n in names)), "totals")
    above = running_xor(totals, key, "_chunk", names, chunk)
    above = saved(above.select(key, (F.col("_chunk") + 1).alias("_part"), *(F.col(f"r_{n}").alias(f"a_{n}") for n in names)), "above")
    both = local.join(above, [key, "_part"], "left")
    summed = {f"r_{n}": F.col(f"r_{n}").bitwiseXOR(F.coalesce(f"a_{n}", F.lit(0).cast("long"))) for n in names}
    return both.withColumns(summed).select(*rows.columns, *summed)


def visits(turns: DataFrame) -> DataFrame:
    """(conv, depth, hi, lo, up_hi, up_lo, chars): the node of each prefix of a rebuilt conversation and the node above it."""
    found = running_xor(turns, "conv", "j", ["hi", "lo"])
    return saved(
        found.select(
            "conv", (F.col("j") + 1).alias("depth"), F.col("r_hi").alias("hi"), F.col("r_lo").alias("lo"),
            F.col("r_hi").bitwiseXOR(F.col("hi")).alias("up_hi"), F.col("r_lo").bitwiseXOR(F.col("lo")).alias("up_lo"), "chars",
        ),
        "visits",
    )


def trie_nodes(convs: DataFrame, visited: DataFrame) -> DataFrame:
    """(r, conv, depth, hi, lo, n_convs, chars, up_r, up_conv, n_children, child, sibling) of every node, numbered by smallest member and
    depth, so that a conversation's nodes have neighbouring numbers; children are in the order of their numbers."""
    below = visited.groupBy("hi", "lo").agg(
        F.min("conv").alias("conv"), F.first("depth").alias("depth"), F.first("up_hi").alias("up_hi"), F.first("up_lo").alias("up_lo"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("hi"), zero.alias("lo"), "conv", zero.alias("depth"), none.alias("up_hi"), none.alias("up_lo"), "n_convs", zero.alias("chars")
    )
    # Smallest member and depth tell nodes apart.
    nodes = saved(numbered(saved(below.unionByName(root), "trie"), ["conv", "depth"], "r"), "nodes")
    parents = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("r").alias("up_r"), F.col("conv").alias("up_conv"))
    # Both sides are plain scans: a node of very many children is split by AQE.
    linked = saved(nodes.join(parents, ["up_hi", "up_lo"], "left"), "linked")
    children = linked.where("up_r IS NOT NULL").select("up_r", "r", F.expr(f"r div {CHUNK}").alias("part"))
    # A node's children go into windows by ranges of their numbers; a range's last child is followed by the first of the node's next range.
    inside = W.partitionBy("up_r", "part").orderBy("r")
    parts = children.groupBy("up_r", "part").agg(F.min("r").alias("least"))
    after = parts.select("up_r", "part", F.lead("least").over(W.partitionBy("up_r").orderBy("part")).alias("after"))
    near = children.select("up_r", "part", "r", F.lead("r").over(inside).alias("near"))
    siblings = near.join(after, ["up_r", "part"]).select("r", F.coalesce("near", "after").alias("sibling"))
    firsts = children.groupBy(F.col("up_r").alias("r")).agg(F.min("r").alias("child"), F.count("*").alias("n_children"))
    joined = linked.join(firsts, "r", "left").join(siblings, "r", "left")
    return saved(joined.select(
        "r", "conv", "depth", "hi", "lo", "n_convs", "chars", "up_r", "up_conv", F.coalesce("n_children", zero).alias("n_children"), "child", "sibling"
    ), "trie-nodes")


# ======== tour ========


def tour_arcs(nodes: DataFrame) -> DataFrame:
    """(id, next, arc, leaf, saved): the arc into node r is 2r, the one out of it 2r + 1. The arc in carries whether the node is a leaf and what
    its own text saves."""
    into = F.coalesce(2 * F.col("child"), 2 * F.col("r") + 1)
    out_of = F.coalesce(2 * F.col("sibling"), 2 * F.col("up_r") + 1)
    nothing, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    arcs = F.array(
        F.struct((2 * F.col("r")).alias("id"), into.alias("next"), one.alias("arc"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")),
        F.struct((2 * F.col("r") + 1).alias("id"), out_of.alias("next"), one.alias("arc"), nothing.alias("leaf"), nothing.alias("saved")),
    )
    return nodes.select(F.inline(arcs))


def subtree_sums(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(r, enter, leave, n_leaves, saved): both arcs' places on the tour, and what the prefix sums there say of the subtree."""
    ranked = prefix_sums(tour_arcs(nodes), ["arc", "leaf", "saved"], block)
    into = F.col("id") % 2 == 0
    of = lambda c, arc: F.max(F.when(arc, F.col(c)))
    return ranked.groupBy(F.expr("id div 2").alias("r")).agg(
        of("b_arc", into).alias("enter"), of("b_arc", ~into).alias("leave"),
        (of("b_leaf", ~into) - of("b_leaf", into)).alias("n_leaves"), (of("b_saved", ~into) - of("b_saved", into)).alias("saved"),
    )


def end_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(hi, lo, ends_sha256): the SHA-256 of the conversations (conv, hi, lo) that end at each node, ascending and comma-joined.

    Ids are sorted and joined in parallel, by ranges of `chunk` ids. A digest is a sequence by nature: its chunks pass one after the other
    through the hash, held one batch at a time."""
    ranges = F.expr(f"conv div {chunk}")
    parts = ends.groupBy("hi", "lo", ranges.alias("chunk")).agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def step(batches):
        now, digest = None, None
        for batch in batches:
            out = {"hi": [], "lo": [], "ends_sha256": []}
            for hi, lo, ids in zip(values(batch, "hi"), values(batch, "lo"), values(batch, "ids")):
                if (hi, lo) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now:
                    for name, value in zip(out, (*now, digest.hexdigest())):
                        out[name].append(value)
                now, digest = (hi, lo), hashlib.sha256(ids.encode())
            yield out
        if now:
            yield {"hi": [now[0]], "lo": [now[1]], "ends_sha256": [digest.hexdigest()]}

    sorted_parts = parts.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "chunk")
    return arrow_step(sorted_parts, step, "hi long, lo long, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text",
    group: int = GROUP, most: int = MOST, block: int = BLOCK,
) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations: (conv_id, smallest member; depth; parent_conv_id; n_convs; n_children; n_leaves;
    saved_tokens; ends_sha256; enter and leave, its arcs' places on the tour).

    Node u lies below v where v.enter <= u.enter < v.leave. Nulls, repeated turns and rows without an id as in `ordered_turns`; conversations
    without turns after rebuilding are members of the root. An empty table has no nodes, not even a root.
    """
    tuned(turns.sparkSession)
    convs, remade = rebuilt(ordered_turns(turns, id_column, turn_column, role_column, text_column), group, most)
    visited = visits(remade)
    nodes = trie_nodes(convs, visited)
    sums = subtree_sums(nodes, block)
    zero = F.lit(0).cast("long")
    last = visited.join(convs, "conv").where("depth = size").select("conv", "hi", "lo")
    ends = last.unionByName(convs.where("size = 0").select("conv", zero.alias("hi"), zero.alias("lo")))
    found = nodes.join(sums, "r").join(end_digests(ends), ["hi", "lo"], "left")
    return found.select(
        F.col("conv").alias(id_column), "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "enter", "leave",
    )
