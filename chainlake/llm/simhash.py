"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 positions gets a non-zero label of radius + 1 bits. A mask for each non-zero vector of as many
bits keeps the positions whose label has an odd product with it. Two fingerprints that differ in at most
`radius` positions agree under some mask: fewer labels than dimensions leave a vector that is even with all of
them. That makes 7 tables for 2 bits, and a pair within the radius can never be missed.

What shares a bucket is not compared pair by pair. Fingerprints at most 2r bits apart share a point within r
bits of both, and sharing one proves it. So each fingerprint that met another in a bucket lists the points
around it, and a point's visitors, of which there can be no more than points, link to their smallest.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import LOWER, arrow_step, raw_texts, saved, tuned, values
from chainlake.llm.components import components

SEED = 42
BITS = 64
# From so many shingles on, counting byte values is faster than unpacking bits.
MANY = 300
_BITS_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text as a signed long; 0 where it has no words."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = (ends - size + 1)[: max(1, len(words) - shingle + 1)].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in zip(starts, stops)]), dtype=np.uint8)
    return majority(raw.reshape(-1, 8))


def majority(grid: np.ndarray) -> int:
    """The bits set in over half of the hashes, rows of eight bytes, highest first, as a signed long."""
    if len(grid) < MANY:
        counts = np.unpackbits(grid, axis=1).sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(grid[:, j], minlength=256) @ _BITS_OF for j in range(8)])
    return int(np.packbits(2 * counts > len(grid)).view(">i8")[0])


def covering_masks(radius: int) -> list[int]:
    """One mask of kept positions for each non-zero vector of radius + 1 bits, as signed longs."""
    vectors = range(1, 1 << (radius + 1))
    labels = [position % len(vectors) + 1 for position in range(BITS)]
    masks = [sum(1 << p for p, label in enumerate(labels) if (label & v).bit_count() % 2) for v in vectors]
    return [_signed(m) for m in masks]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _flips(radius: int) -> list[int]:
    """Differences of up to `radius` bits, none included."""
    return [_signed(sum(1 << p for p in c)) for n in range(radius + 1) for c in combinations(range(BITS), n)]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fingerprint long) of every row."""
    tuned(docs.sparkSession)

    def step(batches):
        for batch in batches:
            yield {"id": values(batch, "id"), "fingerprint": [fingerprint(t, shingle) for t in raw_texts(batch, "text")]}

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return arrow_step(source, step, "id long, fingerprint long")


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(one, other): links that join fingerprints of column `fingerprint` at most `radius` bits apart.

    Each link is within the radius, and whatever is within it is joined by a path of links. `radius` is even.
    """
    if radius % 2:
        raise ValueError("radius must be even")
    masks = F.array(*(F.lit(m).cast("long") for m in covering_masks(radius)))
    keyed = distinct.select(
        "fingerprint", F.posexplode(F.transform(masks, lambda m: F.col("fingerprint").bitwiseAND(m))).alias("table", "key")
    )
    shared = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1").select("table", "key")
    met = keyed.join(shared, ["table", "key"], "left_semi").select("fingerprint").distinct()
    flips = F.array(*(F.lit(f).cast("long") for f in _flips(radius // 2)))
    around = met.select(
        "fingerprint", F.explode(F.transform(flips, lambda f: F.col("fingerprint").bitwiseXOR(f))).alias("point")
    )
    # A point has no more visitors than there are points around it: 65 for a radius of 2.
    visitors = around.groupBy("point").agg(F.collect_list("fingerprint").alias("all")).where(F.size("all") > 1)
    return visitors.select(F.explode("all").alias("one"), F.array_min("all").alias("other")).where("one <> other").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """(id, fingerprint long, component_id) of every row.

    component_id is the smallest id reachable over links of at most `radius` differing bits. Null and empty
    texts have fingerprint 0 and link like any other. Equal rows stay as they are and get the same
    component; a null id is never the smallest, and a component of null ids only has a null component.
    Other columns are not read. An empty table gives an empty result.
    """
    marked = saved(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    groups = saved(marked.groupBy("fingerprint").agg(F.min("id").alias("least")), "groups")
    roots = components(links(groups.select("fingerprint"), radius), "one", "other")
    rooted = groups.join(roots, groups["fingerprint"] == roots["node"], "left").select(
        groups["fingerprint"], "least", F.coalesce("root", groups["fingerprint"]).alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = saved(rooted.join(smallest, "root").select("fingerprint", "component_id"), "classes")
    # Both sides are plain scans: a fingerprint of very many documents is split by AQE.
    return marked.join(of_print, "fingerprint").select(F.col("id").alias(id_column), "fingerprint", "component_id")
