"""Near copies by five-word shingles: covering SimHash finds the closest, a prefix filter all others, their shingles decide.

The SimHash of a text's shingles and its covering masks give, in linear time, texts within a few bits of each other. At a
resemblance of 0.8 some ten bits of 64 differ, for which covering masks would be thousands of tables, so further candidates come
from a prefix filter, which misses none.

Put all shingles in one order, whichever. Of a text's n distinct shingles at least similarity * n are shared with any text that
resembles it, so the first one shared stands among its first n - ceil(similarity * n) + 1, and likewise in the other text. These
first shingles are the buckets; no pair that resembles is without a common one. The order is that of the shingles' hashes,
except that frequent shingles come last, so that lines which many texts carry are no bucket of theirs.

Members of a small bucket that are not joined yet are compared pair by pair. Those of a large one are first held against its most central
members, an original before its edits, which joins groups of copies in linear time. Whatever pairs of a large bucket are then not
joined are compared one by one: leaders only save work, they decide nothing.

Before their texts are fetched, pairs are held against a bound: each shingle flips one bit of its text's signature, so the bits in which two
signatures differ are no more than the shingles that only one of them has. The longer of two is folded to the length of the other.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import LOWER, WordHashes, arrow_step, drop, gram_hashes, mixed, raw_texts, saved, tuned, values
from chainlake.llm.components import components
from chainlake.llm.simhash import links, majority

SHINGLE = 5
SIMILARITY = 0.8
# Buckets up to this size are compared pair by pair at once; larger ones get so many leaders before.
SMALL = 32
LEADERS = 2
# Bits of a signature, the least and the most; between, there are two to four for each shingle. More tell texts apart, none loses a pair.
SIGNATURE = (1024, 1 << 17)
# A shingle is frequent from this share of all documents on, and from LEAST documents; any choice gives the same result.
FREQUENT = 0.001
LEAST = 20
# Shingles are counted in blocks of so many, or of one longer text.
BLOCK = 2_000_000
# Shingles of a bucket's leaders are kept for so many texts of a batch.
CACHED_TEXTS = 64


def shingles(hashed: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's runs of k words, sorted; of the whole text where it has fewer, none without words."""
    return np.unique(gram_hashes(hashed, min(k, max(1, len(hashed)))))


def frequent_shingles(source: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of frequent shingles of `source` (id, text), sorted: all that at least FREQUENT of all documents, and LEAST, have, and none that less
    than half as many have.

    All documents are counted, in blocks. A block sends the shingles that half of FREQUENT of its own documents have; what it does not send is
    over all blocks less than half of what is asked for. So at most the shingles of all texts by half of LEAST reach the driver.
    """
    rows = source.count()
    least = max(LEAST, FREQUENT * rows)
    part = least / 2 / max(1, rows)

    def step(batches):
        cached, block, held = WordHashes(), [], 0

        def often():
            found, n = np.unique(np.concatenate(block), return_counts=True)
            sent = n >= part * len(block)
            return {"shingle": found[sent].view(np.int64), "n": n[sent]}

        for batch in batches:
            for text in raw_texts(batch, "text"):
                if text:
                    block.append(shingles(cached.of(text.translate(LOWER).split()), shingle))
                    held += len(block[-1])
                    if held >= BLOCK:
                        yield often()
                        block, held = [], 0
        if block:
            yield often()

    counts = arrow_step(source.select("text"), step, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= least / 2).select("shingle").toArrow()
    return np.sort(found.column("shingle").to_numpy().view(np.uint64))


def common_order(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Places of the shingles in the order that all texts share: by their hashes mixed once more, frequent ones last."""
    keys = mixed(found) >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        keys[frequent[at] == found] |= np.uint64(1 << 63)
    return np.argsort(keys)


def signature(found: np.ndarray) -> bytes:
    """The parity of how many shingles fall on each bit."""
    least, most = SIGNATURE
    bits = min(most, max(least, 1 << (2 * len(found)).bit_length()))
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def apart(one: bytes, other: bytes) -> int:
    """In how many bits two signatures differ: at most as many as there are shingles of one text only."""
    a, b = np.frombuffer(one, dtype=np.uint64), np.frombuffer(other, dtype=np.uint64)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def width(size: int, similarity: float) -> int:
    """How many of a text's `size` shingles, in the common order, hold the first that it shares with a text that resembles."""
    return size - math.ceil(similarity * size - 1e-9) + 1 if size else 0


def marks(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """(id, words, size, fingerprint, signature, first) of every row: a digest of its words in order, how many distinct shingles it has, their
    SimHash and their signature, and the first of them in the common order, as many as the similarity asks for (none without words)."""
    spark = tuned(docs.sparkSession)
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(source, shingle))

    def step(batches):
        cached = WordHashes()
        for batch in batches:
            out = {"id": values(batch, "id"), "words": [], "size": [], "fingerprint": [], "signature": [], "first": []}
            for text in raw_texts(batch, "text"):
                words = text.translate(LOWER).split() if text else []
                found = shingles(cached.of(words), shingle) if words else np.empty(0, dtype=np.uint64)
                order = common_order(found, frequent.value)
                out["words"].append(hashlib.md5(b" ".join(words)).digest())
                out["size"].append(len(found))
                out["fingerprint"].append(majority(found.astype(">u8").view(np.uint8).reshape(-1, 8)) if words else None)
                out["signature"].append(signature(found))
                out["first"].append(found[order[: width(len(found), similarity)]].view(np.int64))
            yield out

    return arrow_step(source, step, "id long, words binary, size int, fingerprint long, signature binary, first array<long>")


def buckets(classes: DataFrame) -> DataFrame:
    """(token, node, size, rank, members, central): nodes of `classes` (node, size, first) by each of their first shingles that others
    have too; `central` is the greater the more of a node's first shingles are common to many."""
    tokens = classes.where("node IS NOT NULL AND size > 0").select("node", "size", F.posexplode("first").alias("rank", "token"))
    # Counted by the shingle alone, so that each task sends it once; only shingles of several nodes are written.
    shared = saved(tokens.groupBy("token").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    met = saved(tokens.join(shared, "token"), "met")
    drop(shared)
    central = met.groupBy("node").agg(F.sum(F.log2("members")).alias("sum"))
    widths = classes.groupBy("node").agg(F.max(F.size("first")).alias("width"))
    facts = saved(central.join(widths, "node").select("node", (F.col("sum") / F.col("width")).alias("central")), "central")
    found = saved(met.join(facts, "node"), "buckets")
    drop(met, facts)
    return found


def _may(similarity: float):
    """Whether sizes and the places of a shared shingle, the first one, leave room for the similarity."""
    alike = F.least("a.size", "b.size") >= F.lit(similarity - 1e-9) * F.greatest("a.size", "b.size")
    room = F.least(F.col("a.size") - F.col("a.rank"), F.col("b.size") - F.col("b.rank"))
    return alike & (room * (1 + similarity) >= (F.col("a.size") + F.col("b.size")) * similarity - 1e-6)


def all_pairs(met: DataFrame, similarity: float, apart=None) -> DataFrame:
    """(one, other): pairs of a common bucket that may resemble, each once."""
    asked = (F.col("a.token") == F.col("b.token")) & (F.col("a.node") > F.col("b.node")) & _may(similarity)
    if apart is not None:
        asked = asked & apart
    return met.alias("a").join(met.alias("b"), asked).select(F.col("a.node").alias("one"), F.col("b.node").alias("other")).distinct()


def led_pairs(open_: DataFrame, before: list[DataFrame], similarity: float) -> tuple[DataFrame, DataFrame]:
    """((one, other), (token, root)): members of each bucket with its most central one that is in no earlier leader's component."""
    free = open_
    for earlier in before:
        free = free.join(earlier, ["token", "root"], "left_anti")
    best = F.struct("central", (-F.col("node")).alias("least"), "node", "root", "size", "rank")
    leaders = saved(free.groupBy("token").agg(F.max(best).alias("best")).select("token", "best.node", "best.root", "best.size", "best.rank"), "leaders")
    asked = (F.col("a.token") == F.col("b.token")) & (F.col("a.root") != F.col("b.root")) & _may(similarity)
    met = open_.alias("a").join(leaders.alias("b"), asked)
    pairs = met.select(F.greatest("a.node", "b.node").alias("one"), F.least("a.node", "b.node").alias("other")).distinct()
    return pairs, leaders.select("token", "root")


def undecided(large: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of `large` with their `root` by `roots` (node, root), of buckets whose members are not all of one component."""
    known = roots.withColumnRenamed("node", "known")
    rooted = saved(large.join(known, F.col("node") == F.col("known"), "left").select(large["*"], F.coalesce("root", "node").alias("root")), "rooted")
    several = rooted.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("token")
    found = saved(rooted.join(several, "token", "left_semi"), "undecided")
    drop(rooted)
    return found


def bounded(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (one, other) that sizes and signatures leave a chance of the similarity."""
    share = (1 - similarity) / (1 + similarity)

    def step(batches):
        for batch in batches:
            rows = zip(*(values(batch, n) for n in ("one", "other", "one_size", "other_size", "one_bits", "other_bits")))
            left = [(one, other) for one, other, n, m, a, b in rows if apart(a, b) <= (n + m) * share + 1e-6]
            yield {"one": [p[0] for p in left], "other": [p[1] for p in left]}

    facts = classes.where("size > 0").select("node", "size", "signature")
    both = pairs.join(facts.toDF("one", "one_size", "one_bits"), "one").join(facts.toDF("other", "other_size", "other_bits"), "other")
    return arrow_step(both, step, "one long, other long")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (one, other) whose texts, of `texts` (node, text), share at least `similarity` of their distinct shingles."""

    def step(batches):
        cached, kept = WordHashes(), {}

        def of(node: int, text: bytes | None) -> np.ndarray:
            if node not in kept:
                if len(kept) >= CACHED_TEXTS:
                    kept.clear()
                kept[node] = shingles(cached.of(text.translate(LOWER).split() if text else []), shingle)
            return kept[node]

        for batch in batches:
            out = {"one": [], "other": []}
            rows = zip(values(batch, "one"), values(batch, "other"), raw_texts(batch, "one_text"), raw_texts(batch, "other_text"))
            for one, other, one_text, other_text in rows:
                a, b = of(one, one_text), of(other, other_text)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if shared >= similarity * (len(a) + len(b) - shared):
                    out["one"].append(one)
                    out["other"].append(other)
            yield out

    left = texts.select(F.col("node").alias("one"), F.col("text").alias("one_text"))
    right = texts.select(F.col("node").alias("other"), F.col("text").alias("other_text"))
    return arrow_step(pairs.join(left, "one").join(right, "other"), step, "one long, other long")


def similar_prints(classes: DataFrame) -> DataFrame:
    """(one, other): nodes that covering SimHash of their shingles puts together, one of each fingerprint against the others of its own and the
    smallest against those of fingerprints linked to it."""
    prints = classes.where("node IS NOT NULL AND fingerprint IS NOT NULL").select("fingerprint", "node")
    least = saved(prints.groupBy("fingerprint").agg(F.min("node").alias("least")), "prints")
    same = prints.join(least, "fingerprint").select(F.col("node").alias("one"), F.col("least").alias("other"))
    near = links(least.select("fingerprint")).toDF("one", "other")
    one, other = least.toDF("one", "one_node"), least.toDF("other", "other_node")
    linked = near.join(one, "one").join(other, "other").select(F.col("one_node").alias("one"), F.col("other_node").alias("other"))
    pairs = same.unionByName(linked).where("one <> other")
    return pairs.select(F.greatest("one", "other").alias("one"), F.least("one", "other").alias("other")).distinct()


def near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(id, component_id) of every row: the smallest id reachable over texts that resemble.

    Texts with the same words in order are copies, also those without words (null, empty, blank). Others resemble if they
    share at least `similarity` of their distinct shingles; no such pair is left out and every link is checked. Of a repeated id the smallest text
    is held against others. A null id is never the smallest, and a component of null ids only has a null
    component. Other columns are not read. An empty table gives an empty result.
    """
    marked = saved(marks(docs, id_column, text_column, shingle, similarity), "marks")
    firsts = [F.first(c).alias(c) for c in ("size", "fingerprint", "signature", "first")]
    classes = saved(marked.groupBy("words").agg(F.min("id").alias("node"), *firsts), "copies")
    texts = docs.select(F.col(id_column).cast("long").alias("node"), F.col(text_column).cast("string").alias("text"))

    def checked(pairs: DataFrame) -> DataFrame:
        likely = saved(bounded(pairs, classes, similarity), "candidates")
        wanted = likely.select(F.explode(F.array("one", "other")).alias("node")).distinct()
        theirs = saved(texts.join(wanted.hint("merge"), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")), "texts")
        found = saved(verified(likely, theirs, shingle, similarity), "links")
        drop(likely, theirs)
        return found

    met = buckets(classes)
    small, large = met.where(F.col("members") <= SMALL), met.where(F.col("members") > SMALL)
    found = checked(similar_prints(classes).unionByName(all_pairs(small, similarity)).distinct())
    led: list[DataFrame] = []
    while True:
        roots = components(found, "one", "other")
        left = undecided(large, roots)
        if left.isEmpty():
            break
        if len(led) < LEADERS:
            pairs, leaders = led_pairs(left, led, similarity)
            led.append(leaders)
        else:
            pairs, large = all_pairs(left, similarity, F.col("a.root") != F.col("b.root")), large.where("false")
        found = saved(found.unionByName(checked(pairs)), "links")
    rooted = classes.join(roots.withColumnRenamed("node", "known"), F.col("node") == F.col("known"), "left")
    of_words = saved(rooted.select("words", F.coalesce("root", "node").alias("component_id")), "classes")
    drop(classes, met)
    # Both sides are plain scans: a text of very many copies is split by AQE.
    return marked.join(of_words, "words").select(F.col("id").alias(id_column), "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` whose id is their component's smallest, with all their columns; one row for each such id.

    Of repeated rows of one id the one with the smallest text stays. Rows of a null id have no identity to be
    judged by and stay.
    """
    found = near_copies(docs, id_column, text_column).where(F.col(id_column).isNotNull())
    # What goes is the smaller table, so the texts need no shuffle where it is small enough to broadcast.
    gone = saved(found.where(F.col(id_column) != F.col("component_id")).select(id_column).distinct(), "copies")
    first = docs.join(gone, id_column, "left_anti").select(*docs.columns)
    repeated = saved(found.groupBy(id_column).count().where("count > 1").select(id_column), "repeated")
    if repeated.isEmpty():
        return first
    one = (
        first.join(repeated, id_column, "left_semi")
        .groupBy(id_column)
        .agg(F.min_by(F.struct(*docs.columns), F.struct(text_column)).alias("row"))
        .select("row.*")
    )
    return first.join(repeated, id_column, "left_anti").select(*docs.columns).unionByName(one)
