"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k smallest distinct hashes of a text's shingles. The sketch of several parts is the k
smallest of theirs, so documents, sources or whole corpora are summarised part by part, in any grouping.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.llm.common import LOWER, WordHashes, arrow_step, gram_hashes, raw_texts, tuned, values

K = 128
SHINGLE = 5
# Buckets of ids between which neighbours are passed on; a bound on what the driver holds, not on rows.
BUCKETS = 2000


def sketch(text: bytes | None, cached: WordHashes, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    """The k smallest distinct shingle hashes, ascending. Fewer words than a shingle make one; none, none."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = gram_hashes(cached.of(words), min(shingle, len(words)))
    if len(hashes) > 4 * k:  # the rest is sorted only where repeats leave too few
        least = np.unique(np.partition(hashes, 2 * k)[: 2 * k])
        if len(least) >= k:
            return least[:k]
    return np.unique(hashes)[:k]


def merged(*sketches: np.ndarray, k: int = K) -> np.ndarray:
    return np.unique(np.concatenate(sketches))[:k] if sketches else np.empty(0, dtype=np.uint64)


def written(one: np.ndarray) -> str:
    """16 hexadecimal digits for each hash."""
    return one.astype(">u8").tobytes().hex()


def parsed(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64)


def distinct_shingles(one: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles: exact below k."""
    if len(one) < k:
        return float(len(one))
    return (k - 1) / (float(one[k - 1]) / 2.0**64)


def resemblance(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles in all shingles of both; 1 for two empty sketches."""
    both = merged(one, other, k=k)
    if not len(both):
        return 1.0
    shared = np.isin(both, one, assume_unique=True) & np.isin(both, other, assume_unique=True)
    return float(shared.sum()) / len(both)


def containment(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that the other has; 1 for an empty first sketch."""
    if not len(one):
        return 1.0
    both = merged(one, other, k=k)
    shared = resemblance(one, other, k) * distinct_shingles(both, k)
    return min(1.0, shared / distinct_shingles(one, k))


def sketches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint string, n_shingles double) of every row. No words, or null: an empty fingerprint.

    Equal texts have equal fingerprints, other columns are not read, repeated rows stay.
    """
    tuned(docs.sparkSession)

    def step(batches):
        cached = WordHashes()
        for batch in batches:
            found = [sketch(t, cached) for t in raw_texts(batch, "text")]
            yield {
                "id": values(batch, "id"), "fingerprint": [written(f) for f in found],
                "n_shingles": [distinct_shingles(f) for f in found],
            }

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return arrow_step(source, step, "id long, fingerprint string, n_shingles double").withColumnRenamed("id", id_column)


def merged_sketches(sketched: DataFrame, key: str, k: int = K) -> DataFrame:
    """(key, fingerprint, n_shingles): the sketch of all documents of each key, from `sketches` with a key column.

    Each hash is a row; parts drop what k smaller ones of their key exceed before anything is shuffled
    (`row_number() <= k` is a group limit below the exchange), so a hot key costs k rows a task.
    """
    width = F.floor(F.length("fingerprint") / 16).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), width - 1), lambda i: F.substring(F.col("fingerprint"), i * 16 + 1, F.lit(16))
    )
    rows = sketched.where(width > 0).select(key, F.explode(pieces).alias("piece")).distinct()
    ranked = rows.withColumn("place", F.row_number().over(W.partitionBy(key).orderBy("piece"))).where(F.col("place") <= k)
    joined = ranked.groupBy(key).agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    last = F.conv(F.element_at("pieces", k), 16, 10).cast("double") / F.lit(2.0**64)
    estimate = F.when(F.size("pieces") < k, F.size("pieces").cast("double")).otherwise((k - 1) / last)
    return joined.select(key, F.array_join("pieces", "").alias("fingerprint"), estimate.alias("n_shingles"))


def edited_pairs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row's fingerprint against its edited text's and the next row's, in ascending order of id.

    The edited text has the last half (rounded down) of the code points replaced by as many first ones, or all,
    of the next row's text; after the last comes the first. Returns (id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, contains_next).

    Null texts count as empty. Rows of one id follow each other by their texts, null ids come first; a single
    row is its own next. Other columns are not read. An empty table gives an empty result.
    """
    spark = tuned(docs.sparkSession)
    source = docs.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    points = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = sorted({float(c) for c in source.where("id IS NOT NULL").approxQuantile("id", points, 0.25 / BUCKETS)}) or [0.0]
    infinite = float("inf")
    place = Bucketizer(splits=[-infinite, *cuts, infinite], inputCol="key", outputCol="place")
    dealt = place.transform(source.withColumn("key", F.coalesce(F.col("id").cast("double"), F.lit(-infinite))))
    dealt = dealt.select("id", "text", F.col("place").cast("int").alias("bucket"))
    # The smallest row of each bucket, and the bucket before it: no more rows than buckets.
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("id")).alias("least"))
    ring = [(r["bucket"], r["least"]["id"]) for r in firsts.orderBy("bucket").collect()]
    if not ring:
        empty = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
                "near_edited double, near_next double, contains_next double"
        return spark.createDataFrame([], empty).withColumnRenamed("id", id_column)
    before = [(ring[i - 1][0], b, key) for i, (b, key) in enumerate(ring)]
    heads = spark.createDataFrame(before, "to_bucket int, bucket int, least long")
    same = (dealt["bucket"] == heads["bucket"]) & dealt["id"].eqNullSafe(heads["least"])
    ahead = dealt.join(F.broadcast(heads), same).select("to_bucket", dealt["id"], "text", F.lit(True).alias("ahead"))
    ahead = ahead.groupBy("to_bucket").agg(F.min(F.struct("id", "text")).alias("row")).select(
        "row.*", F.col("to_bucket").alias("bucket"), F.lit(True).alias("ahead")
    )
    every = dealt.select("id", "text", "bucket", F.lit(False).alias("ahead")).unionByName(ahead)
    ordered = every.repartition("bucket").sortWithinPartitions("bucket", "ahead", F.asc_nulls_first("id"), "text")

    def rows(batches):
        for batch in batches:
            yield from zip(
                values(batch, "bucket"), values(batch, "ahead"), values(batch, "id"), raw_texts(batch, "text")
            )

    def step(batches):
        cached = WordHashes()
        names = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                 "contains_next")
        out, held = {n: [] for n in names}, None
        for bucket, is_ahead, key, raw in rows(batches):
            text, mine = raw.decode(), sketch(raw, cached)
            if held is not None and held[0] == bucket:
                _, last_id, last_text, last = held
                half = len(last_text) // 2
                edited = (last_text[: len(last_text) - half] + text[:half]).encode()
                changed = sketch(edited, cached)
                facts = (
                    last_id, len(last_text), hashlib.sha256(edited).hexdigest(), written(last), written(changed),
                    resemblance(last, changed), resemblance(last, mine), containment(last, mine),
                )
                for name, value in zip(names, facts):
                    out[name].append(value)
                if len(out["id"]) >= 500:
                    yield out
                    out = {n: [] for n in names}
            held = (bucket, key, text, mine)
        yield out

    result = arrow_step(
        ordered, step, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, contains_next double",
    )
    return result.withColumnRenamed("id", id_column)
