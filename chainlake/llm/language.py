"""Language identification by nearest centroid.

A text is the TF-IDF vector of its hashed runs of 1 to 3 letters; words are set apart by one space. Each language has
several centroids, found by spherical k-means among a bounded sample of its labelled texts. The language of the
centroid with the largest cosine wins; a text farther from it than nearly all of its sample is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.llm.common import arrow_step, saved, tuned, values

DIMENSIONS = 4096
SIZES = (1, 2, 3)
# The classifier is fitted to so many labelled texts of each language at most; document frequencies cover all.
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 12
# A text is rejected where its distance exceeds this quantile of the sample's by a quarter.
REJECT_QUANTILE = 0.99
SLACK = 1.25
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as their code points, each run of anything else as one 0, a 0 at both ends."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    points = np.concatenate([[0], np.where(_letters[points], points, 0), [0]]).astype(np.uint32)
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    return points[keep]


def counted(text: str | None) -> np.ndarray | None:
    """How often each hashed run occurs; None for a text without letters."""
    codes = _codes(text) if text else np.zeros(1, dtype=np.uint32)
    if not codes.any():
        return None
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    run = np.zeros(len(codes), dtype=np.uint32)
    for size in range(1, max(SIZES) + 1):
        run = run[: len(codes) - size + 1] * np.uint32(0x01000193) + codes[size - 1 :]
        if size in SIZES:
            mixed = (run ^ (run >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * size)
            total += np.bincount((mixed >> np.uint32(20)).astype(np.int64), minlength=DIMENSIONS)
    return total


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = np.where(counts > 0, 1.0 + np.log(np.maximum(counts, 1)), 0.0) * idf
    size = np.sqrt(weight @ weight)
    return (weight / size if size else weight).astype(np.float32)


def clustered(rows: np.ndarray, k: int = CENTROIDS) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, each one's distance limit) of unit vectors: spherical k-means from spread-out starts."""
    near = rows @ rows[0]
    chosen = [0]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centers = rows[chosen]
    for _ in range(ROUNDS):
        own = (rows @ centers.T).argmax(axis=1)
        sums = np.stack([rows[own == j].sum(axis=0) if (own == j).any() else centers[j] for j in range(len(centers))])
        sizes = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = (sums / np.where(sizes > 0, sizes, 1)).astype(np.float32)
    cosines = rows @ centers.T
    own = cosines.argmax(axis=1)
    every = np.quantile(1 - cosines.max(axis=1), REJECT_QUANTILE)
    limits = [np.quantile(1 - cosines[own == j, j], REJECT_QUANTILE) if (own == j).any() else every for j in range(len(centers))]
    return centers, SLACK * np.maximum(limits, every)


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> dict:
    """A model from rows with text and language: idf, centroids, their languages and distance limits.

    Document frequencies are of all rows. Centroids come from the `SAMPLE` texts of each language whose ids hash lowest.
    The driver gets DIMENSIONS numbers, and CENTROIDS vectors a language. Rows of one id count once in the sample.
    """
    spark = tuned(docs.sparkSession)
    source = docs.where(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
    )

    def frequencies(batches):
        seen, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for batch in batches:
            for text in values(batch, "text"):
                counts = counted(text)
                if counts is not None:
                    seen += counts > 0
                    n += 1
        yield {"slot": [*np.flatnonzero(seen).tolist(), -1], "n": [*seen[seen > 0].tolist(), n]}

    parts = arrow_step(source.select("text"), frequencies, "slot int, n long")
    found = {r["slot"]: r["n"] for r in parts.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    n = found.pop(-1, 0) or 0
    df = np.zeros(DIMENSIONS)
    df[list(found)] = list(found.values())
    idf = np.log((1 + n) / (1 + df)) + 1.0

    first = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sample = source.select("lang", "id").withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE)
    picked = saved(sample.select("lang", "id").distinct(), "sample")
    texts = source.join(picked, ["lang", "id"], "left_semi").select("lang", "text")
    shared = spark.sparkContext.broadcast(idf)

    def fit(key, table):
        rows = [vector(c, shared.value) for c in map(counted, table.column("text").to_pylist()) if c is not None]
        if not rows:
            return empty
        # The order of rows must not decide the starts.
        rows = np.stack(sorted(rows, key=lambda v: v.tobytes()))
        centers, limits = clustered(rows)
        return pa.table(
            {"lang": [key[0].as_py()] * len(centers), "center": [c.tobytes() for c in centers], "reach": limits.tolist()},
            schema=empty.schema,
        )

    empty = pa.table({"lang": pa.array([], pa.string()), "center": pa.array([], pa.binary()), "reach": pa.array([], pa.float64())})
    fitted = sorted(
        texts.groupBy("lang").applyInArrow(fit, "lang string, center binary, reach double").collect(),
        key=lambda r: (r["lang"], bytes(r["center"])),
    )
    return {
        "idf": idf,
        "langs": [r["lang"] for r in fitted],
        "centers": np.array([np.frombuffer(r["center"], dtype=np.float32) for r in fitted]).reshape(-1, DIMENSIONS),
        "limits": np.array([r["reach"] for r in fitted]),
    }


def predict(docs: DataFrame, model: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) of every row.

    score is the cosine with the nearest centroid. Null texts, texts without letters, and all texts where nothing was
    learned are `und` with score 0. Ties go to the first language in order. `rejected` marks texts too far from their
    centroid; `lang_pred` names it all the same. Other columns are not read, repeated rows stay.
    """
    spark = tuned(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def step(batches):
        known = shared.value
        for batch in batches:
            out = {"id": values(batch, "id"), "lang_pred": [], "score": [], "rejected": []}
            for text in values(batch, "text"):
                counts = counted(text) if known["langs"] else None
                if counts is None:
                    lang, score, far = UNKNOWN, 0.0, True
                else:
                    cosines = known["centers"] @ vector(counts, known["idf"])
                    best = int(cosines.argmax())
                    score = min(1.0, max(0.0, float(cosines[best])))
                    lang, far = known["langs"][best], bool(1 - score > known["limits"][best])
                for name, value in (("lang_pred", lang), ("score", score), ("rejected", far)):
                    out[name].append(value)
            yield out

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    found = arrow_step(source, step, "id long, lang_pred string, score double, rejected boolean")
    return found.withColumnRenamed("id", id_column)


def held_out(id_column: str = "doc_id"):
    """Whether a row is kept from training: crc32 of its id as text is 2 modulo 4. Null ids are."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(True))
