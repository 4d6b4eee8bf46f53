"""Benchmark decontamination by winnowing.

Of the hashes of all runs of `GRAM` words, each stretch of `WINDOW - GRAM + 1` neighbours keeps its smallest.
Two texts that share a span of `WINDOW` words therefore keep a common hash within it. Documents emit, for every
kept hash that the benchmark keeps too, the windows around it; these are joined with the benchmark's by their
words, so a hit is exact, and overlapping hits extend to spans.

Whether a hash is the benchmark's is first asked of a bit filter of fixed size. It lets through whatever the
benchmark keeps, so it only saves shuffling, whatever the benchmark's size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chainlake.llm.common import WordHashes, arrow_step, gram_hashes, mixed, raw_texts, saved, tuned, values

WINDOW = 10
GRAM = 5
# The filter has 2^FILTER_BITS bits (4 MB), each hash sets FILTER_HASHES of them.
FILTER_BITS = 25
FILTER_HASHES = 2

# Lower-cases A-Z; what is neither an ASCII letter or digit nor outside ASCII becomes a space.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def kept_places(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest hash of every `span` neighbours, the rightmost of equals; none below `span`."""
    if len(hashes) < span:
        return np.empty(0, dtype=np.int64)
    tiles = np.lib.stride_tricks.sliding_window_view(hashes[::-1], span)
    last = len(hashes) - 1 - (np.arange(len(tiles)) + tiles.argmin(axis=1))
    return np.unique(last)


def _bits(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """Bit numbers of hashes; grams of different size do not share a bit but by chance."""
    x = mixed(hashes ^ np.uint64(size))
    return [(x >> np.uint64(7 + 27 * i)) & np.uint64((1 << FILTER_BITS) - 1) for i in range(FILTER_HASHES)]


def benchmark_windows(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item, size, words string, bit long): the distinct windows of every item, and the filter bits they set.

    An item of fewer words than a window, but not none, is one window. Rows with `words` null carry bits only.
    """

    def step(batches):
        cached = WordHashes()
        for batch in batches:
            out = {"item": [], "size": [], "words": [], "bit": []}

            def add(item, size, words, bit):
                for name, value in zip(out, (item, size, words, bit)):
                    out[name].append(value)

            for item, text in zip(values(batch, "item"), raw_texts(batch, "text")):
                words = words_of(text)
                if not words:
                    continue
                size = min(WINDOW, len(words))
                for window in {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}:
                    add(item, size, window.decode(), None)
                hashed = cached.of(words)
                if size == WINDOW:
                    grams = gram_hashes(hashed, GRAM)
                    marks, kind = grams[kept_places(grams, WINDOW - GRAM + 1)], GRAM
                else:
                    marks, kind = gram_hashes(hashed, size), -size
                for bits in _bits(marks, kind % 64):
                    for bit in bits.tolist():
                        add(item, size, None, bit)
            yield out

    source = benchmark.select(
        F.col(item_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text")
    )
    return arrow_step(source, step, "item string, size int, words string, bit long")


def _filter(windows: DataFrame) -> np.ndarray:
    """The filter as bytes. At most 2^FILTER_BITS / 64 numbers reach the driver, however large the benchmark."""
    cells = (
        windows.where("bit IS NOT NULL")
        .groupBy((F.col("bit") / 64).cast("int").alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    table[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return table.view(np.uint64)


def _found(table: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    ok = np.ones(len(hashes), dtype=bool)
    for bits in _bits(hashes, size % 64):
        ok &= (table[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) == 1
    return ok


def candidates(
    docs: DataFrame, windows: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, row binary, n_words, start, size, words): one row with `words` null for each document, and one for each
    of its windows that may be the benchmark's. `row` tells rows of one id apart by their text."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(_filter(windows))
    # Lengths of short items: fewer than WINDOW numbers.
    short = [r[0] for r in windows.where(F.col("size") < WINDOW).select("size").distinct().collect()]

    def step(batches):
        import hashlib

        cached, marks = WordHashes(), table.value
        for batch in batches:
            out = {"id": [], "row": [], "n_words": [], "start": [], "size": [], "words": []}

            def add(key, n, row, start, size, text):
                for name, value in zip(out, (key, row, n, start, size, text)):
                    out[name].append(value)

            for key, text in zip(values(batch, "id"), raw_texts(batch, "text")):
                words = words_of(text)
                row = hashlib.md5(text or b"").digest()
                add(key, len(words), row, None, None, None)
                hashed = cached.of(words)
                starts = {size: [] for size in short}
                for size in short:
                    starts[size] = np.flatnonzero(_found(marks, gram_hashes(hashed, size), -size)).tolist()
                grams = gram_hashes(hashed, GRAM)
                places = kept_places(grams, WINDOW - GRAM + 1)
                places = places[_found(marks, grams[places], GRAM)]
                around = places[:, None] + np.arange(GRAM - WINDOW, 1)
                inside = around[(around >= 0) & (around <= len(words) - WINDOW)]
                starts[WINDOW] = np.unique(inside).tolist()
                for size, found in starts.items():
                    for start in found:
                        add(key, len(words), row, start, size, b" ".join(words[start : start + size]).decode())
            yield out

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return arrow_step(source, step, "id long, row binary, n_words long, start int, size int, words string")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: (id, n_words, n_hit, items array of text, contaminated), one row for each row of `docs`.
    spans: (id, start, end, n_words), the runs of hit words, end exclusive, counted in words.

    A null or empty text has no words and no hits, in documents and items alike; equal rows get equal results,
    rows of one id with different texts are judged apart. Null item ids are not listed. Item ids are taken as
    text. Other columns are not read. An empty benchmark leaves every document clean.
    """
    tuned(docs.sparkSession)
    windows = saved(benchmark_windows(benchmark, item_column, item_text), "windows")
    asked = saved(candidates(docs, windows, id_column, text_column), "candidates")
    items = windows.where("words IS NOT NULL").select("words", "item")
    known = items.select("words").distinct()
    place = asked.where("words IS NOT NULL")
    rows = ["id", "row"]
    # Repeated rows yield the same hits: once is enough, and their count brings them back.
    hits = place.join(known, "words", "left_semi").select(*rows, "start", F.col("start") + F.col("size"), "words")
    hits = saved(hits.toDF(*rows, "start", "end", "words").distinct(), "hits")

    along = W.partitionBy(*rows).orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(W.unboundedPreceding, -1))
    step = hits.select(*rows, "start", "end", reach.alias("reach"))
    fresh = F.col("reach").isNull() | (F.col("start") > F.col("reach"))
    runs = step.select(*rows, "start", "end", F.sum(fresh.cast("int")).over(along).alias("run"))
    spans = runs.groupBy(*rows, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    hit_words = spans.groupBy(*rows).agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"))

    in_items = hits.select(*rows, "words").distinct().join(items, "words").select(*rows, "item").distinct()
    listed = in_items.groupBy(*rows).agg(F.sort_array(F.collect_set("item")).alias("items"))
    facts = saved(hit_words.join(listed, rows, "left"), "facts")
    every = asked.where("words IS NULL").select(*rows, "n_words")
    same = (every["id"].eqNullSafe(facts["id"])) & (every["row"] == facts["row"])
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    documents = every.join(facts, same, "left").select(
        every["id"].alias(id_column), "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"),
    )
    counted = spans.select(
        F.col("id").alias(id_column), "start", "end", (F.col("end") - F.col("start")).alias("n_words")
    )
    return documents, counted


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no window of the benchmark. Null ids stay."""
    documents, _ = contamination(docs, benchmark, id_column, text_column)
    bad = saved(documents.where("contaminated").select(id_column).distinct(), "contaminated")
    return docs.join(bad, id_column, "left_anti").select(*docs.columns)
