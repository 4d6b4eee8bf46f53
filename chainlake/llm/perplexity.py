"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model reads whole characters, every code point as itself, in runs of `ORDER`. Counts, contexts, continuation counts and the lower
orders are tables keyed by the runs' text, sharded by Spark; they grow with the corpus and are never collected. Documents are dealt into
chunks. The distinct runs of a chunk are joined with the tables, and the task that scores the chunk reads back what they cost: so a run that
many documents of a chunk have is shuffled once, and the texts not at all.

At a text's start a run is shorter, as there is nothing before it: a run of less than n characters of order n is one of a start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import arrow_step, drop, saved, tuned, values
from chainlake.session import work_folder
from chainlake.sources.store import open_store

ORDER = 4
# Every code point, and the start of a text (0).
K = 0x110001
# A document is rejected above this quantile of its language's trusted documents, plus MARGIN in nats a character.
QUANTILE = 0.99
MARGIN = 0.12
# Documents count as if they had this many more characters of their language's mean, so that short ones vary less.
PRIOR_CHARS = 60
# What a limit lies above its quantile grows as trusted documents get fewer, towards keeping all: MARGIN * (1 + FEW / documents).
FEW = 30
# Quantiles are of a mergeable summary of this accuracy.
ACCURACY = 10_000
# A chunk has at most 2^CHUNK_BITS documents. A task reads PIECE bytes of text at once, or one longer text, and sends what it counted when it
# holds more than MANY runs; results depend on none of these.
CHUNK_BITS = 13
PIECE = 500_000
MANY = 1_000_000


def runs(text: str, order: int = ORDER) -> np.ndarray:
    """The number, in base K, of each run of `order` characters that ends at a character; a text starts with zeros."""
    codes = [0] * (order - 1) + [ord(c) + 1 for c in text]
    numbers = [sum(c * K ** (order - 1 - i) for i, c in enumerate(codes[at : at + order])) for at in range(len(text))]
    return np.array(numbers, dtype=object)


def distinct_runs(texts: list[str], order: int = ORDER) -> tuple[list[str], np.ndarray]:
    """(runs, at): the distinct runs that end at characters of the texts, and for each character of all texts the place of its run."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
    if not len(points):
        return [], np.empty(0, dtype=np.int64)
    lengths = np.array([len(t) for t in texts])
    since = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    # Characters are numbered among those that occur, so that a run of few kinds of them fits a number; longer ones are numbered anew between.
    present = np.zeros(K, dtype=bool)
    present[points] = True
    codes = np.cumsum(present)[points]
    base = int(present.sum()) + 1
    number, bound = codes.copy(), base
    for i in range(1, order):
        if bound * base >= 1 << 63:
            number = np.unique(number, return_inverse=True)[1]
            bound = int(number.max()) + 1
        before = np.zeros_like(codes)
        before[i:] = codes[:-i]
        before[since < i] = 0
        number += before * bound
        bound *= base
    _, first, at = np.unique(number, return_index=True, return_inverse=True)
    starts = first - np.minimum(since[first], order - 1)
    return [joined[a : b + 1] for a, b in zip(starts.tolist(), first.tolist())], at


def saved_by_chunk(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once with a folder for each chunk, which holds no more than its documents or their runs."""
    path = work_folder(df.sparkSession, purpose)
    df.repartition("chunk").write.partitionBy("chunk").parquet(path)
    # Only the path is used: tasks read their chunk's folder.
    df.saved_at = path
    return df


def of_chunk(folder: str, chunk: int, *columns: str) -> list[list]:
    """Columns of one chunk of a table of `saved_by_chunk`; empty where it has no rows."""
    store, inner = open_store(f"{folder}/chunk={chunk}")
    if store.get_file_info(inner).type == fs.FileType.NotFound:
        return [[] for _ in columns]
    table = ds.dataset(inner, filesystem=store, format="parquet").to_table(columns=list(columns))
    return [table.column(c).to_pylist() for c in columns]


def _chunks(batch: pa.RecordBatch):
    """(chunk, rows) of stretches of a batch, each of one chunk and of about PIECE bytes of text."""
    chunk = batch.column(batch.schema.get_field_index("chunk")).to_numpy()
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes, dtype=np.int64) // PIECE
    cuts = [0, *(np.flatnonzero((np.diff(chunk) != 0) | (np.diff(piece) != 0)) + 1).tolist(), len(chunk)]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield int(chunk[start]), batch.slice(start, stop - start)


def chunk_runs(texts: DataFrame, trusted: str | None = None, order: int = ORDER) -> DataFrame:
    """(chunk, run, n): the distinct runs of each chunk of `texts` (id, text, chunk), and how often each occurs in trusted texts, 0 included.

    `trusted` is the folder of the trusted ids by chunk; None trusts all. A chunk that several tasks read has a run more than once.
    """

    def step(batches):
        chunk, known, counted = None, set(), {}

        def found():
            return {"chunk": [chunk] * len(counted), "run": list(counted), "n": list(counted.values())}

        for batch in batches:
            for now, rows in _chunks(batch):
                if now != chunk or len(counted) > MANY:
                    if counted:
                        yield found()
                    counted = {}
                if now != chunk:
                    chunk, known = now, set(of_chunk(trusted, now, "id")[0]) if trusted else set()
                read = [(i, t) for i, t in zip(values(rows, "id"), values(rows, "text")) if t]
                seen, at = distinct_runs([t for _, t in read], order)
                own = np.repeat([trusted is None or i in known for i, _ in read], [len(t) for _, t in read]).astype(bool)
                for run, n in zip(seen, np.bincount(at[own], minlength=len(seen)).tolist()):
                    counted[run] = counted.get(run, 0) + n
        if counted:
            yield found()

    return arrow_step(texts.select("id", "text", "chunk"), step, "chunk long, run string, n long")


def count_runs(texts: DataFrame, text_column: str = "text") -> DataFrame:
    """(run, n): how often each run occurs in all texts. Each task sends what it has counted, not what it has read."""
    source = texts.select(F.lit(None).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"), F.lit(0).cast("long").alias("chunk"))
    return chunk_runs(source).groupBy("run").agg(F.sum("n").alias("n"))


def model_tables(counts: DataFrame, order: int = ORDER) -> dict[int, DataFrame]:
    """For each order: (run, context, suffix, p, weight). p is the interpolated probability of the run's last character after
    its context; weight is what the context leaves to the next lower order.

    The highest order takes counts, the lower ones in how many ways a run continues to the left. Discounts come from
    the counts of counts, for once, twice and oftener; where these are too few, half a count. Runs counted 0 times are asked for only:
    they change no other run's probability.
    """
    level = {order: counts}
    for n in range(order - 1, 0, -1):
        shorter = level[n + 1].select(F.right("run", F.lit(n)).alias("run"), (F.col("n") > 0).cast("long").alias("n"))
        level[n] = shorter.groupBy("run").agg(F.sum("n").alias("n"))
    tables: dict[int, DataFrame] = {}
    for n in range(1, order + 1):
        of = F.when(F.col("n") >= 3, 3).otherwise(F.col("n")).cast("int")
        kinds = {r["kind"]: r["c"] for r in level[n].where("n BETWEEN 1 AND 4").groupBy(F.col("n").alias("kind")).agg(F.count("*").alias("c")).collect()}
        discount = discounts([kinds.get(i, 0) for i in (1, 2, 3, 4)])
        cut = F.when(F.col("n") > 0, F.element_at(F.array(*map(F.lit, discount)), of)).otherwise(0.0)
        runs_n = level[n].select(
            "run", F.expr("left(run, length(run) - 1)").alias("context"), F.right("run", F.lit(n - 1)).alias("suffix"), "n", cut.alias("cut")
        )
        contexts = runs_n.where("n > 0").groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("left"))
        # A context that no trusted text has leaves all to the lower order.
        joined = runs_n.join(contexts, "context", "left").select(
            "run", "context", "suffix",
            F.coalesce((F.col("n") - F.col("cut")) / F.col("total"), F.lit(0.0)).alias("own"),
            F.coalesce(F.col("left") / F.col("total"), F.lit(1.0)).alias("weight"),
        )
        if n == 1:
            below = joined.withColumn("below", F.lit(1.0 / K))
        else:
            lower = tables[n - 1].select(F.col("run").alias("suffix"), F.col("p").alias("below"))
            below = joined.join(lower, "suffix")
        tables[n] = saved(
            below.select("run", "context", "suffix", (F.col("own") + F.col("weight") * F.col("below")).alias("p"), "weight"),
            f"model{n}",
        )
    return tables


def discounts(kinds: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for runs counted once, twice and oftener, from how many runs occur 1 to 4 times."""
    one, two = kinds[0], kinds[1]
    if not one or not two:
        return [0.5, 0.5, 0.5]
    share = one / (one + 2 * two)
    found = [i - (i + 1) * share * kinds[i] / kinds[i - 1] if kinds[i - 1] else 0.5 for i in (1, 2, 3)]
    return [min(max(d, 0.05), i - 0.05) for i, d in zip((1, 2, 3), found)]


class Lookup:
    """Negative log-probabilities of any runs, by their numbers as of `runs`."""

    def __init__(self, p: list[dict[str, float]], weight: list[dict[str, float]]):
        self.p, self.weight = p, weight

    def of(self, run: str, n: int) -> float:
        if not n:
            return 1.0 / K
        known = self.p[n - 1].get(run)
        # Unseen runs fall back as their contexts say.
        return known if known is not None else self.weight[n - 1].get(run[:-1], 1.0) * self.of(run[-(n - 1) :] if n > 1 else "", n - 1)

    def __getitem__(self, numbers: np.ndarray) -> np.ndarray:
        found = []
        for number in numbers:
            run = ""
            while number:
                number, code = divmod(number, K)
                run = chr(code - 1) + run
            found.append(-np.log(self.of(run, len(self.p))))
        return np.array(found)


def dense(tables: dict[int, DataFrame], order: int = ORDER) -> Lookup:
    """The model on the driver, to look into small ones; documents are scored by joins (`scored`), not by this."""
    rows = [tables[n].select("run", "context", "p", "weight").collect() for n in range(1, order + 1)]
    return Lookup([{r["run"]: r["p"] for r in level} for level in rows], [{r["context"]: r["weight"] for r in level} for level in rows])


def surprise(texts: DataFrame, costs: str, order: int = ORDER) -> DataFrame:
    """(id, lang, chars, nats) of each row of `texts` (id, text, lang, chunk): the model's total surprise at it.

    `costs` is the folder of what the runs of each chunk cost.
    """

    def step(batches):
        chunk, known = None, {}
        for batch in batches:
            for now, rows in _chunks(batch):
                if now != chunk:
                    chunk, known = now, dict(zip(*of_chunk(costs, now, "run", "nats")))
                read = [t or "" for t in values(rows, "text")]
                seen, at = distinct_runs(read, order)
                lengths = [len(t) for t in read]
                cost = np.array([known[run] for run in seen], dtype=np.float64)
                nats = np.bincount(np.repeat(np.arange(len(read)), lengths), weights=cost[at], minlength=len(read))
                yield {"id": values(rows, "id"), "lang": values(rows, "lang"), "chars": lengths, "nats": nats}

    return arrow_step(texts.select("id", "text", "lang", "chunk"), step, "id long, lang string, chars long, nats double")


def scored(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    trusted: str = "quality = 1", quantile: float = QUANTILE,
) -> DataFrame:
    """(id, lang, n_chars, perplexity, threshold, kept) of every row of `docs`.

    Rows of `labels` for which `trusted` holds name the trusted ids; the model is trained on all their texts. A text's
    surprise per character, with PRIOR_CHARS at its language's mean, must not exceed the language's threshold, taken
    from the trusted texts and the higher the fewer they are. Null and empty texts have a null perplexity and are kept. So is everything of a
    language without trusted texts, whose threshold is null: other languages' texts say nothing of it. A null language is one of its own.
    Repeated rows and ids stay, as often as they come; other columns are not read.
    """
    tuned(docs.sparkSession)
    source = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit("")).alias("lang"),
    )
    good = saved(labels.where(trusted).select(F.col("doc_id").cast("long").alias("id")).distinct(), "trusted")
    # Stored with its chunk, so that both passes over the texts agree on it.
    texts = saved(source.withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)), "chunked", compression="zstd")
    # Asked for by name: few trusted ids could be broadcast, but there are as many as trusted texts, so the plan that
    # holds at any size is taken at every size.
    ours = saved_by_chunk(texts.select("chunk", "id").join(good.hint("merge"), "id", "left_semi").distinct(), "trusted-ids")
    asked = saved(chunk_runs(texts, ours.saved_at), "runs")
    tables = model_tables(saved(asked.groupBy("run").agg(F.sum("n").alias("n")), "counts"))
    nats = tables[ORDER].select("run", (-F.log("p")).alias("nats"))
    costs = saved_by_chunk(asked.select("chunk", "run").join(nats.hint("merge"), "run"), "costs")
    drop(ours, asked, *tables.values())
    measured = saved(surprise(texts, costs.saved_at), "surprise")
    drop(texts, costs)

    trained = measured.join(good, "id", "left_semi").where("chars > 0")
    overall = trained.agg(F.sum("nats") / F.sum("chars")).first()[0]
    means = saved(trained.groupBy("lang").agg((F.sum("nats") / F.sum("chars")).alias("mean")), "means")

    def rated(rows: DataFrame) -> DataFrame:
        mean = F.coalesce("mean", F.lit(overall))
        rate = (F.col("nats") + PRIOR_CHARS * mean) / (F.col("chars") + PRIOR_CHARS)
        return rows.join(means, "lang", "left").withColumn("rate", F.when(F.col("chars") > 0, rate))

    found = rated(trained)
    limit = F.percentile_approx("rate", quantile, ACCURACY) + F.lit(MARGIN) * (1 + F.lit(FEW) / F.count("*"))
    limits = saved(found.groupBy("lang").agg(limit.alias("limit")), "limits")
    judged = rated(measured).join(limits, "lang", "left")
    return judged.select(
        F.col("id").alias(id_column), F.when(F.col("lang") != "", F.col("lang")).alias("lang"),
        F.col("chars").alias("n_chars"), F.exp("rate").alias("perplexity"), F.exp("limit").alias("threshold"),
        (~F.coalesce(F.col("rate") > F.col("limit"), F.lit(False))).alias("kept"),
    )


def kept_rows(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of `docs`, with all their columns, that the classifier keeps. An id goes where one of its rows is rejected, with all of them; rows of a
    null id stay, as they cannot be told apart. Repeated rows stay as often as they come."""
    gone = saved(scored(docs, labels, id_column).where("NOT kept").select(id_column).distinct(), "rejected")
    return docs.join(gone, id_column, "left_anti").select(*docs.columns)
