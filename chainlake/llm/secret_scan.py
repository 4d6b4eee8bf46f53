"""Secret scans: character Markov models of random strings and of ordinary words, compared by log-likelihood ratio.

Three plain patterns find secrets that say what they are. For the rest, every run of token characters is scored by its best
stretch: the largest sum over neighbouring characters of how much likelier the model of random strings makes the second
after the first than the model of ordinary words does. Both models are trained from labelled samples. DataFrame functions only.

Spans: splitting a text at a pattern gives what lies between its matches, so the lengths of both, added up, are the
matches' places in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.llm.common import saved
from chainlake.session import configured

# The plain patterns, in the order in which spans of one place are listed. Java's (?i) folds ASCII only.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")
LEAST_VALUE = 8

TOKEN = "A-Za-z0-9+/_.=-"
# A stretch is a secret where the ratio reaches this many nats.
LEAST_RATIO = 12.0
# Labelled samples: random strings for each alphabet, and documents whose words count as ordinary.
RANDOM_STRINGS = 2000
ORDINARY_DOCS = 2000
LEAST_PLACES = 2
SYMBOLS = 128

SPAN = "array<struct<start:int,kind:int,end:int>>"


def spans_of(text: Column, pattern: str, kind: int, group: int | None = None, least: int = 0) -> Column:
    """Spans (start, kind, end) of a pattern's leftmost non-overlapping matches, end exclusive.

    Where `group` is given, matches whose group is shorter than `least` are dropped; they still take their place.
    """
    outer = f"({pattern})"
    found = F.regexp_extract_all(text, F.lit(outer), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(outer), F.lit(group + 1)) if group else found
    between = F.split(text, outer, -1)
    parts = F.arrays_zip(between.alias("gap"), found.alias("hit"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(acc, part):
        begin = acc["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["hit"]), F.lit(0))
        keep = F.coalesce(F.length(part["value"]) >= least, F.lit(False)) & part["hit"].isNotNull()
        span = F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))).cast(SPAN)
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    # The pattern that only tells whether there is a match is far cheaper than the three that take a text apart.
    nothing = F.array().cast(SPAN)
    return F.when(text.rlike(pattern), F.aggregate(parts, start, add, lambda acc: acc["spans"])).otherwise(nothing)


def base_spans(text: Column) -> Column:
    every = F.concat(
        spans_of(text, ASSIGN, 0, group=2, least=LEAST_VALUE), spans_of(text, ACCESS, 1), spans_of(text, HEX, 2)
    )
    return F.array_sort(every)


def labelled_samples(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(random boolean, sample string, n): hashed numbers in three alphabets, and the words of ORDINARY_DOCS documents, as often as they come.

    The documents are those whose ids hash lowest; words that the plain patterns find are left out. So are words that only ever follow one
    and the same word: a secret stands in one place, however many copies its document has, and must not pass for ordinary. Words count in
    capitals as well.
    """
    digest = F.sha2(F.col("id").cast("string"), 256)
    packed = F.base64(F.unhex(digest))
    strings = spark.range(RANDOM_STRINGS).select(
        F.explode(F.array(digest, F.regexp_replace(packed, "=", ""), F.upper(F.translate(packed, "+/=", "")))).alias("sample")
    )
    ids = docs.select(F.col(id_column).alias("id")).where("id IS NOT NULL").distinct()
    lowest = ids.orderBy(F.xxhash64("id"), "id").limit(ORDINARY_DOCS)
    # As many ids as the bound says.
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(
        F.broadcast(lowest), "id", "left_semi"
    )
    bare = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    words = texts.select(F.split(bare, f"[^{TOKEN}]+").alias("words"))
    # Beside the word before it, a word in a text of its own: none.
    pairs = words.select(F.explode(F.arrays_zip(F.concat(F.array(F.lit("")), "words").alias("before"), F.col("words").alias("word"))).alias("p"))
    met = pairs.select("p.before", "p.word").where("length(word) > 1").groupBy("word", "before").agg(F.count("*").alias("n"))
    ordinary = met.groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("places")).where(F.col("places") >= LEAST_PLACES)
    # In capitals, an ordinary word is one still.
    forms = ordinary.select(F.explode(F.array_distinct(F.array("word", F.upper("word")))).alias("sample"), "n")
    return strings.select(F.lit(True).alias("random"), "sample", F.lit(1).cast("long").alias("n")).unionByName(
        forms.select(F.lit(False).alias("random"), "sample", "n")
    )


def codes(run: Column) -> Column:
    """The ASCII codes of a string's characters, others as they come. One pass: taking characters by their place would walk the string again for each."""
    return F.transform(F.filter(F.split(run, ""), lambda c: F.length(c) > 0), lambda c: F.ascii(c))


def train(samples: DataFrame) -> DataFrame:
    """(slot int, ratio double): the log-ratio of both models for each pair of characters, at 128 * first + second.

    `samples` has (random, sample, n), n being how often a sample counts. One is added to every pair's count. No more than 128 squared rows;
    pairs that no sample holds have none.
    """
    coded = samples.select("random", "n", codes(F.col("sample")).alias("codes")).where(F.size("codes") > 1)
    length = F.size("codes") - 1
    pairs = coded.select(
        "random", "n", F.explode(F.arrays_zip(F.slice("codes", F.lit(1), length).alias("a"), F.slice("codes", F.lit(2), length).alias("b"))).alias("p")
    ).where("p.a < 128 AND p.b < 128")
    nothing = F.lit(0).cast("long")
    counted = pairs.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(
        F.sum(F.when(F.col("random"), F.col("n")).otherwise(nothing)).alias("r"), F.sum(F.when(F.col("random"), nothing).otherwise(F.col("n"))).alias("o")
    )
    totals = counted.groupBy("a").agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))
    alphabet = 67
    ratio = F.log((F.col("r") + 1) / (F.col("all_r") + alphabet)) - F.log((F.col("o") + 1) / (F.col("all_o") + alphabet))
    return counted.join(totals, "a").select((F.col("a") * SYMBOLS + F.col("b")).alias("slot"), ratio.alias("ratio"))


def ratio_table(model: DataFrame) -> Column:
    """The model as one constant array. At most 128 squared numbers reach the driver."""
    rows = {r["slot"]: r["ratio"] for r in model.collect()}
    return F.split(F.lit(",".join(repr(rows.get(i, 0.0)) for i in range(SYMBOLS * SYMBOLS))), ",").cast(T.ArrayType(T.DoubleType()))


def least_run(model: DataFrame) -> int:
    """How many characters a stretch has at least that reaches LEAST_RATIO: fewer cannot, whatever they are."""
    most = model.agg(F.max("ratio")).first()[0] or 0.0
    return math.ceil(LEAST_RATIO / most) + 1 if most > 0 else 2


def ratios(run: Column, table: Column) -> Column:
    """The log-ratio of each pair of neighbouring characters of a run of token characters."""
    length = F.length(run) - 1
    return F.zip_with(
        F.slice(codes(run), F.lit(1), length), F.slice(codes(run), F.lit(2), length), lambda a, b: F.element_at(table, (a * SYMBOLS + b + 1).cast("int"))
    )


def best_ratio(run: Column, table: Column) -> Column:
    """Log-likelihood ratio of random against ordinary for the best stretch of a run of token characters, 0 at least."""

    def add(acc, ratio):
        total = F.greatest(acc["total"], F.lit(0.0)) + ratio
        return F.struct(total.alias("total"), F.greatest(acc["best"], acc["total"]).alias("best"))

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
    return F.aggregate(ratios(run, table), start, add, lambda acc: F.greatest(acc["best"], acc["total"]))


def stretches(run: Column, offset: Column, table: Column) -> Column:
    """Spans of a run's stretches that reach LEAST_RATIO; a stretch lasts while its ratio stays above 0 and ends at its peak."""
    none = F.array().cast(SPAN)

    def told(acc):
        span = F.struct((offset + acc["since"]).alias("start"), F.lit(3).alias("kind"), (offset + acc["end"]).alias("end"))
        return F.when(acc["peak"] >= LEAST_RATIO, F.concat(acc["spans"], F.array(span).cast(SPAN))).otherwise(acc["spans"])

    def add(acc, ratio):
        i, total = acc["i"] + 1, acc["total"] + ratio
        over = total <= 0
        return F.struct(
            i.alias("i"), F.when(over, 0.0).otherwise(total).alias("total"), F.when(over, i).otherwise(acc["since"]).alias("since"),
            F.when(over, 0.0).otherwise(F.greatest(acc["peak"], total)).alias("peak"),
            F.when(over | (total > acc["peak"]), i + 1).otherwise(acc["end"]).alias("end"),
            F.when(over, told(acc)).otherwise(acc["spans"]).alias("spans"),
        )

    start = F.struct(
        F.lit(0).alias("i"), F.lit(0.0).alias("total"), F.lit(0).alias("since"), F.lit(0.0).alias("peak"), F.lit(0).alias("end"), none.alias("spans")
    )
    return F.aggregate(ratios(run, table), start, add, told)


def without(text: Column, spans: Column) -> Column:
    """The text with blanks in the place of its spans, which are in order."""

    def add(acc, span):
        start, end = F.greatest(acc["at"], span["start"]), F.greatest(acc["at"], span["end"])
        kept = F.substring(text, acc["at"] + 1, start - acc["at"])
        return F.struct(end.alias("at"), F.concat(acc["out"], kept, F.repeat(F.lit(" "), end - start)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(spans, start, add, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, base array of spans, spans array of spans) of every row; a span is (start, kind, end) in code points.

    `base` has what the plain patterns find; `spans` has that and the stretches, of what base spans leave of the text, that the
    models take for random. Kinds are numbered as KINDS lists them. Null and empty texts have no spans, equal rows
    get equal results, other columns are not read. An empty table gives an empty result.
    """
    spark = configured(docs.sparkSession)
    model = saved(train(labelled_samples(spark, docs, id_column, text_column)), "markov")
    table = ratio_table(model)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    found = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), base_spans(text).alias("base"))
    bare = found.select("id", "base", without(F.col("text"), F.col("base")).alias("bare"))
    least = least_run(model)
    runs = F.array_distinct(F.filter(F.split("bare", f"[^{TOKEN}]+", -1), lambda r: F.length(r) >= least))
    scored = bare.withColumn("random", F.filter(runs, lambda r: best_ratio(r, table) >= LEAST_RATIO))

    # Only texts with such a run are taken apart for its places.
    parts = F.arrays_zip(
        F.split("bare", f"[{TOKEN}]+", -1).alias("gap"), F.regexp_extract_all("bare", F.lit(f"([{TOKEN}]+)"), F.lit(1)).alias("run")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(acc, part):
        begin = acc["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["run"]), F.lit(0))
        hit = F.coalesce(F.array_contains("random", part["run"]), F.lit(False))
        return F.struct(end.alias("at"), F.when(hit, F.concat(acc["spans"], stretches(part["run"], begin, table))).otherwise(acc["spans"]).alias("spans"))

    added = F.when(F.size("random") > 0, F.aggregate(parts, start, add, lambda acc: acc["spans"])).otherwise(F.array().cast(SPAN))
    return scored.select(F.col("id").alias(id_column), "base", F.array_sort(F.concat("base", added)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
