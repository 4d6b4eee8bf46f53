"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells (source, language, topic). Raking multiplies the cells' tokens by a factor of
each of their three values until every marginal has its target share; factors, not cells, change from step to
step, and each step is one aggregation that combines before it shuffles, so a source holding a third of all
rows costs one row a task. Documents are then kept by a fixed hash of their id against their cell's probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.llm.common import saved
from chainlake.session import configured

DIMENSIONS = ("source", "lang", "topic")
# Targets: each value's share of tokens to this power (1 leaves the mix as it is, 0 makes all values equal).
FLATTEN = {"source": 0.5, "lang": 0.7, "topic": 0.8}
CYCLES = 8
# Expected tokens kept, as a share of all.
BUDGET = 0.6
# Rounds that hand the surplus of cells kept whole to the others.
CLIPS = 6
NONE = "(none)"


def token_count(text: Column) -> Column:
    """Words of a text; 0 where it is null or blank."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", " ")
    bare = F.trim(bare)
    return F.when(F.length(bare) == 0, F.lit(0)).otherwise(
        F.length(bare) - F.length(F.translate(bare, " ", "")) + 1
    ).cast("long")


def topic_of(text: Column) -> Column:
    """What a document is about as far as its form tells; the tables have no topics of their own."""
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "empty")
        .when(text.contains("Licensed under"), "licensed")
        .when(text.contains(" | "), "table")
        .when(text.contains("@"), "contact")
        .when(F.length(text) > 5000, "long")
        .when(F.length(text) < 400, "note")
        .otherwise("prose")
    )


def described(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, source, lang, topic, tokens): what mixing needs of each row. Null values are the value `(none)`."""
    text = F.col(text_column).cast("string")
    topic = F.col("topic").cast("string") if "topic" in docs.columns else topic_of(text)
    plain = {n: F.col(n).cast("string") if n in docs.columns else F.lit(None).cast("string") for n in ("source", "lang")}
    return docs.select(
        F.col(id_column).cast("long").alias("id"),
        *(F.coalesce(c, F.lit(NONE)).alias(n) for n, c in {**plain, "topic": topic}.items()),
        token_count(text).alias("tokens"),
    )


def targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(dimension, target): target share of each value, from its share of tokens. Values without tokens have none."""
    scaled = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0").select(
        dimension, F.pow(F.col("t").cast("double"), F.lit(power)).alias("w")
    )
    total = scaled.agg(F.sum("w")).first()[0]
    return scaled.select(dimension, (F.col("w") / F.lit(total)).alias("target"))


def given_targets(cells: DataFrame, dimension: str, goals: DataFrame) -> DataFrame:
    """(dimension, target) of given weights of that form, scaled to a sum of 1 over the values that have tokens: no draw gives a value others' tokens."""
    there = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0").select(dimension)
    wanted = goals.select(F.coalesce(F.col(dimension).cast("string"), F.lit(NONE)).alias(dimension), F.col("target").cast("double").alias("w")).where("w > 0")
    known = wanted.groupBy(dimension).agg(F.sum("w").alias("w")).join(there, dimension, "left_semi")
    total = known.agg(F.sum("w")).first()[0]
    if not total and not there.isEmpty():
        raise ValueError(f"none of the targets by {dimension} is of a value that has tokens")
    return known.select(dimension, (F.col("w") / F.lit(total)).alias("target"))


def residual(weighed: DataFrame, goals: dict[str, DataFrame]) -> DataFrame:
    """(dimension, value, target, share): what each value was to have of the weights' sum, and has."""
    total = weighed.agg(F.sum("weight")).first()[0] or 1.0
    parts = [
        goals[d].join(weighed.groupBy(d).agg((F.sum("weight") / F.lit(total)).alias("share")), d, "left").select(
            F.lit(d).alias("dimension"), F.col(d).alias("value"), "target", F.coalesce("share", F.lit(0.0)).alias("share")
        )
        for d in DIMENSIONS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def raked(cells: DataFrame, goals: dict[str, DataFrame], cycles: int = CYCLES, tolerance: float | None = None) -> DataFrame:
    """`cells` (source, lang, topic, tokens) with `weight`, whose marginals have the goals' shares of a sum of 1.

    The last dimension's marginal is exact, the others' are after as many cycles as it takes to settle: `cycles`, or fewer where a cycle
    finds no share further than `tolerance` from its target. A value without goal or tokens weighs nothing.
    """
    factors = {d: saved(goals[d].select(d, F.lit(1.0).alias(f"by_{d}")), f"by-{d}") for d in DIMENSIONS}
    for _ in range(cycles):
        furthest = 0.0
        for d in DIMENSIONS:
            weighed = cells
            for other in DIMENSIONS:
                if other != d:
                    weighed = weighed.join(factors[other], other)
            product = F.col("tokens").cast("double")
            for other in DIMENSIONS:
                if other != d:
                    product = product * F.col(f"by_{other}")
            sums = weighed.groupBy(d).agg(F.sum(product).alias("now")).where("now > 0")
            before = factors[d]
            factors[d] = saved(
                sums.join(goals[d], d).select(d, (F.col("target") / F.col("now")).alias(f"by_{d}")), f"by-{d}"
            )
            if tolerance is not None:
                # What the factors before gave, against the target: one number reaches the driver.
                gap = before.withColumnRenamed(f"by_{d}", "was").join(sums, d).join(goals[d], d).agg(F.max(F.abs(F.col("was") * F.col("now") - F.col("target"))))
                furthest = max(furthest, gap.first()[0] or 0.0)
        if tolerance is not None and furthest <= tolerance:
            break
    weighed = cells
    for d in DIMENSIONS:
        weighed = weighed.join(factors[d], d, "left")
    weight = F.col("tokens") * F.col("by_source") * F.col("by_lang") * F.col("by_topic")
    return weighed.select(*DIMENSIONS, "tokens", F.coalesce(weight, F.lit(0.0)).alias("weight"))


def probabilities(weighed: DataFrame, budget: float = BUDGET, clips: int = CLIPS) -> DataFrame:
    """`weighed` with `probability`: a document of the cell is kept with it, so that about `budget` of all tokens
    are, in the cells' shares. A cell that has too few tokens for its share is kept whole, and the others
    take up what it leaves."""
    total = float(weighed.agg(F.sum("tokens")).first()[0] or 0)
    scale = 1.0
    for _ in range(clips):
        # Numbers of the whole table: one row of two sums each round.
        full = F.col("weight") * F.lit(scale * budget * total) >= F.col("tokens")
        whole, rest = weighed.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not total or not rest or budget * total <= whole:
            break
        scale = (budget * total - whole) / (rest * budget * total)
    wanted = F.col("weight") * F.lit(scale * budget * total) / F.col("tokens")
    return weighed.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), wanted)).otherwise(0.0))


def draw(id_column: Column) -> Column:
    """A number in [0, 1) that depends on the id only, the same in any engine with MD5. Null ids draw 0."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return F.when(id_column.isNull(), 0.0).otherwise(number)


def mixture(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", targets_by: dict[str, DataFrame] | None = None,
    budget: float = BUDGET, tolerance: float = 1e-6, most_cycles: int = 200,
) -> tuple[DataFrame, DataFrame]:
    """(rows, cells): every row with its cell's probability and whether it is drawn, and the raked cells.

    `targets_by` has, for any of the dimensions, a table (its name, target) of weights to rake to; they need not add up to 1. The others, and
    all where none is given, flatten the data's own shares. With given weights, cycles go on until every share is within `tolerance` of
    its target, or `most_cycles` are over, as where targets contradict each other; `residual` tells how far they came.

    Null sources, languages and topics are values of their own; texts without words have no tokens, weigh nothing and are
    not drawn. Equal ids are drawn alike, so repeated rows stay together. An empty table gives empty results.
    Columns beside id, text, source, lang and topic are not read; a missing one of the last three counts as null, but a
    missing topic is derived.
    """
    configured(docs.sparkSession)
    facts = saved(described(docs, id_column, text_column), "described")
    cells = saved(facts.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "cells")
    given = targets_by or {}
    if set(given) - set(DIMENSIONS):
        raise ValueError(f"targets are by {DIMENSIONS}, not {sorted(given)}")
    goals = {d: saved(given_targets(cells, d, given[d]) if d in given else targets(cells, d, FLATTEN[d]), f"goal-{d}") for d in DIMENSIONS}
    weighed = raked(cells.drop("docs"), goals, most_cycles if given else CYCLES, tolerance if given else None)
    chances = saved(probabilities(saved(weighed, "raked"), budget), "chances")
    # Plain scans on both sides: hot cells are split by AQE, and the cells are broadcast where small.
    rows = facts.join(chances.drop("tokens"), list(DIMENSIONS), "left").select(
        F.col("id").alias(id_column), *DIMENSIONS, F.col("tokens").alias("n_tokens"), "probability",
        (F.col("tokens").isNotNull() & (draw(F.col("id")) < F.col("probability"))).alias("drawn"),
    )
    return rows, chances


def drawn_rows(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of `docs`, with all their columns, that the mixture draws, judged row by row in one pass. Nulls, repeated rows and missing
    columns as in `mixture`."""
    _, chances = mixture(docs, id_column)
    text = F.col("text").cast("string")
    topic = F.col("topic").cast("string") if "topic" in docs.columns else topic_of(text)
    names = {d: f"mix_{d}" for d in DIMENSIONS}
    plain = {n: F.col(n).cast("string") if n in docs.columns else F.lit(None).cast("string") for n in ("source", "lang")}
    keys = {**plain, "topic": topic}
    marked = docs.select("*", *(F.coalesce(keys[d], F.lit(NONE)).alias(n) for d, n in names.items()))
    cells = chances.select(*(F.col(d).alias(n) for d, n in names.items()), F.col("probability").alias("mix_chance"))
    drawn = marked.join(cells, list(names.values())).where(
        (draw(F.col(id_column)) < F.col("mix_chance")) & (token_count(text) > 0)
    )
    return drawn.select(*docs.columns)
