"""Declarative data quality rules and their tidy outcomes, one row per rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.contract import Contract
from chainlake.functions.status import status_from_outcome
from chainlake.functions.text import blank, named


def _quoted(name: str) -> str:
    return f'"{name}"'


@dataclass(frozen=True)
class ColumnExists:
    column: str
    metric = None

    @property
    def text(self) -> str:
        return f"ColumnExists {_quoted(self.column)}"


@dataclass(frozen=True)
class IsComplete:
    """Bronze holds '' for an absent value and that counts as present, unless `blank_is_null`."""

    column: str
    blank_is_null: bool = False
    metric = "Completeness"

    @property
    def text(self) -> str:
        return f"IsComplete {_quoted(self.column)}"

    def holds(self) -> Column:
        value = named(self.column)
        return ~blank(value) if self.blank_is_null else value.isNotNull()

    def passes(self, value: Column) -> Column:
        return value == 1.0


@dataclass(frozen=True)
class RowCount:
    more_than: int = 0
    metric = "RowCount"

    @property
    def text(self) -> str:
        return f"RowCount > {self.more_than}"

    def passes(self, value: Column) -> Column:
        return value > self.more_than


@dataclass(frozen=True)
class InDomain:
    """A null is outside the domain; it must not drop out of both counts."""

    column: str
    values: tuple[str, ...]
    metric = "ColumnValues.Compliance"

    @property
    def text(self) -> str:
        return f"ColumnValues {_quoted(self.column)} in [{', '.join(_quoted(v) for v in self.values)}]"

    def holds(self) -> Column:
        return F.coalesce(named(self.column).isin(*self.values), F.lit(False))

    def passes(self, value: Column) -> Column:
        return value == 1.0


@dataclass(frozen=True)
class Uniqueness:
    """Share of the rows whose value occurs exactly once."""

    column: str
    floor: float
    metric = "Uniqueness"

    @property
    def text(self) -> str:
        return f"Uniqueness {_quoted(self.column)} > {self.floor}"

    def passes(self, value: Column) -> Column:
        return value > self.floor


Rule = ColumnExists | IsComplete | RowCount | InDomain | Uniqueness


def ruleset(contract: Contract) -> list[Rule]:
    """Schema, identity and domain rules of a source."""
    return [
        *(ColumnExists(c) for c in contract.required_columns),
        IsComplete(contract.id_column),
        RowCount(0),
        InDomain(contract.domain_column, contract.domain_values),
        Uniqueness(contract.id_column, contract.uniqueness_floor),
    ]


def evaluate(
    df: DataFrame, rules: list[Rule], by: str | None = None, layouts: DataFrame | None = None
) -> DataFrame:
    """([by,] regra, outcome, motivo_falha, metrica_nome, metrica_valor, status), one row per rule.

    One scan and one shuffle for all rules of a source: rows are first counted per unique-column value,
    together with the counts the other rules need, and those counts are then added up. Both steps combine
    before they shuffle, so neither a frequent value nor a large file lands in one task. Every further
    uniqueness column costs one more narrow aggregate.

    `by` gives outcomes per group, e.g. per source file. `layouts` (arquivo_origem, colunas) gives the header
    of each file, so that column rules go by the file's own columns and a file without rows is judged too;
    without it the DataFrame's columns decide.
    """
    there = set(df.columns)
    usable = [r for r in rules if isinstance(r, RowCount) or r.column in there]
    unique = list(dict.fromkeys(r.column for r in usable if isinstance(r, Uniqueness)))
    groups = [by] if by else []

    held = {
        f"held_{i}": r.holds() for i, r in enumerate(rules) if r in usable and isinstance(r, IsComplete | InDomain)
    }
    first = unique[0] if unique else None
    counts = _counts(df, groups, first, held)
    frames = [_outcomes(counts, rules, groups, there, layouts, first, skip=unique[1:])]
    for column in unique[1:]:
        others = [r if isinstance(r, Uniqueness) and r.column == column else None for r in rules]
        frames.append(_outcomes(_counts(df, groups, column, {}), others, groups, there, None, column, ()))
    outcomes = frames[0]
    for frame in frames[1:]:
        outcomes = outcomes.unionByName(frame)
    return outcomes


def _counts(df: DataFrame, groups: list[str], unique: str | None, held: dict[str, Column]) -> DataFrame:
    """rows, single and one count per entry of `held`, per group."""
    tallies = [F.count_if(rule).alias(name) for name, rule in held.items()]
    if unique is None:
        return df.groupBy(*groups).agg(F.count("*").alias("rows"), F.lit(0).alias("single"), *tallies)
    per_value = df.groupBy(*groups, named(unique).alias("value")).agg(F.count("*").alias("rows"), *tallies)
    return per_value.groupBy(*groups).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count_if((F.col("rows") == 1) & F.col("value").isNotNull()).alias("single"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in held),
    )


def _outcomes(
    counts: DataFrame,
    rules: list[Rule | None],
    groups: list[str],
    there: set[str],
    layouts: DataFrame | None,
    unique: str | None,
    skip: tuple[str, ...] | list[str],
) -> DataFrame:
    headers = F.lit(None)
    if layouts is not None and groups:
        # From the headers' side, so that a file without rows is judged too.
        files = layouts.select(F.col("arquivo_origem").alias(groups[0]), "colunas")
        counts = files.join(counts, groups[0], "left").na.fill(0)
        headers = F.col("colunas")

    def row(i: int, rule: Rule) -> Column:
        rows = F.col("rows")
        if isinstance(rule, ColumnExists):
            value = F.lit(None).cast("double")
            passed = (
                F.array_contains(headers, rule.column) if layouts is not None and groups
                else F.lit(rule.column in there)
            )
            reason = F.lit(f"Column {rule.column} does not exist!")
        elif not isinstance(rule, RowCount) and rule.column not in there:
            value, passed = F.lit(None).cast("double"), F.lit(False)
            reason = F.lit(f"Column {rule.column} does not exist!")
        else:
            if isinstance(rule, RowCount):
                value = rows.cast("double")
            elif isinstance(rule, Uniqueness):
                value = F.try_divide(F.col("single").cast("double"), rows.cast("double"))
            else:
                value = F.try_divide(F.col(f"held_{i}").cast("double"), rows.cast("double"))
            passed = F.coalesce(rule.passes(value), F.lit(False))
            shown = F.coalesce(value.cast("string"), F.lit("none"))
            reason = F.concat(F.lit("Value: "), shown, F.lit(" does not meet the constraint requirement!"))
        name = F.when(value.isNotNull(), F.lit(rule.metric)) if rule.metric else F.lit(None).cast("string")
        return F.struct(
            F.lit(rule.text).alias("regra"),
            F.when(passed, "Passed").otherwise("Failed").alias("outcome"),
            F.when(~passed, reason).alias("motivo_falha"),
            name.alias("metrica_nome"),
            value.alias("metrica_valor"),
        )

    wanted = [
        row(i, r) for i, r in enumerate(rules)
        if r is not None and not (isinstance(r, Uniqueness) and r.column in skip)
    ]
    tidy = counts.select(*groups, F.inline(F.array(*wanted)))
    return tidy.withColumn("status", status_from_outcome(F.col("outcome")))


def any_failed(outcomes: DataFrame, by: str | None = None) -> DataFrame:
    """([by,] falhou): did any rule fail."""
    return outcomes.groupBy(*([by] if by else [])).agg(F.bool_or(F.col("outcome") == "Failed").alias("falhou"))
