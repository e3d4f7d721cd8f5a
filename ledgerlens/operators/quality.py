"""Declarative data-quality rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, functions as F

#: Column that keeps with a stored row which rules it passes, a bit per rule.
OUTCOMES = "_rules"


@dataclass(frozen=True)
class Rule:
    """``predicate`` must be TRUE for a row to pass; NULL counts as a failure."""

    name: str
    predicate: str
    action: Literal["drop", "warn"] = "drop"

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passing every ``drop`` rule. ``warn`` rules remove nothing."""
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.passes())
    return df


def _metrics(df: DataFrame, rules: Sequence[Rule], passed: Sequence[Column]) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("evaluated"),
        *[F.count_if(column).alias(f"passed_{i}") for i, column in enumerate(passed)],
    )
    entries = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col("evaluated"),
            F.col(f"passed_{i}").alias("passed"),
            (F.col("evaluated") - F.col(f"passed_{i}")).alias("failed"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows evaluated, passed and failed, from a single pass over ``df``."""
    return _metrics(df, rules, [rule.passes() for rule in rules])


def with_outcomes(
    df: DataFrame,
    rules: Sequence[Rule],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    column: str = OUTCOMES,
) -> DataFrame:
    """``df`` as it is, with the outcome of every rule in one ``column`` of bits.

    The bits are stored by the job that writes the rows, so ``stored_metrics`` and
    ``passing`` read that column alone, and tasks repeated after a lost executor
    count once. ``prepare`` derives what the predicates name; it keeps the rows and
    any column it does not know.
    """
    if len(rules) > 63:
        raise ValueError("a column holds the outcomes of 63 rules")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.passes(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    if prepare is None:
        return df.withColumn(column, bits)
    prepared = prepare(df.withColumn("_whole_row", F.struct("*")))
    return prepared.select("_whole_row.*", bits.alias(column))


def stored_metrics(df: DataFrame, rules: Sequence[Rule], column: str = OUTCOMES) -> DataFrame:
    """``rule_metrics`` of the rows as ``with_outcomes`` judged them."""
    return _metrics(df, rules, [F.col(column).bitwiseAND(1 << i) != 0 for i in range(len(rules))])


def passing(df: DataFrame, rules: Sequence[Rule], column: str = OUTCOMES) -> DataFrame:
    """``apply_rules`` of the rows as ``with_outcomes`` judged them, without that column."""
    needed = sum(1 << i for i, rule in enumerate(rules) if rule.action == "drop")
    return df.filter(F.col(column).bitwiseAND(needed) == needed).drop(column)


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Surviving rows and the metrics of the rules on the incoming rows."""
    return apply_rules(df, rules), rule_metrics(df, rules)


def observe_rules(
    df: DataFrame, rules: Sequence[Rule], name: str = "rules"
) -> tuple[DataFrame, Observation]:
    """Surviving rows plus failure counts gathered by the job that writes them.

    Costs no extra pass; ``observation.get`` is available once an action ran.
    Meant for monitoring: rows of tasks repeated after a lost executor may be
    counted again. ``rule_metrics`` is exact.
    """
    observation = Observation(name)
    watched = df.observe(
        observation,
        F.count(F.lit(1)).alias("evaluated"),
        *[F.count_if(~rule.passes()).alias(rule.name) for rule in rules],
    )
    return apply_rules(watched, rules), observation
