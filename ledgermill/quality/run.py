"""Run rules and summarise them."""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.quality.contract import (
    Rule,
    checked,
    checked_counts,
    checked_failures,
    compacted,
    conform,
    packed,
    registry,
    union_all,
)
from ledgermill.schema import RULE_OUTPUT
from ledgermill.settings import Settings

OUTPUT = [f.name for f in RULE_OUTPUT.fields]


def evaluate(tables: Mapping[str, DataFrame], settings: Settings, rules: Iterable[Rule] | None = None) -> DataFrame:
    """``rule_id`` and the rule output columns for every judged unit.

    Row-by-row rules that share an input share one pass over it.
    """
    rules = list(registry.values()) if rules is None else list(rules)
    plain: list[DataFrame] = []
    dense: list[DataFrame] = []
    for rule in rules:
        for build in (rule.build, rule.extra):
            if build is not None:
                units = build(tables, settings)
                units = packed(units) if rule.compact else conform(units)
                (dense if rule.compact else plain).append(units.selectExpr(f"'{rule.id}' AS rule_id", "*"))
    for source, members in _by_source(rules).items():
        for compact, target in ((False, plain), (True, dense)):
            chosen = [r for r in members if r.compact == compact]
            if chosen:
                target.append(checked(tables[source], chosen, settings))
    if dense:
        plain.append(compacted(union_all(dense), [r for r in rules if r.compact]))
    return union_all(plain)


def evaluate_failures(tables: Mapping[str, DataFrame], settings: Settings, rules: Iterable[Rule] | None = None) -> DataFrame:
    """The failing units of :func:`evaluate`. Every failure keeps a row of its own, so nothing is added up or dealt for it."""
    rules = list(registry.values()) if rules is None else list(rules)
    parts: list[DataFrame] = []
    for rule in rules:
        for build in (rule.failing or rule.build, rule.extra):
            if build is not None:
                units = build(tables, settings).where("status = 'fail'")
                units = units.select("status", "n", "d.*") if "d" in units.columns else units
                parts.append(conform(units).selectExpr(f"'{rule.id}' AS rule_id", "*"))
    for source, members in _by_source(rules).items():
        parts.append(checked_failures(tables[source], members, settings))
    return union_all(parts)


def tally(tables: Mapping[str, DataFrame], settings: Settings, rules: Iterable[Rule] | None = None) -> DataFrame:
    """``rule_id, status, n``: the units of :func:`evaluate` added up, without their details."""
    rules = list(registry.values()) if rules is None else list(rules)
    parts: list[DataFrame] = []
    for rule in rules:
        for build in (rule.counts or rule.build, rule.extra):
            if build is not None:
                units = build(tables, settings)
                n = F.sum("n") if "n" in units.columns else F.count(F.lit(1))
                parts.append(units.groupBy("status").agg(n.cast("long").alias("n"))
                             .selectExpr(f"'{rule.id}' AS rule_id", "status", "n"))
    for source, members in _by_source(rules).items():
        parts.append(checked_counts(tables[source], members, settings))
    return union_all(parts)


def _by_source(rules: Iterable[Rule]) -> dict[str, list[Rule]]:
    by_source: dict[str, list[Rule]] = defaultdict(list)
    for rule in rules:
        if rule.check is not None:
            by_source[rule.source].append(rule)
    return by_source


def run_rule(rule: Rule, tables: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """The output of one rule."""
    return evaluate(tables, settings, [rule]).select(*OUTPUT)


def catalog(spark, rules: Iterable[Rule] | None = None) -> DataFrame:
    rules = list(registry.values()) if rules is None else list(rules)
    rows = [tuple(r.metadata().values()) for r in rules]
    return spark.createDataFrame(rows, "rule_id string, rule_name string, category string, severity string, "
                                       "unit string, description string")


def failures(units: DataFrame, rules: Iterable[Rule] | None = None) -> DataFrame:
    """Failing units with the names of their rules (a bounded lookup, broadcast)."""
    names = catalog(units.sparkSession, rules).select("rule_id", "rule_name", "category", "severity")
    return units.where("status = 'fail'").join(F.broadcast(names), "rule_id").select(
        "rule_id", "rule_name", "category", "severity", *OUTPUT)


def summary(units: DataFrame, rules: Iterable[Rule] | None = None) -> DataFrame:
    """Counts, failure rate and coverage per rule, of units or of their :func:`tally`; rules without units are listed with
    zeros."""
    def total(status: str):
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n"))), F.lit(0))

    counts = units.groupBy("rule_id").agg(
        total("pass").alias("passed"), total("fail").alias("failed"), total("skip").alias("skipped"))
    known = catalog(units.sparkSession, rules).join(counts, "rule_id", "left").na.fill(
        0, ["passed", "failed", "skipped"])
    evaluated = F.col("passed") + F.col("failed")
    return known.select(
        "rule_id", "rule_name", "category", "severity", "unit", "description",
        (evaluated + F.col("skipped")).alias("candidates"), evaluated.alias("evaluated"), "passed", "failed",
        "skipped", F.try_divide(F.col("failed"), evaluated).alias("failure_rate"),
        F.try_divide(evaluated, evaluated + F.col("skipped")).alias("coverage"))
