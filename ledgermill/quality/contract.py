"""What a rule is.

A rule reads warehouse tables and yields one row per judged unit: a status (``pass``, ``fail`` or ``skip``), a
weight ``n`` (1 unless given) and optional details. Rules over very many units are *compacted*: rows that only
count are added up on the map side, so the passes of a huge table leave as one row while every failure keeps
its details and its multiplicity.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.sqltext import case, struct, text
from ledgermill.schema import RULE_OUTPUT
from ledgermill.settings import Settings

CATEGORIES = ("identity", "sign", "plausibility", "continuity", "restatement", "duplicate", "outlier",
              "completeness", "unit", "referential")
SEVERITIES = ("error", "warn", "info")
DETAILS = [f.name for f in RULE_OUTPUT.fields if f.name not in ("status", "n")]

# A check of one input row, as SQL expressions: the condition to be judged at all, and the judged unit.
Check = Callable[[Settings], tuple[str, str]]
Build = Callable[[Mapping[str, DataFrame], Settings], DataFrame]


@dataclass(frozen=True)
class Rule:
    id: str
    name: str
    category: str
    severity: str
    unit: str
    description: str
    build: Build | None = None
    source: str | None = None  # with ``check``: the shared table this rule judges row by row
    check: Check | None = None
    compact: bool = False
    always: tuple[tuple[str, str | None], ...] = (("pass", None),)  # rows a compacted rule yields even at zero
    extra: Build | None = field(default=None)  # units judged apart from the row-by-row check
    failing: Build | None = None  # the failing units of ``build`` alone, where these are found with less work
    counts: Build | None = None  # ``status, n`` of the units of ``build``, likewise
    of_company: bool = True  # its units may name a company

    def metadata(self) -> dict[str, str]:
        return {k: getattr(self, k) for k in ("id", "name", "category", "severity", "unit", "description")}


registry: dict[str, Rule] = {}


def register(rule: Rule) -> Rule:
    """Add a rule. Ids are unique and the descriptive fields are required."""
    empty = [k for k, v in rule.metadata().items() if not v]
    if empty:
        raise ValueError(f"rule {rule.id or '?'}: missing {', '.join(empty)}")
    if rule.id in registry:
        raise ValueError(f"duplicate rule id {rule.id}")
    if rule.category not in CATEGORIES or rule.severity not in SEVERITIES:
        raise ValueError(f"rule {rule.id}: unknown category or severity")
    registry[rule.id] = rule
    return rule


def rule_named(name: str) -> Rule:
    return next(r for r in registry.values() if name in (r.id, r.name))


def conform(df: DataFrame) -> DataFrame:
    """The rule output columns with their types; absent details become NULL, an absent weight 1."""
    if "status" not in df.columns:
        raise ValueError("a rule has to yield a status column")
    absent = {"n": "1"}
    return df.selectExpr(*[
        f"CAST({f.name if f.name in df.columns else absent.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) "
        f"AS {f.name}" for f in RULE_OUTPUT.fields])


def verdict(skip: str, passes: str) -> str:
    """``skip`` first, then ``pass``, and ``fail`` for the rest, unknown comparisons included."""
    return case((skip, "'skip'"), (passes, "'pass'"), otherwise="'fail'")


def pass_unless(bad: str) -> str:
    return case((bad, "'fail'"), otherwise="'pass'")


def _typed(given: Mapping[str, str], names: list[str]) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in RULE_OUTPUT.fields}
    return struct({name: f"CAST({given.get(name, 'NULL')} AS {kinds[name]})" for name in names})


def unit(status: str, **details: str) -> str:
    """One judged unit as a struct of the rule output type."""
    return _typed({"n": "1", **details, "status": status}, [f.name for f in RULE_OUTPUT.fields])


def detail(**details: str) -> str:
    """The details of a unit as one struct."""
    return _typed(details, DETAILS)


def counted(bad: str, n: str = "1", **details: str) -> str:
    """A unit of a compacted rule: details exist only where it fails, so a pass costs next to nothing."""
    return struct({"status": pass_unless(bad), "n": f"CAST({n} AS bigint)", "d": case((bad, detail(**details)))})


def checked(source: DataFrame, rules: list[Rule], settings: Settings) -> DataFrame:
    """All row-by-row checks of one table in a single pass over it: ``rule_id`` and the unit columns."""
    checks = [(rule, *rule.check(settings)) for rule in rules]
    if len(checks) == 1:
        rule, applies, result = checks[0]
        return source.where(applies).selectExpr(f"{text(rule.id)} AS rule_id", f"{result} AS u").select("rule_id", "u.*")
    results = ", ".join(case((applies, struct({"rule_id": text(rule.id), "u": result})))
                        for rule, applies, result in checks)
    return source.selectExpr(f"explode(array_compact(array({results}))) AS x").select("x.rule_id", "x.u.*")


def checked_failures(source: DataFrame, rules: list[Rule], settings: Settings) -> DataFrame:
    """The failing units of :func:`checked`, each once per occurrence. Rows without any are left out before their units
    are made."""
    results, failed = [], []
    for rule in rules:
        applies, result = rule.check(settings)
        failed.append(f"(({applies}) AND ({result}).status = 'fail')")
        flat = (struct({"status": "'fail'", "n": f"({result}).n",
                        **{name: f"({result}).d.{name}" for name in DETAILS}}) if rule.compact else result)
        results.append(case((failed[-1], struct({"rule_id": text(rule.id), "u": flat}))))
    found = source.where(" OR ".join(failed))
    return found.selectExpr(f"explode(array_compact(array({', '.join(results)}))) AS x").select("x.rule_id", "x.u.*")


def checked_counts(source: DataFrame, rules: list[Rule], settings: Settings) -> DataFrame:
    """``rule_id, status, n``: the units of :func:`checked` added up in one pass, without making them."""
    statuses = ("pass", "fail", "skip")
    judged, sums, rows = [], [], []
    for i, rule in enumerate(rules):
        applies, result = rule.check(settings)
        judged += [f"CASE WHEN {applies} THEN ({result}).status END AS s{i}", f"({result}).n AS n{i}"]
        sums += [f"sum(CASE WHEN s{i} = '{status}' THEN n{i} END) AS {status}{i}" for status in statuses]
        rows += [struct({"rule_id": text(rule.id), "status": text(status), "n": f"{status}{i}"}) for status in statuses]
    total = source.selectExpr(*judged).agg(*[F.expr(e) for e in sums])
    return total.selectExpr(f"explode(array({', '.join(rows)})) AS x").select("x.*").where("n IS NOT NULL")


def packed(units: DataFrame) -> DataFrame:
    """Units with their details in one struct ``d``."""
    if "d" in units.columns:
        return units.selectExpr("status", "n", "d")
    return conform(units).selectExpr("status", "n", f"struct({', '.join(DETAILS)}) AS d")


def compacted(units: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add up passes and skips that are equal in everything; a failure keeps its weight and reappears once per
    occurrence. Takes and gives ``rule_id``, ``status``, ``n`` and the details, packed on the way in."""
    baseline = [(r.id, status, 0, message) for r in rules for status, message in r.always]
    always = (units.sparkSession.createDataFrame(baseline, "rule_id string, status string, n bigint, message string")
              .selectExpr("rule_id", "status", "n",
                          case(("message IS NOT NULL", detail(message="message"))) + " AS d"))
    fails = F.col("status") == "fail"
    totals = (units.unionByName(always).withColumn("weight", F.when(fails, F.col("n")))
              .groupBy("rule_id", "status", "d", "weight")
              .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("copies")))
    once = "sequence(1L, CASE WHEN status = 'fail' THEN copies ELSE 1L END)"
    return (totals.selectExpr("rule_id", "status", "coalesce(weight, n) AS n", "d", f"explode({once}) AS copy")
            .select("rule_id", "status", "n", "d.*"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """One union of many frames, as a balanced tree: every step is analysed anew, so depth costs."""
    while len(parts) > 1:
        pairs = [parts[i:i + 2] for i in range(0, len(parts), 2)]
        parts = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]
