"""Canonical metrics: one value per company, period, duration and metric."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import dates
from ledgermill.functions.sqltext import case, struct, text, texts
from ledgermill.functions.text import is_amended
from ledgermill.operators.facts import CONSOLIDATED_STANDARD, with_tag_types
from ledgermill.operators.restatements import FACT_KEY, restated_facts, with_verdicts
from ledgermill.settings import Derivation, Settings

GRAIN = ["cik", "period_end", "qtrs"]

COLUMNS = ["cik", "period_end", "period_key", "qtrs", "fiscal_year", "fiscal_quarter", "metric", "datatype", "value",
           "uom", "currency", "source_adsh", "source_tag", "alias_rank", "source_filed", "source_form",
           "n_candidates", "n_sources", "n_distinct_values", "is_restated", "status", "resolution_reason"]


def match_aliases(facts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Facts with the metric their tag stands for; a lookup row without a taxonomy matches any."""
    a = F.broadcast(aliases.withColumnRenamed("taxonomy", "alias_taxonomy"))
    fits = (facts["tag"] == a["tag"]) & (a["alias_taxonomy"].isNull() | (a["alias_taxonomy"] == facts["taxonomy"]))
    return facts.join(a, fits).drop(a["tag"])


def candidates(facts: DataFrame, tags: DataFrame, currencies: DataFrame, settings: Settings) -> DataFrame:
    """Facts that may supply a metric: right tag, right datatype, right unit."""
    aliases = settings.alias_map(facts.sparkSession).withColumnRenamed("datatype", "wanted").drop("statement")
    matched = match_aliases(facts.where(CONSOLIDATED_STANDARD), aliases)
    typed = with_tag_types(matched, tags, "datatype").where("datatype = wanted")
    if "filing_currency" in facts.columns:  # the fact table carries it
        in_currency = typed.withColumnRenamed("filing_currency", "currency")
    else:
        in_currency = typed.join(currencies.select("adsh", "currency"), "adsh", "left")
    in_currency = in_currency.withColumn("currency", F.coalesce("currency", F.lit("USD")))
    unit = (F.when(F.col("datatype") == "shares", F.lit("shares"))
            .when(F.col("datatype").isin("monetary", "perShare"), F.col("currency"))
            .otherwise(F.col("uom")))
    return in_currency.where((F.col("uom") == unit) | (F.col("datatype") == "pure"))


def source_counts(found: DataFrame) -> DataFrame:
    """Distinct filings and values per candidate metric. They are gathered where the candidates of a company, period and
    duration lie, for counting two distinct things at once would deal every candidate three times."""
    dealt = found.select(*GRAIN, "metric", "adsh", (F.col("value") + F.lit(0.0)).alias("value")).repartition(*GRAIN)
    return dealt.groupBy("cik", "metric", "period_end", "qtrs").agg(
        F.size(F.collect_set("adsh")).cast("long").alias("n_sources"),
        F.size(F.collect_set("value")).cast("long").alias("n_values"))


def facts_by_company(facts: DataFrame, settings: Settings) -> DataFrame:
    """The facts that may supply a metric or restate one that does, dealt by company and no wider than needed.

    The facts of a filing stay side by side on their way, so that what they share is packed to little. Everything up to
    the ratios is computed where the facts of a company lie, without a further exchange.
    """
    tags = sorted({row[1] for row in settings.alias_rows()})
    carried = [name for name in ("datatype", "tag_declared", "filing_currency") if name in facts.columns]
    dealt = facts.where(CONSOLIDATED_STANDARD).where(F.col("tag").isin(tags)).select(
        *GRAIN, "tag", "uom", "adsh", "form", "filed", "value", "version", "taxonomy", "fiscal_year", "fiscal_quarter",
        *carried).repartition("cik")
    return dealt.withColumns({"is_consolidated": F.lit(True), "is_custom_tag": F.lit(False)})


def resolve(facts: DataFrame, tags: DataFrame, currencies: DataFrame | None, restated: DataFrame | None,
            settings: Settings) -> DataFrame:
    """The reported metrics: best tag first, then the latest filing.

    Facts are dealt once, by company. Without a table of restatements the versions of a fact are judged there; the winner
    among the candidates and the counts of candidates, sources and values are windows over one metric, whose candidates
    are the copies of it in a company's filings. A table of restatements that is given is joined by fact.
    """
    near = facts_by_company(facts, settings)
    if restated is None:
        near = with_verdicts(near, settings.tolerance("restatement_rel"))
    found = candidates(near, tags, currencies, settings).withColumns({
        "amended": is_amended(F.col("form")), "_cell": F.xxhash64(*GRAIN, "metric")})  # decides most comparisons
    # first wins: low priority number, late filing, amendment, high accession number, late taxonomy version
    order = [F.asc("priority"), *[F.col(name).desc_nulls_last() for name in (
        "filed", "amended", "adsh", "version", "value", "fiscal_year", "fiscal_quarter", "datatype", "uom",
        "currency", "tag", "form")]]
    cell = Window.partitionBy("_cell", *GRAIN, "metric")
    picked = (found.withColumn("_rank", F.row_number().over(cell.orderBy(*order)))
              .withColumns({
                  "n_candidates": F.count(F.lit(1)).over(cell),
                  "n_sources": F.size(F.collect_set("adsh").over(cell)).cast("long"),
                  # adding zero makes one value of both zeros
                  "n_distinct_values": F.size(F.collect_set(F.col("value") + F.lit(0.0)).over(cell)).cast("long")})
              .where("_rank = 1"))
    if restated is None:
        classified = picked
    else:
        verdicts = restated_facts(restated).select(*FACT_KEY, "classification")
        classified = picked.join(verdicts.hint("shuffle_hash"), FACT_KEY, "left")
    kind = F.col("classification")
    reason = F.concat(
        F.lit("alias_priority="), F.col("priority").cast("string"), F.lit(";authoritative="),
        F.when(F.col("n_sources") > 1, F.lit("latest_filed")).otherwise(F.lit("single_source")),
        F.when(kind == "restatement", F.lit(";restated")).when(kind == "rounding_diff", F.lit(";rounding_diff"))
        .otherwise(F.lit("")))
    return classified.select(  # the key is made for the winners only, not carried through the sorts
        *GRAIN, dates.period_key(F.col("period_end"), F.col("qtrs")).alias("period_key"), "fiscal_year", "fiscal_quarter", "metric", "datatype", "value", "uom", "currency",
        F.col("adsh").alias("source_adsh"), F.col("tag").alias("source_tag"), F.col("priority").alias("alias_rank"),
        F.col("filed").alias("source_filed"), F.col("form").alias("source_form"),
        "n_candidates", "n_sources", "n_distinct_values",
        F.coalesce(kind == "restatement", F.lit(False)).alias("is_restated"),
        F.lit("reported").alias("status"), reason.alias("resolution_reason"),
    ).select(*COLUMNS)


# ---- derived metrics ----------------------------------------------------------------------------------------

_CELL = ["value", "uom", "currency", "source_adsh", "source_filed", "source_form", "is_restated"]
_REST = [name for name in COLUMNS if name not in GRAIN]


def metric_cell(metric: str, columns: list[str], where: str = "TRUE") -> str:
    """Aggregate: the struct of ``columns`` of the single row of ``metric`` in a group."""
    return f"max(CASE WHEN metric = {text(metric)} AND {where} THEN struct({', '.join(columns)}) END)"


def _derived_cell(rule: Derivation) -> str:
    """The cell of a derived metric from the cells of its terms; NULL when a required term is absent."""
    names = [name for _, name in rule.terms]
    amounts = [f"coalesce({name}.value, 0D)" if name in rule.optional else f"{name}.value" for name in names]
    value = " ".join(f"{'+' if sign > 0 else '-'} {amount}" for (sign, _), amount in zip(rule.terms, amounts, strict=True))
    present = f"array_compact(array({', '.join(names)}))"
    latest = (f"array_max(transform(filter({present}, c -> c.source_filed IS NOT NULL), "
              "c -> struct(c.source_filed, c.source_adsh, c.source_form)))")
    cell = struct({
        "value": value,
        "uom": f"array_min(transform({present}, c -> c.uom))",
        "currency": f"array_min(transform({present}, c -> c.currency))",
        "source_adsh": f"{latest}.source_adsh", "source_filed": f"{latest}.source_filed",
        "source_form": f"{latest}.source_form",
        "is_restated": f"exists({present}, c -> c.is_restated)",
    })
    return case((f"({value}) IS NOT NULL", cell))


def _side_by_side(settings: Settings) -> list[str]:
    """Aggregates of one period: what derived rows take over from it, and a cell for each metric the rules involve."""
    involved = list(dict.fromkeys(name for rule in settings.derivations for name in
                                  [rule.metric, *[term for _, term in rule.terms]]))
    return [*(f"max(CASE WHEN metric IN ({texts(involved)}) THEN {name} END) AS {name}"
              for name in ("period_key", "fiscal_year", "fiscal_quarter")),
            *(f"{metric_cell(name, _CELL)} AS {name}" for name in involved)]


def _filled(wide: DataFrame, settings: Settings) -> tuple[DataFrame, str]:
    """Rows of periods with the cells that rules fill, and the expression for the array of their derived rows.

    Each rule fills its column where it is empty, so later rules see what earlier ones filled.
    """
    filled = []
    for i, rule in enumerate(settings.derivations):
        others = [name for name in wide.columns if name != rule.metric]
        wide = wide.selectExpr("*", f"{case((f'{rule.metric} IS NULL', _derived_cell(rule)))} AS new_{i}",
                               "CAST(size(array_distinct(array_compact(array("
                               + ", ".join(f"{name}.source_adsh" for _, name in rule.terms)
                               + f")))) AS bigint) AS sources_{i}")
        wide = wide.selectExpr(*others, f"new_{i}", f"sources_{i}",
                               f"coalesce({rule.metric}, new_{i}) AS {rule.metric}")
        values = {"metric": text(rule.metric), "datatype": text(settings.metrics[rule.metric]["datatype"]),
                  "source_tag": text(f"derived:{rule.formula}"), "resolution_reason": text(rule.reason),
                  "n_sources": f"sources_{i}", "alias_rank": "99", "n_candidates": "0L", "n_distinct_values": "1L",
                  "status": "'derived'", **{name: f"new_{i}.{name}" for name in _CELL}}
        filled.append(case((f"new_{i} IS NOT NULL", struct({name: values.get(name, name) for name in _REST}))))
    return wide, f"array_compact(array({', '.join(filled)}))" if filled else "array()"


def derive(reported: DataFrame, settings: Settings) -> DataFrame:
    """Rows for metrics that were not reported but follow from others.

    The metrics involved are laid side by side once per period. Only filled cells become rows.
    """
    wide, rows = _filled(reported.groupBy(*GRAIN).agg(*[F.expr(e) for e in _side_by_side(settings)]), settings)
    rows = f"CAST({rows} AS {_row_type(reported)})"
    return wide.selectExpr(*GRAIN, f"explode({rows}) AS d").selectExpr(*GRAIN, "d.*").select(*COLUMNS)


def fact_normalized(reported: DataFrame, settings: Settings) -> DataFrame:
    """Reported and derived metrics together, in one pass: the reported ones of a period, at most one per metric, are
    gathered beside the cells that the derived ones follow from."""
    periods = reported.groupBy(*GRAIN).agg(*[F.expr(e) for e in _side_by_side(settings)],
                                           F.expr(f"collect_list(struct({', '.join(_REST)})) AS _reported"))
    wide, rows = _filled(periods, settings)
    rows = f"concat(_reported, CAST({rows} AS {_row_type(reported)}))"
    return wide.selectExpr(*GRAIN, f"explode({rows}) AS d").selectExpr(*GRAIN, "d.*").select(*COLUMNS)


def _row_type(reported: DataFrame) -> str:
    return reported.selectExpr(f"array(struct({', '.join(_REST)})) AS rows").schema["rows"].dataType.simpleString()


def metrics_wide(normalized: DataFrame, settings: Settings) -> DataFrame:
    """One row per company, period end and duration; a value and a status column per metric."""
    newest = "max(CASE WHEN source_filed IS NOT NULL THEN struct(source_filed, source_adsh) END).source_adsh"
    columns = ["max(fiscal_year) AS fiscal_year", "max(fiscal_quarter) AS fiscal_quarter", f"{newest} AS adsh",
               "min(currency) AS currency"]
    for name in settings.metric_names:
        hit = f"CASE WHEN metric = {text(name)} THEN"
        columns += [f"max({hit} value END) AS {name}", f"max({hit} status END) AS {name}_status"]
    return normalized.groupBy(*GRAIN).agg(*[F.expr(column) for column in columns])
