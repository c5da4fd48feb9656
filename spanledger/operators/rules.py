"""Declared rules of the models as data, checked in one aggregate a model, or while the model is written.

A rule names a layer, a model, a kind, columns, accepted values, a filter and
a severity. Rules of one model are compiled into one aggregate; where a layer
declares them for each chain, that aggregate is grouped by chain and chains
without a row are reported too. A rule that has seen no row has not passed.

While a model is written, the same counts are taken from the rows on their way
to the files (``observed``), so a report of a stored model reads it no more.
Only uniqueness needs the rows side by side: it reads the key columns alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.model_rules import LAYERS, MODEL_RULES, ONE_CHAIN_ONLY, PER_CHAIN
from spanledger.operators.quality import rule_report

REPORT = "model string, rule string, severity string, failures bigint, checked bigint, passed boolean"


@dataclass(frozen=True)
class Rule:
    """One declared check. ``chains``: the chains it is declared for, or none where the model is one for all."""

    layer: str
    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    where: str | None = None
    severity: str = "error"
    chains: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind} {', '.join(self.columns)}"

    def violated(self) -> Column:
        """Whether a row breaks a not-null or accepted-values rule."""
        column = F.col(self.columns[0])
        broken = column.isNull() if self.kind == "not_null" else ~column.isin(list(self.values))
        return broken if self.where is None else broken & F.expr(self.where)


def declared_rules() -> list[Rule]:
    """All declared rules, one for each model and column (not one for each chain)."""
    out = []
    for layer, models in LAYERS.items():
        every = tuple(sorted(C.SUPPORTED_CHAINS)) if layer in PER_CHAIN else ()
        for model in models:
            told = MODEL_RULES[model]
            kinds = [("not_null", (c,), ()) for c in told["not_null"]]
            kinds += [("accepted_values", (c,), tuple(v)) for c, v in told.get("accepted", {}).items()]
            kinds += [("unique", tuple(c), ()) for c in told.get("unique", [])]
            out += [Rule(layer, model, k, c, v, chains=tuple(ONE_CHAIN_ONLY.get((model, c[0]), every))) for k, c, v in kinds]
    return out


def of_model(model: str, rules: list[Rule] | None = None) -> list[Rule]:
    return [r for r in (declared_rules() if rules is None else rules) if r.model == model]


def _with_severity(report: DataFrame, rules: list[Rule], model: str, *by: str) -> DataFrame:
    pairs = [F.lit(x) for r in rules for x in (r.name, r.severity)]
    severity = F.element_at(F.create_map(*pairs), F.col("rule"))
    return report.select(*by, F.lit(model).alias("model"), "rule", severity.alias("severity"), "failures", "checked", "passed")


def _unique(df: DataFrame, rule: Rule, by: list[str], expected: DataFrame | None) -> DataFrame:
    """Duplicate keys as a rule report; an empty model does not pass."""
    kept = df if rule.where is None else df.filter(rule.where)
    keys = list(dict.fromkeys([*by, *rule.columns]))
    counted = kept.dropna(subset=list(rule.columns)).groupBy(*keys).agg(F.count("*").alias("copies"))
    found = counted.groupBy(*by).agg(F.count_if(F.col("copies") > 1).alias("failures"), F.sum("copies").alias("checked"))
    if expected is not None:
        found = expected.join(found, by, "left")
    failures, checked = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("failures", "checked"))
    passed = (failures == 0) & (checked > 0)
    return found.select(*by, F.lit(rule.name).alias("rule"), failures.alias("failures"), checked.alias("checked"), passed.alias("passed"))


def report(df: DataFrame, model: str, rules: list[Rule] | None = None) -> DataFrame:
    """Verdicts of a model's rules over all its rows: ``model``, ``rule``, ``severity``, ``failures``, ``checked``, ``passed``."""
    rules = of_model(model, rules)
    row_rules = {r.name: r.violated() for r in rules if r.kind != "unique"}
    parts = [rule_report(df, row_rules)] if row_rules else []
    parts += [_unique(df, r, [], None) for r in rules if r.kind == "unique"]
    return _with_severity(reduce(DataFrame.unionByName, parts), rules, model)


def report_by_chain(df: DataFrame, model: str, rules: list[Rule] | None = None) -> DataFrame:
    """The same with a verdict for each chain a rule is declared for, in the column ``chain``."""
    rules = of_model(model, rules)
    by = PER_CHAIN[rules[0].layer]
    pairs = [(c, r.name) for r in rules for c in r.chains]
    wanted = df.sparkSession.createDataFrame(pairs, f"{by} string, rule string")
    expected = wanted.select(by).distinct()
    row_rules = {r.name: r.violated() for r in rules if r.kind != "unique"}
    parts = [rule_report(df, row_rules, by, expected)] if row_rules else []
    parts += [_unique(df, r, [by], expected) for r in rules if r.kind == "unique"]
    found = reduce(DataFrame.unionByName, parts).join(wanted, [by, "rule"], "left_semi")
    return _with_severity(found, rules, model, by).withColumnRenamed(by, "chain")


class Observed:
    """The counts of a model's rules, taken while its rows are written.

    ``rows`` is what to write. The counts are exact where nothing but the
    write follows ``rows``: its tasks count once each, also when they run
    again after a lost executor.
    """

    def __init__(self, df: DataFrame, model: str, rules: list[Rule] | None = None):
        self.model, self.rules = model, of_model(model, rules)
        self.row_rules = [r for r in self.rules if r.kind != "unique"]
        self.observation = Observation(f"rules of {model}")
        counts = [F.count_if(r.violated()).alias(f"r{i}") for i, r in enumerate(self.row_rules)]
        self.rows = df.observe(self.observation, F.count(F.lit(1)).alias("checked"), *counts)
        self.observations = [self.observation]

    def add(self, other: Observed) -> None:
        """Take in the counts of a further part of the same model."""
        self.observations += other.observations

    def report(self, spark: SparkSession, stored: DataFrame) -> DataFrame:
        """The report of ``report``; waits for the write. Of the stored model only the columns of unique keys are read."""
        parts = [o.get for o in self.observations]
        seen = {name: sum(part[name] for part in parts) for name in parts[0]}
        checked = seen["checked"]
        rows = [(self.model, r.name, r.severity, seen[f"r{i}"], checked, seen[f"r{i}"] == 0 and checked > 0) for i, r in enumerate(self.row_rules)]
        told = spark.createDataFrame(rows, REPORT)
        unique = [_unique(stored, r, [], None) for r in self.rules if r.kind == "unique"]
        return reduce(DataFrame.unionByName, [told, *(_with_severity(u, self.rules, self.model) for u in unique)])


def found_rows(rows: DataFrame, name: str, severity: str = "error") -> DataFrame:
    """A check that returns offending rows, as one verdict: it passes where there is none."""
    counted = rows.agg(F.count("*").alias("failures"))
    return counted.select(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), "failures", (F.col("failures") == 0).alias("passed"))


