"""Rule sets of one's own: labelled patterns over a text column, as the engine's own rules are evaluated."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.text import any_match, count_matches, pinned, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A label, its patterns (any of them tells) and a weight."""

    label: str
    patterns: tuple[str, ...]
    weight: int = 1


@dataclass(frozen=True)
class RuleSet:
    """Rules in order; evaluated as expressions, so a text is classified in one narrow stage."""

    name: str
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def with_rule(self, label: str, *patterns: str, weight: int = 1) -> RuleSet:
        return RuleSet(self.name, (*self.rules, Rule(label, patterns, weight)))

    def labels(self, low: Column) -> Column:
        """Labels with a pattern that matches a text in lower case, in order."""
        return F.array_compact(F.array(*[F.when(any_match(low, r.patterns), F.lit(r.label)) for r in self.rules]))

    def hits(self, low: Column) -> Column:
        """How many patterns of each rule match, in order."""
        return F.array(*[count_matches(low, r.patterns) for r in self.rules])

    def apply(self, df: DataFrame, text: str, out: str | None = None) -> DataFrame:
        """``df`` with ``struct<labels, weight, patterns>``: labels, the greatest weight (0 without any), patterns that match."""
        low = F.col("__low")
        own = df.withColumn("__low", pinned(F.lower(text_or_empty(F.col(text))))).withColumn("__hits", pinned(self.hits(low)))
        hit = [F.col("__hits")[i] > 0 for i in range(len(self.rules))]
        labels = F.array_compact(F.array(*[F.when(h, F.lit(r.label)) for h, r in zip(hit, self.rules, strict=True)]))
        weight = F.greatest(F.lit(0), *[F.when(h, F.lit(r.weight)).otherwise(F.lit(0)) for h, r in zip(hit, self.rules, strict=True)])
        total = F.aggregate("__hits", F.lit(0), lambda a, x: a + x)
        return own.withColumn(out or self.name, F.struct(labels.alias("labels"), weight.alias("weight"), total.alias("patterns"))).drop("__low", "__hits")

    def table(self, spark) -> DataFrame:
        """``(rule_set, position, label, weight, pattern)``: the rules as rows, for audit."""
        rows = [(self.name, i, r.label, r.weight, p) for i, r in enumerate(self.rules) for p in r.patterns]
        return spark.createDataFrame(rows, "rule_set string, position int, label string, weight int, pattern string")


def from_pairs(name: str, pairs: tuple[tuple[str, tuple[str, ...]], ...]) -> RuleSet:
    """A rule set of ``(label, patterns)`` as the engine's tables hold them."""
    return RuleSet(name, tuple(Rule(label, patterns) for label, patterns in pairs))


def alert_catalogue(spark, source_url: str) -> DataFrame:
    """The alert catalogue without its patterns: ``pattern_code, pattern_label, process, origin, source_url``."""
    from fiscalis.rules.tables import ALERT_PATTERNS

    rows = [(code, label, process, origin, source_url) for code, label, process, origin, _ in ALERT_PATTERNS]
    return spark.createDataFrame(rows, "pattern_code string, pattern_label string, process string, origin string, source_url string")
