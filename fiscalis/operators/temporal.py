"""When a fact occurred: an ordered cascade of text patterns, as guarded structs under one coalesce.

Each step looks at the first match of its pattern only; if the words around it are normative (for single dates also:
point to the future) the step gives nothing and the next one is tried.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.dates import MONTHS, document_date, iso_date, month_end, month_number
from fiscalis.functions.text import bound, normalize_ws, pinned, text_or_empty
from fiscalis.rules.tables import FUTURE_WORDS, NORMATIVE_WORDS

# Patterns, precisions and confidences of the steps, and the radius of the context.
_MONTH = "|".join(m for m, _ in MONTHS)
_DAY_TEXT = rf"(\d{{1,2}})\s+de\s+({_MONTH})(?:\s+de\s+(\d{{4}}))?"
_DAY_NUM = r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
_RADIUS = 85
FIELDS = ("from", "to", "anchor", "precision", "basis", "confidence")


def _group(t: Column, pattern: str, i: int) -> Column:
    return F.regexp_extract(t, pattern, i)


def context(t: Column, match: Column, pattern: str) -> Column:
    """Lower-cased text around ``match``, the first match of a pattern."""

    def cut(at: Column) -> Column:
        left = F.greatest(at - _RADIUS, F.lit(1))
        return F.substring(t, left, F.least(F.length(t), at - 1 + F.length(match) + _RADIUS) - left + 1)

    return F.lower(bound(F.regexp_instr(t, F.lit(pattern)), cut))


def _has(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


@dataclass(frozen=True)
class Step:
    """A pattern, how its groups give the two ends, and what its context must not hold."""

    pattern: str
    precision: str
    confidence: float
    ends: Callable[[Callable[[int], Column]], tuple[Column, Column]]
    normative: bool = True
    future: bool = False
    words: tuple[str, ...] = ()

    def apply(self, t: Column, prefix: str) -> Column:
        """The step's interval; the text is searched once, the groups are read from the short match."""
        p = f"(?iuU){self.pattern}"
        banned = (NORMATIVE_WORDS if self.normative else ()) + (FUTURE_WORDS if self.future else ()) + self.words

        def judged(m: Column) -> Column:
            lo, hi = self.ends(lambda i: _group(m, p, i))
            basis = F.substring(normalize_ws(F.concat(F.lit(f"{prefix}: "), m)), 1, 220)
            found = F.when((lo != "") & (hi != ""), _interval(lo, hi, F.lit(self.precision), basis, F.lit(self.confidence)))
            return F.when((m != "") & ~bound(context(t, m, p), lambda c: _has(c, banned)), found)

        return bound(_group(t, p, 0), judged)


def _interval(lo: Column, hi: Column, precision: Column, basis: Column, confidence: Column) -> Column:
    anchor = F.when(hi != "", hi).otherwise(lo)
    return F.struct(*[c.alias(n) for n, c in zip(FIELDS, (lo, hi, anchor, precision, basis, confidence), strict=True)])


def _text_day(g, d: int, m: int, y: Column) -> Column:
    return iso_date(y, month_number(g(m)), g(d))


def _text_range(g) -> tuple[Column, Column]:
    first_year = F.when(g(3) != "", g(3)).otherwise(g(6))
    # both years are needed: a second date without one gives no range
    usable = (first_year != "") & (g(6) != "")
    return F.when(usable, _text_day(g, 1, 2, first_year)).otherwise(F.lit("")), F.when(usable, _text_day(g, 4, 5, g(6))).otherwise(F.lit(""))


def _single(g) -> tuple[Column, Column]:
    day = F.when(g(3) != "", _text_day(g, 1, 2, g(3))).otherwise(F.lit(""))
    return day, day


STEPS = (
    Step(rf"(?:per[ií]odo\s+comprendido\s+)?(?:entre|desde)\s+(?:el\s+)?{_DAY_TEXT}\s+(?:y|hasta)\s+(?:el\s+)?{_DAY_TEXT}", "RANGE", 0.95, _text_range),
    Step(
        rf"(?:entre|desde)\s+(?:el\s+)?{_DAY_NUM}\s+(?:y|hasta)\s+(?:el\s+)?{_DAY_NUM}", "RANGE", 0.95,
        lambda g: (iso_date(g(3), g(2), g(1)), iso_date(g(6), g(5), g(4))),
    ),
    Step(
        r"(?:durante|entre|en)\s+(?:los\s+)?años?\s+(\d{4})\s+(?:y|a|hasta)\s+(\d{4})", "YEAR_RANGE", 0.86,
        lambda g: (F.concat(g(1), F.lit("-01-01")), F.concat(g(2), F.lit("-12-31"))),
    ),
    Step(r"(?:durante|en)\s+(?:el\s+)?año\s+(\d{4})", "YEAR", 0.84, lambda g: (F.concat(g(1), F.lit("-01-01")), F.concat(g(1), F.lit("-12-31")))),
    Step(
        rf"(?:durante|en)\s+(?:el\s+mes\s+de\s+)?({_MONTH})\s+de\s+(\d{{4}})", "MONTH", 0.88,
        lambda g: (iso_date(g(2), month_number(g(1)), F.lit("1")), month_end(g(2), month_number(g(1)))),
    ),
    Step(rf"\bal\s+{_DAY_TEXT}", "AS_OF_DATE", 0.90, _single, future=True, words=("fecha de corte", "equival")),
)
LATE_STEPS = (
    Step(rf"(?:el\s+d[ií]a|del\s+d[ií]a|con\s+fecha|el)\s+{_DAY_TEXT}", "EXACT", 0.96, _single, future=True),
    Step(
        rf"(?:el\s+d[ií]a|del\s+d[ií]a|con\s+fecha|el)\s+{_DAY_NUM}", "EXACT", 0.96,
        lambda g: (iso_date(g(3), g(2), g(1)), iso_date(g(3), g(2), g(1))), future=True,
    ),
)


def _decree(t: Column, prefix: str) -> Column:
    """The day of a decree, if the text repeats it as a day of the year at hand."""
    p = rf"(?iuU)\bdecreto\b.{{0,100}}?\bde\s+{_DAY_TEXT}"
    return bound(_group(t, p, 0), lambda found: F.when(found != "", _repeated_day(t, found, p, prefix)))


def _repeated_day(t: Column, found: Column, p: str, prefix: str) -> Column:
    d, m, y = (_group(found, p, i) for i in (1, 2, 3))
    # the repeated day is found by collecting all such days and looking for this one
    again = F.regexp_extract_all(F.lower(t), F.lit(rf"(?iuU)\bd[ií]a\s+(\d{{1,2}}\s+de\s+(?:{_MONTH}))\s+de\s+la\s+presente\s+anualidad"), F.lit(1))
    again = F.transform(again, lambda x: F.regexp_replace(x, r"\s+", " "))
    day = iso_date(y, month_number(m), d)
    ok = (y != "") & (day != "") & F.array_contains(again, F.concat_ws(" ", d, F.lit("de"), F.lower(m)))
    basis = F.concat(F.lit(f"{prefix}: fecha del acto coincidente con día del hecho ("), d, F.lit(" de "), m, F.lit(" de "), y, F.lit(")"))
    return F.when(ok, _interval(day, day, F.lit("EXACT"), F.substring(normalize_ws(basis), 1, 220), F.lit(0.94)))


def infer(text: Column, prefix: str = "FINDING_TEXT") -> Column:
    """Interval of a text as a struct of :data:`FIELDS`, null without evidence.

    All steps need a year, so texts without four digits in a row are not searched; the first interval ends the search.
    """

    def cascade(t: Column) -> Column:
        steps = [*[s.apply(t, prefix) for s in STEPS], _decree(t, prefix), *[s.apply(t, prefix) for s in LATE_STEPS]]
        return F.when(t.rlike(r"(?U)\d{4}"), F.coalesce(*steps))

    return bound(normalize_ws(text), cascade)


def objective(raw: Column) -> Column:
    """The objective of a report: between its heading and the conclusions, or to the end."""
    return normalize_ws(F.regexp_extract(text_or_empty(raw), r"(?isuU)OBJETIVO\s+(.*?)(?:CONCLUSIONES|$(?!\n))", 1))


def with_occurrence(findings: DataFrame, text: str = "description", audit_objective: str | None = None, doc_date: str | None = None) -> DataFrame:
    """``findings`` with ``occurrence struct<from, to, anchor, precision, basis, confidence>``.

    The finding's text decides; else the objective of its audit, marked ``AUDIT_`` and at most 0.68 sure; intervals
    that begin after the document are refused; a report's date is never taken for the fact's.
    """
    limit = document_date(F.col(doc_date)) if doc_date else F.lit("")
    out = findings.withColumn("__direct", pinned(infer(F.col(text)))).withColumn("__limit", limit)
    late = lambda c: (F.col("__limit") != "") & (F.col(c)["from"] > F.col("__limit"))
    out = out.withColumn("__direct", F.when(~late("__direct"), F.col("__direct")))
    unknown = _interval(F.lit(""), F.lit(""), F.lit("UNKNOWN"), F.lit("NO_TEMPORAL_EVIDENCE"), F.lit(0.0))
    if audit_objective:
        out = out.withColumn("__audit", pinned(infer(F.col(audit_objective), "AUDIT_OBJECTIVE")))
        out = out.withColumn("__audit", F.when(~late("__audit"), F.col("__audit")))
        a = F.col("__audit")
        inherited = F.when(a.isNotNull(), _interval(a["from"], a["to"], F.concat(F.lit("AUDIT_"), a["precision"]), a["basis"], F.least(a["confidence"], F.lit(0.68))))
        out = out.withColumn("occurrence", pinned(F.coalesce("__direct", inherited, unknown))).drop("__audit")
    else:
        out = out.withColumn("occurrence", pinned(F.coalesce("__direct", unknown)))
    return out.drop("__direct", "__limit")
