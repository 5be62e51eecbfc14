"""Interactive filters over the marts; every parameter is optional."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.dates import overlaps


def contains(q: str, *columns: str) -> Column:
    """Text search without case over joined columns."""
    return F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(q.lower()))


def precision_is(col: Column, precision: str) -> Column:
    """Equality, but ``AUDIT_`` stands for all inherited precisions."""
    return col.startswith("AUDIT_") if precision == "AUDIT_" else col == precision


def organizations(df: DataFrame, q: str = "", region: str = "") -> DataFrame:
    out = df.filter(contains(q, "name")) if q else df
    return out.filter(F.col("region") == region) if region else out


def providers(df: DataFrame, q: str = "", min_score: int = 0) -> DataFrame:
    out = df.filter(contains(q, "name")) if q else df
    return out.filter(F.col("exposure_score") >= min_score)


def temporal(df: DataFrame, lo: str = "", hi: str = "", precision: str = "", date_from: str = "occurrence.from", date_to: str = "occurrence.to", precision_col: str = "occurrence.precision") -> DataFrame:
    out = df.filter(overlaps(F.col(date_from), F.col(date_to), lo, hi))
    return out.filter(precision_is(F.col(precision_col), precision)) if precision else out


def findings(df: DataFrame, q: str = "", columns: tuple[str, ...] = ("description",), min_penal: int = 0, lo: str = "", hi: str = "", precision: str = "") -> DataFrame:
    out = df.filter(contains(q, *columns)) if q else df
    out = out.filter(F.col("penal_score") >= min_penal) if min_penal else out
    return temporal(out, lo, hi, precision) if lo or hi or precision else out


def enforcement(df: DataFrame, kind: str = "", lo: str = "", hi: str = "") -> DataFrame:
    """Text ranges on the action date: an empty date passes an upper bound and fails a lower one."""
    out = df.filter(F.col("enforcement_type") == kind) if kind else df
    out = out.filter(F.col("action_date") >= lo) if lo else out
    return out.filter(F.col("action_date") <= hi) if hi else out


def alerts(df: DataFrame, pattern: str = "", min_score: int = 0) -> DataFrame:
    out = df.filter(F.col("pattern_code") == pattern) if pattern else df
    return out.filter(F.col("score") >= min_score)


def watch(df: DataFrame, kind: str = "", status: str = "") -> DataFrame:
    out = df.filter(F.col("watch_type") == kind) if kind else df
    return out.filter(F.col("status") == status) if status else out


def penal(df: DataFrame, lo: str = "", hi: str = "", precision: str = "", relevance: str = "") -> DataFrame:
    """Cases by time, precision and relevance."""
    out = temporal(df, lo, hi, precision, "occurrence_date_from", "occurrence_date_to", "occurrence_date_precision")
    return out.filter(F.col("penal_relevance") == relevance) if relevance else out
