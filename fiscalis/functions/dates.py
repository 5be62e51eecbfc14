"""Dates as ISO text at the borders: strict parsing, bounds, calendars, interval overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalis.functions.text import missing, text_or_empty

#: Spanish month names, one with two spellings.
MONTHS = (
    ("enero", 1), ("febrero", 2), ("marzo", 3), ("abril", 4), ("mayo", 5), ("junio", 6), ("julio", 7),
    ("agosto", 8), ("septiembre", 9), ("setiembre", 9), ("octubre", 10), ("noviembre", 11), ("diciembre", 12),
)


def iso_date(y: Column, m: Column, d: Column) -> Column:
    """ISO text of a day that exists, else empty."""
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
    return F.coalesce(F.when(F.try_to_date(text, "yyyy-MM-dd").isNotNull(), text), F.lit(""))


def document_date(col: Column) -> Column:
    """``DD-MM-YYYY``, ``DD/MM/YYYY`` or ``YYYY-MM-DD`` as ISO text; anything else as empty."""
    t = F.trim(text_or_empty(col))
    dmy = F.when(t.rlike(r"^[0-9]{2}(-[0-9]{2}-|/[0-9]{2}/)[0-9]{4}$"), iso_date(F.substring(t, 7, 4), F.substring(t, 4, 2), F.substring(t, 1, 2)))
    ymd = F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), iso_date(F.substring(t, 1, 4), F.substring(t, 6, 2), F.substring(t, 9, 2)))
    return F.coalesce(dmy, ymd, F.lit(""))


def export_timestamp(col: Column) -> Column:
    """Text with a ``T`` as it is, a date as midnight UTC, else null."""
    t = F.trim(text_or_empty(col))
    day = document_date(t)
    return F.when(t.contains("T"), t).when(day != "", F.concat(day, F.lit("T00:00:00+00:00")))


def month_number(name: Column) -> Column:
    out = F.lit(None).cast("int")
    for word, n in MONTHS:
        out = F.when(F.lower(name) == word, F.lit(n)).otherwise(out)
    return out


def month_end(y: Column, m: Column) -> Column:
    first = F.try_to_date(iso_date(y, m, F.lit(1)), "yyyy-MM-dd")
    return F.coalesce(F.last_day(first).cast("string"), F.lit(""))


def month_windows(spark: SparkSession, start_year: int, end_year: int, end_month: int) -> DataFrame:
    """``(window_id, date_from, date_to)``: the calendar months from January of the first year."""
    months = f"sequence(date '{start_year}-01-01', date '{end_year}-{end_month:02d}-01', interval 1 month)"
    return spark.sql(f"select explode({months}) as m").select(
        F.date_format("m", "yyyy-MM").alias("window_id"), F.col("m").cast("string").alias("date_from"), F.last_day("m").cast("string").alias("date_to")
    )


def search_day(iso_date: Column) -> Column:
    """A day as the search form takes it, dd/MM/yyyy; null where there is no day."""
    return F.date_format(F.try_to_timestamp(missing(iso_date), F.lit("yyyy-MM-dd")), "dd/MM/yyyy")


def overlaps(date_from: Column, date_to: Column, lo: str = "", hi: str = "") -> Column:
    """Closed intervals overlap; no bounds: true; no dates: false; a one-sided interval uses its other end."""
    if not lo and not hi:
        return F.lit(True)
    a, b = F.coalesce(missing(date_from), missing(date_to)), F.coalesce(missing(date_to), missing(date_from))
    inside = (a <= hi if hi else F.lit(True)) & (b >= lo if lo else F.lit(True))
    return F.coalesce(inside, F.lit(False)) & a.isNotNull()


def text_min(col: Column) -> Column:
    return F.coalesce(F.min(missing(col)), F.lit(""))


def text_max(col: Column) -> Column:
    return F.coalesce(F.max(missing(col)), F.lit(""))
