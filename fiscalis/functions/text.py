"""Text functions: Column -> Column, inside whole-stage code generation."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters with marks and their plain forms, for text in the languages of the reports.
ACCENTED = "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
PLAIN = "AAAAAAEEEEIIIIOOOOOUUUUNCY"


def bound(col: Column, body: Callable[[Column], Column]) -> Column:
    """``body(col)`` with ``col`` evaluated once, whatever the mentions."""
    return F.element_at(F.transform(F.array(col), body), 1)


def pinned(col: Column) -> Column:
    """A column that the optimizer neither copies into filters nor merges into later projections.

    A filter on the result of a large expression would otherwise evaluate it again for each mention. Filters on other
    columns belong before it, since they do not move below it either.
    """
    return F.when(F.monotonically_increasing_id() >= 0, col)


def text_or_empty(col: Column) -> Column:
    """Null as the empty string: the missing value of all text columns."""
    return F.coalesce(col.cast("string"), F.lit(""))


def missing(col: Column) -> Column:
    """Empty string as null."""
    return F.nullif(col, F.lit(""))


def normalize_ws(col: Column) -> Column:
    """Runs of Unicode white space as one space, trimmed; null as empty."""
    return F.trim(F.regexp_replace(text_or_empty(col), r"(?U)[\s\x1c-\x1f]+", " "))


def fold(col: Column) -> Column:
    """Upper case without the marks of :data:`ACCENTED`."""
    return F.translate(F.upper(text_or_empty(col)), ACCENTED, PLAIN)


def _name_form(folded: Column) -> Column:
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.regexp_replace(folded, "[^A-Za-z0-9 ]+", " "), " +", " ")), F.lit(" "))
    for old, new in ((" S A ", " SA "), (" S P A ", " SPA "), (" LTDA ", " LIMITADA ")):
        plain = F.replace(plain, F.lit(old), F.lit(new))
    return F.trim(plain)


@F.pandas_udf(StringType())
def _nfkd_upper(s: pd.Series) -> pd.Series:
    return s.map(lambda v: "".join(c for c in unicodedata.normalize("NFKD", v or "") if not unicodedata.combining(c)).upper())


def normalize_name(col: Column, exact: bool = False) -> Column:
    """Name form: folded, other characters as spaces, legal suffixes unified.

    ``exact`` folds by full compatibility decomposition in Arrow batches; the default covers Latin letters natively.
    """
    return _name_form(_nfkd_upper(text_or_empty(col)) if exact else fold(col))


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix-`` and 20 hexadecimal digits over the trimmed, upper-cased parts; null, empty and zero are alike."""
    falsy = [F.when(p.cast("string").isin("0", "0.0", "false"), F.lit("")).otherwise(F.coalesce(p.cast("string"), F.lit(""))) for p in parts]
    joined = F.concat_ws("|", *[F.upper(F.trim(p)) for p in falsy])
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(joined, 256), 1, 20))


def direct_id(prefix: str, seed: Column) -> Column:
    """As :func:`stable_id` over a seed that is taken as it is."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(text_or_empty(seed), 256), 1, 20))


def clp_amounts(col: Column) -> Column:
    """Whole pesos after a ``$``, all marks between the digits dropped; beyond 18 digits a value is left out."""
    raw = F.regexp_extract_all(text_or_empty(col), F.lit(r"\$\s*([0-9][0-9.,]{2,})"), F.lit(1))
    return F.filter(F.transform(raw, lambda x: F.regexp_replace(x, r"[^0-9]", "").try_cast("bigint")), lambda x: x.isNotNull())


def max_amount(col: Column) -> Column:
    """Largest amount of a text, null without one."""
    return F.array_max(clp_amounts(col))


def name_tokens(col: Column, min_len: int, stop: tuple[str, ...], digits: bool) -> Column:
    """Distinct tokens of a name that are long enough, no stop words and, unless ``digits``, no numbers."""
    words = F.split(normalize_name(col), " ")
    keep = lambda x: (F.length(x) >= min_len) & ~x.isin(*stop) & (F.lit(True) if digits else ~x.rlike("^[0-9]+$"))
    return F.array_distinct(F.filter(words, keep))


def overlap_similarity(a: Column, b: Column, floor: int = 0) -> Column:
    """Common tokens by the smaller set; 0 without tokens or below ``floor`` common ones."""
    common = F.size(F.array_intersect(a, b))
    small = F.least(F.size(a), F.size(b))
    return F.when((small == 0) | (common < floor), F.lit(0.0)).otherwise(common / F.greatest(small, F.lit(1)))


def regex(pattern: str, dotall: bool = True) -> str:
    """A search pattern for this engine: case-insensitive beyond ASCII, and ``.`` over line ends."""
    return f"(?iu{'s' if dotall else ''}){pattern}"


def low_regex(pattern: str, dotall: bool = True) -> str:
    """The pattern for text in lower case: its letters lowered, escapes and flags as they are.

    Matching lower-case text as it is takes a fraction of the time of matching without regard to case.
    """
    lowered = re.sub(r"(\\.|\(\?[A-Za-z]+\))|([A-ZÁÉÍÓÚÜÑ])", lambda m: m[1] or m[2].lower(), pattern)
    return f"(?s){lowered}" if dotall else lowered


def any_match(low: Column, patterns: tuple[str, ...], dotall: bool = True) -> Column:
    """Whether a text in lower case matches one of the patterns."""
    return reduce(lambda a, b: a | b, [low.rlike(low_regex(p, dotall)) for p in patterns])


def count_matches(low: Column, patterns: tuple[str, ...]) -> Column:
    """How many of the patterns a text in lower case matches."""
    return reduce(lambda a, b: a + b, [low.rlike(low_regex(p)).cast("int") for p in patterns])


def section(text: Column, start: str, end: str | None = None) -> Column:
    """Text after ``start`` up to ``end`` (or to the end without it), both searched as substrings without case."""
    up = F.upper(text)
    at = F.locate(start.upper(), up)
    rest = F.substring(text, at + len(start), F.length(text))
    if end:
        stop = F.locate(end.upper(), F.upper(rest))
        rest = F.when(stop > 0, F.substring(rest, F.lit(1), stop - 1)).otherwise(rest)
    return F.when(at > 0, F.trim(rest)).otherwise(F.lit(""))
