"""Urls as expressions: references resolved against their page, parts, hashes that a text names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalis.functions.identity import AUDIT_PATH
from fiscalis.functions.text import bound, text_or_empty

_SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*:"
#: Fixed value: the legacy parameter with the 32 digits of an audit.
LEGACY_ID = r"(?i)docIdcm[^0-9a-f]{0,30}([0-9a-f]{32})"


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    seg = F.split(path, "/")
    fold = F.aggregate(
        seg,
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))).when(s == ".", kept).otherwise(F.concat(kept, F.array(s))),
    )
    last = F.element_at(seg, -1)
    clean = F.concat(F.array_join(fold, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), clean).otherwise(path)


def resolve(base: Column, reference: Column) -> Column:
    """``reference`` resolved against the absolute url ``base`` by RFC 3986; an empty one is the base itself."""

    def whole(ref: Column) -> Column:
        root = F.regexp_extract(base, rf"^({_SCHEME}(?://[^/?#]*)?)", 1)
        path = F.regexp_extract(base, rf"^{_SCHEME}(?://[^/?#]*)?([^?#]*)", 1)
        head, tail = F.regexp_extract(ref, r"^([^?#]*)", 1), F.regexp_extract(ref, r"(?s)^[^?#]*(.*)$", 1)
        merged = F.when(head.startswith("/"), head).otherwise(F.concat(F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)), head))
        return (
            F.when(ref == "", base)
            .when(ref.rlike(f"^{_SCHEME}"), ref)
            .when(ref.startswith("//"), F.concat(F.regexp_extract(base, f"^({_SCHEME})", 1), ref))
            .when(ref.startswith("?"), F.concat(root, path, ref))
            .when(ref.startswith("#"), F.concat(F.substring_index(base, "#", 1), ref))
            .otherwise(F.concat(root, _without_dots(merged), tail))
        )

    return bound(F.trim(text_or_empty(reference)), whole)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_or_empty(url), rf"^{_SCHEME}//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), rf"^{_SCHEME}//[^/?#]*([^?#]*)", 1)


def query_keys(url: Column) -> Column:
    """Names of the parameters with a value, in lower case, joined by spaces."""
    q = F.regexp_extract(text_or_empty(url), r"\?([^#]*)", 1)
    used = F.filter(F.split(q, "&"), lambda x: x.rlike("=.+"))
    return F.lower(F.array_join(F.transform(used, lambda x: F.substring_index(x, "=", 1)), " "))


def text_hashes(text: Column) -> Column:
    """Sorted distinct audit hashes that a text names, by path or by the legacy parameter, in lower case."""
    t = text_or_empty(text)
    found = F.array_union(F.regexp_extract_all(t, F.lit(AUDIT_PATH), F.lit(1)), F.regexp_extract_all(t, F.lit(LEGACY_ID), F.lit(1)))
    return F.array_sort(F.array_distinct(F.transform(found, F.lower)))
