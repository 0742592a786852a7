"""Small scalar expressions with the semantics that the operators need."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, functions as F


def truthy(text: Column) -> Column:
    """The string, null if it is empty."""
    return F.nullif(text, F.lit(""))


def either(*texts: Column) -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*(truthy(t) for t in texts))


def rounded(value: Column) -> Column:
    """Nearest integer, halves up (also below zero)."""
    return F.floor(value + 0.5)


def ratio(part: Column, whole: Column, none: float | None = None) -> Column:
    """part / whole with three decimals; ``none`` where there is nothing to divide by."""
    return F.when(whole > 0, F.round(F.try_divide(part.cast("double"), whole.cast("double")), 3)).otherwise(F.lit(none).cast("double"))


def to_fixed(value: float, digits: int) -> str:
    """A double's exact decimal value, rounded half away from zero: for files, not for columns."""
    return str(Decimal(value).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def compact(*items: Column) -> Column:
    """Array of the items that are not null, in order."""
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def joined(array: Column, by: str = ", ") -> Column:
    return F.array_join(F.coalesce(array, F.array().cast("array<string>")), by)


def strip_version(record_id: Column) -> Column:
    """The id without one trailing version or seed suffix."""
    return F.regexp_replace(record_id, r"_[vs][0-9]+\z", "")


def safe_path(path: Column) -> Column:
    """Whether a path is relative and stays below its root."""
    p = F.replace(F.coalesce(path, F.lit("")), F.lit("\\"), F.lit("/"))
    return (p != "") & ~p.rlike(r"\A(/|[A-Za-z]:)") & ~p.rlike(r"(\A|/)\.\.(/|\z)")


def html_escaped(text: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def closest(needle: Column, candidates: Column, most: int = 2) -> Column:
    """The nearest candidate by edit distance without case, first of ties; at most ``most`` edits, 1 for needles of up to three characters."""
    cap = F.when(F.length(needle) <= 3, F.lit(min(1, most))).otherwise(F.lit(most))
    scored = F.transform(candidates, lambda c, i: F.struct(F.levenshtein(F.lower(needle), F.lower(c)).alias("d"), i.alias("i"), c.alias("c")))
    return F.when(truthy(needle).isNotNull(), F.array_min(F.filter(scored, lambda s: s["d"] <= cap))["c"])


def row_hash(body: Column, schema_version: Column, build_config: Column, project_fingerprint: Column) -> Column:
    """Cache key of an entry: its four inputs with NUL between them."""
    parts = [F.coalesce(x, F.lit("")) for x in (body, schema_version, build_config, project_fingerprint)]
    return F.sha2(F.concat_ws("\0", *parts), 256)
