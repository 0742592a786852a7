"""Canonical JSON and hashes over watched fields, as column expressions over VARIANT."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, functions as F

TOKENS = r'"(?:[^"\\]++|\\.)*+"|-?Infinity|NaN|-?[0-9][-+.0-9eE]*+|[^"0-9IN-]++|.'


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _part(text: Column, group: int) -> Column:
    return F.regexp_extract(text, r"\A([0-9]+)\.([0-9]+)(?:E(-?[0-9]+))?\z", group)


def _zeros(n: Column) -> Column:
    return F.repeat(F.lit("0"), n.cast("int"))


def _written(sign: Column, digits: Column, point: Column) -> Column:
    """0.<digits> times ten to the ``point``: plain from 1e-6 up to below 1e21, else with an exponent."""
    n = F.length(digits)
    fraction = F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise("")
    exponent = F.concat(F.when(point > 0, "+").otherwise("-"), F.abs(point - 1).cast("string"))
    return F.concat(
        sign,
        F.when((n <= point) & (point <= 21), F.concat(digits, _zeros(point - n)))
        .when((point > 0) & (point <= 21), F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n)))
        .when((point > -6) & (point <= 0), F.concat(F.lit("0."), _zeros(-point), digits))
        .otherwise(F.concat(F.substring(digits, F.lit(1), F.lit(1)), fraction, F.lit("e"), exponent)),
    )


def number_text(value: Column) -> Column:
    """The shortest decimal text that gives the double again; null for what isn't finite.

    The digits that a cast gives may be more than it takes, so each shorter rounding is tried.
    """

    def of(text: Column) -> Column:
        both = F.concat(_part(text, 1), _part(text, 2))
        exponent = F.coalesce(F.nullif(_part(text, 3), F.lit("")).cast("int"), F.lit(0))
        digits = F.regexp_replace(F.regexp_replace(both, r"\A0+", ""), r"0+\z", "")
        point = F.length(_part(text, 1)) + exponent - F.length(F.regexp_extract(both, r"\A0*", 0))
        return _let(F.struct(digits.alias("d"), point.cast("int").alias("p")), shortest)

    tens = F.array(*(F.lit(10**k).cast("bigint") for k in range(19)))

    def shortest(x: Column) -> Column:
        n = F.length(x["d"])

        def cut(k: Column) -> Column:
            """The value with its last k digits rounded away: q times ten to the e."""
            ten = F.get(tens, k)
            return F.struct(F.floor((x["d"].cast("decimal(20,0)") + F.when(k > 0, ten / 2).otherwise(0).cast("decimal(20,0)")) / ten.cast("decimal(20,0)")).cast("bigint").alias("q"), (x["p"] - n + k).alias("e"))

        cuts = F.filter(F.transform(F.sequence(n - 1, F.lit(0), F.lit(-1)), cut), lambda c: F.concat(c["q"].cast("string"), F.lit("E"), c["e"].cast("string")).cast("double") == F.abs(value))
        # no two decimals of up to 15 digits are one double of the normal range, so such digits are the shortest
        sign, plain = F.when(value < 0, "-").otherwise(""), (n <= 15) & (F.abs(value) >= F.lit(sys.float_info.min))
        searched = _let(F.get(cuts, F.lit(0)), lambda c: _written(sign, F.regexp_replace(c["q"].cast("string"), r"0+\z", ""), c["e"] + F.length(c["q"].cast("string"))))
        return F.when(plain, _written(sign, x["d"], x["p"])).otherwise(searched)

    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    # a cast rounds whole numbers of over 17 digits once more than needed, so theirs come from the integer
    whole = (F.abs(value) < 9e18) & (F.floor(value) == value)
    text = F.when(whole, F.concat(F.abs(value).cast("bigint").cast("string"), F.lit(".0"))).otherwise(F.abs(value).cast("string"))
    return F.when(~finite, "null").when(value == 0, "0").otherwise(_let(text, of))


def canonical(text: Column) -> Column:
    """JSON text without blanks, keys in order of their UTF-16 units, numbers as doubles are written; null if it isn't JSON.

    The parser of VARIANT sorts keys and takes blanks out; what is left is to write each number anew.
    """
    plain = F.to_json(F.try_parse_json(text))

    def token(x: Column) -> Column:
        lower = x
        for c in "ABCDEF":  # control characters are written with lower-case digits
            lower = F.regexp_replace(lower, rf"((?<!\\)(?:\\\\)*\\u00[01]){c}", f"$1{c.lower()}")
        return F.when(x.rlike(r"\A-?[0-9]"), number_text(x.cast("double"))).when(x.rlike(r"\A(-?Infinity|NaN)\z"), "null").when(x.contains("\\u00"), lower).otherwise(x)

    return F.array_join(F.transform(F.regexp_extract_all(plain, F.lit(TOKENS), F.lit(0)), token), "")


def _quoted(text: Column) -> Column:
    """A string as JSON, null for null."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNull(), "null").otherwise(F.substring(listed, F.lit(2), F.length(listed) - 2))


def at_path(value: Column, path: Column) -> Column:
    """The VARIANT at a dotted path of nested objects; null where it ends early or isn't an object."""
    return F.aggregate(F.split(path, r"\."), value, lambda found, key: F.try_element_at(found.try_cast("map<string,variant>"), key))


def watch_hash(entry: Column, fields: Column, schema_version: Column) -> Column:
    """SHA-256 over the watched fields of an entry (JSON text) and the schema version, in canonical form; other fields and the body don't enter."""
    parsed = F.try_parse_json(entry)
    one = lambda f: F.concat(_quoted(f), F.lit(":"), F.coalesce(F.to_json(at_path(parsed, f)), F.lit("null")))
    watched = F.array_join(F.transform(F.array_distinct(F.coalesce(fields, F.array().cast("array<string>"))), one), ",")
    return F.sha2(canonical(F.concat(F.lit('{"schema_version":'), _quoted(schema_version), F.lit(',"watched":{'), watched, F.lit("}}"))), 256)
