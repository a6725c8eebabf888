"""Normalisers of names, identifiers and keys, as Column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def matcher_name(x: Column | str) -> Column:
    """Lower case, white space single; null is empty."""
    return F.coalesce(strip(F.regexp_replace(F.lower(_c(x)), r"(?U)\s+", " ")), F.lit(""))


def website(x: Column | str) -> Column:
    """Host and path: no scheme, www., query, fragment or trailing slashes."""
    bare = F.regexp_replace(F.regexp_replace(strip(F.lower(_c(x))), r"^\s*https?://", ""), r"^www\.", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?s)\?.*$", ""), r"(?s)#.*$", "")
    return F.coalesce(strip(F.regexp_replace(bare, "/+$", "")), F.lit(""))


def phone(x: Column | str) -> Column:
    """The last ten digits; empty with fewer."""
    digits = F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"\D", "")
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10))).otherwise("")


def wikidata(x: Column | str) -> Column:
    up = F.upper(strip(_c(x)))
    return F.when(up.rlike("^Q[1-9][0-9]*$"), up).otherwise("")


IDENTIFIERS: dict[str, Callable[[Column | str], Column]] = {"website": website, "phone": phone, "wikidata": wikidata}


def identifier(kind: str, x: Column | str) -> Column:
    if kind not in IDENTIFIERS:
        raise ValueError(f"unknown identifier kind {kind!r}")
    return IDENTIFIERS[kind](x)


def market_name(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9 ]+", " "), " +", " "))


def tokens(x: Column | str) -> Column:
    return F.filter(F.split(_c(x), " "), lambda t: t != "")


def token_subset(a: Column | str, b: Column | str) -> Column:
    """Either token set holds the other; both have tokens."""
    x, y = tokens(a), tokens(b)
    return (F.size(x) > 0) & (F.size(y) > 0) & ((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0))


def without_last_of(x: Column | str, drop: list[str]) -> Column:
    """A name without its last token if that is one of drop and not all there is."""
    t = tokens(x)
    last = F.try_element_at(t, F.lit(-1))
    return F.array_join(F.when((F.size(t) > 1) & last.isin(drop), F.slice(t, 1, F.size(t) - 1)).otherwise(t), " ")


def osm_key(kind: Column | str, number: Column | str) -> Column:
    return F.concat(F.lit("osm:"), F.left(F.lower(_c(kind)), F.lit(1)), _c(number).cast("long").cast("string"))


def ovt_key(number: Column | str) -> Column:
    return F.concat(F.lit("ovt:"), _c(number))


def title(x: Column | str, n: Column) -> Column:
    return F.concat(F.initcap(F.replace(_c(x), F.lit("_"), F.lit(" "))), F.lit(" (N = "), n.cast("string"), F.lit(")"))


def path(x: Column | str) -> Column:
    return F.when(F.size(_c(x)) > 0, F.array_join(_c(x), " > "))


def group_key(*parts: Column | str) -> Column:
    return F.concat_ws("\x1f", *[_c(p) for p in parts])
