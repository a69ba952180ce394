"""Text functions as Catalyst expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Single characters that have another plain form, and that form; made by rule.
_FROM = [c for c in map(chr, [*range(0xC0, 0x180), *range(0xFF01, 0xFF5F)]) if len(unicodedata.normalize("NFKD", c)[0]) == 1 and unicodedata.normalize("NFKD", c) != c]
PLAIN_FROM = "".join(_FROM) + "ºª²³¹"
PLAIN_TO = "".join(unicodedata.normalize("NFKD", c)[0] for c in _FROM) + "oa231"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once and not written out again at each of its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def plain(c: Column) -> Column:
    """Lower case without accents and compatibility forms."""
    return F.lower(F.translate(F.regexp_replace(c, r"\p{Mn}", ""), PLAIN_FROM, PLAIN_TO))


def norm(c: Column) -> Column:
    """Plain words and @ signs with single blanks between; null becomes empty."""
    words = F.regexp_replace(F.replace(plain(F.coalesce(c, F.lit(""))), F.lit("@"), F.lit(" @ ")), "[^a-z0-9@]+", " ")
    return F.trim(words)


def tokens(normal: Column) -> Column:
    return F.regexp_extract_all(normal, F.lit("[a-z0-9]+"), 0)


def squash(c: Column) -> Column:
    """Lower case, outer blanks off, inner blanks single; accents stay."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"\s+", " ")


def has_phrase(normal: Column, phrase: str) -> Column:
    return F.concat(F.lit(" "), normal, F.lit(" ")).contains(f" {phrase} ")


def any_phrase(normal: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | has_phrase(normal, p)
    return out


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def digit_density(normal: Column) -> Column:
    compact = F.replace(normal, F.lit(" "), F.lit(""))
    return F.coalesce(F.length(digits(compact)) / F.nullif(F.length(compact), F.lit(0)), F.lit(0.0))


def strip(c: Column) -> Column:
    """Without blanks of any kind at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | ~c.rlike(r"(?U)\S")


def safe_name(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_"), F.lit("")), F.lit("document"))
