"""Numbers, dates, identity numbers and keys as Catalyst expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import digits


def decimal(c: Column) -> Column:
    """A number in either notation: "R$ 1.234,56", "1234,56", "1234.56"; null where it is none."""
    v = F.regexp_replace(F.regexp_replace(F.trim(c), r"R\$", ""), r"(?U)\s", "")
    both = v.contains(",") & v.contains(".")
    s = F.when(both, F.replace(F.replace(v, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(v.contains(","), F.replace(v, F.lit(","), F.lit("."))).otherwise(v)
    return F.when(s.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)$"), s.try_cast("decimal(28,6)"))


def percentage(c: Column) -> Column:
    return decimal(F.replace(c, F.lit("%"), F.lit("")))


def date(c: Column) -> Column:
    """dd/mm/yyyy, yyyy-mm-dd or mm/yyyy (its first day); null where it is none."""
    v = F.trim(c)
    return (
        F.when(v.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(v, "d/M/yyyy"))
        .when(v.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(v, "yyyy-M-d"))
        .when(v.rlike(r"^\d{1,2}/\d{4}$"), F.try_to_date(F.concat(F.lit("1/"), v), "d/M/yyyy"))
    )


def _check(d: Column, weights: list[int]) -> Column:
    total = sum((F.substring(d, i + 1, 1).try_cast("int") * w for i, w in enumerate(weights)), F.lit(0))
    rest = total % 11
    return F.when(rest < 2, F.lit(0)).otherwise(11 - rest)


def valid_document(c: Column) -> Column:
    """Has a CPF (11 digits) or CNPJ (14) its two check digits? Repeated digits are none."""
    d = digits(c)
    cnpj = [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
    ok11 = (_check(d, list(range(10, 1, -1))) == F.substring(d, 10, 1).try_cast("int")) & (_check(d, list(range(11, 1, -1))) == F.substring(d, 11, 1).try_cast("int"))
    ok14 = (_check(d, cnpj[1:]) == F.substring(d, 13, 1).try_cast("int")) & (_check(d, cnpj) == F.substring(d, 14, 1).try_cast("int"))
    same = d == F.repeat(F.substring(d, 1, 1), F.length(d))
    return F.when((F.length(d) == 11) & ~same, ok11).when((F.length(d) == 14) & ~same, ok14).otherwise(F.lit(False))


def document_mask(c: Column) -> Column:
    """The printed form of a CPF or CNPJ; null for other lengths."""
    d = digits(c)
    return F.when(F.length(d) == 14, F.regexp_replace(d, r"^(..)(...)(...)(....)(..)$", "$1.$2.$3/$4-$5")).when(F.length(d) == 11, F.regexp_replace(d, r"^(...)(...)(...)(..)$", "$1.$2.$3-$4"))


def uuid5(c: Column, space: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """The name-based UUID (version 5) of a text."""
    h = F.sha1(F.concat(F.unhex(F.lit(space.hex)), F.encode(c, "UTF-8")))
    variant = F.element_at(F.array(*map(F.lit, "89ab")), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), group)


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))
