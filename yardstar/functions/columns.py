"""Column expressions shared by the conforming rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from yardstar import config as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def transmission_from_text(c: str | Column) -> Column:
    """Known spellings of automatic, anything else (NULL included) is manual."""
    return F.when(upper_trim(c).isin(*C.AUTOMATIC_SPELLINGS), C.AUTOMATIC).otherwise(C.MANUAL)


def transmission_from_flag(c: str | Column) -> Column:
    return F.when(col(c), C.AUTOMATIC).otherwise(C.MANUAL)


def status_from_return(c: str | Column) -> Column:
    return F.when(col(c).isNotNull(), C.DONE).otherwise(C.ACTIVE)


def recode(c: str | Column, codes: Mapping, default: str = C.UNKNOWN) -> Column:
    """Map codes to names; unknown codes and NULL become ``default``."""
    expr = F
    for code, name in codes.items():
        expr = expr.when(col(c) == code, name)
    return expr.otherwise(default)


def whole_days(start: str | Column, end: str | Column) -> Column:
    """Whole 24-hour periods from start to end, truncated toward zero; NULL if either is NULL."""
    return F.extract(F.lit("DAY"), col(end) - col(start)).cast("int")


def differs(a: str | Column, b: str | Column) -> Column:
    """Null-safe inequality: NULL differs from a value but not from NULL."""
    return ~col(a).eqNullSafe(col(b))


def padded_name(d: str | Column, pattern: str) -> Column:
    """English day or month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(col(d), pattern), 9, " ")


def own_or_foreign(yard_owner: str | Column, vehicle_company: str | Column) -> Column:
    """Own when the vehicle has no company or its company owns the yard."""
    owner = col(yard_owner)
    return F.when(owner == F.coalesce(col(vehicle_company), owner), C.OWN).otherwise(C.FOREIGN)
