"""Cleaning expressions for identifiers, names, contacts and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted form of an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: str | Column) -> Column:
    """Identifier without outer spaces, in upper case."""
    return F.trim(F.upper(_col(c)))


def title_case(c: str | Column) -> Column:
    return F.trim(F.initcap(_col(c)))


def clean_email(c: str | Column) -> Column:
    return F.trim(F.lower(_col(c)))


def phone_digits(c: str | Column) -> Column:
    """Digits of a phone number; NULL when there is none."""
    return F.nullif(F.regexp_replace(_col(c), "[^0-9]", ""), F.lit(""))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_email(c: str | Column) -> Column:
    return _col(c).rlike(EMAIL_PATTERN)


def iso_date(c: str | Column) -> Column:
    """A ``yyyy-MM-dd`` date; other text becomes NULL instead of an error."""
    return F.try_to_date(_col(c), "yyyy-MM-dd")


def money(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """Amount as decimal; text that is no number, or too wide, becomes NULL."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def masked_email(c: str | Column) -> Column:
    """First three characters and a fixed tail.

    A local part of three characters or fewer is hidden whole.
    """
    address = _col(c)
    short = F.instr(address, "@").between(1, 4)
    return (
        F.when(address.isNull(), F.lit(None).cast("string"))
        .when(short, F.lit("***@***.com"))
        .otherwise(F.concat(F.substring(address, 1, 3), F.lit("***@***.com")))
    )
