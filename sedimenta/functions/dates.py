"""Date rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.text import WHITESPACE, trim_text

# Separators may differ within a date.
_DATE = r"\d{4}[-./]\d{1,2}[-./]\d{1,2}"
_BLANKS = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE) + "]*"


def parse_date(text: Column) -> Column:
    """Year, month, day with `-`, `/` or `.` between them; anything else is null.

    The cast skips ordinary blanks by itself, so only rarer white space is stripped first.
    """

    def dashed(date: Column) -> Column:
        dash = F.lit("-")
        return F.replace(F.replace(date, F.lit("/"), dash), F.lit("."), dash).try_cast("date")

    return F.when(text.rlike(rf"^\s*{_DATE}\s*\z"), dashed(text)).when(
        text.rlike(rf"^{_BLANKS}{_DATE}{_BLANKS}\z"), dashed(trim_text(text))
    )


def not_before(later: Column, earlier: Column) -> Column:
    """`later`, or null where it lies before `earlier`. An unknown date refutes nothing."""
    return F.when(later < earlier, F.lit(None)).otherwise(later)


def year_number(day: Column) -> Column:
    return F.year(day).cast("bigint")


def month_number(day: Column) -> Column:
    return F.month(day).cast("bigint")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def quarter_start(day: Column) -> Column:
    return F.trunc(day, "quarter")
