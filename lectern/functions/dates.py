"""Years and dates out of text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern import fixed_values as fixed
from lectern.functions.text import as_column, bind, strip


def year_day_first(value) -> Column:
    """Year of a day-first date; else the first number of the text that begins with 1900 to 2099; else NULL.

    A date may have two digits for its year: 69 to 99 are of the last century, the others of this one.
    """
    def read(text: Column) -> Column:
        heads = F.transform(F.split(text, "[^0-9]+"), lambda number: F.left(number, F.lit(4)).try_cast("int"))
        written = F.get(F.filter(heads, lambda year: year.between(1900, 2099)), 0)
        return F.coalesce(*[_year_of(text, pattern) for pattern in fixed.DAY_FIRST_FORMATS], written,
                          *[_century(_year_of(text, pattern)) for pattern in fixed.SHORT_YEAR_FORMATS])

    return bind(strip(value), read)


def _shape(pattern: str) -> str:
    """What every text looks like that a date pattern reads; a failed reading costs far more than this test."""
    def digits(run: re.Match) -> str:
        if run[0] == "yy":
            return r"\d{2}"
        return r"[+-]?\d{4,}" if run[0][0] == "y" else r"\d{%d}" % len(run[0]) if len(run[0]) > 1 else r"\d+"

    return "^" + re.sub(r"[A-Za-z]+", digits, re.sub(r"([.])", r"\\\1", pattern)) + "$"


def _year_of(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(_shape(pattern)), F.year(F.try_to_timestamp(text, F.lit(pattern))))


def _century(year: Column) -> Column:
    """A two-digit year is read as 2000 to 2099."""
    return F.when(year > fixed.LAST_SHORT_YEAR, year - 100).otherwise(year)


def year_iso(value, strict: bool = False) -> Column:
    """Year of a ``yyyy-MM-dd`` text; with ``strict`` a bad value stops the job."""
    if strict:
        return F.year(F.to_date(strip(value), "yyyy-MM-dd"))
    return bind(strip(value), lambda text: _year_of(text, "yyyy-MM-dd"))


def iso_text(value) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")

