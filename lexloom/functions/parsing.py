"""Dates and period numbers from text; bad text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of the input.
DATE_FORMAT = "dd/MM/yyyy"
PERIOD_WORD = "period"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(text: Column | str, date_format: str = DATE_FORMAT) -> Column:
    return F.try_to_date(_col(text), date_format)


def parse_year(text: Column | str, date_format: str = DATE_FORMAT) -> Column:
    return F.year(parse_date(text, date_format))


def period_number(text: Column | str, word: str = PERIOD_WORD) -> Column:
    """`period 9` → 9; anything that is no number without the word → null."""
    return F.regexp_replace(_col(text), word, "").try_cast("int")
