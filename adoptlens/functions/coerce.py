"""Lenient type coercion for dirty extract columns (bad values become NULL, never errors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adoptlens.functions.text import clean_text

# Accepted date layouts, in trial order; one letter takes one or two digits. The first list
# reads the month first, the second ('Date Added' column) the day.
DATE_FORMATS = ["yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "d MMM yyyy", "d-MMM-yyyy", "MMM d yyyy", "d MMMM yyyy", "MMMM d yyyy", "yyyy/M/d"]
DAY_FIRST_FORMATS = ["d/M/yyyy", "yyyy-M-d", "d-M-yyyy", "d MMM yyyy", "d-MMM-yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy", "yyyy/M/d"]
# A time of day after the date, with an offset or without; the date is the one written.
_TIME_RE = r"[T ]+\d{1,2}:\d{2}(:\d{2}(\.\d*)?)?\s*([AaPp][Mm])?\s*([Zz]|[+-]\d{2}:?\d{2})?$"
_INT_RE = r"^[+-]?[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: Column | str, default: int | None = None, numeric_input: bool = False) -> Column:
    """Integer or ``default``: text must be a whole number ('3.7' -> default); numeric input
    is truncated (3.7 -> 3)."""
    if numeric_input:
        out = _col(c).try_cast("int")
    else:
        s = clean_text(c)
        out = F.when(s.rlike(_INT_RE), s.try_cast("int"))
    return F.coalesce(out, F.lit(default).cast("int")) if default is not None else out


def lenient_date(c: Column | str, formats: list[str] = DATE_FORMATS) -> Column:
    """First format that parses the text without its time of day; NULL when none does."""
    s = F.regexp_replace(F.regexp_replace(clean_text(c), _TIME_RE, ""), ", *", " ")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(fmt))) for fmt in formats])


def day_first_date(c: Column | str) -> Column:
    return lenient_date(c, DAY_FIRST_FORMATS)
