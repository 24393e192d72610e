"""Text cleaning expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes Unicode whitespace (incl. U+00A0); Spark's trim() removes
# spaces only. Fixed value: the exact set str.strip() removes, trimmed with btrim (no regex).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
                 "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading/trailing Unicode whitespace (NULL stays NULL)."""
    return F.btrim(_col(c).cast("string"), F.lit(PY_WHITESPACE))


def clean_text(c: Column | str) -> Column:
    """Strip, and turn an empty result into NULL."""
    return F.nullif(strip(c), F.lit(""))


def normalize_email(c: Column | str) -> Column:
    """Strip + lower case; blank becomes NULL (never joins)."""
    return F.lower(clean_text(c))


def compare_value(c: Column | str) -> Column:
    """Normalise a value for extract reconciliation.

    NULL -> '', timestamps -> 'yyyy-MM-dd HH:mm:ss', other values -> stripped text with a
    trailing '+00:00' removed.
    """
    col = _col(c)
    return F.coalesce(F.regexp_replace(strip(col), r"\+00:00$", ""), F.lit(""))


def compare_timestamp(c: Column | str) -> Column:
    return F.coalesce(F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def like_needle(needle: str | None) -> str:
    """Lower+trim a search needle and make it safe for Spark's LIKE.

    ``%`` and ``_`` keep their wildcard meaning (as in the reference). A backslash that does
    not escape ``%``, ``_`` or ``\\`` is dropped (PostgreSQL reads ``\\b`` as ``b``; Spark
    would reject the pattern).
    """
    s = (needle or "").strip().lower()
    out = []
    i = 0
    while i < len(s):
        ch = s[i]
        if ch == "\\":
            if i + 1 < len(s) and s[i + 1] in "%_\\":
                out.append(s[i : i + 2])
                i += 2
                continue
            i += 1
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def csv_safe(c: Column | str) -> Column:
    """Comma-free text for the line exports: commas become spaces, NULL becomes ''."""
    return F.coalesce(F.replace(_col(c), F.lit(","), F.lit(" ")), F.lit(""))
