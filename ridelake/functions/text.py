"""Text cleaning and text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank when text is stripped.
BLANKS = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Accepted e-mail and phone formats. The end anchor lets one
# trailing newline pass and nothing else, so `$` is spelled out.
END = r"\n?\z"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}" + END
PHONE = r"^\+1\d{10}" + END


def strip(c: Column) -> Column:
    """Remove blanks (every kind in BLANKS, not only spaces) from both ends."""
    return F.trim(c, F.lit(BLANKS))


def or_default(c: Column, default: str) -> Column:
    """`default` where the text is NULL or empty."""
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def tidy(c: Column) -> Column:
    """Stripped text, '' for NULL."""
    return strip(F.coalesce(c, F.lit("")))


def is_present(c: Column) -> Column:
    """Neither NULL nor empty text."""
    return c.isNotNull() & (c.cast("string") != "")


def is_email(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL), F.lit(False))


def is_phone(c: Column) -> Column:
    return F.coalesce(c.rlike(PHONE), F.lit(False))
