"""Parsing and cleaning of dirty strings.

Every cast is a ``try_*`` form, so a bad value becomes null whether the session
runs in ANSI mode or not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns.  The two date shapes are prefix matches on purpose.
SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}"
ISO_DATE_ONLY = r"^\d{4}-\d{2}-\d{2}\z"
SSN_SHAPE = r"^\d{3}-\d{2}-\d{4}$"
TEXT_SYMBOLS = r"[*#$%&@]"
NOT_NUMERIC = r"[^0-9.-]"
NOT_LETTER_OR_SPACE = r"[^a-zA-Z\s]"
PLAIN_DECIMAL = r"^\s*[+-]?(?=\.?\d)\d*\.?\d*\s*$"


def _slash_day(c: Column) -> Column:
    return F.try_to_date(c, "M/d/yyyy")


def _iso_day(c: Column) -> Column:
    return F.when(c.rlike(ISO_DATE_ONLY), c.try_cast("date"))


def parse_date(c: Column) -> Column:
    """Date from ``yyyy-MM-dd`` or ``M/d/yyyy`` text, else null.

    The shape picks the format, so a good value is never tried against the
    wrong one; a failed try costs far more than a good parse.
    """
    return F.when(c.contains("/"), _slash_day(c)).otherwise(_iso_day(c))


def iso_text(day: Column) -> Column:
    """``yyyy-MM-dd`` of a date or of a timestamp's day.

    A cast of days; ``date_format`` goes through instants of the session's time zone, at many times the cost.
    """
    return day.cast("date").cast("string")


def normalize_date(c: Column) -> Column:
    """ISO text of a date string; an ISO-looking string passes unchanged, others become null."""
    slashed = iso_text(_slash_day(c))
    return F.when(c.rlike(SLASH_DATE), slashed).when(c.rlike(ISO_DATE), c)


def snapshot_day(c: Column) -> Column:
    """The normalised date as a real date; shapes that are no calendar day become null."""
    return F.when(c.rlike(SLASH_DATE), _slash_day(c)).otherwise(_iso_day(c))


def parse_int(c: Column) -> Column:
    """Integer from text, cutting decimals (``'23.7'`` is 23); exponents and suffixes are null."""
    truncated = c.try_cast("double").try_cast("int")
    return F.coalesce(c.try_cast("int"), F.when(c.rlike(PLAIN_DECIMAL), truncated))


def clean_number(c: Column) -> Column:
    """Double from text after dropping everything but digits, dots and minus signs.

    An empty rest, a lone dash or a second dot fails the cast and becomes null.  The lambda keeps
    the rule out of the stage's one generated method, which the JVM does not compile beyond 8,000 bytes:
    a dozen numbers of a row would pass that.
    """
    return F.transform(F.array(c), lambda text: F.regexp_replace(text, NOT_NUMERIC, "").try_cast("double"))[0]


def clean_text(c: Column) -> Column:
    """Trimmed text without the symbols ``* # $ % & @``; empty becomes null."""
    return F.nullif(F.regexp_replace(F.trim(c), TEXT_SYMBOLS, ""), F.lit(""))


def letters_only(c: Column) -> Column:
    """Drop everything but ASCII letters and white space."""
    return F.regexp_replace(c, NOT_LETTER_OR_SPACE, "")


def clean_occupation(c: Column) -> Column:
    """Trim, turn underscores into spaces, keep letters; the spaces stay."""
    return letters_only(F.translate(F.trim(c), "_", " "))


def age_in_range(c: Column, low: int = 18, high: int = 100) -> Column:
    age = parse_int(c)
    return F.when(age.between(low, high), age)


def is_valid_ssn(c: Column) -> Column:
    return c.rlike(SSN_SHAPE)
