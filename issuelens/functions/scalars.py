"""Scalar column functions used by the reports.

Every function maps Column -> Column with built-in Spark expressions only (code-generated,
no Python), so a report projection stays one narrow stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3600 * MICROS_PER_SECOND
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_commas(c: Column | str) -> Column:
    """F1 ``gsub(",", "", x)``."""
    return F.translate(_c(c), ",", "")


def strip_spaces(c: Column | str) -> Column:
    """F1 ``gsub(" ", "", x)``."""
    return F.replace(_c(c), F.lit(" "), F.lit(""))


def trim_ws(c: Column | str) -> Column:
    """F2 ``trimws``: strips space, tab, CR and LF at both ends (Spark's trim keeps newlines)."""
    return F.regexp_replace(_c(c), r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def flatten_newlines(c: Column | str) -> Column:
    """Optional: replace inner line breaks by a space (what the SBP comment intends)."""
    return F.regexp_replace(_c(c), r"[\r\n]+", " ")


def paste0(*cols: Column | str) -> Column:
    """F4 ``paste0``: a NULL part prints as ``NA``, as in R."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("NA")) for c in cols])


def r_date(c: Column | str) -> Column:
    """F5 ``as.Date(x, "%Y-%m-%d")``: the leading calendar date as written, else NULL."""
    head = F.regexp_extract(_c(c), r"^\s*(\d{4}-\d{1,2}-\d{1,2})", 1)
    return F.try_to_date(head, "yyyy-M-d")


def r_timestamp(c: Column | str) -> Column:
    """F6/F7 ``as.POSIXct`` / ``ymd_hms``: ISO text with optional offset -> instant.

    The instant is kept; display follows ``spark.sql.session.timeZone``.
    """
    return F.try_to_timestamp(_c(c))


def _micros(ts: Column) -> Column:
    # timestamp_ntz inputs are wall clock in the session's zone.
    return F.unix_micros(ts.cast("timestamp"))


def days_between(end: Column | str, start: Column | str) -> Column:
    """F8 ``difftime(end, start, units = "days")`` as a fractional double."""
    return (_micros(_c(end)) - _micros(_c(start))) / F.lit(float(MICROS_PER_DAY))


def hours_between(end: Column | str, start: Column | str) -> Column:
    """F9 ``as.duration(interval(start, end)) / 3600``; NULL when either end is NULL."""
    return (_micros(_c(end)) - _micros(_c(start))) / F.lit(float(MICROS_PER_HOUR))


def millis_to_minutes(c: Column | str) -> Column:
    """F10 ``(x / 1000) / 60``."""
    return _c(c).cast("double") / 1000 / 60


def as_of_literal(as_of: str | None) -> Column:
    """the run's "now", evaluated once; pass a literal for reproducible output."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def nan_if_null(c: Column | str) -> Column:
    """F13 ``replace_na(x, NaN)``."""
    return F.coalesce(_c(c).cast("double"), F.lit(float("nan")))


def as_character(c: Column | str) -> Column:
    """F14 ``as.character``."""
    return _c(c).cast("string")


def as_numeric(c: Column | str) -> Column:
    """F14 ``as.numeric`` on dirty text: NULL instead of an error."""
    return _c(c).try_cast("double")
