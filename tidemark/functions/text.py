"""Small text helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"^\s+|\s+$", "")


def event_key(c: Column | str) -> Column:
    """Join key of an eventID: runs of ``.``, ``_`` and ``-`` are one dash; upper case."""
    dashed = F.regexp_replace(strip(c), r"[._-]+", "-")
    return F.coalesce(F.upper(F.regexp_replace(dashed, r"^-+|-+$", "")), F.lit(""))


def event_date_text(c: Column | str) -> Column:
    """A date, timestamp or ISO text as ``yyyy.MM.dd``; what cannot be read becomes empty."""
    value = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.date_format(F.try_to_timestamp(value.cast("string")), "yyyy.MM.dd"), F.lit(""))


# Level names of the run-log format and the levels counted as events.
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
EVENT_LEVELS = ("WARNING", "ERROR", "CRITICAL")


def line_level(c: Column | str) -> Column:
    """Severity of a log line: the second `` | `` field if it is a level, else text markers."""
    line = F.col(c) if isinstance(c, str) else c
    field = F.upper(strip(F.get(F.split(line, r" \| ", 4), F.lit(1))))
    text = F.upper(line)

    def has(*marks: str) -> Column:
        found = text.contains(marks[0])
        for mark in marks[1:]:
            found = found | text.contains(mark)
        return found

    return (
        F.when(field.isin(*LOG_LEVELS), field)
        .when(has("[ERROR]", "[FAIL]", "TRACEBACK", "EXCEPTION"), F.lit("ERROR"))
        .when(has("[WARN]", "WARNING"), F.lit("WARNING"))
    )
