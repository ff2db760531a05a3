"""Reading dates in many notations, calendar fields, gaps and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace, and marks without width that may cling to a written date.
SPACES = (
    " \t\n\u000b\u000c\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
MARKS = "\u200b\ufeff"
_ZONE = r"(?:Z|UTC|GMT|[+-]\d{2}:\d{2})"
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"\d{1,2}:\d{2}:\d{2}(?:\.\d{1,9})?"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def moment(date: Column) -> Column:
    """The UTC timestamp that a written date denotes, or NULL if it denotes none.

    Read are ISO-like notations (``-``, ``/`` or ``.`` between the parts, ``T``
    or blank before the time, optional fraction and zone, any case), day-first
    dates with dots, and Unix seconds or milliseconds. A date without a zone is
    UTC. Dates that do not exist, words and blanks give NULL. The result does
    not depend on the session's time zone.
    """
    s = F.translate(F.upper(F.btrim(date, F.lit(SPACES + MARKS))), "/", "-")
    dotted = F.regexp_replace(s, r"^(\d{1,2})\.(\d{1,2})\.(\d{4})", "$3-$2-$1")
    dotted = F.regexp_replace(dotted, r"^(\d{4})\.(\d{1,2})\.(\d{1,2})", "$1-$2-$3")
    dotted = F.regexp_replace(F.regexp_replace(dotted, r",(?=\d+)", "."), r"\s*([+-]\d{2})(\d{2})$", "$1:$2")
    dotted = F.regexp_replace(dotted, r"^(\S+[T ]+\d{1,2}:\d{2})(?![:\d])", "$1:00")

    def known(c: Column) -> Column:
        """Only what these notations leave open is left to the cast; the first that fits counts."""
        return (
            F.when(c.rlike(rf"^{_DAY}[T ]+{_TIME}$"), F.concat(c, F.lit("Z")).try_cast("timestamp"))
            .when(c.rlike(rf"^{_DAY}[T ]+{_TIME}\s*{_ZONE}$"), c.try_cast("timestamp"))
            .when(c.rlike(rf"^{_DAY}$"), F.concat(c, F.lit("T00:00:00Z")).try_cast("timestamp"))
        )

    # Most dates need one look; the rarer notations are rewritten only where the first look finds none.
    return (
        F.when(s.rlike(rf"^{_DAY}(?:[T ]+{_TIME}(?:\s*{_ZONE})?)?$"), known(s))
        .when(s.rlike(r"^\d{9,10}$"), F.timestamp_seconds(s.try_cast("bigint")))
        .when(s.rlike(r"^\d{12,13}$"), F.timestamp_millis(s.try_cast("bigint")))
        .when(s.rlike(r"^\d"), known(dotted))
    )


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def nick(name: Column) -> Column:
    """A sender or recipient as compared: lower case, no surrounding whitespace, blank as NULL."""
    return F.nullif(F.lower(stripped(name)), F.lit(""))


def is_blank(text: Column) -> Column:
    return text.isNull() | (stripped(text) == "")


def minutes_between(later: Column, earlier: Column) -> Column:
    """Minutes with fractions, from microseconds."""
    return (micros(later) - micros(earlier)) / F.lit(60_000_000.0)


def period_start(ts: Column, granularity: str) -> Column:
    """Start of the UTC day, Monday-based week or month."""
    if granularity not in ("day", "week", "month"):
        raise ValueError(f"granularity must be day, week or month, not {granularity!r}")
    return F.date_trunc(granularity, ts)


def calendar_fields(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "day_of_week": F.date_format(ts, "EEEE"),
        "hour": F.hour(ts),
    }


def right_closed(value: Column, bounds: list[float], labels: list[str]) -> Column:
    """Label of the first bound that is not below the value; NULL stays NULL."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        out = out.when(value <= bound, label)
    return out.otherwise(labels[-1])
