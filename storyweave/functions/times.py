"""Column functions on times, and cluster ranges such as ``{"days": 1}``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two zone names that have a fixed offset, the day-time units of a range, and the
# layouts tried in order after the weekday is dropped and the zone is written as an offset.
ZONES = {"EST": "-0500", "EDT": "-0400", "GMT": "+0000", "UTC": "+0000", "Z": "+0000"}
UNITS = ("days", "hours", "minutes", "seconds", "weeks")
DATES = ("yyyy-MM-dd", "yyyy/MM/dd", "d MMM yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy", "M/d/yyyy")
CLOCKS = ("[ HH:mm[:ss][.SSSSSS]][ xx]", " h:mm[:ss] a[ xx]")
# Other spellings of dates and what they stand for, in order; $1 and so on are what the brackets hold.
SPELLINGS = (
    (r" ?\([^)]*\)$", ""),
    (r"^(\d{4})(\d{2})(\d{2})(?= |$)", "$1-$2-$3"),
    (r"(?<= )(\d{2})(\d{2})(\d{2})(?=$|[ +Z-])", "$1:$2:$3"),
    (r"^([A-Za-z]{3,9} \d{1,2}) (\d{1,2}:\d{2}(?::\d{2})?) (\d{4})$", "$1 $3 $2"),
    (r"(?<= )(\d):(\d{2})", "0$1:$2"),
    (r"^(\d{1,2} [A-Za-z]{3,9}) ([0-6]\d|7[0-5])(?= |$)", "$1 20$2"),
    (r"^(\d{1,2} [A-Za-z]{3,9}) (\d{2})(?= |$)", "$1 19$2"),
    (r"^(1[3-9]|2\d|3[01])[./](\d{1,2})[./](\d{4})", "$2/$1/$3"),
    (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})", "$1/$2/$3"),
)

_WEEKDAY = r"(?i)^\s*(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+"
_CLOCK = r"(?i)^\s*\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(am|pm)?\s*$"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once; spelled out, it would be repeated at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _plain(column: Column) -> Column:
    """The text without weekday and commas, zones as offsets."""
    text = F.regexp_replace(column, _WEEKDAY, "")
    text = F.regexp_replace(text, r"(\d)T(\d)", "$1 $2")
    text = F.trim(F.regexp_replace(text, r"[,\s]+", " "))
    for written, plain in SPELLINGS:
        text = F.regexp_replace(text, written, plain)
    for name, offset in ZONES.items():
        text = F.regexp_replace(text, rf"(?<=[\d\sMm]){name}$", offset)
    # A zone of another name is not known, so the time is read without it.
    text = F.regexp_replace(text, r"(?<=\d) (?!AM$|PM$)[A-Z]{2,5}$", "")
    # One blank before the offset, no colon in it, and a fraction of six digits: few layouts then suffice.
    text = F.regexp_replace(text, r"(:\d{2}(?:\.\d+)?(?: [AaPp][Mm])?) ?([+-]\d{2}):?(\d{2})$", "$1 $2$3")
    text = F.regexp_replace(text, r"(:\d{2}\.\d+)", "$1000000")
    return F.regexp_replace(text, r"(:\d{2}\.\d{6})\d*", "$1")


def parse_time(column: Column, runtime: Column) -> Column:
    """Free-form date to timestamp: ``runtime`` where the text is blank, its day where there is only a clock, null where it
    cannot be read.

    Text without a zone is read in the session time zone.
    """
    def read(text: Column) -> Column:
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(d + c)) for d in DATES for c in CLOCKS])

    today = F.concat(F.date_format(runtime, "yyyy-MM-dd "), F.trim(column))
    dated = F.when(column.rlike(_CLOCK), today).otherwise(column)
    blank = column.isNull() | (F.trim(column) == "")
    return F.when(blank, runtime).otherwise(_bind(_plain(dated), read))


def format_time(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSxx")


def day_string(column: Column) -> Column:
    return F.date_format(column, "dd-MM-yyyy")


def format_range(cluster_range: dict[str, int]) -> str:
    if len(cluster_range) != 1:
        raise ValueError("a cluster range has exactly one unit")
    (unit, amount), = cluster_range.items()
    return f"{amount} {unit}"


def range_delta(cluster_range: dict[str, int]) -> timedelta:
    format_range(cluster_range)
    return timedelta(**cluster_range)


def interval_eq(begin: Column, end: Column, cluster_range: dict[str, int]) -> Column:
    """``end - begin`` equals the range; 24 hours equal 1 day."""
    return (end - begin) == F.lit(range_delta(cluster_range))
