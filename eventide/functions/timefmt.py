"""Time arithmetic and the text forms of windows, panes and attributions.

All event and processing times are TIMESTAMP_NTZ read as UTC.  Every function
returns a Catalyst ``Column`` so formatting stays inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms the golden outputs use.
GLOBAL_WINDOW_TEXT = "[global window]"
END_OF_GLOBAL_WINDOW = "END_OF_GLOBAL_WINDOW"
NULL_TEXT = "null"
MIN_TIME_TEXT, MAX_TIME_TEXT = "TIMESTAMP_MIN_VALUE", "TIMESTAMP_MAX_VALUE"
# The least and greatest times: 64-bit microseconds cut to milliseconds; the global window ends a day earlier.
MIN_TIME_US, MAX_TIME_US = -9_223_372_036_854_775_000, 9_223_372_036_854_775_000
END_OF_GLOBAL_US = MAX_TIME_US - 86_400_000_000
# Time of day of the last instant inside an open-ended window (one millisecond
# before the end of the global window, year 294247); printed as the output time
# of a window whose end is open.
OPEN_END_PANE_TIME = "04:00:54"
ARROW = " → "

_UNITS = {
    "microsecond": 1, "microseconds": 1, "us": 1,
    "millisecond": 1_000, "milliseconds": 1_000, "ms": 1_000,
    "second": 1_000_000, "seconds": 1_000_000, "s": 1_000_000, "sec": 1_000_000,
    "minute": 60_000_000, "minutes": 60_000_000, "min": 60_000_000, "m": 60_000_000,
    "hour": 3_600_000_000, "hours": 3_600_000_000, "h": 3_600_000_000,
    "day": 86_400_000_000, "days": 86_400_000_000, "d": 86_400_000_000,
}


def dur_us(d: str | int | float) -> int:
    """'2 minutes', '1 hour 30 minutes', or a number of seconds -> microseconds."""
    if isinstance(d, (int, float)):
        return int(round(d * 1_000_000))
    total = 0
    for num, unit in re.findall(r"(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)", d):
        total += int(round(float(num) * _UNITS[unit.lower()]))
    if total == 0 and not re.search(r"\d", d):
        raise ValueError(f"bad duration {d!r}")
    return total


def to_us(c: Column | str) -> Column:
    """TIMESTAMP_NTZ -> microseconds since the epoch (UTC wall clock)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def from_us(c: Column) -> Column:
    return F.timestamp_micros(c).cast("timestamp_ntz")


def plus(c: Column | str, d: str | int | float) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return from_us(to_us(c) + F.lit(dur_us(d)))


def floor_to(c: Column | str, size: str | int | float, offset: str | int | float = 0) -> Column:
    s, o = dur_us(size), dur_us(offset)
    u = to_us(c) - F.lit(o)
    return from_us(u - F.pmod(u, F.lit(s)) + F.lit(o))


def ceil_to(c: Column | str, size: str | int | float, offset: str | int | float = 0) -> Column:
    """Smallest boundary ``offset + k*size`` at or after ``c``."""
    s, o = dur_us(size), dur_us(offset)
    u = to_us(c) - F.lit(o)
    r = F.pmod(u, F.lit(s))
    return from_us(F.when(r == 0, u).otherwise(u - r + F.lit(s)) + F.lit(o))


def parse_time(c: Column | str) -> Column:
    """'HH:mm:ss' -> TIMESTAMP_NTZ on 1970-01-01 (UTC)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_timestamp_ntz(F.concat(F.lit("1970-01-01 "), c))


def format_time(c: Column | str) -> Column:
    """``HH:mm:ss``, or the names of NULL, the least and greatest times and the end of the global window."""
    c = F.col(c) if isinstance(c, str) else c
    us = to_us(c)
    return (F.when(c.isNull(), F.lit(NULL_TEXT)).when(us == MIN_TIME_US, F.lit(MIN_TIME_TEXT))
            .when(us == MAX_TIME_US, F.lit(MAX_TIME_TEXT)).when(us == END_OF_GLOBAL_US, F.lit(END_OF_GLOBAL_WINDOW))
            .otherwise(F.date_format(c, "HH:mm:ss")))


def format_window(start: Column | str, end: Column | str, greatest: Column | str | None = None) -> Column:
    """Global window when both bounds are NULL; an open end prints as the end of the global window.

    A window of another kind is known by its greatest time alone: ``..., greatest]``.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    start, end = col(start), col(end)
    end_text = F.when(end.isNull(), F.lit(END_OF_GLOBAL_WINDOW)).otherwise(format_time(end))
    text = (F.when(start.isNull() & end.isNull(), F.lit(GLOBAL_WINDOW_TEXT))
            .otherwise(F.concat(F.lit("["), format_time(start), F.lit(", "), end_text, F.lit(")"))))
    if greatest is None:
        return text
    return F.when(col(greatest).isNotNull(), F.concat(F.lit("..., "), format_time(greatest), F.lit("]"))).otherwise(text)


def pane_time_text(start: Column | str, end: Column | str) -> Column:
    """Output time of a window's pane: end minus one millisecond."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return (F.when(start.isNull() & end.isNull(), F.lit(END_OF_GLOBAL_WINDOW))
            .when(end.isNull(), F.lit(OPEN_END_PANE_TIME))
            .otherwise(F.date_format(from_us(to_us(end) - F.lit(1000)), "HH:mm:ss")))


def _pane_flags(on_time_index: Column, is_first: Column, is_last: Column) -> Column:
    return F.concat(
        F.when(on_time_index.isNotNull(), F.concat(F.lit(" onTimeIndex="), on_time_index.cast("string"))).otherwise(
            F.lit("")),
        F.when(is_first, F.lit(" isFirst")).otherwise(F.lit("")), F.when(is_last, F.lit(" isLast")).otherwise(F.lit("")))


def format_pane(start, end, key, value, timing, pane_index, on_time_index, is_first, is_last) -> Column:
    """``<window>: <key>:<value, width 2> <time> <timing, width 7> index=<i>`` plus optional flags."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    head = F.format_string("%s: %s:%-2d %s %-7s index=%d", format_window(start, end), col(key),
                           col(value), pane_time_text(start, end), col(timing), col(pane_index))
    return F.concat(head, _pane_flags(col(on_time_index), col(is_first), col(is_last)))


def format_attribution(impression: Column | str, trail: Column | str, goal: Column | str,
                       timing: Column | str = "UNKNOWN", pane_index: Column | None = None,
                       on_time_index: Column | None = None, is_first: Column | None = None,
                       is_last: Column | None = None) -> Column:
    """``[global window]: imp=<id> <source> → <trail urls> → <goal url> <goal time> <timing>``.

    Unless the timing is UNKNOWN, the pane's index and flags follow as in ``format_pane``.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    imp, tr, g = col(impression), col(trail), col(goal)
    timing = F.lit(timing) if isinstance(timing, str) else timing
    urls = F.transform(tr, lambda v: v["url"])
    path = F.array_join(F.concat(F.array(imp["source_url"]), urls, F.array(g["url"])), ARROW)
    head = F.format_string("%s: imp=%s %s %s %-7s", F.lit(GLOBAL_WINDOW_TEXT),
                           imp["id"].cast("string"), path, format_time(g["ts"]), timing)
    if pane_index is None:
        return head
    none, no = F.lit(None).cast("long"), F.lit(False)
    tail = F.concat(F.lit(" index="), pane_index.cast("string"), _pane_flags(
        none if on_time_index is None else on_time_index, no if is_first is None else is_first,
        no if is_last is None else is_last))
    return F.when(timing == "UNKNOWN", head).otherwise(F.concat(head, tail))
