"""Scalar functions over columns."""

from __future__ import annotations

import sys
from collections.abc import Iterable
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, functions as F

MICROS = 1_000_000


def concat_blank(parts: Iterable[Column]) -> Column:
    """Concatenation in which a NULL part counts as empty text."""
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def clamp(value: Column, upper: Column, lower: Column) -> Column:
    """``value`` held inside the bounds; the upper bound is tested first.

    NULL stays NULL, and a NULL bound does not bind. That rules out ``least``/``greatest``,
    which skip NULLs and would turn a NULL value into a bound.
    """
    return F.when(value > upper, upper).when(value < lower, lower).otherwise(value)


@lru_cache(maxsize=128)
def _same_when_lowered(letter: str) -> tuple[str, ...]:
    """Every character that a lower-cased text beginning with ``letter`` can begin with."""
    return tuple(c for c in map(chr, range(sys.maxunicode + 1)) if c.lower().startswith(letter))


def ilike(value: Column, pattern: str) -> Column:
    """``value ILIKE pattern``, whose first letter the file reader can prune by.

    A reader does not know ILIKE. Where the pattern begins with a letter, the few characters that
    fold to it are asked for as plain prefixes too; the exact test stays.
    """
    lowered = pattern.lower()
    if not lowered or lowered[0] in "%_\\":
        return value.ilike(pattern)
    first = [value.startswith(c) for c in _same_when_lowered(lowered[0])]
    return reduce(or_, first) & value.ilike(pattern)


def year_gap(year: int | Column, since: Column) -> Column:
    """Whole years from ``since`` (a year number) to ``year``."""
    return _column(year) - since


def year_ratio(year: int | Column, since: Column) -> Column:
    """``year / since`` as fixed-point division with six decimals."""
    return _column(year).cast("decimal(38,0)") / since.cast("decimal(38,0)")


def add_days(moment: Column, days: int) -> Column:
    """``moment`` moved by a number of days; a timestamp without zone stays without zone."""
    return moment + F.make_dt_interval(F.lit(days))


def zoned(text: str, pattern: str = "yyyy-MM-dd HH:mm:ss.SSS Z") -> Column:
    """The instant named by text with an offset, such as ``2024-04-04 21:34:31.833 -0700``."""
    return F.to_timestamp(F.lit(text), pattern)


def utc_clock(instant: Column) -> Column:
    """What a UTC clock shows at an instant, as timestamp without zone."""
    local = instant.cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def elapsed_micros(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end``, negative if ``end`` comes first.

    Works on the difference of the two, so the session time zone cannot shift timestamps that
    have no zone.
    """
    return _micros(end - start)


def seconds_crossed(start: Column, end: Column) -> Column:
    """How many full-second marks lie between the two: 0.9 s to 1.1 s is one."""
    from_mark = elapsed_micros(start, end) + _past_mark(start) - _past_mark(end)
    return F.call_function("div", from_mark, F.lit(MICROS))


def _past_mark(moment: Column) -> Column:
    """Microseconds since the last full second."""
    second = F.extract(F.lit("SECOND"), moment)
    return ((second - F.floor(second)) * MICROS).cast("bigint")


def sum_hours(start: Column, end: Column) -> Column:
    """Aggregate: total hours between the pairs; pairs with a NULL end are skipped.

    Whole seconds and left-over microseconds are summed as two integers and divided once, so
    row order cannot change the result and trillions of rows cannot overflow it.
    """
    gap = end - start
    seconds = gap.cast("interval second").cast("bigint")
    whole = F.sum(seconds)
    rest = F.sum(gap - seconds * F.expr("INTERVAL '1' SECOND"))
    return (whole + _micros(rest) / MICROS) / 3600


def _micros(gap: Column) -> Column:
    """A day-time interval as a number of microseconds."""
    minutes = (
        F.extract(F.lit("DAY"), gap).cast("bigint") * 1440
        + F.extract(F.lit("HOUR"), gap) * 60
        + F.extract(F.lit("MINUTE"), gap)
    )
    seconds = F.extract(F.lit("SECOND"), gap)  # decimal, carries the fraction
    return minutes * (60 * MICROS) + (seconds * MICROS).cast("bigint")


def _column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
