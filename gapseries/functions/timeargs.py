"""Time-range arguments (FIL-1, FIL-4).

The rules, each tested in ``tests/test_timeargs.py``:

* a bound written as a date alone means its midnight; as an end it means the
  following midnight, so the half-open comparison takes in the whole day;
* any other bound is an instant: an end given as an instant is excluded;
* instants with a UTC offset are moved to UTC, and sub-millisecond digits are
  cut off (block times have milliseconds);
* a range must not start after it ends, compared before an end is extended.
"""

from __future__ import annotations

import datetime as dt
import re

# a clock in the text: hours and minutes, or an ISO "T" before digits
_CLOCK = re.compile(r":|\dT\d")
MILLISECOND = dt.timedelta(milliseconds=1)


def _read(text: str) -> dt.datetime:
    """The text as a naive UTC time: ISO forms, a month (``2024-03``) or year alone, names (``March 13, 2024``)."""
    import pandas as pd
    try:
        when = pd.to_datetime(str(text).strip())
    except (ValueError, OverflowError) as e:
        raise ValueError(f"{text!r} is no time: {e}") from None
    if when is pd.NaT:
        raise ValueError(f"{text!r} is no time")
    if when.tzinfo is not None:
        when = when.tz_convert("UTC").tz_localize(None)
    return when.floor("us").to_pydatetime()


def _day(text: str) -> dt.datetime | None:
    """Midnight of a text without a clock, else None; a month or a year alone stands for its first day."""
    when = _read(text)
    return when if when.time() == dt.time() and not _CLOCK.search(str(text)) else None


_instant = _read


def normalize_bound(text: str, is_end: bool = False) -> dt.datetime:
    """A range bound as a naive UTC time in whole milliseconds."""
    day = _day(text)
    if day is not None:
        return day + dt.timedelta(days=int(is_end))
    when = _instant(text)
    return when - (when - dt.datetime.min) % MILLISECOND


def validate_range_args(start: str | None, end: str | None, limit: int | None) -> None:
    """Raise ``ValueError`` unless the arguments of a range read make sense together."""
    given = {name: value for name, value in (("start", start), ("end", end)) if value is not None}
    blank = [name for name, value in given.items() if not str(value).strip()]
    if blank:
        raise ValueError(f"empty {' and '.join(blank)}: pass None for an open bound")
    if limit is not None and (type(limit) is not int or limit < 0):
        raise ValueError(f"limit is a row count of 0 or more, not {limit!r}")
    if not given and limit is None:
        raise ValueError("a read needs a bound or a limit")
    if len(given) == 2 and _instant(end) < _instant(start):
        raise ValueError(f"the range is empty: {start} is after {end}")
