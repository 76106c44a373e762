"""Time-argument semantics (T1-T5): date-only ends, ms truncation, checks."""

import datetime as dt

import pytest

from gapseries.functions.timeargs import normalize_bound, validate_range_args


@pytest.mark.parametrize("text,is_end,expected", [
    ("2024-03-13", False, "2024-03-13 00:00:00.000"),
    ("2024-03-13", True, "2024-03-14 00:00:00.000"),
    ("2024/03/13", True, "2024-03-14 00:00:00.000"),
    ("20240313", True, "2024-03-14 00:00:00.000"),
    ("2024-03-13 12:30:45", False, "2024-03-13 12:30:45.000"),
    ("2024-03-13 12:30:45", True, "2024-03-13 12:30:45.000"),
    ("2024-03-13T12:30:45", True, "2024-03-13 12:30:45.000"),
    ("2024-03-13 00:00:00", True, "2024-03-13 00:00:00.000"),
    ("2024-03-13 12:30:45.123456", False, "2024-03-13 12:30:45.123"),
    ("2024-03-13 12:30:45.999999", False, "2024-03-13 12:30:45.999"),
    ("2024-03", False, "2024-03-01 00:00:00.000"),
    ("2024-03", True, "2024-03-02 00:00:00.000"),
    ("2024", False, "2024-01-01 00:00:00.000"),
    ("March 13, 2024", True, "2024-03-14 00:00:00.000"),
    ("March 13, 2024 12:30", True, "2024-03-13 12:30:00.000"),
    ("20240313T123045", True, "2024-03-13 12:30:45.000"),
    ("2024-03-13 10:00:00.123456789", True, "2024-03-13 10:00:00.123"),
])
def test_bound(text, is_end, expected):
    assert normalize_bound(text, is_end).isoformat(" ", "milliseconds") == expected


def test_offset_converted_to_utc():
    assert normalize_bound("2024-03-13T12:00:00+02:00") == dt.datetime(2024, 3, 13, 10, 0, 0)


@pytest.mark.parametrize("kw", [dict(start="", end=None, limit=None), dict(start=None, end="", limit=None),
                                dict(start=None, end=None, limit=None),
                                dict(start="2024-03-14", end="2024-03-13", limit=None),
                                dict(start="2024-03-13 12:00:00", end="2024-03-13", limit=None),
                                dict(start=None, end=None, limit=-1), dict(start=None, end=None, limit=True),
                                dict(start=None, end=None, limit=2.0), dict(start="no date", end="2024-03-13", limit=None),
                                dict(start="2024111", end="2024-03-13", limit=None)])
def test_invalid(kw):
    with pytest.raises(ValueError):
        validate_range_args(**kw)


@pytest.mark.parametrize("kw", [dict(start="2024-03-13", end="2024-03-13", limit=None),
                                dict(start=None, end=None, limit=0), dict(start="2024-03-13", end=None, limit=None),
                                dict(start=None, end="2024-03-13", limit=None), dict(start=None, end=None, limit=5)])
def test_valid(kw):
    validate_range_args(**kw)
