from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st

from chronofold.functions.widths import (
    Width,
    as_instant,
    before,
    bucket_ceiling,
    bucket_end,
    bucket_floor,
    parse_width,
    width_text,
)

DAY = 86_400_000_000


@pytest.mark.parametrize(
    ("value", "text"),
    [
        ((7, "day"), "7 days"),
        ((1, "month"), "1 month"),
        ((2, "week"), "2 weeks"),
        (timedelta(days=7), "7 days"),
        (timedelta(minutes=90), "01:30:00"),
        (timedelta(days=2, hours=4), "2 days 04:00:00"),
        (timedelta(milliseconds=500), "00:00:00.5"),
        (timedelta(0), "00:00:00"),
        (86_400, 86_400),
    ],
)
def test_text(value, text):
    assert width_text(value) == text
    assert parse_width(text, allow_zero=True) == parse_width(value, allow_zero=True)


@pytest.mark.parametrize(
    ("value", "width"),
    [
        ("15 minutes", Width("micros", 900_000_000)),
        ("1 hour 30 minutes", Width("micros", 5_400_000_000)),
        ("2 weeks", Width("micros", 14 * DAY)),
        ("1 year", Width("months", 12)),
        ("1.5 hours", Width("micros", 5_400_000_000)),
        (".5 day", Width("micros", DAY // 2)),
        ("0.5 years", Width("months", 6)),
        ("15 min", Width("micros", 900_000_000)),
        ("2 mins 30 secs", Width("micros", 150_000_000)),
        ("1h", Width("micros", 3_600_000_000)),
        ("1 hr", Width("micros", 3_600_000_000)),
        ("250 ms", Width("micros", 250_000)),
        ("1 mon", Width("months", 1)),
        ("2 yrs", Width("months", 24)),
        ((3, "Month"), Width("months", 3)),
        ("00:00:00.000001", Width("micros", 1)),
        (5, Width("raw", 5)),
    ],
)
def test_parse(value, width):
    assert parse_width(value) == width


@pytest.mark.parametrize(
    "value",
    ["1 month 2 days", "soon", "", "5 parsecs", "0.5 months", "0.1 us", "1.2.3 days", "1 day and more", timedelta(0), timedelta(days=-1), -1, 0, (-1, "day"), "0 days"],
)
def test_refused(value):
    with pytest.raises(ValueError):
        parse_width(value)


@pytest.mark.parametrize("value", [True, 1.5, None])
def test_wrong_type(value):
    with pytest.raises(TypeError):
        parse_width(value)


def test_instants():
    assert as_instant("1970-01-02") == DAY
    assert as_instant(date(1970, 1, 2)) == DAY
    assert as_instant(datetime(1970, 1, 1, 2, tzinfo=timezone(timedelta(hours=1)))) == 3_600_000_000
    assert as_instant(17) == 17


def test_before_keeps_the_day_of_month_where_it_exists():
    month = Width("months", 1)
    assert before(as_instant("2024-03-31T05:00:00"), month) == as_instant("2024-02-29T05:00:00")
    assert before(as_instant("2024-01-15"), month) == as_instant("2023-12-15")
    assert before(as_instant("2024-01-15"), Width("micros", DAY)) == as_instant("2024-01-14")


@given(
    st.integers(-(10**16), 10**16),
    st.one_of(
        st.integers(1, 10**13).map(lambda n: Width("micros", n)),
        st.integers(1, 500).map(lambda n: Width("months", n)),
        st.integers(1, 10**9).map(lambda n: Width("raw", n)),
    ),
)
def test_buckets_tile_time(position, width):
    start, end = bucket_floor(position, width), bucket_end(position, width)
    assert start <= position < end
    assert bucket_floor(start, width) == start
    assert bucket_floor(end, width) == end
    assert bucket_ceiling(position, width) == (position if position == start else end)
