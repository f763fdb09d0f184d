"""Months as plain values: the closed ones before a day, and the bounds of one."""

from __future__ import annotations

import calendar
import datetime as dt


def recent_closed_months(today: dt.date, n: int) -> list[tuple[int, int]]:
    """The ``n`` months before the one of ``today``, latest first, over year ends."""
    return [((today.year * 12 + today.month - 1 - i) // 12, (today.year * 12 + today.month - 1 - i) % 12 + 1) for i in range(1, n + 1)]


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First and last day of a month."""
    return dt.date(year, month, 1), dt.date(year, month, calendar.monthrange(year, month)[1])
