"""Day texts, bill months, and the integer positions that series are indexed by (SQL text)."""

from __future__ import annotations


def parse_fix_date(text: str) -> str:
    """``dd/MM/yyyy`` text to a date, NULL when it is none or lies outside FIRST_DAY to LAST_DAY."""
    day = f"CAST(try_to_timestamp({text}, 'd/M/yyyy') AS date)"
    return f"if({day} BETWEEN DATE'{FIRST_DAY}' AND DATE'{LAST_DAY}', {day}, null)"


# The days that a nanosecond timestamp can hold, and the months whose first day it can.
# What lies outside is taken for a typing error, which also bounds a series at 7,015 months.
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-11"
FIRST_MONTH, LAST_MONTH = (1677, 10), (2262, 4)


def bill_month_position(text: str) -> str:
    """Position of a ``yyyyMM`` or ``yyyyM`` text, NULL when it is no month.

    A pattern and integer arithmetic: far cheaper per reading than parsing a timestamp.
    """
    is_month = f"{text} RLIKE '^[0-9]{{4}}(0?[1-9]|1[0-2])$'"
    place = f"(int(substr({text}, 1, 4)) * 12 + int(substr({text}, 5)) - 1)"
    first, last = (year * 12 + month - 1 for year, month in (FIRST_MONTH, LAST_MONTH))
    return f"CASE WHEN {is_month} THEN if({place} BETWEEN {first} AND {last}, {place}, null) END"


def parse_bill_month(text: str) -> str:
    """``yyyyMM`` text to the first of that month, NULL when it is none."""
    return position_month(bill_month_position(text))


def month_position(date: str) -> str:
    """Months since year 0, so that neighbours differ by one."""
    return f"(year({date}) * 12 + month({date}) - 1)"


def position_month(position: str) -> str:
    return f"make_date(int(({position}) div 12), int(({position}) % 12 + 1), 1)"


def day_position(date: str) -> str:
    return f"unix_date(CAST({date} AS date))"


def series_start(first_reading: str, fixed: str) -> str:
    """The later of the first reading and the fixing of the meter; a missing one is skipped."""
    return f"greatest({first_reading}, {fixed})"
