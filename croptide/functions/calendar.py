"""Marketing-year and weekly calendar expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from croptide.functions.climate import ColumnOrName, _col


def marketing_year(date: ColumnOrName) -> Column:
    """``2009/10`` for June 2009 … May 2010."""
    start = F.year(F.add_months(_col(date), -5))
    return F.concat(start.cast("string"), F.lit("/"),
                    F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def marketing_quarter(date: ColumnOrName) -> Column:
    """1 Jun–Aug, 2 Sep–Nov, 3 Dec–Feb, 4 Mar–May."""
    return F.quarter(F.add_months(_col(date), -5))


def marketing_month(date: ColumnOrName) -> Column:
    """Three-letter month name."""
    return F.date_format(_col(date), "MMM")


def closing_monday(date: ColumnOrName) -> Column:
    """The Monday on or after a day: bins run Tuesday … Monday."""
    return F.next_day(F.date_sub(_col(date), 1), "MON")


def parse_utc_offset(text: str) -> int:
    """Minutes east of UTC of a fixed zone like ``utc-05:00``."""
    m = re.fullmatch(r"utc([+-])(\d{2}):(\d{2})", text.strip().lower())
    if not m:
        raise ValueError(f"not a fixed UTC offset: {text!r}")
    minutes = int(m[2]) * 60 + int(m[3])
    return -minutes if m[1] == "-" else minutes
