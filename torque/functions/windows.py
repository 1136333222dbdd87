"""Time windows: event windows, change windows and their labels."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Window:
    """A time window.  Closed on both ends by default, like the source queries;
    ``end_exclusive`` makes it half-open so a day-end bound keeps its day."""

    start: datetime
    end: datetime
    end_exclusive: bool = False

    def start_lit(self) -> Column:
        return F.lit(self.start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def end_lit(self) -> Column:
        return F.lit(self.end.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def contains(self, c: Column | str) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        upper = (c < self.end_lit()) if self.end_exclusive else (c <= self.end_lit())
        return (c >= self.start_lit()) & upper

    def label(self, fmt: str = "%Y%m%d") -> str:
        return f"{self.start.strftime(fmt)}-{self.end.strftime(fmt)}"


def year_window(year: int, end_exclusive: bool = False) -> Window:
    """The calendar-year window the jobs run on.  The year is an argument so a
    run can be repeated; without ``end_exclusive`` the end is 31 December 00:00,
    as in the source jobs, so sales later that day fall out."""
    if end_exclusive:
        return Window(datetime(year, 1, 1), datetime(year + 1, 1, 1), True)
    return Window(datetime(year, 1, 1), datetime(year, 12, 31))


def last_year_window(today: datetime | None = None) -> Window:
    return year_window((today or datetime.now()).year - 1)


def event_window(w: Window, column: str = "transaction_date") -> Column:
    """closed range on an event-time column; null times drop.  Plain column
    comparisons, so both bounds reach the Parquet scan as pushed filters."""
    return w.contains(column)


def changed_in(w: Window, updated: str = "updated_at", created: str = "created_at") -> Column:
    """``coalesce(updated, created)`` in the window, written so the scan can
    use it.  ``coalesce`` itself is opaque to Parquet pushdown; the expanded
    disjunction is equal and every branch is a plain column comparison."""
    u, c = F.col(updated), F.col(created)
    return (u.isNotNull() & w.contains(u)) | (u.isNull() & w.contains(c))


def changed_in_coalesce(w: Window, updated: str = "updated_at", created: str = "created_at") -> Column:
    """F2 as the source query writes it (kept for plan comparison)."""
    return w.contains(F.coalesce(F.col(updated), F.col(created)))


def day_key(c: Column | str) -> Column:
    """A date or timestamp as ``yyyyMMdd`` text."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyyMMdd")


def parquet_name(prefix: str, w: Window) -> str:
    """Sink name of a windowed output: ``<prefix>__YYYYMMDD-YYYYMMDD``."""
    return f"{prefix}__{w.label()}"
