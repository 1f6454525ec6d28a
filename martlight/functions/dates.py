"""Date helpers (all dates UTC; the session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def months_between_starts(a, b) -> Column:
    """Number of month boundaries from ``a`` to ``b`` (calendar months, not
    30-day units): 2025-01-31 → 2025-02-01 is 1."""
    a, b = _c(a), _c(b)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def ts_lit(value) -> Column:
    """A wall-clock timestamp literal (``TIMESTAMP_NTZ``) built from ISO text.

    ``F.lit(datetime)`` would interpret a naive datetime in the *driver
    process's* local zone; this form does not depend on where the driver runs.
    Compared with a zoned timestamp column it is read in the session zone (UTC).
    """
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")
