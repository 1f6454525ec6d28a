"""Number and date formatting as Column expressions.

Rules kept from the report format:

* credits print with 4 decimals and thousands separators, money with 2,
  money gets a leading ``$``; NULL prints as zero;
* the value is rounded HALF_UP on a decimal *before* formatting
  (``format_number`` alone would round half-even on a double);
* percentages print with one decimal, no separators; counts as integers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORK = "decimal(38,9)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fmt_fixed(x, places: int, null_as_zero: bool = True) -> Column:
    """``1234.5`` → ``1,234.5000`` (places=4)."""
    v = _c(x).cast(_WORK)
    if null_as_zero:
        v = F.coalesce(v, F.lit(0).cast(_WORK))
    return F.format_number(F.round(v, places), places)


def fmt_credits(x) -> Column:
    """Credits, 4 decimals."""
    return fmt_fixed(x, 4)


def fmt_credits2(x) -> Column:
    """Credits, 2 decimals."""
    return fmt_fixed(x, 2)


def fmt_usd(x) -> Column:
    """Money: ``$`` + 2 decimals."""
    return F.concat(F.lit("$"), fmt_fixed(x, 2))


def fmt_plain(x, places: int) -> Column:
    """No thousands separator: ``1234.56`` → ``1234.6`` (places=1)."""
    v = F.round(_c(x).cast(_WORK), places)
    return v.cast(f"decimal(38,{places})").cast("string") if places else \
        v.cast("decimal(38,0)").cast("string")


def fmt_day(x) -> Column:
    """``2024-01-19``."""
    return _c(x).cast("date").cast("string")


def fmt_day_named(x) -> Column:
    """``Fri 2024-01-19`` (abbreviated English weekday)."""
    return F.date_format(_c(x).cast("date"), "EEE yyyy-MM-dd")


def html_escape(x) -> Column:
    """Escape ``& < >`` in labels placed into HTML."""
    v = _c(x)
    v = F.replace(v, F.lit("&"), F.lit("&amp;"))
    v = F.replace(v, F.lit("<"), F.lit("&lt;"))
    return F.replace(v, F.lit(">"), F.lit("&gt;"))
