"""Date parsing and shifting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text date format of the raw sales files.
RAW_DATE_FORMAT = "dd.MM.yyyy"


def parse_text_date(c, fmt: str = RAW_DATE_FORMAT) -> Column:
    """Text -> date; text that does not match the pattern becomes NULL.

    ``try_to_timestamp`` keeps bad rows instead of failing the job under ANSI
    mode (``1.1.2020`` and ``2020-12-31`` do not match ``dd.MM.yyyy``).
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(fmt)).cast("date")


def shift_years(c, years: int) -> Column:
    """Move a date by whole years; 29 Feb becomes 28 Feb in non-leap years."""
    col = F.col(c) if isinstance(c, str) else c
    return F.add_months(col, 12 * years)
