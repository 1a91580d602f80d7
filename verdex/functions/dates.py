"""Date parsing without time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day, month and year at the start of a date written day first.
DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"


def parse_date(c: Column) -> Column:
    """ISO or day-first text to a timestamp without time zone; what is neither becomes null."""
    return F.regexp_replace(c, DAY_FIRST, "$3-$2-$1").try_cast("timestamp_ntz")
