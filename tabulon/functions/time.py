"""Time parsing and elapsed-time arithmetic on TIMESTAMP / TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_timestamp(col, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse text to TIMESTAMP_NTZ; unparseable text gives null (no job failure)."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")


def parse_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse text to DATE; unparseable text gives null."""
    return F.to_date(F.try_to_timestamp(F.trim(_c(col)), F.lit(fmt)))


def elapsed_us(start, end) -> Column:
    """Microseconds from ``start`` to ``end`` (negative when end is earlier)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def floor_div(us, unit_us: int) -> Column:
    """Floor division of a microsecond count (rounds toward minus infinity,
    so -1 us gives -1, unlike ``div`` which truncates toward zero)."""
    return F.floor(_c(us) / F.lit(float(unit_us))).cast("bigint")


def floor_hours(start, end) -> Column:
    """Whole elapsed hours, floored: days*24 + seconds//3600 of a time delta."""
    return floor_div(elapsed_us(start, end), US_PER_HOUR)


def whole_seconds(start, end) -> Column:
    """Whole elapsed seconds, floored: days*86400 + seconds of a time delta."""
    return floor_div(elapsed_us(start, end), US_PER_SECOND)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 for TIMESTAMP or TIMESTAMP_NTZ (a sort key)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts).cast("timestamp_ntz"))


def epoch_millis(ts) -> Column:
    """Milliseconds since the epoch as a double (fractional below 1 ms)."""
    return epoch_micros(ts) / F.lit(1000.0)


def is_weekday(d) -> Column:
    """True Monday..Friday (Spark ``weekday``: Monday = 0)."""
    return F.weekday(_c(d)) < 5
