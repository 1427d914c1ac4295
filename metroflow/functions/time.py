"""Time expressions.

Event time is kept as ``timestamp_ntz`` (wall clock in UTC), so results do not
depend on the session time zone. Epoch numbers convert with
``timestampadd``/``timestampdiff`` against the NTZ epoch, which are also
zone-free.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch values above this are milliseconds, below it seconds (dashboard rule).
MILLIS_THRESHOLD = 10_000_000_000

# Display format of outage dates on the elevator board ("Jan 05, 2024 1:04 PM").
BOARD_DATE_FORMAT = "MMM dd, yyyy h:mm a"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch0() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch of an NTZ timestamp (floor)."""
    return F.timestamp_diff("SECOND", epoch0(), _c(ts))


def from_epoch_seconds(x: Column | str) -> Column:
    return F.timestamp_add("SECOND", _c(x), epoch0())


def from_epoch_millis(x: Column | str) -> Column:
    return F.timestamp_add("MILLISECOND", _c(x), epoch0())


def to_event_time(ts: Column | str) -> Column:
    """NTZ -> TIMESTAMP for watermarks, read as UTC whatever the session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch0(), _c(ts)))


def to_wall_time(ts: Column | str) -> Column:
    """TIMESTAMP -> NTZ (UTC wall clock), whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), epoch0())


def normalize_time(x: Column | str) -> Column:
    """One normaliser for epoch seconds, epoch milliseconds, ISO strings and null.

    Input is a string or number column. Numbers above 1e10 are milliseconds,
    others seconds, fractions to the microsecond; anything else is tried as an
    ISO timestamp: text with ``Z`` or an offset is converted to UTC, text
    without is taken as UTC, whatever the session zone. What does not parse is
    null. Result: timestamp_ntz.
    """
    s = F.trim(_c(x).cast("string"))
    n = F.when(s.rlike(r"^-?[0-9]+$"), s.try_cast("bigint"))
    fraction = F.when(s.rlike(r"^-?[0-9]+\.[0-9]+$"), s.try_cast("decimal(38,9)"))
    micros = (fraction * F.when(F.abs(fraction) > MILLIS_THRESHOLD, F.lit(1_000)).otherwise(F.lit(1_000_000))).cast("bigint")
    zoned = s.rlike(r"[0-9]:[0-9]{2}.*(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)$")
    return (
        F.when(n.isNotNull() & (F.abs(n) > MILLIS_THRESHOLD), from_epoch_millis(n))
        .when(n.isNotNull(), from_epoch_seconds(n))
        .when(micros.isNotNull(), F.timestamp_add("MICROSECOND", micros, epoch0()))
        .when(zoned, to_wall_time(F.try_to_timestamp(s)))
        .otherwise(s.try_cast("timestamp_ntz"))
    )


def board_date(ts: Column | str, missing: str = "N/A") -> Column:
    """Outage board date text; ``missing`` for null (N/A for start, Indefinite for end)."""
    return F.coalesce(F.date_format(_c(ts), BOARD_DATE_FORMAT), F.lit(missing))
