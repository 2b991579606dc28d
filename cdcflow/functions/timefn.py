"""Time and date parsers.

Results are epoch milliseconds (BIGINT) and dates (DATE, or epoch days INT),
the representations the declared targets use.  Everything that depends on the
current time takes an injectable ``now`` / ``as_of`` so batch checks can pin it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcflow.functions._util import as_col, lit_or_col
from cdcflow.functions.jsonval import json_is_number, json_text, variant_path

# ---------------------------------------------------------------------------
# Fixed values that results depend on.
# Epoch-unit bands: (0, 1e10) seconds; [1e12, 1e13) millis; [1e13, 1e16) micros.
SECONDS_UPPER = 10_000_000_000
MILLIS_LOWER = 1_000_000_000_000
MICROS_LOWER = 10_000_000_000_000
MICROS_UPPER = 10_000_000_000_000_000
# Offset added to "processed at" stamps (hours, Korea Standard Time).
PROCESSED_AT_OFFSET_HOURS = 9
# Earliest accepted 8-digit birth date; six-digit years flip century past this age.
BIRTH_MIN = _dt.date(1900, 1, 1)
BIRTH_MAX_AGE = 90
# ISO-8601 instant: date 'T' time with seconds, optional fraction, Z or offset.
ISO_INSTANT_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2}(:\d{2})?)\z"
END_OF_DAY = r"T24:00:00(\.0{1,9})?(Z|[+-][0-9:]+)\z"
# ---------------------------------------------------------------------------

_EPOCH_NTZ = _dt.datetime(1970, 1, 1)


def ntz_epoch_micros(ts: Column | str) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ read as UTC (session-zone free)."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), as_col(ts))


def _safe_date(y: Column, m: Column, d: Column, clamp: bool) -> Column:
    """``make_date`` that yields NULL instead of failing.

    ``clamp=True`` is the lenient resolution of a parsed ``yyyyMMdd``: a day of
    29-31 past the month end becomes the last day; month outside 1-12 or a day
    outside 1-31 is invalid.  ``clamp=False`` is strict (Feb 30 -> NULL).
    """
    valid = m.between(1, 12) & d.between(1, 31) & (y >= 1) & (y <= 9999)
    last = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    if clamp:
        return F.when(valid, F.make_date(y, m, F.least(d, last)))
    return F.when(valid & (d <= last), F.make_date(y, m, d))


def parse_instant(c: Column | str) -> Column:
    """ISO-8601 instant text -> epoch millis (floor); anything else -> NULL.

    Parsing is case-insensitive (``t``/``z`` accepted) and needs seconds; an
    offset such as ``+09:00`` is applied.  A shape guard keeps Spark's more
    lenient cast (which would take ``2023-03-15``) out.
    """
    x = F.upper(as_col(c))
    midnight = x.rlike(END_OF_DAY)  # hour 24 is the next day's first instant
    millis = F.unix_millis(F.try_to_timestamp(F.when(midnight, F.replace(x, F.lit("T24:"), F.lit("T00:"))).otherwise(x)))
    return F.when(x.rlike(ISO_INSTANT_SHAPE), millis + F.when(midnight, F.lit(86_400_000)).otherwise(F.lit(0)))


def normalize_epoch_millis(c: Column | str) -> Column:
    """Guess the unit of an epoch number and return millis.

    (0, 1e10) seconds -> *1000; [1e12, 1e13) millis as is;
    [1e13, 1e16) micros -> /1000 (integer division); anything else unchanged.
    """
    v = as_col(c).cast("bigint")
    return (
        F.when((v > 0) & (v < SECONDS_UPPER), v * 1000)
        .when((v >= MILLIS_LOWER) & (v < MICROS_LOWER), v)
        .when((v >= MICROS_LOWER) & (v < MICROS_UPPER), (v.cast("decimal(20,0)") / F.lit(1000)).cast("bigint"))
        .otherwise(v)
    )


def parse_timestamp_text(text: Column | str) -> Column:
    """Timestamp from text: all-digit text is an epoch number, else ISO instant."""
    t = as_col(text)
    digits = t.rlike(r"^[0-9]+\z")
    as_long = t.try_cast("bigint")
    return (
        F.when(t.isNull() | (t == ""), F.lit(None).cast("bigint"))
        .when(digits, normalize_epoch_millis(as_long))
        .otherwise(parse_instant(t))
    )


def parse_timestamp(data: Column | str, field: str, text: Column | None = None) -> Column:
    """Timestamp field of a JSON record -> epoch millis.

    JSON number -> its integer part -> unit normalisation; digit-only text ->
    number -> normalisation (overflow -> NULL); other text -> ISO instant;
    missing, null or empty -> NULL.
    """
    number = F.try_variant_get(as_col(data), variant_path(field), "bigint")
    return F.when(json_is_number(data, field), normalize_epoch_millis(number)).otherwise(
        parse_timestamp_text(json_text(data, field) if text is None else text)
    )


def refine_birth(c: Column | str, as_of: Column | _dt.date | None = None) -> Column:
    """Birth date from loosely formatted text.

    Keep digits, cut to 8.  Eight digits: ``yyyyMMdd`` (day 29-31 past the
    month end clamps to the last day) and must lie in [1900-01-01, as_of].
    Six digits: ``yyMMdd`` in 19yy, or 20yy when that would be older than 90
    (and back to 19yy when 20yy is not in the past); no range check.
    Any other length -> NULL.
    """
    today = F.current_date() if as_of is None else lit_or_col(as_of).cast("date")
    digits = F.substring(F.regexp_replace(as_col(c), "[^0-9]", ""), 1, 8)
    n = F.length(digits)
    y8 = F.substring(digits, 1, 4).try_cast("int")
    m8 = F.substring(digits, 5, 2).try_cast("int")
    d8 = F.substring(digits, 7, 2).try_cast("int")
    date8 = _safe_date(y8, m8, d8, clamp=True)
    in_range = (date8 >= F.lit(BIRTH_MIN)) & (date8 <= today)

    yy = F.substring(digits, 1, 2).try_cast("int")
    m6 = F.substring(digits, 3, 2).try_cast("int")
    d6 = F.substring(digits, 5, 2).try_cast("int")
    this_year = F.year(today)
    y19 = yy + 1900
    y20 = yy + 2000
    year6 = F.when(this_year - y19 > BIRTH_MAX_AGE, F.when(this_year - y20 <= 0, y19).otherwise(y20)).otherwise(y19)
    date6 = _safe_date(year6, m6, d6, clamp=True)
    return F.when((n == 8) & in_range, date8).when(n == 6, date6)


def refine_birth_epoch_days(c: Column | str, as_of: Column | _dt.date | None = None) -> Column:
    return F.unix_date(refine_birth(c, as_of))


def contdate_to_millis(c: Column | str) -> Column:
    """``yyyy/MM/dd`` (exact widths, lenient month end) -> UTC midnight millis."""
    x = as_col(c)
    shaped = x.rlike(r"^\d{4}/\d{2}/\d{2}\z")
    d = _safe_date(
        F.substring(x, 1, 4).try_cast("int"), F.substring(x, 6, 2).try_cast("int"), F.substring(x, 9, 2).try_cast("int"), clamp=True
    )
    return F.when(shaped, F.unix_date(d).cast("bigint") * 86_400_000)


def now_millis(now: Column | _dt.datetime | None = None) -> Column:
    ts = F.current_timestamp() if now is None else lit_or_col(now).cast("timestamp")
    return F.unix_millis(ts)


def processed_at(
    now: Column | _dt.datetime | None = None, offset_hours: int = PROCESSED_AT_OFFSET_HOURS
) -> Column:
    """Processing stamp: now shifted by ``offset_hours``, as epoch millis.

    The shift yields a wall-clock reading written as if it were UTC, not a true
    instant; this is the stamp's contract.
    """
    return now_millis(now) + F.lit(offset_hours * 3_600_000).cast("bigint")
