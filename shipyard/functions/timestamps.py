"""Timestamp parsing to UTC wall-clock ``TIMESTAMP_NTZ``; null when unparseable.

All three parsers are pure Column expressions. Strings with an offset are
parsed to an instant and shifted to UTC through the session zone, which jobs
pin to UTC (``shipyard.session.REQUIRED_CONF``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted ISO-8601 shapes. A calendar date (extended or basic)
# or a week date, then an optional time after any one character: hours with
# optional minutes, seconds and a fraction (extended or basic), then an optional
# zone: Z, or an offset with optional minutes, seconds and a fraction.
ISO_DATE = r"(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})|(\d{4})-?W(\d{2})(?:-?([1-7]))?)"
ISO_TIME = r"(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+|(?=[Z+-])))?)?)?"
ISO_ZONE = r"(Z| ?[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)"
ISO_PATTERN = f"^{ISO_DATE}(?:.{ISO_TIME}{ISO_ZONE}?)?$"
# Mixtures of the extended and the basic form within a date, a time or an offset,
# a blank between a fraction and an offset (one is accepted elsewhere), and a dash
# between a week and digits that may be a day or a time.
ISO_MIXED = r"^(?:\d{4}-W\d{2}-\d\d.*|\d{4}-W\d{2}[1-7]|\d{4}W\d{2}-|.*[.,]\d+ [+-]|.{7,10}?[^0-9-](?:\d{2}:\d{4}|\d{4}:)|.*[+-](?:\d{2}:\d{4}|\d{4}:\d{2})(?:\.\d+)?$)"

# The common forms, parsed in one step: an extended date, 'T' or a blank, time to the
# minute or second, a fraction of one to six digits, Z, +HH:MM, +HHMM or no zone.
ISO_FULL_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?$"
ISO_FULL_FORMAT = "yyyy-MM-dd['T'][' ']HH:mm[:ss][.SSSSSS][XXX][XX]"

# Of these, the forms that Spark's cast reads alike, without a formatter. It also takes a
# year 0, which is none here.
ISO_CAST_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?\z"
NAIVE_CAST_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"

# carrier_b's naive "YYYY-MM-DD HH:MM:SS" as strptime reads it:
# four-digit year, one- or two-digit other parts, blanks between date and time.
NAIVE_PATTERN = r"^(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})$"

# Epoch milliseconds of 0001-01-01T00:00:00 and 9999-12-31T23:59:59.999.
MIN_EPOCH_MILLIS = -62135596800000
MAX_EPOCH_MILLIS = 253402300799999


def _g(value: Column, idx: int, pattern: str) -> Column:
    return F.regexp_extract(value, pattern, idx)


def parse_iso8601_utc(value: Column) -> Column:
    """ISO-8601 text -> UTC timestamp; naive text counts as UTC.

    The common forms (nearly every feed line) take one regex test and one
    cast or parse; other accepted shapes go through the general path, which
    rebuilds a canonical string from the regex groups.
    """
    cast = F.when(value.rlike(ISO_CAST_PATTERN), value.try_cast("timestamp").cast("timestamp_ntz"))
    cast = F.when(F.year(cast).between(1, 9999), cast)
    fast = F.try_to_timestamp(value, F.lit(ISO_FULL_FORMAT)).cast("timestamp_ntz")
    fast = F.when(F.year(fast).between(1, 9999), fast)
    # Offsets beyond 18 hours are left to the general path, too.
    return F.coalesce(cast, F.when(value.rlike(ISO_FULL_PATTERN), fast), _parse_iso8601_general(value))


def _parse_iso8601_general(value: Column) -> Column:
    ok = value.rlike(ISO_PATTERN) & ~value.rlike(ISO_MIXED)
    # One regex pass gives all parts; the rest works on them.
    parts = F.split(F.regexp_replace(value, ISO_PATTERN, "|".join(f"${k}" for k in range(1, 15))), "[|]", -1)
    return F.when(ok, F.element_at(F.transform(F.array(parts), _instant_of), 1))


def _instant_of(parts: Column) -> Column:
    """The UTC timestamp of the 14 parts of ``ISO_PATTERN``; null for impossible values."""

    def part(idx: int, missing: str = "00") -> Column:
        return F.when(parts[idx - 1] == "", F.lit(missing)).otherwise(parts[idx - 1])

    date = (
        F.when(parts[0] != "", F.try_to_date(F.concat_ws("-", *[parts[k] for k in (0, 1, 2)]), "yyyy-MM-dd"))
        .when(parts[3] != "", F.try_to_date(F.concat_ws("-", *[parts[k] for k in (3, 4, 5)]), "yyyy-MM-dd"))
        .otherwise(_week_date(parts[6], parts[7], part(9, "1")))
    )
    fraction = F.rpad(F.substring(parts[12], 1, 6), 6, "0")  # digits beyond the sixth are cut off
    local = F.try_to_timestamp(
        F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), F.concat_ws(":", part(10), part(11), part(12)), F.lit("."), fraction),
        F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"),
    ).cast("timestamp_ntz")
    instant = F.timestamp_add("MICROSECOND", -_offset_micros(parts[13]), local)
    return F.when(F.year(instant).between(1, 9999), instant)


def _week_date(year: Column, week: Column, day: Column) -> Column:
    """The date of an ISO week date: week 1 holds 4 January; null for a week that
    the year does not have."""
    fourth = F.try_to_date(F.concat(year, F.lit("-01-04")), "yyyy-MM-dd")
    date = F.date_add(F.trunc(fourth, "week"), (week.try_cast("int") - 1) * 7 + day.try_cast("int") - 1)
    return F.when((week != "00") & (F.weekofyear(date) == week.try_cast("int")), date)


def _offset_micros(zone: Column) -> Column:
    """Microseconds of ``Z`` or ``+HH[[:]MM[[:]SS[.f]]]``; null for an offset of a day or more."""
    sign = F.substring(F.ltrim(zone), 1, 1)
    digits = F.regexp_replace(F.substring(F.ltrim(zone), 2, 30), ":", "")

    def number(start: int) -> Column:
        return F.coalesce(F.substring(digits, start, 2).try_cast("long"), F.lit(0))

    fraction = F.rpad(F.substring(F.regexp_extract(digits, r"\.(\d+)", 1), 1, 6), 6, "0").try_cast("long")
    seconds = number(1) * 3600 + number(3) * 60 + number(5)
    micros = seconds * 1_000_000 + F.coalesce(fraction, F.lit(0))
    return (
        F.when((zone == "") | (zone == "Z"), F.lit(0).cast("long"))
        .when(micros < 86_400_000_000, F.when(sign == "-", -micros).otherwise(micros))
    )


def parse_naive_utc(value: Column) -> Column:
    """Naive ``YYYY-MM-DD HH:MM:SS`` -> timestamp, taken as UTC. Zero-padded
    text is cast in one step; unpadded parts or repeated blanks go through the
    general path."""
    cast = F.when(value.rlike(NAIVE_CAST_PATTERN), value.try_cast("timestamp_ntz"))
    fast = F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    padded = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
    return F.coalesce(cast, F.when(value.rlike(padded), fast).otherwise(_parse_naive_general(value)))


def _parse_naive_general(value: Column) -> Column:
    p = NAIVE_PATTERN
    canonical = F.concat_ws(
        " ",
        F.concat_ws("-", _g(value, 1, p), _g(value, 2, p), _g(value, 3, p)),
        F.concat_ws(":", _g(value, 4, p), _g(value, 5, p), _g(value, 6, p)),
    )
    parsed = F.try_to_timestamp(canonical, F.lit("yyyy-M-d H:m:s"))
    return F.when(value.rlike(p), parsed.cast("timestamp_ntz"))


def parse_epoch_millis(value: Column) -> Column:
    """Epoch milliseconds -> timestamp; null outside years 1..9999."""
    in_range = value.between(F.lit(MIN_EPOCH_MILLIS), F.lit(MAX_EPOCH_MILLIS))
    return F.when(in_range, F.timestamp_millis(value).cast("timestamp_ntz"))


def hours_between(start: Column, end: Column) -> Column:
    """(end - start) in hours as a double; null when either side is null."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1000000.0) / F.lit(3600.0)
