"""Column functions for AIS fields: times, codes, dimensions, emissions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship activity behind each navigational status code.
MODE_OF_STATUS = {
    0: "Cruise", 1: "Anchor", 2: "Anchor", 3: "Maneuver", 4: "Maneuver", 5: "Berth", 6: "Berth", 7: "Cruise",
    8: "Cruise", 9: "Cruise", 10: "Cruise", 11: "Cruise", 12: "Cruise", 13: "Cruise", 14: "Cruise", 15: "Cruise",
}
MODES = ("Berth", "Anchor", "Maneuver", "Cruise")

_TIME_TEXT = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,6})\d*\s\+(?:[01]\d|2[0-3])[0-5]\d$"


def parse_ais_timestamp(text: Column) -> Column:
    """``2024-01-02 10:00:00.123456789 +0000 UTC`` as a zone-free timestamp.

    The fraction is cut (or padded) to microseconds and is required; the clock
    time is kept as written and only ``+`` offsets are legal. Anything else is
    NULL, including impossible dates.
    """
    bare = F.replace(text, F.lit(" UTC"), F.lit(""))
    return F.regexp_extract(bare, _TIME_TEXT, 1).try_cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double with microsecond precision, whatever the session time zone."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


def epoch_seconds(ts: Column) -> Column:
    return seconds_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def vessel_dimensions(dimension: Column | dict[str, Column]) -> tuple[Column, Column]:
    """(length, width) from antenna distances, rounded; NULL as soon as one part is missing."""
    def total(a: str, b: str) -> Column:
        return F.round(dimension[a] + dimension[b]).try_cast("int")

    return total("A", "B"), total("C", "D")


def operation_mode(code: Column) -> Column:
    """Berth, Anchor, Maneuver or Cruise; NULL for codes outside the standard."""
    picked = F
    for mode in MODES:
        picked = picked.when(code.isin([c for c, m in MODE_OF_STATUS.items() if m == mode]), mode)
    return picked


_NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(" \t\n\r\f\v"))


def parse_code(text: Column) -> Column:
    """Whole number in a lenient numeric text (``' 80.7 '`` is 80), else NULL."""
    bare = strip(text)
    return F.when(bare.rlike(_NUMBER_TEXT), bare.try_cast("double").try_cast("int"))


def is_blank(text: Column) -> Column:
    """Missing or only white space."""
    return text.isNull() | (strip(text) == "")


def rate_of_mode(mode: Column, rates: dict[str, Column]) -> Column:
    """The emission rate of the current mode; NULL for an unknown mode."""
    picked = F
    for name, rate in rates.items():
        picked = picked.when(mode == name, rate)
    return picked


def emission_for_interval(allowed: Column, mode: Column, hours: Column, rate: Column) -> Column:
    """``rate * hours`` where discharge is allowed, 0 where not or where the mode is unknown.

    A missing rate or interval gives NULL, which sums skip.
    """
    return F.when(allowed & mode.isin(*MODES), rate * hours).otherwise(F.lit(0.0))


def sum_or_zero(value: Column) -> Column:
    """Sum that is 0 for no rows or only NULLs."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def in_range(ts: Column, start, end) -> Column:
    """Half-open interval ``[start, end)``."""
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))


def ne_null_true(column: Column, value) -> Column:
    """``column != value`` where a missing value counts as different."""
    return ~column.eqNullSafe(F.lit(value))


def date_parts(ts: Column) -> dict[str, Column]:
    """Date, hour, Monday-0 weekday, month and day of month."""
    return {
        "date": F.to_date(ts), "hour": F.hour(ts), "day_of_week": F.weekday(ts),
        "month": F.month(ts), "day": F.dayofmonth(ts),
    }
