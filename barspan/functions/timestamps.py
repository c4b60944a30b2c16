"""Normalising epoch and text times to naive timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted text layout, with no fraction or one of 3, 6 or 9 digits.
STRICT_ISO = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.(\d{3}|\d{6}|\d{9}))?$"

_NANOS = 1_000_000_000
# Fraction digits per unit.
_DIGITS = {"s": 0, "ms": 3, "us": 6}

_DAY_MICROS = 86_400_000_000
# Microseconds per unit.
_UNIT_MICROS = {"s": 1_000_000, "ms": 1_000, "us": 1}


def _unit(unit: str) -> int:
    if unit not in _UNIT_MICROS:
        raise ValueError(f"unknown unit {unit!r}")
    return _UNIT_MICROS[unit]


# Seconds from 1970 to the first moments of the years 1 and 10000.
_FIRST_SECOND, _BEYOND_SECOND = -62_135_596_800, 253_402_300_800


def _whole(value: Column) -> Column:
    """A number as bigint, NULL where 64 bits don't hold it. The range is tested first: a cast that fails makes an exception for every row."""
    return F.when(value.between(-(1 << 63), (1 << 63) - 1), value.try_cast("bigint"))


def epoch_fits(value: Column, unit: str = "us") -> Column:
    """Whether an epoch number is a time of the years 1 to 9999; false for NULL and for numbers (of any unit) that 64 bits don't hold."""
    per_second = _NANOS if unit == "ns" else 1_000_000 // _unit(unit)
    first, last = (max(min(x, (1 << 63) - 1), -(1 << 63)) for x in (_FIRST_SECOND * per_second, _BEYOND_SECOND * per_second - 1))
    return F.coalesce(_whole(value).between(first, last), F.lit(False))


def from_epoch(value: Column, unit: str = "us") -> Column:
    """Epoch number to a naive timestamp; nanoseconds are floored to microseconds.

    NULL for times outside the years 1 to 9999 and for numbers that 64 bits don't hold.
    """
    whole = _whole(value)
    # The product is only formed where it fits.
    micros = F.when(epoch_fits(value, unit), _floor_div(whole, 1000) if unit == "ns" else whole * F.lit(_unit(unit)).cast("bigint"))
    # Day and rest are added to a naive origin, so the session time zone plays no part.
    rest = F.pmod(micros, F.lit(_DAY_MICROS)).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(
        _floor_div(micros, _DAY_MICROS).cast("int"), F.lit(0), F.lit(0), rest.cast("decimal(18,6)")
    )


def from_parts(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """A naive timestamp from its parts; ``second`` may carry a fraction (as decimal). Impossible dates give NULL."""
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second)


def _floor_div(value: Column, by: int) -> Column:
    """Integer division rounding down, exact for the whole bigint range."""
    value = value.cast("bigint")
    rest = F.pmod(value, F.lit(by))
    return F.call_function("div", value, F.lit(by)) - F.when((rest != 0) & (value < 0), 1).otherwise(0)


def to_epoch(at: Column, unit: str = "us") -> Column:
    """A naive timestamp as epoch number, rounded down to the unit."""
    at = at.cast("timestamp_ntz")
    days = F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.extract(F.lit("SECOND"), at) * 1_000_000
    micros = days * _DAY_MICROS + (F.hour(at) * 3600 + F.minute(at) * 60).cast("bigint") * 1_000_000 + seconds.cast("bigint")
    return micros * 1000 if unit == "ns" else _floor_div(micros, _unit(unit))


def parse_strict(text: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS[.fff|.ffffff|.fffffffff]`` to a naive timestamp, anything else to NULL."""
    return F.when(text.rlike(STRICT_ISO), text.try_cast("timestamp_ntz"))


def format_time(at: Column, unit: str = "us") -> Column:
    return _text(at, _DIGITS[unit])


def _text(at: Column, digits: int) -> Column:
    """Built from the naive time's own text, as formatting by pattern would pass through the session's time zone."""
    whole = F.substring_index(at.cast("timestamp_ntz").cast("string"), ".", 1)
    if not digits:
        return whole
    micros = F.lpad(F.pmod(to_epoch(at), F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(whole, F.lit("."), F.substring(micros, 1, digits))


def format_nanos(epoch_ns: Column) -> Column:
    """Nanosecond epoch as text with nine fraction digits."""
    seconds = _text(from_epoch(epoch_ns, "ns"), 0)
    return F.concat(seconds, F.lit("."), F.lpad(F.pmod(epoch_ns, F.lit(_NANOS)).cast("string"), 9, "0"))


def micros_between(start: Column, end: Column) -> Column:
    return to_epoch(end) - to_epoch(start)


def split_epochs(df: DataFrame, epoch: str, unit: str = "us", name: str = "dt") -> tuple[DataFrame, DataFrame]:
    """Rows whose epoch is a time of the years 1 to 9999 (as ``name``), and the rejected rows as they came; a NULL epoch is rejected.

    Epochs that may outgrow 64 bits come as decimals.
    """
    fits = epoch_fits(F.col(epoch), unit)
    return df.where(fits).withColumn(name, from_epoch(F.col(epoch), unit)), df.where(~fits)


def split_parsed(df: DataFrame, text: str, name: str = "dt") -> tuple[DataFrame, DataFrame]:
    """Rows whose text parses (with the time as ``name``), and the rejected rows as they came."""
    parsed = df.withColumn(name, parse_strict(F.col(text)))
    return parsed.where(F.col(name).isNotNull()), parsed.where(F.col(name).isNull()).drop(name)
