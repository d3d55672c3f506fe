"""Conversions from untrusted text, and number handling shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Costs carry many decimals; summing them as decimals makes totals independent of row order.
COST_DECIMAL = "decimal(28,12)"

MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


# Text conversions are SQL fragments: `text` is a column name or expression, the result goes into
# selectExpr. The wide staging projections stay one call per column that way.


def blank_to_null(text: str) -> str:
    return f"nullif({text}, '')"


def _is_plain_number(text: str) -> str:
    return rf"{text} RLIKE '^[-+0-9.eE\\s]+$'"


def to_double(text: str) -> str:
    """Plain decimal or exponent notation; anything else, and infinities, become NULL."""
    number = f"try_cast({text} AS DOUBLE)"
    finite = f"abs({number}) < double('Infinity')"
    return f"CASE WHEN {_is_plain_number(text)} AND {finite} THEN {number} END"


#: Sign, digits before the point, digits after it, exponent.
_EXPONENT_FORM = r"^\\s*([-+]?)([0-9]*)\\.?([0-9]*)[eE]([-+]?[0-9]+)\\s*$"


def to_long(text: str, dtype: str = "BIGINT") -> str:
    """Integers, and decimal or exponent notation rounded half away from zero.

    The first digit after the point decides. Digits behind it are cut off before the text is converted, or the
    conversion would round them once before the rounding that is meant; an exponent moves the point first.
    """
    plain = rf"regexp_replace({text}, '(\\.[0-9])[0-9]+', '$1')"
    part = lambda n: rf"regexp_extract({text}, '{_EXPONENT_FORM}', {n})"
    digits = f"left({part(3)}, greatest(try_cast({part(4)} AS INT) + 1, 0))"
    shifted = f"concat({part(1)}, '0', {part(2)}, '.', {digits}, 'e', {part(4)})"
    exact = rf"CASE WHEN {text} RLIKE '[0-9]\\.?[eE]' THEN {shifted} ELSE {plain} END"
    rounded = f"round(try_cast({exact} AS DECIMAL(38, 18)), 0)"
    slow = f"CASE WHEN {_is_plain_number(text)} THEN try_cast({rounded} AS {dtype}) END"
    return f"coalesce(try_cast({text} AS {dtype}), {slow})"


def to_int(text: str) -> str:
    return to_long(text, "INT")


def to_bool(text: str) -> str:
    return f"CASE {text} WHEN 'true' THEN true WHEN 'false' THEN false END"


def round_to(value: Column, digits: int) -> Column:
    """Round a double by scaling in binary, so 1.005 gives 1.0 and not 1.01."""
    scale = float(10**digits)
    return F.round(value.cast("double") * scale, 0) / scale


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return round_to(
        part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0)).cast("double"), digits
    )


def in_range(epoch_ms: Column) -> Column:
    return F.when(epoch_ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS), epoch_ms)


def to_instant(epoch_ms: Column) -> Column:
    """Milliseconds since 1970 as a point in time; NULL outside the years 1 to 9999."""
    return F.timestamp_millis(in_range(epoch_ms))


def to_timestamp(epoch_ms: Column) -> Column:
    """The same as date and time in UTC, whatever zone the session is set to."""
    seconds = (in_range(epoch_ms).cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    start = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return start + F.make_dt_interval(secs=seconds)


def to_date(epoch_ms: Column) -> Column:
    return to_timestamp(epoch_ms).cast("date")


def utc_text(epoch_ms: Column) -> Column:
    return F.substring(to_timestamp(epoch_ms).cast("string"), 1, 19)


def _decimal_parts(value: Column) -> tuple[Column, Column]:
    """(value as a decimal, value where it is too large for that)."""
    dec = value.try_cast(COST_DECIMAL)
    return dec, F.when(dec.isNull(), value)


def join_parts(dec: Column, big: Column) -> Column:
    """The total of what was summed as decimals and what was too large for that."""
    return F.coalesce(dec.cast("double") + big, dec.cast("double"), big)


def exact_total(value: Column) -> Column:
    """SUM over doubles that does not depend on row order or partitioning.

    Values are added as decimals; those too large for the decimal type are added as doubles, so
    none is lost.
    """
    dec, big = _decimal_parts(value)
    return join_parts(F.sum(dec), F.sum(big))


class TwoLevelTotal:
    """exact_total for group-bys in two steps: `parts` of rows, then the `total` of parts."""

    def __init__(self, column: str):
        self.column = column
        self._dec, self._big = f"__{column}_dec", f"__{column}_big"

    def names(self) -> list[str]:
        """The columns that `parts` makes."""
        return [self._dec, self._big]

    def parts(self) -> list[Column]:
        dec, big = _decimal_parts(F.col(self.column))
        return [F.sum(dec).alias(self._dec), F.sum(big).alias(self._big)]

    def total(self) -> Column:
        return join_parts(F.sum(self._dec), F.sum(self._big))
