"""Cleaning of all-text source columns and the way back to text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a source uses for "true".
FIXED_TRUTHY = ("1", "true", "oui", "yes")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def id_text(value: Column | str) -> Column:
    """The whole id as text: a cut would make two ids one."""
    return _col(value).cast("string")


def fitted_text(value: Column | str, width: int) -> Column:
    """The text, at most `width` characters long; a longer one is an error when it is read."""
    text = _col(value).cast("string")
    complaint = F.concat(F.lit(f"longer than {width} characters: "), text)
    return F.when(F.length(text) > width, F.raise_error(complaint).cast("string")).otherwise(text)


def to_date(value: Column | str) -> Column:
    return _col(value).try_cast("date")


def to_timestamp(value: Column | str) -> Column:
    return _col(value).try_cast("timestamp_ntz")


def to_decimal(value: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return _col(value).try_cast(T.DecimalType(precision, scale))


def to_int(value: Column | str) -> Column:
    return _col(value).try_cast("int")


def clean_text(value: Column | str) -> Column:
    return F.trim(_col(value))


def clean_code(value: Column | str) -> Column:
    return F.upper(F.trim(_col(value)))


def clean_lower(value: Column | str) -> Column:
    return F.lower(F.trim(_col(value)))


def flag(value: Column | str, truthy: Sequence[str] = FIXED_TRUTHY) -> Column:
    """True for a truthy text; everything else, NULL included, is false."""
    return F.coalesce(clean_lower(value).isin(*truthy), F.lit(False))


def flag_present(value: Column | str) -> Column:
    """True when the text column holds anything but blanks."""
    return F.coalesce(F.trim(_col(value)) != "", F.lit(False))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name around one blank; a missing part counts as empty text."""
    parts = [F.coalesce(_col(c), F.lit("")) for c in (first, last)]
    return F.concat(parts[0], F.lit(" "), parts[1])


def zero_to_null(code: Column | str) -> Column:
    """Error code as text, NULL for the success code 0."""
    return F.when(_col(code) != 0, _col(code).cast("string"))


def number_or(value: Column | str, default: float = 0.0) -> Column:
    return F.coalesce(_col(value).try_cast("double"), F.lit(default))


def int_or(value: Column | str, default: int = 0) -> Column:
    """Whole part of the number in a text ('12.7' gives 12), or the default."""
    return F.coalesce(_col(value).try_cast("double").try_cast("int"), F.lit(default))


def date_or(value: Column | str, default: Column | None = None) -> Column:
    parsed = to_date(value)
    return parsed if default is None else F.coalesce(parsed, default)


def source_text(df: DataFrame, scale: int = 2) -> list[Column]:
    """Every column of `df` in the text form a change-data source emits."""
    return [_as_text(F.col(f"`{field.name}`"), field.dataType, scale).alias(field.name) for field in df.schema]


def _as_text(value: Column, kind: T.DataType, scale: int) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.lit("1")).when(~value, F.lit("0"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float_text(value, scale)
    return value.cast("string")


def float_text(value: Column, scale: int = 2) -> Column:
    """The float with `scale` places (at most 7), decided by its exact binary value, ties to even.

    Formatting goes by the shortest digits that read back as the float. Those decide wrongly only
    where they end in a 5 just beyond the last place; there the fraction times 2 * 10**scale is
    taken as a rounded product and its exact error, which tell on which side of the tie it lies. So
    2.675 (a little less in binary) gives 2.67 and 0.125 gives 0.12. Infinity reads inf, NaN is
    NULL. A number of more than 17 digits is padded with zeros.
    """
    if not 0 <= scale <= 7:
        raise ValueError("scale is 0 to 7")
    x = value.cast("double")
    size, twice = F.abs(x), float(2 * 10**scale)
    digits = size.try_cast(f"decimal(38,{scale + 1})")
    tie = (digits.cast("double") == size) & (digits * F.lit(10 ** (scale + 1)).cast("decimal(9,0)") % 10 == 5)
    part = size - F.floor(size).cast("double")
    product, split = part * twice, part * 134217729.0
    high = split - (split - part)
    beyond = (product - F.rint(product)) + ((high * twice - product) + (part - high) * twice)
    down = (digits - F.lit(f"{5 * 10 ** -(scale + 1):.{scale + 1}f}").cast(f"decimal(9,{scale + 1})")).cast(f"decimal(38,{scale})")
    up = (digits + F.lit(f"{5 * 10 ** -(scale + 1):.{scale + 1}f}").cast(f"decimal(9,{scale + 1})")).cast(f"decimal(38,{scale})")
    exact = F.when(beyond > 0, up).when(beyond < 0, down).otherwise(F.bround(digits, scale))
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    plain = F.format_string(f"%.{scale}f", size)
    text = F.when(size == float("inf"), "inf").when(tie, exact.cast("string")).otherwise(plain)
    return F.when(x.isNotNull() & ~F.isnan(x), F.concat(sign, text))
