"""Scalar value rules of the entity mappers, as Column expressions.

Rules that depend on the input type take the DataFrame and a column name, because a Column does not know its type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.DoubleType, T.FloatType)


def data_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a top-level column, looked up without regard to case."""
    return next(f.dataType for f in df.schema.fields if f.name.lower() == name.lower())


def first_present(df: DataFrame, *names: str) -> str | None:
    """The first of `names` that is a column of `df`, or None."""
    present = {c.lower() for c in df.columns}
    return next((n for n in names if n.lower() in present), None)


def col_or(df: DataFrame, names: tuple[str, ...] | str, default) -> Column:
    """First column of `names` that exists, else a literal. A NULL value stays NULL: this does not coalesce."""
    name = first_present(df, *((names,) if isinstance(names, str) else names))
    return F.lit(default) if name is None else F.col(name)


def is_not_finite(c: Column) -> Column:
    """True for NaN and both infinities; NULL stays NULL."""
    d = c.cast("double")
    return F.isnan(d) | (F.abs(d) == F.lit(float("inf")))


def finite_or_null(df: DataFrame, name: str) -> Column:
    """NaN and infinities become NULL, so that JSON output stays valid."""
    c = F.col(name)
    if not isinstance(data_type(df, name), _FRACTIONAL):
        return c
    return F.when(~is_not_finite(c), c)


def coerce_numeric(df: DataFrame, names: tuple[str, ...] | str, default: int = 0) -> Column:
    """The number, or `default` for NULL, NaN and infinities."""
    name = first_present(df, *((names,) if isinstance(names, str) else names))
    if name is None:
        return F.lit(default).cast("bigint")
    return F.coalesce(finite_or_null(df, name), F.lit(default))


def whole_or(df: DataFrame, names: tuple[str, ...] | str, default: int) -> Column:
    """The first column of `names` that exists as a 64-bit integer, else `default`; NULL, NaN and infinities are NULL."""
    name = first_present(df, *((names,) if isinstance(names, str) else names))
    return F.lit(default).cast("bigint") if name is None else finite_or_null(df, name).try_cast("bigint")


def safe_str(df: DataFrame, name: str) -> Column:
    """Text form for custom attributes: NULL and non-finite give '', whole floats print as integers."""
    if first_present(df, name) is None:
        return F.lit("")
    c = F.col(name)
    if not isinstance(data_type(df, name), _FRACTIONAL):
        return F.coalesce(c.cast("string"), F.lit(""))
    whole, number = c.try_cast("bigint"), c.cast("double")
    # Doubles beyond 64 bits are whole. In two exact parts, of 2 ** 53 each, they fit a decimal, which prints all digits.
    high = F.when(F.abs(number) < 2.0**115, F.floor(number / 2.0**53))
    low = (number - high * 2.0**53).cast("bigint").cast("decimal(17,0)")
    large = high.cast("decimal(20,0)") * F.lit(1 << 53).cast("decimal(16,0)") + low
    text = (
        F.when(F.abs(number) < 2.0**62, F.when(whole.cast("double") == number, whole.cast("string")))
        .when(F.abs(number) < 2.0**115, large.cast("string"))
    )
    text = F.coalesce(text, c.cast("string"))
    return F.when(is_not_finite(c), F.lit("")).otherwise(F.coalesce(text, F.lit("")))


# A zone at the end of a text with a time: Z, an offset, or a zone's name.
ZONED = r":\d{2}(?:\.\d+)?\s*(?:[Zz]|[+-]\d{1,2}(?::?\d{2}){0,2}|(?:UTC|GMT)\S*|[A-Za-z]+/\S+)\s*$"
# Forms of date texts beside the standard one, each told by how it begins; the time that may follow, by its colons.
DATE_FORMS = {
    r"^ *\d{5,}( |$)": "yyyyMMdd",
    r"^ *\d+ \p{L}{3} ": "d MMM yyyy",
    r"^ *\d+ \p{L}{4,} ": "d MMMM yyyy",
    r"^ *\p{L}{3} \d+,": "MMM d, yyyy",
    r"^ *\p{L}{4,} \d+,": "MMMM d, yyyy",
    r"^ *\d{1,3}/": "M/d/yyyy",
    r"^ *\d{4,}/": "yyyy/M/d",
}
TIME_FORMS = ("", " HH:mm", " HH:mm:ss")


def _naive_micros(c: Column) -> Column:
    """Microseconds since 1970 of a time without zone, read as UTC whatever the session's zone."""
    hours = F.unix_date(c.cast("date")).cast("bigint") * 24 + F.hour(c)
    seconds = (hours * 60 + F.minute(c)) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def _text_micros(c: Column) -> Column:
    """Microseconds since 1970 of a text; one without zone is read as UTC. NULL if its form doesn't fit. The beginning of a text
    tells its form, so each is parsed once."""
    colons = F.length(c) - F.length(F.replace(c, F.lit(":")))
    # A zone is added to the text and the form, so that the session's never counts.
    in_utc = F.concat(F.trim(c), F.lit(" +00:00"))
    parsed = F.when(F.rlike(c, F.lit(ZONED)), F.unix_micros(c.try_cast("timestamp")))
    for beginning, date in DATE_FORMS.items():
        with_time = F.lit(None).cast("bigint")
        for n, time in enumerate(TIME_FORMS):
            with_time = F.when(colons == n, F.unix_micros(F.try_to_timestamp(in_utc, F.lit(f"{date}{time} XXX")))).otherwise(with_time)
        parsed = parsed.when(F.rlike(c, F.lit(beginning)), with_time)
    return parsed.otherwise(_naive_micros(c.try_cast("timestamp_ntz")))


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds: numbers pass (truncated), text is parsed, naive times are UTC, anything else is NULL."""
    if first_present(df, name) is None:
        return F.lit(None).cast("bigint")
    c, dtype = F.col(name), data_type(df, name)
    if isinstance(dtype, T.NumericType):
        return finite_or_null(df, name).try_cast("bigint")
    if isinstance(dtype, T.StringType):
        micros = _text_micros(c)
    elif isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(c)
    elif isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        micros = _naive_micros(c.cast("timestamp_ntz"))
    else:
        return F.lit(None).cast("bigint")
    return F.call_function("div", micros, F.lit(1000))


def when_set(ms: Column) -> Column:
    """An epoch of 0 counts as not set."""
    return F.nullif(ms, F.lit(0).cast("bigint"))


def text_or_empty(c: Column) -> Column:
    """NULL text becomes ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def flag(c: Column, value: str) -> Column:
    """True when the text equals `value`; NULL counts as false."""
    return F.coalesce(c == F.lit(value), F.lit(False))


def truthy(c: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(c.cast("boolean"), F.lit(False))
