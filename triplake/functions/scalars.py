"""Coercion helpers (values of unknown type -> typed Columns).

Each helper takes a Column and the Spark type it currently has; the type is
known at plan time from the DataFrame schema, so the dispatch costs nothing
at run time and the result stays a plain Catalyst expression (codegen, no
Python in the data path).  ANSI mode is assumed on: every cast that may fail
is a ``try_cast`` or guarded.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# A number as Python's float() reads it (including "inf"/"infinity"), minus
# the spellings Spark reads but Python does not ("5d", "5f"), digit-group
# underscores ("1_000") and "nan" (NaN is normalised to null anyway).
NUMBER_PATTERN = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# The usual spelling: cast as it stands, without trimming (``\z``: no line end after it, as ``$`` would let pass).
_PLAIN_NUMBER = r"^[+-]?\d++(?:\.\d*+)?(?:[eE][+-]?\d++)?\z"

# ISO date or date-time, extended (2022-04-01T08:30) or basic (20220401T0830) in
# either part, hours alone allowed, any number of fraction digits after a point or
# comma; optionally " UTC", "Z" or a numeric offset.  Week and ordinal dates are null.
_DATE_PART = r"(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
_TIME_PART = r"(?:[ T](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?)?"
TIMESTAMP_PATTERN = "^" + _DATE_PART + _TIME_PART + r"( UTC|Z|[+-]\d{2}(?::?\d{2})?)?$"
_OFFSET_PART = r"^([+-])(\d{2}):?(\d{2})?$"
# What warehouse exports write: read by one match, where any other spelling is taken apart by a match for each part.
_PLAIN_TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?: UTC)?\z"

# Characters Python's str.strip() removes (every c with c.isspace()).
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def ntz_seconds(c: Column) -> Column:
    """Seconds from the epoch of a zone-less timestamp read as UTC (``timestamp_diff`` would go through the session zone)."""
    return F.unix_date(F.to_date(c)).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def to_double(c: Column, dtype: T.DataType) -> Column:
    """Value -> double; null, empty, unparsable and NaN -> null."""
    if isinstance(dtype, T.StringType):
        v = F.when(c.rlike(_PLAIN_NUMBER), c.try_cast("double")).when(
            c.rlike(NUMBER_PATTERN), F.btrim(c, F.lit(WHITESPACE)).try_cast("double"))
    elif isinstance(dtype, _NUMERIC):
        v = c.cast("double")
    elif isinstance(dtype, T.BooleanType):
        v = c.cast("int").cast("double")
    else:
        return _null("double")
    return F.nanvl(v, _null("double"))


def to_bigint(c: Column, dtype: T.DataType) -> Column:
    """Value -> bigint by parsing a double and truncating toward zero.

    Out-of-range values become null instead of failing the job.
    """
    if isinstance(dtype, _INTEGRAL):
        return c.cast("bigint")
    return to_double(c, dtype).try_cast("bigint")


def to_naive_ts(c: Column, dtype: T.DataType) -> Column:
    """Value -> zone-less timestamp holding UTC wall time.

    Zoned timestamps and strings with an offset are converted to UTC; the
    result never depends on the session time zone.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch_ntz())
    if isinstance(dtype, T.DateType):
        return c.cast(T.TimestampNTZType())
    if not isinstance(dtype, T.StringType):
        return _null("timestamp_ntz")
    part = lambda *groups: F.concat(*[F.regexp_extract(c, TIMESTAMP_PATTERN, g) for g in groups])
    clock = lambda g: F.coalesce(F.nullif(part(g), F.lit("")), F.lit("00"))
    # microseconds, as far as a timestamp holds them
    local = F.concat(F.concat_ws("-", part(1), part(2, 4), part(3, 5)), F.lit(" "),
                     F.concat_ws(":", clock(6), clock(7), clock(8)), F.lit("."),
                     F.rpad(F.substring(part(9), 1, 6), 6, "0"))
    zone = part(10)          # "", " UTC", "Z" or an offset
    local_ts = local.try_cast(T.TimestampNTZType())
    sign = F.when(F.regexp_extract(zone, _OFFSET_PART, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    hh = F.nullif(F.regexp_extract(zone, _OFFSET_PART, 2), F.lit(""))
    mm = F.nullif(F.regexp_extract(zone, _OFFSET_PART, 3), F.lit(""))
    offset_min = sign * (F.coalesce(hh.try_cast("int"), F.lit(0)) * 60
                         + F.coalesce(mm.try_cast("int"), F.lit(0)))
    utc = F.when(zone.rlike(_OFFSET_PART),
                 F.timestamp_add("MINUTE", -offset_min, local_ts)).otherwise(local_ts)
    return F.when(c.rlike(_PLAIN_TIMESTAMP), F.substring(c, 1, 19).try_cast(T.TimestampNTZType())).when(
        c.rlike(TIMESTAMP_PATTERN), utc)


def strip_whitespace(c: Column) -> Column:
    """Python ``str.strip()``: remove every whitespace character at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def default_if_empty(c: Column, default: str) -> Column:
    """Python ``value or default`` for strings: null and "" become default."""
    return F.when(c.isNull() | (c == F.lit("")), F.lit(default)).otherwise(c)


def default_strip(c: Column, default: str) -> Column:
    """Python ``(value or default).strip()``."""
    return strip_whitespace(default_if_empty(c, default))


def in_closed_range(c: Column, low, high) -> Column:
    """True when low <= c <= high; null counts as outside."""
    return F.coalesce(c.between(F.lit(low), F.lit(high)), F.lit(False))
