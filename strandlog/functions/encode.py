"""Encoders from source types to the replica's storage types: Catalyst expressions, no user functions.

A value that has no exact encoding raises an error that starts with "<spec key>.<column>: ". NULL stays NULL.
Errors only show where a column is computed, so replicas are written whole (see ``sources.store``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.spec import TableSpec

SIZE_GUARD = 1_900_000
SIZE_CAP = 2_000_000
SAFE_INTEGER = 2**53 - 1
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
#: date, optional time, fraction only after a time, optional zone
_GRAMMAR = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2})?(?:\.(\d+))?)?(?:([Zz])|([+-]\d{2})(?::?(\d{2}))?)?$"


def _raise(prefix: str, message: str, value: Column | None = None) -> Column:
    text = F.lit(f"{prefix}: {message}") if value is None else F.concat(F.lit(f"{prefix}: {message}: "), F.substring(F.coalesce(value.cast("string"), F.lit("NULL")), 1, 80))
    return F.raise_error(text)


def _checked(value: Column, fine: Column, out: Column, error: Column) -> Column:
    return F.when(value.isNull(), F.lit(None)).when(F.coalesce(fine, F.lit(False)), out).otherwise(error)


def size_of(value: Column) -> Column:
    """Bytes as stored: UTF-8 for text."""
    return F.octet_length(value)


def guard_size(value: Column, prefix: str = "value") -> Column:
    return _checked(value, size_of(value) <= SIZE_GUARD, value, _raise(prefix, f"value exceeds the {SIZE_CAP} byte cap"))


def encode_text(value: Column, prefix: str = "value") -> Column:
    return guard_size(value.cast("string"), prefix)


def encode_integer(value: Column, prefix: str = "value") -> Column:
    """Whole numbers of at most 2**53 - 1 in size; text must be digits, with a sign at most."""
    text = F.trim(value.cast("string"))
    plain = text.rlike(r"^[+-]?\d+(?:\.0+)?$")
    number = F.regexp_replace(text, r"\.0+$", "").try_cast("bigint")
    return _checked(value, plain & number.between(-SAFE_INTEGER, SAFE_INTEGER), number, _raise(prefix, "not a safe integer", value))


def _digits(value: Column, prefix: str, kind: T.DataType | None) -> Column:
    """The value's own digits. A floating number is taken only if it holds them all: a whole one within 2**53 - 1,
    without a fraction, or one with a fraction; a larger whole one has lost digits before it came here.
    """
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = value.cast("double")
        whole = number == F.floor(number)
        text = F.when(whole, number.try_cast("bigint").cast("string")).otherwise(value.cast("string"))
        finite = ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
        return _checked(value, finite & (~whole | (F.abs(number) <= SAFE_INTEGER)), text, _raise(prefix, "digits were lost in a floating number", value))
    return guard_size(value.cast("string"), prefix)


def encode_bigint(value: Column, prefix: str = "value", kind: T.DataType | None = None) -> Column:
    return _digits(value, prefix, kind)


def encode_numeric(value: Column, prefix: str = "value", kind: T.DataType | None = None) -> Column:
    """Decimal text as it is: digits are neither rounded nor rescaled, and never pass through a double."""
    return _digits(value, prefix, kind)


def encode_real(value: Column, prefix: str = "value") -> Column:
    number = value.try_cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return _checked(value, number.isNotNull() & finite, number, _raise(prefix, "not a finite number", value))


def encode_boolean(value: Column, prefix: str = "value", kind: T.DataType | None = None) -> Column:
    """1 or 0, of true, false, the texts 't', 'f', 'true', 'false', and the numbers 1 and 0 only."""
    text, yes, no = value.cast("string"), ["true", "t"], ["false", "f"]
    if isinstance(kind, T.NumericType):
        text, yes, no = value.cast("double"), [1.0], [0.0]
    return _checked(value, text.isin(*yes, *no), F.when(text.isin(*yes), F.lit(1)).otherwise(F.lit(0)), _raise(prefix, "not a boolean", value))


def parse_timestamp(text: Column) -> Column:
    """Text of the timestamp grammar as an instant, microseconds kept and more digits cut; else NULL."""
    text = F.trim(text)
    part = lambda k: F.regexp_extract(text, _GRAMMAR, k)
    or_else = lambda c, x: F.when(c == "", F.lit(x)).otherwise(c)
    fraction = F.rpad(F.substring(part(4), 1, 6), 6, "0")
    zone = F.when(part(6) == "", F.lit("+00:00")).otherwise(F.concat(part(6), F.lit(":"), or_else(part(7), "00")))
    rebuilt = F.concat(part(1), F.lit(" "), or_else(part(2), "00:00"), or_else(part(3), ":00"), F.lit("."), fraction, zone)
    return F.when(text.rlike(_GRAMMAR), rebuilt.try_cast("timestamp"))


def iso_utc(instant: Column) -> Column:
    """Six fixed digits in UTC, whatever the session's time zone, so that text order is time order."""
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), ISO)


def encode_timestamp(value: Column, prefix: str = "value", kind: T.DataType | None = None) -> Column:
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):  # no zone: UTC, so the clock is formatted as it is
        return F.date_format(value.cast("timestamp_ntz"), ISO)
    instant = value if isinstance(kind, T.TimestampType) else parse_timestamp(value.cast("string"))
    return _checked(value, instant.isNotNull(), iso_utc(instant), _raise(prefix, "not a timestamp", value))


def encode_json(value: Column, prefix: str = "value", kind: T.DataType | None = None) -> Column:
    """JSON text passes; nested values are written with their nulls."""
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return guard_size(F.to_json(value, {"ignoreNullFields": "false"}) if nested else value.cast("string"), prefix)


def encode_blob(value: Column, prefix: str = "value", kind: T.DataType | None = None) -> Column:
    if kind is not None and not isinstance(kind, (T.BinaryType, T.NullType)):
        return _checked(value, F.lit(False), F.lit(None).cast("binary"), _raise(prefix, "not binary"))
    return guard_size(value, prefix)


def encode(value: Column, logical: str, prefix: str = "value", kind: T.DataType | None = None) -> Column:
    """Storage value of a logical type; ``kind`` is the source column's Spark type."""
    if logical == "timestamp":
        return encode_timestamp(value, prefix, kind)
    if logical == "json":
        return encode_json(value, prefix, kind)
    if logical == "blob":
        return encode_blob(value, prefix, kind)
    typed = {"bigint": encode_bigint, "numeric": encode_numeric, "boolean": encode_boolean}
    if logical in typed:
        return typed[logical](value, prefix, kind)
    return {"text": encode_text, "integer": encode_integer, "real": encode_real}[logical](value, prefix)


#: Storage types of the replica.
STORED = {
    "text": T.StringType(), "integer": T.LongType(), "bigint": T.StringType(), "numeric": T.StringType(), "real": T.DoubleType(),
    "boolean": T.IntegerType(), "timestamp": T.StringType(), "json": T.StringType(), "blob": T.BinaryType(),
}


def stored_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(c.name, STORED[c.type]) for c in spec.columns])


def encode_frame(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the registered columns, in order, renamed and encoded. Key and cursor must not be NULL."""
    out = []
    for c in spec.columns:
        prefix = f"{spec.key}.{c.source}"
        value = encode(F.col(f"`{c.source}`"), c.type, prefix, df.schema[c.source].dataType).cast(STORED[c.type])
        if c.source in (spec.primary_key, spec.cursor_column):
            value = F.coalesce(value, _raise(prefix, "must not be NULL").cast(STORED[c.type]))
        out.append(value.alias(c.name))
    return df.select(*out)
