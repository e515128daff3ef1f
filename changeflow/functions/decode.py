"""Decode wire text into typed values.

Arguments are STRING columns: the text a JSON parser yields for a number, a string
or a nested object. Nothing here raises; a value that cannot be read becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Logical type names of change events and the unit of their numbers.
TIMESTAMP_UNITS = {
    "io.debezium.time.Timestamp": "ms",
    "io.debezium.time.MicroTimestamp": "us",
    "io.debezium.time.NanoTimestamp": "ns",
    "org.apache.kafka.connect.data.Timestamp": "ms",
}
ZONED_TIMESTAMP = "io.debezium.time.ZonedTimestamp"
TIME_UNITS = {
    "io.debezium.time.Time": "ms",
    "io.debezium.time.MicroTime": "us",
    "io.debezium.time.NanoTime": "ns",
    "org.apache.kafka.connect.data.Time": "ms",
}
DATES = ("io.debezium.time.Date", "org.apache.kafka.connect.data.Date")
DECIMALS = ("org.apache.kafka.connect.data.Decimal", "io.debezium.data.VariableScaleDecimal")

# Integers above this are taken for microseconds when the logical type is unknown.
MICROS_THRESHOLD = 1_000_000_000_000_000

INTEGER = r"^\s*[+-]?[0-9]+\s*$"
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _integer(text: Column, target: str = "bigint") -> Column:
    """``try_cast`` behind a pattern test: a failing cast of text costs an exception per
    row, some hundred times the test."""
    return F.when(text.rlike(INTEGER), text.try_cast(target))


def fit_decimal(value: Column | str, precision: int, scale: int) -> Column:
    """round half up to the scale, NULL when the precision is exceeded.

    The magnitude is tested as a double first, so only borderline values can overflow
    inside the cast.
    """
    text = _col(value).cast("string")
    small = F.abs(text.try_cast("double")) <= F.lit(float(10 ** (precision - scale)))
    return F.when(text.rlike(PLAIN_NUMBER) & small, text.try_cast(f"decimal({precision},{scale})"))


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``value`` computed once under ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _fit_sql(number: str, precision: int, scale: int) -> str:
    """``fit_decimal`` for a text that is known to be a number."""
    return (f"CASE WHEN abs(CAST({number} AS DOUBLE)) <= 1E{precision - scale}D "
            f"THEN try_cast({number} AS DECIMAL({precision},{scale})) END")


# Hex digits h of a big-endian two's complement. Up to eight bytes are a BIGINT; more
# are brought to 32 digits, beyond which digits may only repeat the sign. NULL if the
# number needs more than sixteen bytes.
_SIGN = "if(h >= '8', 'F', '0')"
_SHORT = f"conv(lpad(h, 16, {_SIGN}), 16, -10)"
_DIGITS_32 = (f"CASE WHEN length(h) <= 32 THEN lpad(h, 32, {_SIGN}) "
              f"WHEN left(h, length(h) - 32) = repeat({_SIGN}, length(h) - 32) "
              "AND (right(h, 32) >= '8') = (h >= '8') THEN right(h, 32) END")
# The halves of 32 digits f joined in DECIMAL(38,0), NULL beyond it. For a negative high
# half one 2^64 moves to the low half: hi * 2^64 alone would leave the type near -10^38.
_HI = "CAST(CAST(conv(left(f, 16), 16, -10) AS BIGINT) AS DECIMAL(20,0))"
_LO = "CAST(conv(right(f, 16), 16, 10) AS DECIMAL(20,0))"
_TWO_64 = "18446744073709551616BD"
_JOINED = (f"CAST(CASE WHEN f >= '8' THEN try_add(try_multiply({_HI} + 1, {_TWO_64}), {_LO} - {_TWO_64}) "
           f"ELSE try_add(try_multiply({_HI}, {_TWO_64}), {_LO}) END AS DECIMAL(38,0))")


def decode_decimal(text: Column | str, precision: int = 38, scale: int = 18,
                   mode: str = "auto") -> Column:
    """plain number text, base64 unscaled bytes, or ``{"scale", "value"}``.

    Some base64 texts look like numbers (``1234``). ``auto`` reads them as numbers;
    ``mode="base64"`` or ``"text"`` states the encoding.
    """
    def read(raw: str, shift: str) -> str:
        plain = f"CASE WHEN {raw} RLIKE r'{PLAIN_NUMBER}' THEN {_fit_sql(raw, precision, scale)} END"
        if mode == "text":
            return plain
        long = _let("f", _DIGITS_32, f"CAST({_JOINED} AS STRING)")
        unscaled = f"CASE WHEN h <> '' THEN if(length(h) <= 16, {_SHORT}, {long}) END"
        coded = _let("h", f"hex(try_to_binary({raw}, 'base64'))", _let(
            "n", f"concat({unscaled}, 'E', CAST(-({shift}) AS STRING))", _fit_sql("n", precision, scale)))
        if mode == "base64":
            return coded
        return f"CASE WHEN {raw} RLIKE r'{PLAIN_NUMBER}' THEN {_fit_sql(raw, precision, scale)} ELSE {coded} END"

    nested = _let("v", "from_json(raw, 'scale INT, value STRING', map('mode', 'PERMISSIVE'))",
                  read("v.value", f"coalesce(v.scale, {scale})"))
    body = f"raw -> CASE WHEN raw LIKE '{{%' THEN {nested} ELSE {read('raw', str(scale))} END"
    return F.call_function("transform", F.array(_col(text)), F.expr(body))[0]


def from_millis(n: Column) -> Column:
    """Milliseconds to TIMESTAMP, NULL outside its range."""
    bound = 9_223_372_036_854_775  # beyond it milliseconds do not fit a timestamp
    return F.when(n.between(-bound, bound), F.timestamp_millis(n))


def _micros_of_nanos(n: Column) -> Column:
    return F.call_function("div", n - F.pmod(n, F.lit(1000)), F.lit(1000))


def decode_timestamp(text: Column | str, logical: str | None = None) -> Column:
    """F8: change-event timestamp; the unit comes from the logical type.

    Without one, large integers are microseconds and others milliseconds. Text is an
    ISO instant, kept to the millisecond. Zoned values are TIMESTAMP, others NTZ.
    """
    text = _col(text)
    n = _integer(text)
    unit = TIMESTAMP_UNITS.get(logical)
    number = {
        "ms": lambda: from_millis(n),
        "us": lambda: F.timestamp_micros(n),
        "ns": lambda: F.timestamp_micros(_micros_of_nanos(n)),
    }.get(unit, lambda: F.when(n > MICROS_THRESHOLD, F.timestamp_micros(n)).otherwise(from_millis(n)))()
    iso = F.date_trunc("MILLISECOND", F.try_to_timestamp(F.when(n.isNull(), text)))
    value = F.coalesce(number, iso)
    return value if logical == ZONED_TIMESTAMP else value.cast("timestamp_ntz")


def decode_json_timestamp(text: Column | str) -> Column:
    """integers and digit texts are milliseconds; ISO and SQL texts are parsed."""
    text = _col(text)
    n = _integer(text)
    return F.coalesce(from_millis(n), F.try_to_timestamp(F.when(n.isNull(), text))).cast("timestamp_ntz")


def decode_date(text: Column | str) -> Column:
    """days since the epoch, or an ISO date."""
    text = _col(text)
    days = _integer(text, "int")
    return F.coalesce(F.date_from_unix_date(days), F.when(days.isNull(), text).try_cast("date"))


def decode_time(text: Column | str, logical: str | None = None) -> Column:
    """microseconds of the day, scaled by the logical type (else unchanged)."""
    n = _integer(_col(text))
    unit = TIME_UNITS.get(logical)
    if unit == "ms":
        return F.try_multiply(n, F.lit(1000).cast("bigint"))
    if unit == "ns":
        return _micros_of_nanos(n)
    return n


def coerce(text: Column | str, target: str, zero_on_bad: bool = False) -> Column:
    """lenient scalar reading; ``zero_on_bad`` gives 0/false/'' for bad values.

    JSON null stays NULL in both modes.
    """
    text = _col(text)
    clean = F.trim(text)
    number = F.when(clean.rlike(PLAIN_NUMBER), clean.try_cast("double"))
    if target == "string":
        return text
    if target == "boolean":
        value = F.when(clean == "true", True).when(clean == "false", False).otherwise(number != 0)
        zero = F.lit(False)
    elif target in ("int", "bigint"):
        value = F.when(clean.rlike(INTEGER), clean.try_cast(target)).otherwise(number.try_cast(target))
        zero = F.lit(0).cast(target)
    else:
        value, zero = number.cast(target), F.lit(0).cast(target)
    return F.coalesce(value, F.when(text.isNotNull(), zero)) if zero_on_bad else value


def decode_bytes(text: Column | str, raw_text: bool = False) -> Column:
    """base64 bytes; ``raw_text`` gives the text's own UTF-8 bytes instead."""
    text = _col(text)
    return F.to_binary(text, F.lit("utf-8")) if raw_text else F.try_to_binary(text, F.lit("base64"))
