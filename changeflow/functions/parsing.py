"""Parse a text column exactly once."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changeflow.functions.decode import decode_json_timestamp

CORRUPT = "_corrupt"
#: ``_error`` of messages that are no rows by rule, such as heartbeats: counted, no letter.
SKIPPED = "skipped"

SOURCE = "STRUCT<db STRING, table STRING, ts_ms BIGINT, file STRING, pos BIGINT, row BIGINT>"

# The six attributes of a change event, in their archive order. Fixed values.
ENVELOPE_FIELDS = ("before", "after", "source", "op", "ts_ms", "transaction")


def once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``withColumn`` for an expensive expression.

    A filter on a projected expression is pushed below the projection, which would
    evaluate a JSON parse a second time. Filters do not pass a generator's output,
    so a one-row generator pins the expression to a single evaluation.
    """
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))


def unread_fields(name: str | None, fields: dict[str, tuple[Column, Column]]) -> list[Column]:
    """The names of fields (value, text) that have a text but no value, as one column; none without a name for it."""
    if name is None:
        return []
    found = [F.when(value.isNull() & text.isNotNull(), F.lit(n)) for n, (value, text) in fields.items()]
    return [(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")).alias(name)]


def judged(rows: DataFrame, raw: Column, error: Column, fields: Column | None = None) -> DataFrame:
    """``rows`` with their judgement; the raw text stays only where a letter needs it."""
    fields = F.array().cast("array<string>") if fields is None else fields
    noted = rows.withColumns({"_error": error.cast("string"), "_fields": fields})
    speaks = (F.col("_error") != SKIPPED) | (F.col("_error").isNull() & (F.size("_fields") > 0))
    return noted.withColumn("_raw", F.when(speaks, raw.cast("string")))


def json_struct(text: Column | str, ddl: str) -> Column:
    """``from_json`` that never fails; malformed text lands in ``_corrupt`` if declared.

    Giving an option also keeps Catalyst from splitting the parse per accessed field.
    """
    return F.from_json(text, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _wire(ddl: str, timestamp_format: str | None) -> tuple[T.StructType, T.StructType, dict[str, T.DataType], dict[str, str]]:
    """The declared layout, the one that is parsed, the times that are parsed as text, and the options."""
    schema = T.StructType.fromDDL(ddl)
    times = {} if timestamp_format else {
        f.name: f.dataType for f in schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    wire = T.StructType([T.StructField(f.name, T.StringType() if f.name in times else f.dataType) for f in schema])
    options = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format} if timestamp_format else {}
    return schema, wire, times, options | {"columnNameOfCorruptRecord": CORRUPT}


def _declared(name: str, times: dict[str, T.DataType], row: str = "_row") -> Column:
    text = F.col(f"{row}.`{name}`")
    return decode_json_timestamp(text).cast(times[name]) if name in times else text


def _readable(schema: T.StructType) -> Column:
    return reduce(or_, [F.col(f"_row.`{f.name}`").isNotNull() for f in schema], F.col(f"_row.{CORRUPT}").isNull())


def declared_json(df: DataFrame, ddl: str, value: str = "value",
                  timestamp_format: str | None = None, on_error: str = "skip",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a declared schema from JSON text.

    Timestamps follow ``timestamp_format`` if one is given, else ISO (with or without
    zone), SQL style and epoch milliseconds are all read. ``on_error``: ``fail`` stops the
    job, ``skip`` drops malformed rows, ``null`` keeps them as all-null rows. In both
    lenient modes a single unreadable field is NULL and its row is kept.
    """
    schema, wire, times, options = _wire(ddl, timestamp_format)
    options["mode"] = "FAILFAST" if on_error == "fail" else "PERMISSIVE"
    if on_error != "fail":
        wire = wire.add(CORRUPT, T.StringType())
    parsed = once(df, "_row", F.from_json(F.col(value).cast("string"), wire, options))
    if on_error == "skip":
        parsed = parsed.where(F.col(value).isNotNull() & _readable(schema))
    return parsed.select(*keep, *[_declared(f.name, times).alias(f.name) for f in schema])


def judged_json(df: DataFrame, ddl: str, value: str = "value", timestamp_format: str | None = None,
                keep: tuple[str, ...] = (), refuse: Column | None = None) -> DataFrame:
    """F16, Q5: as ``declared_json``, but nothing is dropped: see ``changeflow.sinks.letters`` for the judgement.

    A text is looked through for its unreadable fields only if it has one. ``refuse`` is why a readable row
    cannot be used, NULL if it can.
    """
    schema, wire, times, options = _wire(ddl, timestamp_format)
    text = F.col("_text")
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = once(df.select(*keep, F.col(value).cast("string").alias("_text")), "_row",
                  F.from_json(text, wire.add(CORRUPT, T.StringType()), options | {"mode": "PERMISSIVE"}))
    late = reduce(or_, [_declared(n, times).isNull() & F.col(f"_row.`{n}`").isNotNull() for n in times], F.lit(False))
    doubtful = _readable(schema) & (F.col(f"_row.{CORRUPT}").isNotNull() | late)
    parsed = once(parsed, "_texts", F.when(doubtful, F.from_json(text, as_text, {"mode": "PERMISSIVE"})))
    error = F.when(text.isNull(), "empty").when(~_readable(schema), "malformed")
    named = {f.name: _declared(f.name, times) for f in schema}
    fields = unread_fields("_unread", {n: (c, F.col(f"_texts.`{n}`")) for n, c in named.items()})
    rows = parsed.select(*keep, *[c.alias(n) for n, c in named.items()], "_text", error.alias("_why"), *fields)
    why = F.col("_why") if refuse is None else F.coalesce("_why", refuse)
    return judged(rows, text, why, F.col("_unread")).drop("_text", "_why", "_unread")


def open_envelope(df: DataFrame, value: str = "value", with_schema: bool = False) -> DataFrame:
    """change events with or without the outer ``{"schema", "payload"}`` wrapper.

    Adds op, before, after (JSON text), source (struct), ts_ms, transaction and
    ``_corrupt``; with ``with_schema`` also the schema block as text, which is skipped
    unparsed otherwise.
    """
    body = (f"op STRING, before STRING, after STRING, source {SOURCE}, "
            "ts_ms BIGINT, transaction STRING")
    wire = f"{body}, payload STRUCT<{body}>, {CORRUPT} STRING"
    if with_schema:
        wire += ", schema STRING"
    parsed = once(df, "_env", json_struct(F.col(value).cast("string"), wire))
    wrapped = F.col("_env.payload").isNotNull()
    names = ("op", "before", "after", "source", "ts_ms", "transaction")
    cols = [F.when(wrapped, F.col(f"_env.payload.{n}")).otherwise(F.col(f"_env.{n}")).alias(n)
            for n in names]
    extra = [F.col("_env.schema").alias("schema")] if with_schema else []
    return parsed.select(*df.columns, *cols, *extra, F.col(f"_env.{CORRUPT}").alias(CORRUPT))


def unwrap(df: DataFrame, value: str = "value") -> DataFrame:
    """F5 as text: the bare event of either form in ``value``."""
    text = F.col(value).cast("string")
    parsed = once(df.withColumn(value, text), "_p", json_struct(value, "payload STRING"))
    return parsed.withColumn(value, F.coalesce("_p.payload", value)).drop("_p")


def envelope_columns(df: DataFrame, value: str = "value", flavour: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The raw event as six columns.

    ``text``: objects as JSON text, scalars plain, ts_ms BIGINT.
    ``json``: every attribute as JSON text, so strings keep their quotes and an absent
    or null attribute is the text ``null``. Unreadable events are dropped, unless columns are to be kept.
    """
    if flavour == "json":
        parsed = once(df, "_v", F.try_parse_json(F.col(value).cast("string")))
        return (parsed if keep else parsed.where("_v IS NOT NULL")).select(*keep, *[
            F.coalesce(F.expr(f"to_json(try_variant_get(_v, '$.{n}', 'variant'))"), F.lit("null")).alias(n)
            for n in ENVELOPE_FIELDS
        ])
    ddl = ", ".join(f"{n} {'BIGINT' if n == 'ts_ms' else 'STRING'}" for n in ENVELOPE_FIELDS)
    return declared_json(df, ddl, value, on_error="null" if keep else "skip", keep=keep)


def with_error(df: DataFrame, value: str = "value") -> DataFrame:
    """F16: raw rows with ``error``, why a text is no parseable JSON object; NULL if it is one."""
    text = F.col(value).cast("string")
    return once(df, "_v", F.try_parse_json(text)).withColumn(
        "error",
        F.when(text.isNull(), "empty")
        .when(F.col("_v").isNull(), "malformed")
        .when(~F.schema_of_variant("_v").startswith("OBJECT"), "not an object"),
    ).drop("_v")


def dead_letters(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """F16: split raw rows into parseable JSON objects and ``(value, error)`` rows. Each side reads the rows and parses them."""
    text, kind = F.col(value).cast("string"), with_error(df, value)
    good = kind.where("error IS NULL").select(*df.columns)
    bad = kind.where("error IS NOT NULL").select(text.alias("value"), "error")
    return good, bad
