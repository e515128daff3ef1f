"""Schemas carried by events, inferred from values, declared, evolved."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from changeflow.functions import decode as D
from changeflow.functions.parsing import json_struct, once, unread_fields

# Base types of change-event schemas.
BASE_TYPES = {
    "boolean": "boolean", "int8": "int", "int16": "int", "int32": "int", "int64": "bigint",
    "float32": "float", "float64": "double", "bytes": "binary", "string": "string",
}
# Type names of the compact schema string.
DECLARED_TYPES = {
    "string": "string", "int": "int", "integer": "int", "long": "bigint", "double": "double",
    "float": "double", "boolean": "boolean", "timestamp": "timestamp_ntz", "date": "date",
}
DEFAULT_PRECISION, DEFAULT_SCALE = 38, 18

COLUMN_BLOCK = ("STRUCT<field STRING, type STRING, optional BOOLEAN, name STRING, "
                "parameters MAP<STRING, STRING>>")
SCHEMA_BLOCK = f"fields ARRAY<STRUCT<field STRING, fields ARRAY<{COLUMN_BLOCK}>>>"


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a change-event schema block."""

    name: str
    type: str = "string"
    logical: str | None = None
    optional: bool = True
    parameters: dict = field(default_factory=dict, hash=False)

    @property
    def data_type(self) -> str:
        return map_type(self.type, self.logical, self.parameters)

    def decoded(self, text: Column) -> Column:
        """The typed value of this column from its wire text."""
        target = self.data_type
        if target.startswith("decimal"):
            precision, scale = map(int, re.findall(r"\d+", target))
            return D.decode_decimal(text, precision, scale)
        if target in ("timestamp_ntz", "timestamp"):
            return D.decode_timestamp(text, self.logical)
        if target == "date":
            return D.decode_date(text)
        if self.logical in D.TIME_UNITS:
            return D.decode_time(text, self.logical)
        if target == "binary":
            return D.decode_bytes(text)
        return D.coerce(text, target)


def _decimal(parameters: dict | None) -> str:
    p = parameters or {}
    precision = p.get("connect.decimal.precision", p.get("precision", DEFAULT_PRECISION))
    return f"decimal({int(precision)},{int(p.get('scale', DEFAULT_SCALE))})"


def map_type(base: str, logical: str | None = None, parameters: dict | None = None) -> str:
    """Spark type of a change-event column; times are microseconds in BIGINT."""
    if logical in D.TIMESTAMP_UNITS:
        return "timestamp_ntz"
    if logical == D.ZONED_TIMESTAMP:
        return "timestamp"
    if logical in D.DATES:
        return "date"
    if logical in D.TIME_UNITS:
        return "bigint"
    if logical in D.DECIMALS or (base == "bytes" and "scale" in (parameters or {})):
        return _decimal(parameters)
    return BASE_TYPES.get(base, "string")


def map_type_column(base: Column, logical: Column, parameters: Column) -> Column:
    """C2 over columns, for schemas kept as data."""
    def parameter(*names: str, default: int) -> Column:
        found = [F.try_element_at(parameters, F.lit(n)) for n in names]
        return F.coalesce(*found, F.lit(str(default)))

    base_map = F.create_map(*[F.lit(x) for kv in BASE_TYPES.items() for x in kv])
    is_decimal = F.coalesce(logical.isin(*D.DECIMALS), F.lit(False)) | (
        (base == "bytes") & F.try_element_at(parameters, F.lit("scale")).isNotNull())
    return (
        F.when(logical.isin(*D.TIMESTAMP_UNITS), "timestamp_ntz")
        .when(logical == D.ZONED_TIMESTAMP, "timestamp")
        .when(logical.isin(*D.DATES), "date")
        .when(logical.isin(*D.TIME_UNITS), "bigint")
        .when(is_decimal, F.concat(
            F.lit("decimal("), parameter("connect.decimal.precision", "precision", default=DEFAULT_PRECISION),
            F.lit(","), parameter("scale", default=DEFAULT_SCALE), F.lit(")")))
        .otherwise(F.coalesce(F.try_element_at(base_map, base), F.lit("string")))
    )


def event_schemas(events: DataFrame) -> DataFrame:
    """The columns declared by opened events (``_table``, ``op``, ``schema``, ``ts_ms``).

    One row per table, distinct schema block and column. The block is deduplicated by a
    map-side combined hash aggregate before anything is parsed: one pass, no sort. (Only
    numbers are aggregated; a struct such as ``_order`` would need sorting by the text.)
    """
    image = F.when(F.col("op") == "d", "before").otherwise("after")
    blocks = (
        events.where("schema IS NOT NULL AND op IS NOT NULL")
        .groupBy("_table", image.alias("_image"), "schema")
        .agg(F.min("ts_ms").alias("first_ts_ms"), F.max("ts_ms").alias("last_ts_ms"))
    )
    parsed = once(blocks, "_s", json_struct("schema", SCHEMA_BLOCK))
    entry = F.try_element_at(
        F.filter("_s.fields", lambda e: e["field"] == F.col("_image")), F.lit(1))
    columns = parsed.select("_table", "_image", "first_ts_ms", "last_ts_ms",
                            F.posexplode(entry["fields"]).alias("pos", "c"))
    return columns.select(
        "_table", "_image", "first_ts_ms", "last_ts_ms", "pos",
        F.col("c.field").alias("column_name"),
        F.coalesce("c.type", F.lit("string")).alias("wire_type"),
        F.col("c.name").alias("logical"),
        F.coalesce("c.optional", F.lit(True)).alias("nullable"),
        F.col("c.parameters").alias("parameters"),
        map_type_column(F.coalesce("c.type", F.lit("string")), F.col("c.name"), F.col("c.parameters"))
        .alias("data_type"),
    )


def schema_from_events(events: DataFrame) -> DataFrame:
    """C1 as a report: distinct columns per table."""
    return event_schemas(events).groupBy("_table", "column_name").agg(
        F.min("pos").alias("pos"), F.max_by("data_type", "last_ts_ms").alias("data_type"),
        F.bool_or("nullable").alias("nullable"))


def table_specs(events: DataFrame) -> dict[str, list[ColumnSpec]]:
    """C1 for planning: per table the column list, later blocks overriding earlier ones.

    Only metadata reaches the driver: a row per table, schema version and column.
    """
    specs: dict[str, dict[str, ColumnSpec]] = {}
    rows = event_schemas(events).orderBy("_table", "last_ts_ms", "first_ts_ms", "pos").toLocalIterator()
    for r in rows:
        specs.setdefault(r["_table"], {})[r["column_name"]] = ColumnSpec(
            r["column_name"], r["wire_type"], r["logical"], r["nullable"], dict(r["parameters"] or {}))
    return {table: list(columns.values()) for table, columns in specs.items()}


def key_columns(specs: list[ColumnSpec]) -> list[str]:
    """The NOT NULL columns, a fallback where no key is given."""
    return [s.name for s in specs if not s.optional]


def key_report(events: DataFrame) -> DataFrame:
    """C5 over events: the key columns each table would get from the fallback."""
    return schema_from_events(events).where("NOT nullable").select("_table", "pos", "column_name")


# ---------------------------------------------------------------- inference

BOOL, INT, LONG, DOUBLE, TEXT = 1, 2, 4, 8, 16


def _type_bit(variant: Column) -> Column:
    kind = F.schema_of_variant(variant)
    n = F.try_variant_get(variant, "$", "bigint")
    return (
        F.when(kind == "VOID", 0)
        .when(kind == "BOOLEAN", BOOL)
        .when(kind == "BIGINT", F.when(n.between(-2147483648, 2147483647), INT).otherwise(LONG))
        # An integer too long for BIGINT is kept as text; other decimals are doubles.
        .when(kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), TEXT)
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE") | (kind == "FLOAT"), DOUBLE)
        .otherwise(TEXT)
    )


def _type_of_bits(bits: Column) -> Column:
    """The narrowest type for everything seen, independent of arrival order."""
    return (
        F.when((bits == 0) | (bits >= TEXT), "string")
        .when(bits == BOOL, "boolean")
        .when(bits.bitwiseAND(F.lit(BOOL)) != 0, "string")
        .when(bits >= DOUBLE, "double")
        .when(bits >= LONG, "bigint")
        .otherwise("int")
    )


def infer_schema(df: DataFrame, value: str = "value", table: str = "_table") -> DataFrame:
    """Column types of schema-less JSON per table.

    Types seen are OR-ed as bits, so the aggregate holds one integer per table and
    field and combines map-side: a table with most of the rows is no hot spot.
    """
    parsed = once(df.select(F.col(table).alias("_table"), F.col(value).alias("_json")),
                  "_v", F.try_parse_json("_json")).drop("_json")
    objects = parsed.where(F.schema_of_variant("_v").startswith("OBJECT"))
    fields = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    seen = fields.groupBy("_table", F.col("key").alias("column_name")).agg(
        F.bit_or(_type_bit(F.col("value"))).alias("_bits"), F.count(F.lit(1)).alias("n_values"))
    return seen.select("_table", "column_name", _type_of_bits(F.col("_bits")).alias("data_type"), "n_values")


def inferred_structs(inferred: DataFrame) -> dict[str, T.StructType]:
    """C3 for planning: per table a StructType with columns in name order (metadata only)."""
    fields: dict[str, list[T.StructField]] = {}
    for r in inferred.orderBy("_table", "column_name").toLocalIterator():
        fields.setdefault(r["_table"], []).append(
            T.StructField(r["column_name"], T.DataType.fromDDL(r["data_type"])))
    return {table: T.StructType(fs) for table, fs in fields.items()}


# ---------------------------------------------------------------- declared

def parse_schema_string(text: str) -> T.StructType:
    """C4: ``"a:int,b:decimal(10,2)"`` -> StructType; commas inside parentheses belong
    to the type, unknown types are strings, a part without a type is an error."""
    fields = []
    for part in re.split(r",(?![^(]*\))", text):
        name, sep, declared = (x.strip() for x in part.partition(":"))
        if not (name and sep and declared):
            raise ValueError(f"invalid schema part: {part!r}")
        declared = declared.lower()
        decimal = re.fullmatch(r"decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)", declared)
        ddl = f"decimal({decimal[1]},{decimal[2]})" if decimal else DECLARED_TYPES.get(declared, "string")
        fields.append(T.StructField(name, T.DataType.fromDDL(ddl)))
    return T.StructType(fields)


def read_json_rows(df: DataFrame, schema: T.StructType, value: str = "value",
                   keep: tuple[str, ...] = (), unread: str | None = None) -> DataFrame:
    """Schema-less JSON objects as typed rows: by name, missing -> NULL, extra ignored,
    nested objects as JSON text in string columns. A column renamed by ``merge`` is read by its own name.
    ``unread`` is the name of a column with the fields that have a text but no value."""
    text = F.col(value).cast("string")
    twins = [f for f in schema if f.metadata.get(SOURCE)]
    wire = T.StructType([T.StructField(f.name, T.StringType()) for f in schema if f not in twins])
    parsed = once(df, "_row", F.from_json(text, wire, {"mode": "PERMISSIVE"}))
    if twins:
        parsed = once(parsed, "_all", F.from_json(text, "map<string,string>"))

    def given(f: T.StructField) -> Column:
        source = f.metadata.get(SOURCE)
        return F.try_element_at("_all", F.lit(source)) if source else F.col("_row").getField(f.name)

    def typed(f: T.StructField) -> Column:
        source, text = f.metadata.get(SOURCE), given(f)
        target = f.dataType.simpleString()
        if target.startswith("timestamp"):
            found = D.decode_json_timestamp(text)
        elif target == "date":
            found = D.decode_date(text)
        elif target.startswith("decimal"):
            found = D.fit_decimal(text, f.dataType.precision, f.dataType.scale)
        else:
            found = D.coerce(text, target)
        return found.alias(f.name, metadata=f.metadata) if source else found.alias(f.name)

    return parsed.select(*keep, *[typed(f) for f in schema], *unread_fields(unread, {f.name: (typed(f), given(f)) for f in schema}))


# ---------------------------------------------------------------- evolution

WIDER = {("int", "bigint"), ("float", "double"), ("int", "double")}


def evolve(old: T.StructType, new: T.StructType) -> T.StructType:
    """The merged schema. Columns may be added, int -> bigint, int -> double and float -> double
    may widen, NOT NULL may relax. An absent column stays (nullable); other changes raise."""
    incoming = {f.name: f for f in new}
    merged = []
    for f in old:
        g = incoming.pop(f.name, None)
        if g is None:
            merged.append(T.StructField(f.name, f.dataType, True))
            continue
        a, b = f.dataType.simpleString(), g.dataType.simpleString()
        if a == b or (b, a) in WIDER:
            kind = f.dataType
        elif (a, b) in WIDER:
            kind = g.dataType
        else:
            raise ValueError(f"column {f.name} cannot change from {a} to {b}")
        merged.append(T.StructField(f.name, kind, f.nullable or g.nullable))
    merged += [T.StructField(g.name, g.dataType, True) for g in incoming.values()]
    return T.StructType(merged)


#: Metadata of a column that was renamed: its name in the messages.
SOURCE = "source_name"


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for the values of both; text if there is no other."""
    x, y = a.simpleString(), b.simpleString()
    if x == y or (y, x) in WIDER:
        return a
    if (x, y) in WIDER:
        return b
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = scale + max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    if {x, y} <= {"int", "bigint", "float", "double"}:
        return T.DoubleType()
    return T.StringType()


def merge(known: T.StructType, new: T.StructType) -> T.StructType:
    """C6 without a refusal, for streams that must go on: any two types have a common one.

    Columns keep their place and added ones follow. A name that differs only in case from another
    column's gets a number, and its own name in the metadata, so that both are kept.
    """
    merged = {f.metadata.get(SOURCE, f.name): f for f in known}
    taken = {f.name.lower() for f in known}
    for g in new:
        source = g.metadata.get(SOURCE, g.name)
        f = merged.get(source)
        if f is not None:
            merged[source] = T.StructField(f.name, _common_type(f.dataType, g.dataType), True, f.metadata)
            continue
        name, number = source, 2
        while name.lower() in taken:
            name, number = f"{source}_{number}", number + 1
        taken.add(name.lower())
        merged[source] = T.StructField(name, g.dataType, True, {SOURCE: source} if name != source else {})
    return T.StructType(list(merged.values()))


def quoted(name: str) -> str:
    """A column name as it stands in an expression."""
    return "`" + name.replace("`", "``") + "`"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the columns of ``schema``: casts to wider types, NULL for absent columns."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}

    def column(f: T.StructField) -> Column:
        found = F.col(quoted(f.name)) if f.name in have else F.lit(None)
        # Structs of one type may differ in what may be NULL, which no cast may change.
        return found if have.get(f.name) == f.dataType.simpleString() else found.cast(f.dataType).alias(f.name)

    return df.select(*map(column, schema))


def schema_versions(events: DataFrame, table: str = "_table", schema: str = "schema",
                    order: str = "_order") -> DataFrame:
    """Each point where a table's schema text differs from the one before.

    A window over a whole table would put a hot table in one task. Rows are instead cut
    into equal ordered ranges, compared inside a range, and only the first and last row
    of each range are compared across ranges (two rows per range and table). A 128-bit hash
    stands for the text; the distinct texts, combined map-side, are joined to the result.
    """
    known = events.where(F.col(schema).isNotNull())
    texts = known.select(F.col(schema).alias("_text")).distinct().select(F.md5("_text").alias("_s"), "_text")
    rows = known.select(
        F.col(table).alias("_t"), F.col(order).alias("_o"), F.md5(schema).alias("_s"))
    ranged = rows.repartitionByRange("_t", "_o").withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range", "_t").orderBy("_o")
    marked = ranged.select(
        "_t", "_o", "_s", "_range", F.lag("_s").over(inside).alias("_prev"),
        F.lag(F.lit(True)).over(inside).isNull().alias("_first"),
        F.lead(F.lit(True)).over(inside).isNull().alias("_last"))
    edge = F.col("_first") | F.col("_last")
    across = Window.partitionBy("_t", F.when(edge, -1).otherwise(F.col("_range"))).orderBy("_o")
    # One evaluation of the ranges: edges and inner changes must see the same cut.
    heads = marked.where("_first OR _last OR _prev <> _s").withColumn("_edge_prev", F.lag("_s").over(across))
    changed = F.when(F.col("_first"), F.col("_edge_prev").isNull() | (F.col("_edge_prev") != F.col("_s"))) \
        .otherwise(F.col("_prev") != F.col("_s"))
    return heads.where(changed).join(texts, "_s").select(
        F.col("_t").alias(table), F.col("_o").alias(order), F.col("_text").alias(schema))


def partition_column(schema: T.StructType, name: str = "tm") -> str | None:
    """A table is cut by hour if it has a timestamp column ``tm``."""
    return next((f.name for f in schema if f.name == name
                 and f.dataType.simpleString().startswith("timestamp")), None)


def with_hour(df: DataFrame, column: str | None, name: str = "tm_hour") -> DataFrame:
    """The derived hour column to partition by; unchanged for tables without one."""
    return df.withColumn(name, F.date_trunc("hour", column).cast("timestamp_ntz")) if column else df
