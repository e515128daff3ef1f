"""Change streams: row kinds, changelog, keyed state, point-in-time reads.

A changelog row carries ``_table``, ``_kind`` (+I -U +U -D), ``_order`` and columns of
the row image. ``_order`` must be a total order per key; Spark has no implicit order,
so nothing here depends on arrival or on a single reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changeflow.functions.parsing import CORRUPT, SKIPPED, judged, once, open_envelope, unread_fields
from changeflow.operators.schemas import ColumnSpec, conform, read_json_rows
from changeflow.session import materialize

META = ("_table", "_kind", "_order", "_ts_ms")


def row_kind(op: Column | str) -> Column:
    """The changelog kind of an operation code; unknown codes insert."""
    op = F.col(op) if isinstance(op, str) else op
    return F.when(op == "u", "+U").when(op == "d", "-D").otherwise("+I")


def row_image(op: str = "op", before: str = "before", after: str = "after") -> Column:
    """``before`` for a delete, else ``after``."""
    return F.when(F.col(op) == "d", F.col(before)).otherwise(F.col(after))


def source_order(position: list[str] | tuple[str, ...] = ()) -> Column:
    """Total order of events of one source: its own clock and log position, then the place of the message.

    Events that say nothing of their source are ordered by the columns of ``position`` alone.
    """
    return F.struct("source.ts_ms", "source.file", "source.pos", "source.row", *position)


def table_name() -> Column:
    """R2: the source table of an opened event, else a fixed name."""
    return F.coalesce(F.nullif(F.trim("source.table"), F.lit("")), F.lit("unknown_table"))


def data_events(opened: DataFrame, order: Column | None = None) -> DataFrame:
    """P5, R2: opened events that change data, with ``_table``, ``_order`` and ``_image``.

    Events without operation (DDL, heartbeats) or without a row image are dropped.
    """
    return opened.select(
        "*",
        table_name().alias("_table"),
        (source_order() if order is None else order).alias("_order"),
        row_image().alias("_image"),
    ).where("op IS NOT NULL AND _image IS NOT NULL")


def event_error(text: Column) -> Column:
    """Why an opened event is no data change; NULL if it is one, even if some other attribute of it cannot be read."""
    nothing = F.col("op").isNull() | row_image().isNull()
    return F.when(text.isNull(), "empty").when(nothing & F.col(CORRUPT).isNotNull(), "not JSON").when(nothing, SKIPPED)


def judged_events(batch: DataFrame, schema: T.StructType, upsert: bool = True, position: list[str] | tuple[str, ...] = (),
                  refuse: Column | None = None) -> DataFrame:
    """Changelog rows of a declared layout from event texts, with their judgement; nothing is dropped.

    An event without a data change is SKIPPED. With ``upsert=False`` an update is two rows, so accounts count it twice.
    ``refuse`` is why a readable row cannot be used, NULL if it can.
    """
    opened = open_envelope(batch)
    events = opened.select("*", table_name().alias("_table"), source_order(position).alias("_order"), row_image().alias("_image"),
                           event_error(F.col("value")).alias("_why"))
    changes = changelog(events, upsert, keep=("_why", "value"))
    decoded = read_json_rows(changes, schema, "_image", keep=(*META, "_why", "value"), unread="_unread")
    why = F.col("_why") if refuse is None else F.coalesce("_why", refuse)
    return judged(decoded, F.col("value"), why, F.when(why.isNull(), F.col("_unread")).otherwise(F.array().cast("array<string>"))) \
        .drop("_why", "_unread", "value")


def slim_events(events: DataFrame, *more: str) -> DataFrame:
    """Only what the changelog and the schema need: the raw text would double a staged batch."""
    needed = ("_table", "_order", "ts_ms", "op", "before", "_image", "schema", *more)
    return events.select(*[c for c in needed if c in events.columns])


def changelog(events: DataFrame, upsert: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``_table, _kind, _order, _ts_ms, _image`` rows.

    With ``upsert=False`` an update yields its old image (-U) and then the new one (+U).
    """
    meta = [F.col("_table"), F.col("ts_ms").alias("_ts_ms"), *keep]
    if upsert:
        return events.select(*meta, "_order", row_kind("op").alias("_kind"), "_image")

    def entry(kind: Column, step: int, image: Column) -> Column:
        return F.struct(kind.alias("_kind"), F.lit(step).alias("_step"), image.alias("_image"))

    after = entry(row_kind("op"), 1, F.col("_image"))
    before = entry(F.lit("-U"), 0, F.col("before"))
    split = (F.col("op") == "u") & F.col("before").isNotNull()
    return events.select(
        *meta, F.col("_order"),
        F.inline(F.when(split, F.array(before, after)).otherwise(F.array(after))),
    ).select("_table", "_ts_ms", *keep, F.struct("_order.*", "_step").alias("_order"), "_kind", "_image")


def project_images(changes: DataFrame, specs: list[ColumnSpec], unread: str | None = None) -> DataFrame:
    """Decode ``_image`` by field name: missing -> NULL, extra ignored. ``unread`` is the name of a column
    with the fields that have a text but no value."""
    wire = ", ".join(f"`{s.name}` STRING" for s in specs)
    parsed = once(changes, "_row", F.from_json("_image", wire, {"mode": "PERMISSIVE"}))
    keep = [c for c in changes.columns if c != "_image"]
    texts = {s.name: F.col(f"_row.`{s.name}`") for s in specs}
    return parsed.select(*keep, *[s.decoded(texts[s.name]).alias(s.name) for s in specs],
                         *unread_fields(unread, {s.name: (s.decoded(texts[s.name]), texts[s.name]) for s in specs}))


def latest_per_key(changes: DataFrame, keys: list[str], order: str = "_order") -> DataFrame:
    """The last row per key.

    ``max_by`` combines map-side: a hot key costs one row per map task in the shuffle.
    """
    rest = [c for c in changes.columns if c not in keys]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), order).alias("_last"))
        .select(*[c if c in keys else F.col(f"_last.`{c}`") for c in changes.columns])
    )


def drop_meta(df: DataFrame) -> DataFrame:
    return df.drop(*META)


def current_state(changes: DataFrame, keys: list[str], order: str = "_order") -> DataFrame:
    """D6 from an empty target: last image per key, deleted keys removed.

    -U rows are superseded by their +U; they sort before it.
    """
    return drop_meta(latest_per_key(changes, keys, order).where("_kind NOT IN ('-D', '-U')"))


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str],
                  order: str = "_order") -> DataFrame:
    """A keyed target after a set of changes.

    The changes are reduced to one row per key and written to the shared folder, so they are
    decoded once and the join sees unique keys on both sides. Only keys are joined: if
    the reduced changes are small by Spark's own estimate they are broadcast and the target
    is not shuffled, else both sides are.
    """
    last = materialize(latest_per_key(changes, keys, order), "changes")
    kept = target.join(last.select(*keys), keys, "left_anti")
    fresh = conform(last.where("_kind NOT IN ('-D', '-U')"), target.schema)
    return kept.select(*target.columns).unionByName(fresh)


def state_as_of(changes: DataFrame, keys: list[str], ts_ms: int | Column,
                order: str = "_order") -> DataFrame:
    """The state once all changes up to ``ts_ms`` had been applied."""
    bound = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms)
    return current_state(changes.where(F.col("_ts_ms") <= bound), keys, order)


def table_history(changes: DataFrame, version: Column) -> DataFrame:
    """Inserts, updates and deletes per table and version (a commit, a day, ...)."""
    def n(*kinds: str) -> Column:
        return F.count(F.when(F.col("_kind").isin(*kinds), 1))

    return changes.groupBy("_table", version.alias("version")).agg(
        n("+I").alias("n_insert"), n("+U").alias("n_update"), n("-D").alias("n_delete"),
        F.min("_ts_ms").alias("first_ts_ms"), F.max("_ts_ms").alias("last_ts_ms"))


def snapshot_events(snapshot: DataFrame, table: str, ts_ms: int | Column = 0) -> DataFrame:
    """Rows of an initial load as insert changes that precede every event."""
    stamp = (ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms)).cast("bigint")
    null = F.lit(None)
    return snapshot.select(
        F.lit(table).alias("_table"), stamp.alias("_ts_ms"),
        F.struct(stamp.alias("ts_ms"), null.cast("string").alias("file"),
                 null.cast("bigint").alias("pos"), null.cast("bigint").alias("row")).alias("_order"),
        F.lit("+I").alias("_kind"), "*")
