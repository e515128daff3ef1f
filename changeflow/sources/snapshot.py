"""Initial load of a table by key ranges while it changes (S10, S11), and through JDBC.

The table is read in waves of chunks. The position of the change log is taken before and after each
wave, so what a wave has read lies between the two: changes from the first position on are
applied to its rows, and the log is followed from the second on. Nothing is locked and no row comes
twice. A finished wave is noted, so a load that is started again goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from changeflow.operators.changelog import latest_per_key
from changeflow.operators.schemas import quoted
from changeflow.session import materialize

SPLIT_SIZE, FETCH_SIZE, FACTOR_UPPER, FACTOR_LOWER = 2000, 1000, 10.0, 0.05


def snapshot_chunks(df: DataFrame, key: str, split_size: int = SPLIT_SIZE, strategy: str = "ranked",
                    factor_upper: float = FACTOR_UPPER, factor_lower: float = FACTOR_LOWER) -> DataFrame:
    """Half-open key ranges ``[lower, upper)`` of about ``split_size`` rows.

    The first range has no lower and the last no upper bound, so rows outside the
    measured span belong to a range too. ``ranked`` cuts any keys by their rank; ``even`` cuts integer keys by
    arithmetic from min, max and count; ``by_density`` takes the second where the span of integer keys is between
    ``factor_lower`` and ``factor_upper`` times their number, else the first.
    """
    if strategy not in ("ranked", "even", "by_density"):
        raise ValueError(f"unknown strategy {strategy!r}")
    spark, kind = df.sparkSession, df.schema[key].dataType
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n:
        return spark.range(1).select(F.col("id").alias("chunk"), *[F.lit(None).cast(kind).alias(c) for c in ("lower", "upper")])
    factor = (high - low + 1) / n if isinstance(low, int) else None
    if strategy == "even" and factor is None:
        raise ValueError(f"{key} is no integer")
    if strategy == "ranked" or factor is None or strategy == "by_density" and not factor_lower <= factor <= factor_upper:
        return _ranked_chunks(df, key, split_size)
    step = max(int(factor * split_size), 1)
    chunks = -(-(high - low + 1) // step)
    start = F.lit(low) + F.col("id") * step
    return spark.range(chunks).select(
        F.col("id").alias("chunk"),
        F.when(F.col("id") > 0, start).cast(kind).alias("lower"),
        F.when(F.col("id") < chunks - 1, start + step).cast(kind).alias("upper"))


def _ranked_chunks(df: DataFrame, key: str, split_size: int) -> DataFrame:
    """Ranges of exactly ``split_size`` keys: ranks are local to an ordered range of the
    data plus the size of the ranges before it, so no task sees all keys."""
    keys = df.select(F.col(key).alias("_k")).where("_k IS NOT NULL")
    ranged = materialize(
        keys.repartitionByRange("_k").withColumn("_range", F.spark_partition_id()), "snapshot-keys")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    # One row per range, i.e. at most spark.sql.shuffle.partitions rows.
    local = F.row_number().over(Window.partitionBy("_range").orderBy("_k")) - 1
    ranked = ranged.withColumn("_rn", local).join(F.broadcast(offsets), "_range")
    starts = ranked.select("_k", (F.col("_rn") + F.col("_offset")).alias("_rank")) \
        .where(F.col("_rank") % split_size == 0)
    # Only chunk starts are left: 1/split_size of the keys. Bounds come from a join on
    # the next chunk number rather than a window over all of them.
    heads = starts.select(F.call_function("div", "_rank", F.lit(split_size)).alias("chunk"), F.col("_k").alias("lower"))
    heads = materialize(heads, "snapshot-heads")
    nexts = heads.select((F.col("chunk") - 1).alias("chunk"), F.col("lower").alias("upper"))
    return heads.join(nexts, "chunk", "left").select(
        "chunk", F.when(F.col("chunk") > 0, F.col("lower")).alias("lower"), "upper")


def jdbc_options(url: str, table: str, user: str, password: str, fetch_size: int = FETCH_SIZE) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "fetchsize": str(fetch_size)}


#: (lower, upper) of one chunk, either may be None.
Bounds = tuple
#: Waves of a load; each is a job of its own, and one row of metadata.
WAVES = 64


def within(key: str, lower, upper) -> Column:
    """The keys of a chunk. The first chunk has the NULL keys, too."""
    column = F.col(quoted(key))
    inside = F.lit(True) if lower is None else column >= F.lit(lower)
    inside = inside if upper is None else inside & (column < F.lit(upper))
    return inside | column.isNull() if lower is None else inside


def read_waves(chunks: DataFrame, key: str, read: Callable[[list[Bounds]], DataFrame], position: Callable[[], int],
               out: str, waves: int = WAVES) -> DataFrame:
    """Read all chunks and write their rows below ``out``.

    ``read`` gives the rows of some chunks, ``position`` the place up to which the change log has been
    written just now. Returns (wave, lower, upper, low, high), a row for each wave.
    """
    spark, kind = chunks.sparkSession, chunks.schema["lower"].dataType.simpleString()
    chunks = materialize(chunks, "chunks")
    per_wave = max(1, -(-chunks.count() // waves))
    number = F.call_function("div", F.col("chunk"), F.lit(per_wave)).cast("int")
    plan = sorted(r[0] for r in chunks.select(number).distinct().collect())
    schema = f"wave INT, lower {kind}, upper {kind}, low BIGINT, high BIGINT"
    done = set()
    try:
        done = {r["wave"] for r in spark.read.schema(schema).parquet(f"{out}/notes/*").collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    for wave in plan:
        if wave in done:
            continue
        bounds = [(r["lower"], r["upper"]) for r in chunks.where(number == wave).orderBy("chunk").collect()]
        low = position()
        read(bounds).write.mode("overwrite").parquet(f"{out}/rows/wave={wave}")
        note = (wave, bounds[0][0], bounds[-1][1], low, position())
        spark.createDataFrame([note], schema).coalesce(1).write.mode("overwrite").parquet(f"{out}/notes/{wave}")
    return spark.read.schema(schema).parquet(*[f"{out}/notes/{wave}" for wave in plan])


def loaded_rows(notes: DataFrame, out: str) -> DataFrame:
    """What the waves have read, with their number."""
    numbers = sorted(r["wave"] for r in notes.select("wave").collect())
    parts = [notes.sparkSession.read.parquet(f"{out}/rows/wave={n}").withColumn("wave", F.lit(n)) for n in numbers]
    return reduce(DataFrame.unionByName, parts)


def interleave(loaded: DataFrame, notes: DataFrame, changes: DataFrame, key: str, position: Column, order: Callable[[Column], Column]) -> DataFrame:
    """The loaded rows as they were at the end of their wave, as inserts, and the changes since.

    ``changes`` has ``_kind``, ``_order`` and the columns of ``loaded``; ``position`` is a change's place in the
    log; ``order`` makes the ``_order`` of a loaded row from a place, before all changes that follow it.

    There are at most WAVES notes, so they are broadcast: a change meets each of them, not each chunk.
    """
    columns = [c for c in loaded.columns if c != "wave"]
    names = [quoted(c) for c in columns]
    k = F.col(quoted(key))
    ours = (F.col("_lower").isNull() | (k >= F.col("_lower"))) & (F.col("_upper").isNull() | (k < F.col("_upper")))
    ours = ours | k.isNull() & F.col("_lower").isNull()
    spans = notes.toDF("_wave", "_lower", "_upper", "_low", "_high")
    placed = changes.withColumn("_at", position).join(F.broadcast(spans), ours).where("_at > _low")
    during = placed.where("_at <= _high").select(*names, "_kind", F.struct(F.col("_at").alias("at"), F.col("_order").alias("own")).alias("_sort"), "_high")
    kind = changes.schema["_order"].dataType
    read = loaded.join(F.broadcast(spans), F.col("wave") == F.col("_wave")).select(
        *names, F.lit("+I").alias("_kind"), F.struct(F.col("_low").alias("at"), F.lit(None).cast(kind).alias("own")).alias("_sort"), "_high")
    settled = latest_per_key(read.unionByName(during), [key], "_sort").where("_kind NOT IN ('-D', '-U')")
    first = settled.select(*names, F.lit("+I").alias("_kind"), order(F.col("_high")).cast(kind).alias("_order"))
    return first.unionByName(placed.where("_at > _high").select(*names, "_kind", "_order"))


def jdbc_predicates(key: str, bounds: list[Bounds]) -> list[str]:
    """A WHERE clause for each chunk of an integer or text key; NULL keys are in the first."""
    def text(value) -> str:
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"

    def clause(lower, upper) -> str:
        parts = [] if lower is None else [f"{key} >= {text(lower)}"]
        parts += [] if upper is None else [f"{key} < {text(upper)}"]
        inside = " AND ".join(parts) or "1 = 1"
        return inside if lower is not None else f"({inside}) OR {key} IS NULL"

    return [clause(*b) for b in bounds]


def jdbc_reader(spark: SparkSession, options: dict[str, str], key: str) -> Callable[[list[Bounds]], DataFrame]:
    """``read`` for read_waves: a query of the database for each chunk."""
    rest = dict(options)
    url, table = rest.pop("url"), rest.pop("dbtable")
    return lambda bounds: spark.read.jdbc(url, table, predicates=jdbc_predicates(key, bounds), properties=rest)
