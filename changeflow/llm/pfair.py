"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are cut in blocks, its quanta. A source of weight w has its k-th block
(k = 1, 2, ...) released at floor((k - 1) / w) and due at ceil(k / w); earliest deadline
first, among the released, gives every source in every prefix of the schedule less
than one block more or less than its share (Baruah et al. 1996).

Weights are exact fractions, so no source gains or loses by rounding, however small it is and
however long the mixture. The schedule is as long as the mixture has blocks. One task runs it, with a
few numbers for each source in memory, and writes one row for each block; no rows of the data go there.
Everything else is arithmetic on a row's number within its source. Numbers come from
counts of each input partition and a running number inside it, so no source is gathered.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from changeflow.llm.common import arrow_schema, free_name, shielded, unshielded
from changeflow.session import materialize

BLOCK_ROWS = 8
#: Blocks of the schedule that are written at a time.
BATCH = 1 << 16
#: Weights, if none are given: share ** TEMPER, so rare sources gain.
TEMPER = 0.8
NONE = "\u0000null"


def exact_parts(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportions of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be above 0")
    scale = lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


def parts(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole parts of the period by largest remainder, at least one for every source."""
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources need a period of as many slots at least")
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    rest = period - sum(out.values())
    if rest >= 0:
        for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:rest]:
            out[s] += 1
    while (over := sum(out.values()) - period) > 0:
        for s in sorted(out, key=lambda s: (-out[s], s))[:over]:
            out[s] -= out[s] > 1
    return out


def schedule(shares: dict[str, int], slots: int | None = None) -> Iterator[tuple[str, int, int]]:
    """(source, block of it from 0, slot from 0) of so many slots or one period, earliest deadline first among
    the released. One block runs at a time, so any order of equal deadlines is feasible: by name."""
    period = sum(shares.values())
    names = sorted(shares)
    share, done = [shares[s] for s in names], [0] * len(names)
    ready = [(-(-period // n), i) for i, n in enumerate(share)]
    heapq.heapify(ready)
    waiting: list[tuple[int, int]] = []
    for slot in range(period if slots is None else slots):
        while waiting and waiting[0][0] <= slot:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[i] + 1) * period // share[i]), i))
        due, i = heapq.heappop(ready)
        k = done[i]
        if slot >= due:
            raise AssertionError(f"block {k} of {names[i]} misses its deadline")
        yield names[i], k, slot
        done[i] = k + 1
        heapq.heappush(waiting, ((k + 1) * period // share[i], i))


def block_table(spark: SparkSession, shares: dict[str, int], slots: int) -> DataFrame:
    """(_s, _k, _slot) of ``slots`` slots, written to the shared folder by one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            plan = schedule(shares, slots)
            while part := list(islice(plan, BATCH)):
                s, k, slot = zip(*part)
                yield pa.RecordBatch.from_pydict({"_s": pa.array(s, pa.string()), "_k": pa.array(k, pa.int64()), "_slot": pa.array(slot, pa.int64())})

    return materialize(spark.range(0, 1, 1, 1).mapInArrow(run, "_s string, _k long, _slot long"), "schedule")


def numbered(df: DataFrame, group: str) -> DataFrame:
    """``df`` with ``_pid`` and ``_own``: the input partition and a running number for each
    value of ``group`` inside it. ``df`` must give the same partitions whenever it is read,
    as a scan of files does."""
    extra = T.StructType([T.StructField("_pid", T.IntegerType()), T.StructField("_own", T.LongType())])
    schema = arrow_schema(df, extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            own = []
            for key in batch[group].to_pylist():
                own.append(seen.get(key, 0))
                seen[key] = own[-1] + 1
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([pid] * n, pa.int32()), pa.array(own, pa.int64())],
                                             [*batch.schema.names, "_pid", "_own"])

    return df.mapInArrow(run, schema)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, period: int | None = None) -> DataFrame:
    """The rows of ``docs`` laid out at their target weights: with mix_source, mix_epoch, mix_block, mix_slot, mix_position.

    The mixture is as short as holds every row: the source that is largest for its weight
    appears once, others begin again (mix_epoch 0, 1, ...) and so fill their share. Positions run from 0
    without gaps; rows [0, n) of any n have every source at its weight, to less than one block.
    With ``period``, weights are first rounded to whole parts of it, one at least.

    * a null source is a source of its own; a source of ``docs`` without a weight is an error,
      weights of sources without rows are left out; weights must be above 0;
    * rows are told apart by place, so null ids and repeated rows stay as they are;
    * an empty table gives no rows; other columns are carried along, and where the table has a column with the name of
      a new one, the new one has underscores before its name.
    """
    spark, inner = docs.sparkSession, shielded(docs)
    src = F.coalesce(F.col(f"c{[c.lower() for c in docs.columns].index('source')}_").cast("string"), F.lit(NONE))
    rows = numbered(inner.withColumn("mix_source", src), "mix_source")
    keys = numbered(inner.select(src.alias("mix_source")), "mix_source")
    counts = materialize(keys.groupBy("mix_source", "_pid").agg(F.count("*").alias("c")), "counts")
    sizes = {r["mix_source"]: r["n"] for r in counts.groupBy("mix_source").agg(F.sum("c").alias("n")).collect()}
    if weights is None:
        weights = {s: float(n) ** TEMPER for s, n in sizes.items()}
    else:
        weights = {NONE if s is None else s: w for s, w in weights.items()}
        if missing := sorted(set(sizes) - set(weights)):
            raise ValueError(f"no weight for {missing}")
    if not sizes:
        kinds = "mix_source string, mix_epoch long, mix_block long, mix_slot long, mix_position long"
        return docs.limit(0).select("*", *(F.lit(None).cast(kind).alias(free_name(docs, name)) for name, kind in map(str.split, kinds.split(", "))))
    chosen = {s: weights[s] for s in sizes}
    shares = exact_parts(chosen) if period is None else parts(chosen, period)
    whole = sum(shares.values())
    last = {s: (n - 1) // block_rows for s, n in sizes.items()}
    # The last block that must be there is in its place at its deadline.
    slots = max(-(-(last[s] + 1) * whole // shares[s]) for s in sizes)
    table = block_table(spark, shares, slots)
    sources = F.broadcast(spark.createDataFrame([(s, last[s], sizes[s]) for s in sizes], "_s string, _last long, _size long"))
    ends = table.join(sources, "_s").where("_k = _last")
    total = ends.agg(F.max(F.col("_slot") * block_rows + (F.col("_size") - 1) % block_rows)).first()[0] + 1
    # Where a partition's rows of a source begin: sums over counts, at most one row for each source and partition.
    before = Window.partitionBy("mix_source").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("mix_source", "_pid", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_base"))
    at = rows.join(offsets, ["mix_source", "_pid"]).withColumn("_row", F.col("_base") + F.col("_own"))
    # A row for each place of the mixture, without texts: rows of the data are exchanged once, however often they are repeated.
    places = table.join(sources, "_s").select("_s", "_k", "_slot", "_size", F.explode(F.sequence(F.lit(0), F.lit(block_rows - 1))).alias("_i"))
    place = F.col("_k") * block_rows + F.col("_i")
    places = places.select("_s", (place % F.col("_size")).alias("_at"), F.floor(place / F.col("_size")).alias("mix_epoch"), F.col("_k").alias("mix_block"),
                           F.col("_slot").alias("mix_slot"), (F.col("_slot") * block_rows + F.col("_i")).alias("mix_position"))
    due = [F.col("mix_source") == F.col("_s"), F.col("_row") == F.col("_at")]
    out = at.join(places.where(F.col("mix_position") < total).hint("merge"), due)
    source = F.when(F.col("mix_source") != NONE, F.col("mix_source")).alias(free_name(docs, "mix_source"))
    return out.select(*unshielded(docs), source, *(F.col(c).alias(free_name(docs, c)) for c in ("mix_epoch", "mix_block", "mix_slot", "mix_position")))
