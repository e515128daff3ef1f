"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

In a uniform permutation the number of rows that go from an input partition to an output
chunk is multivariate hypergeometric. The matrix of those counts is drawn first (Sanders
1998): chunk sizes are given, partition sizes are counted, and the matrix is drawn along a
binary tree over the partitions with a generator seeded by tree node. A task draws the
path to its own row only: the matrix exists nowhere as a whole, and a repeated task draws the
same row. Then each task deals its rows in a random permutation of its row of the matrix,
the rows are exchanged, and each chunk is permuted again. A shard is several chunks of
bounded size, so no shard is one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from changeflow.llm.common import arrow_schema, free_name, mix, shielded, unshielded

SHARDS = 40
#: Rows of a chunk, the unit that is permuted in one sort.
CHUNK_ROWS = 1 << 17
#: Bytes of text in a chunk, about: chunks are random rows, so of mean size.
CHUNK_BYTES = 128 << 20
#: Above it numpy's sampler does not draw.
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n rows drawn from good + bad are good."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(good, n)
    total = good + bad
    mean = n / total * good
    spread = int(12 * np.sqrt(mean * (bad / total) * ((total - n) / max(total - 1, 1)))) + 12
    low, high = max(low, int(mean) - spread), min(high, int(mean) + spread)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.concatenate(([0.0], np.cumsum(steps)))
    mass = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def draw(rng: np.random.Generator, capacity: np.ndarray, n: int) -> np.ndarray:
    """How many of n rows go to each chunk, of those still free."""
    total = int(capacity.sum())
    if total < NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(capacity, n, method="marginals")
    out = np.zeros_like(capacity)
    for i, c in enumerate(capacity.tolist()):
        out[i] = hypergeometric(rng, c, total - c, n)
        total, n = total - c, n - int(out[i])
    return out


def matrix_row(sizes: np.ndarray, capacity: np.ndarray, row: int, seed: int) -> np.ndarray:
    """The row of the communication matrix: counts from partition ``row`` to every chunk."""
    before = np.concatenate(([0], np.cumsum(sizes)))
    low, high, free = 0, len(sizes), capacity
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = draw(rng, free, int(before[middle] - before[low]))
        free, low, high = (left, low, middle) if row < middle else (free - left, middle, high)
    return free


def exact_sizes(n: int, shards: int, chunk_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk sizes, and the shard and the first slot of each. Shard sizes differ by one at most."""
    shard_size = np.full(shards, n // shards, np.int64)
    shard_size[: n % shards] += 1
    each = np.maximum(1, -(-shard_size // chunk_rows))
    shard = np.repeat(np.arange(shards), each)
    k = np.arange(len(shard)) - np.repeat(np.cumsum(each) - each, each)
    size, m = shard_size[shard], each[shard]
    capacity = size // m + (k < size % m)
    first = k * (size // m) + np.minimum(k, size % m)
    return capacity, shard, first


def shuffle_into_shards(df: DataFrame, shards: int = SHARDS, seed: int = 20, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard).

    Every permutation of the rows over the places is equally likely, up to the generator. The same
    seed over the same files gives the same places. ``df`` must give the same partitions when it
    is read twice, as a scan of files does; if it does not, the job fails instead of losing rows.

    Nulls, empty texts and repeated rows are rows as any other; fewer rows than shards leave
    shards empty; an empty table gives no rows; other columns are carried along. If the table has a column
    ``shard`` or ``slot``, the new one has underscores before its name.
    """
    whole, df = df, shielded(df)
    sized = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum((c.cast("long") for c in sized), F.lit(0).cast("long"))
    per_partition = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).collect()
    found = {r["p"]: r["n"] for r in per_partition}
    sizes = np.array([found.get(p, 0) for p in range(max(found, default=-1) + 1)], np.int64)
    mean = sum(r["bytes"] for r in per_partition) // max(int(sizes.sum()), 1)
    capacity, shard, first = exact_sizes(int(sizes.sum()), shards, max(1, min(chunk_rows, chunk_bytes // max(mean, 1))))
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((sizes, capacity))
    extra = T.StructType([T.StructField("_chunk", T.IntegerType()), T.StructField("_key", T.LongType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, (sizes, capacity), done = TaskContext.get().partitionId(), shared.value, 0
        labels = None
        for batch in batches:
            if labels is None:
                if pid >= len(sizes):
                    raise RuntimeError("the input has other partitions than when it was counted; write it first")
                labels = np.repeat(np.arange(len(capacity)), matrix_row(sizes, capacity, pid, seed))
                np.random.default_rng([seed, pid, 1]).shuffle(labels)
            n = batch.num_rows
            if done + n > len(labels):
                raise RuntimeError("the input has other partitions than when it was counted; write it first")
            at = np.arange(done, done + n, dtype=np.uint64)
            key = mix(mix(at + np.uint64(seed)) ^ np.uint64(pid * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[done: done + n], pa.int32()), pa.array(key.view(np.int64))],
                [*batch.schema.names, "_chunk", "_key"])
            done += n
        if labels is not None and done != len(labels):
            raise RuntimeError("the input has other partitions than when it was counted; write it first")

    dealt = df.mapInArrow(deal, arrow_schema(df, extra))
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy("_key")) - 1
    places = F.broadcast(spark.createDataFrame(
        [(i, int(s), int(f)) for i, (s, f) in enumerate(zip(shard, first))], "_chunk int, shard int, _first long"))
    out = dealt.withColumn("_inside", inside).join(places, "_chunk")
    slot = F.col("_first") + F.col("_inside")
    return out.select(*unshielded(whole), F.col("shard").alias(free_name(whole, "shard")), slot.alias(free_name(whole, "slot")))
