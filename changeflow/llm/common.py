"""Helpers shared by the operators: 128-bit text keys, vectorised hashes, stable numbering of rows."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MASK = (1 << 64) - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; 0 is held out. A null id is in the fold of the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def text_keys(text: str = "text") -> list[Column]:
    """Two 64-bit hashes that stand for a text (null: empty) in joins: 128 bits."""
    value = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(value).alias("_t"), F.xxhash64(F.lit(7919), value).alias("_u")]


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shielded(df: DataFrame) -> DataFrame:
    """The table under names that no operator uses inside; by place, so any names will do."""
    return df.toDF(*[f"c{i}_" for i in range(len(df.columns))])


def unshielded(df: DataFrame) -> list[Column]:
    """The columns of ``shielded(df)`` under their own names."""
    return [F.col(f"c{i}_").alias(name) for i, name in enumerate(df.columns)]


def worker_cache(name: str) -> dict:
    """A dict that outlives a task in a reused Python worker."""
    holder = sys.modules.setdefault("_changeflow_worker", types.ModuleType("_changeflow_worker"))
    return holder.__dict__.setdefault(name, {})


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of MULTIPLIER and of its inverse modulo 2**64, at least n of each."""
    kept = worker_cache("powers")
    if len(kept.get("up", ())) < n:
        size = max(n, 1 << 20)
        up = np.full(size, MULTIPLIER, np.uint64)
        down = np.full(size, np.uint64(pow(int(MULTIPLIER), -1, 1 << 64)), np.uint64)
        up[0] = down[0] = 1
        kept["up"], kept["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return kept["up"], kept["down"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end) of ``data``; equal ranges have equal hashes."""
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * down[start])


def chunks(sizes: list[int], most: int):
    """Index ranges of consecutive items that have ``most`` bytes together, or one item."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def byte_slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, with ``most`` bytes of the column together or one row, before anything becomes Python objects."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    for lo, hi in chunks(sizes.tolist(), most):
        yield batch.slice(lo, hi - lo)


def arrow_schema(df: DataFrame, extra: T.StructType) -> T.StructType:
    return T.StructType(df.schema.fields + extra.fields)


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]
