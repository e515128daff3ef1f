"""Toxicity by logistic regression with FTRL-proximal updates (McMahan et al. 2013).

Features are the distinct words, word pairs and pairs with one word between, of a text, and the
beginnings of its words, hashed to 2**20 places. Every coordinate has its own learning
rate, and L1 leaves few weights that are not zero: the model is two short arrays.

The model is fitted in one task on a bounded sample of labelled rows (MAX_TOXIC and MAX_CLEAN
documents, about; chosen by a hash of the id). Scoring is one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from changeflow.llm.common import arrow_schema, chunks, fold, free_name, mix, span_hashes, texts_of
from changeflow.session import materialize

BITS = 20
#: Largest numbers of labelled documents to learn from.
MAX_TOXIC, MAX_CLEAN = 6_000, 12_000
#: Passes over the sample. More of them learn rare words by heart.
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1
#: Words are also features by their first characters (bytes).
STEM = 5
CHUNK = 1 << 20

#: Bytes that words consist of: lower-case letters, digits and all of UTF-8's other letters.
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("a"):ord("z") + 1] = IN_WORD[ord("0"):ord("9") + 1] = IN_WORD[128:] = True


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place) of every feature of a few texts; repeats are left in."""
    lowered = [t.decode("utf-8", "replace").lower().encode() for t in texts]
    data = np.frombuffer(b"\n".join(lowered) + b"\n", np.uint8)
    word = IN_WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    stop = np.cumsum([len(t) + 1 for t in lowered])
    line = np.searchsorted(stop, start, side="right")
    hashes = span_hashes(data, start, end)
    stems = span_hashes(data, start, np.minimum(end, start + STEM))
    lines, found = [line, line], [hashes, mix(stems + np.uint64(1))]
    for gap in (1, 2):
        if len(hashes) > gap:
            same = line[gap:] == line[:-gap]
            found.append(mix(hashes[:-gap] * np.uint64(2 * gap + 1) + hashes[gap:] + np.uint64(gap))[same])
            lines.append(line[gap:][same])
    return np.concatenate(lines), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def fit(examples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and weights that are not zero, and the bias, from examples (distinct places, label)."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = 0.0

    def weights(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    rng = np.random.default_rng(8)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            at, label = examples[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            bias = -z0 / ((BETA + n0 ** 0.5) / ALPHA)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30))) - label
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0 ** 0.5) / ALPHA * bias
            n0 += g * g
    w = weights(z, n)
    at = np.flatnonzero(w)
    return at, w[at].astype(np.float32), float(-z0 / ((BETA + n0 ** 0.5) / ALPHA))


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples: list[tuple[np.ndarray, int]] = []
    for batch in batches:
        texts, labels = texts_of(batch["text"]), batch["toxic"].to_pylist()
        for lo, hi in chunks([len(t) for t in texts], CHUNK):
            line, at = features(texts[lo:hi])
            order = np.argsort(line, kind="stable")
            cuts = np.searchsorted(line[order], np.arange(1, hi - lo))
            parts = np.split(at[order], cuts)
            examples += [(np.unique(p).astype(np.int32), y) for p, y in zip(parts, labels[lo:hi])]
    at, w, bias = fit(examples) if examples else (np.zeros(0, np.int64), np.zeros(0, np.float32), -30.0)
    yield pa.RecordBatch.from_pydict({"at": pa.array([at.tolist()], pa.list_(pa.int32())),
                                      "w": pa.array([w.tolist()], pa.list_(pa.float32())), "bias": pa.array([bias], pa.float64())})


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """The model, one row: at (places), w (weights), bias.

    Learns from documents with a label whose fold is not 0. Null ids and null labels are left
    out; of several labels of a document the largest counts; without any label the
    model rejects nothing.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = marked.where(fold() != 0)
    size = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).where("toxic in (0, 1)").collect()}
    rates = [min(most / max(size.get(label, 0), 1), 1.0) for label, most in ((0, max_clean), (1, max_toxic))]
    rate = F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    draw = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    # At most about max_toxic + max_clean rows, so small enough to broadcast.
    sample = known.where(F.col("toxic").isin(0, 1)).where(draw < rate)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    one = chosen.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", "text"), "doc_id").select("text", "toxic")
    fitted = one.mapInArrow(_fit_task, "at array<int>, w array<float>, bias double")
    # The sample has other odds than the labels; the bias brings those of the labels back.
    odds = float(np.log(rates[0] / rates[1]))
    return materialize(fitted.withColumn("bias", F.col("bias") + odds), "toxicity")


def score(docs: DataFrame, model: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; texts that are null or empty have that of no features. If the table
    has a column ``name``, the new one has underscores before its name."""
    name = free_name(docs, name)
    row = model.first() or {"at": [], "w": [], "bias": -30.0}
    shared = docs.sparkSession.sparkContext.broadcast((np.array(row["at"], np.int64), np.array(row["w"], np.float32), row["bias"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = shared.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = w
        for batch in batches:
            texts = texts_of(batch["text"])
            scores = []
            for lo, hi in chunks([len(t) for t in texts], CHUNK):
                line, place = features(texts[lo:hi])
                counts = dense[place] != 0
                pairs = np.unique(line[counts] << BITS | place[counts])
                total = np.bincount(pairs >> BITS, dense[pairs & (1 << BITS) - 1], hi - lo) + bias
                scores.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, name])

    return docs.mapInArrow(run, arrow_schema(docs, T.StructType([T.StructField(name, T.DoubleType())])))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``: see train and score."""
    model = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, all columns kept, whatever their names.

    Null and empty texts have no features and stay unless the bias alone rejects them; equal texts have equal scores;
    repeated rows are judged each; an empty table gives no rows, and without labels nothing is rejected.
    """
    name = free_name(docs, "toxic_score")
    return score(docs, train(docs, labels), name).where(F.col(name) < threshold).drop(name)
