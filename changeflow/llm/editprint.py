"""Fingerprints that keep edit distance: a randomised embedding (Chakraborty et al. 2016).

A random walk reads a text: at step j it writes the current character, and a bit shared by all
texts, for (j, character), says whether it moves on. After an edit two walks soon meet again
and write the same, so few edits give few differing places (Hamming distance). The
fingerprint samples written characters at places shared by all texts: PLACES in every
range [2^k, 2^(k+1)), so short and long texts are both covered whole. Likeness is the
share of equal places, each range weighted by its length. Equal texts have equal fingerprints.

How long a walk stays on a character depends on (j, character) alone and comes from a table,
so a walk is one look-up for each character; all texts of a chunk walk together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import mix
from changeflow.session import materialize

PERIOD = 1 << 12
CLASSES = 256
PLACES = 16
SEED = 9
#: Code points that walk together.
CHUNK = 1 << 21
#: Texts up to which a chunk is walked one by one.
FEW = 8
#: Places of a band of the bit-sampled index.
BAND = 4


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Steps a walk stays, by (step in the period, class of the character), and the sampled places."""
    rng = np.random.default_rng(SEED)
    moves = rng.integers(0, 2, (PERIOD, CLASSES), np.uint8)
    moves[PERIOD - 1] = 1
    stay = np.ones((PERIOD, CLASSES), np.uint8)
    for j in range(PERIOD - 2, -1, -1):
        stay[j] = np.where(moves[j] == 1, 1, np.minimum(stay[j + 1] + 1, 255))
    places = []
    for k in range(1, 40):
        low = 1 << k if k > 1 else 0
        width = (1 << k + 1) - low
        places.append(np.sort(low + (rng.permutation(width)[:PLACES] if width <= 4096 else rng.choice(4096, PLACES, replace=False) * (width // 4096))))
    return stay.ravel(), places


STAY, SAMPLED = _tables()
NIBBLES = np.frombuffer(b"0123456789abcdef", np.uint8)


def walk(classes: np.ndarray, begin: np.ndarray, size: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The step at which each character is first written, for texts that lie in ``classes`` from
    ``begin`` and start at ``step``; and the steps at which they end."""
    at = np.zeros(len(classes), np.int64)
    order = np.argsort(-size, kind="stable")
    start, length, now = begin[order], size[order], step[order].astype(np.int64)
    active = len(order) - np.searchsorted(length[::-1], np.arange(int(length[0]) if len(length) else 0), side="right")
    i = 0
    for i, k in enumerate(active.tolist()):
        if k <= FEW:
            break
        place = start[:k] + i
        own = now[:k]
        at[place] = own
        now[:k] = own + STAY[(own & PERIOD - 1) * CLASSES + classes[place]]
    else:
        i = len(active)
    stay = STAY.tobytes()
    for text in range(int(active[i]) if i < len(active) else 0):
        j, own = int(now[text]), []
        low, high = int(start[text]) + i, int(start[text] + length[text])
        for c in classes[low:high].tolist():
            own.append(j)
            j += stay[(j & PERIOD - 1) * CLASSES + c]
        at[low:high] = own
        now[text] = j
    end = np.empty(len(order), np.int64)
    end[order] = now
    return at, end


def _print(steps: list[np.ndarray], points: list[np.ndarray], end: int) -> str:
    """The fingerprint of a text given as consecutive parts."""
    at, chars = np.concatenate(steps), np.concatenate(points)
    if not len(at):
        return ""
    levels = max(1, int(end - 1).bit_length() - 1)
    places = np.concatenate(SAMPLED[:levels])
    symbol = NIBBLES[(mix(chars[np.searchsorted(at, places, side="right") - 1].astype(np.uint64) + np.uint64(SEED)) >> np.uint64(60)).astype(np.int64)]
    return np.where(places < end, symbol, ord("-")).astype(np.uint8).tobytes().decode()


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    x, y = (np.frombuffer(s.ljust(n, "-").encode(), np.uint8) for s in (a, b))
    weight, at = np.zeros(n), 0
    for k, places in enumerate(SAMPLED):
        if at >= n:
            break
        weight[at: at + len(places)] = ((1 << k + 2) - (1 << k + 1 if k else 0)) / len(places)
        at += len(places)
    weight[(x == ord("-")) & (y == ord("-"))] = 0
    return float(weight[x == y].sum() / weight.sum()) if weight.sum() else 1.0


def compare(texts: list[str]) -> list[tuple]:
    """(n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of all but the last text.

    The edited text is the text with its last half, rounded down, replaced by the first characters of the
    next text, as many or all.
    """
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    size = np.array([len(p) for p in points], np.int64)
    half = size[:-1] // 2
    flat = np.concatenate(points) if len(points) else np.zeros(0, np.uint32)
    classes = (mix(flat.astype(np.uint64)) & np.uint64(CLASSES - 1)).astype(np.int64)
    begin = np.cumsum(size) - size
    at, end = walk(classes, begin, size, np.zeros(len(texts), np.int64))
    steps = [at[b: b + n] for b, n in zip(begin, size)]
    keep = size[:-1] - half
    resume = np.array([s[k] if k < n else e for s, k, n, e in zip(steps, keep, size, end)], np.int64)
    taken = np.minimum(half, size[1:])
    part_begin = np.cumsum(taken) - taken
    part = np.concatenate([classes[b: b + n] for b, n in zip(begin[1:], taken)]) if len(taken) else classes[:0]
    at2, end2 = walk(part, part_begin, taken, resume)
    prints = [_print([s], [p], int(e)) for s, p, e in zip(steps, points, end)]
    out = []
    for i in range(len(texts) - 1):
        k, m, b = int(keep[i]), int(taken[i]), int(part_begin[i])
        edited = _print([steps[i][:k], at2[b: b + m]], [points[i][:k], points[i + 1][:m]], int(end2[i]))
        digest = hashlib.sha256((texts[i][:k] + texts[i + 1][:m]).encode("utf-8", "surrogatepass")).hexdigest()
        out.append((int(size[i]), digest, prints[i], edited, likeness(prints[i], edited), likeness(prints[i], prints[i + 1])))
    return out


COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every
    row of ``docs`` (doc_id, text).

    The next document is the one with the next smaller doc_id, after the last the first. Null ids
    come last, equal ids in the order of a hash of the text. Null texts are empty: their fingerprint
    is empty, like only to an empty one. A single row is its own next. Other columns are
    ignored; an empty table gives no rows.

    Rows are dealt in ranges of ids; each range is read in order, and only its first and last
    rows meet those of its neighbours, in a join over as many rows as there are ranges.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = f"doc_id {kind}, {COLUMNS}, edge string, part int, text string"

    def frame(ids: list, found: list[tuple], edge: str | None, part: int, texts: list) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [()] * 6
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, arrow_id), *(pa.array(c, t) for c, t in zip(columns, types)), pa.array([edge] * len(ids), pa.string()),
             pa.array([part] * len(ids), pa.int32()), pa.array(texts, pa.string())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edge", "part", "text"])

    arrow_id = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    nothing = (None,) * 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, ids, texts, total = TaskContext.get().partitionId(), [], [], 0
        fresh = True
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                if fresh:
                    yield frame([doc], [nothing], "first", part, [text])
                    fresh = False
                ids.append(doc)
                texts.append(text)
                total += len(text)
                if total > CHUNK and len(ids) > 1:
                    yield frame(ids[:-1], compare(texts), None, part, [None] * (len(ids) - 1))
                    ids, texts = ids[-1:], texts[-1:]
                    total = len(texts[0])
        if len(ids) > 1:
            yield frame(ids[:-1], compare(texts), None, part, [None] * (len(ids) - 1))
        if ids:
            yield frame(ids[-1:], [nothing], "last", part, texts[-1:])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, following in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "following"))):
                yield frame([doc], compare([text, following]), None, 0, [None])

    made = materialize(ordered.mapInArrow(run, schema), "fingerprints")
    parts = sorted(r["part"] for r in made.where("edge = 'last'").select("part").collect())
    spark = docs.sparkSession
    after = F.broadcast(spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int"))
    last = made.where("edge = 'last'").select("doc_id", "text", "part").join(after, "part")
    first = made.where("edge = 'first'").select(F.col("text").alias("following"), F.col("part").alias("after"))
    rest = last.join(first, "after").select("doc_id", "text", "following").mapInArrow(edges, schema)
    return made.where("edge is null").union(rest).drop("edge", "part", "text")


def similar_pairs(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness) of documents (doc_id, fingerprint) whose fingerprints share a band and are alike.

    A band is BAND places of one range of the fingerprint and the range's number. Only the smallest id
    of a band meets its other members, so a band of n members gives n pairs, not n squared.
    """
    n = F.length("fingerprint")
    cut = F.sequence(F.lit(0), F.greatest(F.ceil(n / BAND).cast("int") - 1, F.lit(0)))
    rows = prints.where(n > 0).select("doc_id", "fingerprint", F.explode(cut).alias("band"))
    rows = rows.select("doc_id", "band", F.substr("fingerprint", F.col("band") * BAND + 1, F.lit(BAND)).alias("places"))
    heads = rows.groupBy("band", "places").agg(F.min("doc_id").alias("head"))
    pairs = rows.join(heads, ["band", "places"]).where("head < doc_id").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    of = prints.select("doc_id", "fingerprint")
    both = pairs.join(of.toDF("a", "print_a"), "a").join(of.toDF("b", "print_b"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([likeness(x, y) for x, y in zip(batch["print_a"].to_pylist(), batch["print_b"].to_pylist())], pa.float64())
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], found], ["a", "b", "likeness"])

    kind = prints.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(verify, f"a {kind}, b {kind}, likeness double").where(F.col("likeness") >= least)
