"""Ranked lexical search over deduplicated bags.

A score depends on a document only through its length weight m and through how often it holds the
words of the items. So a document is cut down to its bag, the counts of the items' vocabulary; a
hash brings documents with equal bags and equal m together and the grouping compares the bags
themselves, so a class holds identical vectors only. Each class is scored once. A class stands for
at least one document, so the best ten documents are members of the best ten classes, with ties
broken by the smallest id of a class; only those classes are expanded, by ascending id.

Items are worked through in blocks of a bounded number of items and of words, so what a worker holds
does not grow with the items, and whatever their number no pair of item and document is a row:
each task keeps the best ten classes of each item of the block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.llm.common import byte_slices, texts_of
from changeflow.session import materialize

TOP = 10
#: Items of a block, and distinct words of its items, about. An item is never split.
ITEMS = 256
ENTRIES = 500_000
CHUNK = 1 << 22
#: Class rows that are scored together.
ROWS = 8192
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything of ASCII that is neither a digit nor a letter.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same for the bytes of UTF-8: A-Z become lower case, separators become spaces.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The maximal runs of digits, letters and everything beyond ASCII, A-Z lower-cased."""
    return text.translate(FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, key, term, q): the words of each distinct (item_id, text) and how often it holds them."""
    folded = F.trim(F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), BETWEEN, " "))
    rows = items.select("item_id", "text").distinct().select("item_id", F.xxhash64("item_id", "text").alias("key"), folded.alias("j"))
    words = rows.where("j <> ''").select("item_id", "key", F.explode(F.split("j", " ")).alias("term"))
    return words.groupBy("item_id", "key", "term").agg(F.count("*").alias("q"))


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: its number of words, the vocabulary words it holds in ascending order, and their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            for part in byte_slices(batch, "text", CHUNK):
                n, terms, tfs = [], [], []
                for text in texts_of(part["text"]):
                    words = terms_of(text)
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    own = sorted(found)
                    n.append(len(words))
                    terms.append(np.array(own, np.int32))
                    tfs.append(np.array([found[t] for t in own], np.int64))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part["doc_id"], "n": pa.array(n, pa.int64()), "terms": pa.array(terms, pa.list_(pa.int32())), "tfs": pa.array(tfs, pa.list_(pa.int64()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _place(row: tuple) -> tuple:
    score, least, _ = row
    return (-score, True) if least is None else (-score, False, least)


def best_classes(classes: DataFrame, wanted: list[tuple[np.ndarray, np.ndarray]], top: int) -> DataFrame:
    """(item, cid, score, least): the best classes of each item in each task. ``wanted`` has, for each item, its words and their weights."""
    shared = classes.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        held: list[list[tuple]] = [[] for _ in items]
        weights = np.zeros(1 + max((int(t.max()) for t, _ in items if len(t)), default=0), np.int64)
        schema = None
        for batch in batches:
            schema = schema or pa.schema([("item", pa.int32()), ("cid", pa.int64()), ("score", pa.int64()), ("least", batch.schema.field("least").type)])
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                length = np.diff(part["terms"].offsets.to_numpy())
                starts = np.concatenate(([0], np.cumsum(length)[:-1]))
                term, tf = part["terms"].flatten().to_numpy(), part["tfs"].flatten().to_numpy()
                m = np.repeat(part["m"].to_numpy(), length)
                gain = 1_000_000_000 * tf // (1000 * tf + 8 * m)
                cid = part["cid"].to_numpy()
                for i, (own, weighted) in enumerate(items):
                    weights[own] = weighted
                    score = np.add.reduceat(gain * weights[term], starts)
                    weights[own] = 0
                    full = len(held[i]) == top
                    near = np.flatnonzero(score >= held[i][-1][0] if full else score > 0)
                    if len(near) > top:  # ties of the last place stay
                        near = near[score[near] >= np.partition(score[near], len(near) - top)[len(near) - top]]
                    if len(near):
                        least = part["least"].take(pa.array(near)).to_pylist()
                        both = held[i] + list(zip(score[near].tolist(), least, cid[near].tolist()))
                        held[i] = sorted(both, key=_place)[:top]
        if schema is not None:
            rows = [(i, c, s, least) for i, best in enumerate(held) for s, least, c in best]
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    kind = classes.schema["least"].dataType.simpleString()
    return classes.select("cid", "m", "terms", "tfs", "least").mapInArrow(run, f"item int, cid long, score long, least {kind}")


def _first(rows: DataFrame, by: str, order: list[Column], top: int, name: str) -> DataFrame:
    """The first rows of each group; tasks cut their own rows before the shuffle."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col(name) <= top)


def _ranked(docs: DataFrame, entries: list, kind: str, top: int) -> DataFrame:
    """Ranks of the items of one block; ``kind`` is the type of item_id."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({r["term"].encode() for r in entries}))}
    held = materialize(bags(docs, vocabulary), "bags")
    total = held.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, length = total["docs"], total["terms"]
    df = {r["t"]: r["count"] for r in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    owners = list(dict.fromkeys((r["item_id"], r["key"]) for r in entries))
    number = {o: i for i, o in enumerate(owners)}
    words: list[list[tuple[int, int]]] = [[] for _ in owners]
    for r in entries:
        t = vocabulary[r["term"].encode()]
        if t in df:
            words[number[r["item_id"], r["key"]]].append((t, r["q"] * weight(n_docs, df[t])))
    wanted = [(np.array([t for t, _ in w], np.int64), np.array([x for _, x in w], np.int64)) for w in words]

    m = F.expr(f"25L + ((75L * n * {n_docs}L) div {length or 1}L)")
    vector = ["h", "m", "terms", "tfs"]
    keyed = held.where("size(terms) > 0").select("doc_id", m.alias("m"), "terms", "tfs").withColumn("h", F.xxhash64("m", "terms", "tfs"))
    grouped = keyed.groupBy(*vector).agg(F.min("doc_id").alias("least"))
    classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = best_classes(classes, wanted, top)
    best = materialize(_first(found, "item", [F.desc("score"), F.asc_nulls_last("least"), F.asc("cid")], top, "place").select("item", "cid", "score"), "best")
    # At most ``top`` classes for each item of a block, so they are broadcast.
    chosen = classes.join(F.broadcast(best.select("cid").distinct()), "cid").select("cid", *vector)
    members = _first(keyed.join(F.broadcast(chosen), vector).select("cid", "doc_id"), "cid", [F.asc_nulls_last("doc_id")], top, "place")
    ranked = _first(members.join(F.broadcast(best), "cid"), "item", [F.desc("score"), F.asc_nulls_last("doc_id")], top, "rank")
    names = spark.createDataFrame([(i, o[0]) for i, o in enumerate(owners)], f"item int, item_id {kind}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents (doc_id, text) of every item (item_id, text).

    * null, empty and wordless texts: such items and documents are in no result, and such documents
      don't count;
    * equal scores: by ascending doc_id, null ids last; each row of ``docs`` is a document, so
      repeated rows each have a rank; repeated rows of ``items`` are one item, different
      texts of one item_id are ranked each by themselves;
    * texts are counted whole, one at a time; empty tables give no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    kind = items.schema["item_id"].dataType.simpleString()
    entries = materialize(item_terms(items), "items")
    size = entries.agg(F.count_distinct(F.hash("item_id"), "key").alias("items"), F.count("*").alias("entries")).first()
    blocks = max(1, -(-size["items"] // block), -(-size["entries"] // ENTRIES))
    one = F.pmod(F.xxhash64("key"), F.lit(blocks))
    return reduce(DataFrame.union, (
        _ranked(docs, entries.where(one == b).collect(), kind, top) for b in range(blocks)))
