"""Near copies by SuperMinHash (Ertl 2017), banding, exact verification and components.

Each element of a set draws a random permutation of the signature's places and values that
rise by one with each step; a place keeps the smallest value it is offered. The places of
one element differ, which lowers the estimate's variance, and once every place holds a
value below j no later step can change anything: few steps are needed. All elements of a
batch take a step together.

Candidates. 32 bands of 4 places: two sets of similarity 0.75 share no band with a
probability of 5e-6. Equal sets are one class from the start. In a bucket every class is
compared to the bucket's smallest: first in one bucket, then in those where it is still in another component.
Only buckets that hold several components after that are searched within, in blocks of a
bounded size: signatures of members of different components are compared, and those
that may be links are verified at once, until the components are one. No bucket is capped,
no pairs of a group are emitted. Every link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import byte_slices, chunks, mix, span_hashes, text_keys, texts_of
from changeflow.llm.components import connected
from changeflow.session import materialize

WORDS = 5
PLACES = 128
ROWS = 4
CHUNK = 1 << 20
#: Members of a bucket that one task compares with as many others.
BLOCK = 2048
#: A pair goes to verification from this share of equal 8-bit places: 128 places of two sets
#: of similarity 0.75 fall below it with a probability of about 1e-5.
LOW = 0.59


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text.

    A-Z are lower-cased, words are split at space and 09-0D. Fewer words than ``words``
    make one shingle, none makes an empty set.
    """
    joined = [b" ".join(t.lower().split()) for t in texts]
    out: list[np.ndarray] = []
    for lo, hi in chunks([len(j) + 1 for j in joined], CHUNK):
        data = np.frombuffer(b"\n".join(joined[lo:hi]) + b"\n", np.uint8)
        ends = np.flatnonzero((data == 32) | (data == 10))
        starts = np.concatenate(([0], ends[:-1] + 1))
        real = ends > starts  # an empty text is an empty word
        line = np.concatenate(([0], np.cumsum(data[ends] == 10)[:-1]))
        starts, ends, line = starts[real], ends[real], line[real]
        count = np.bincount(line, minlength=hi - lo)
        first = np.concatenate(([0], np.cumsum(count)[:-1]))
        last = len(starts) - 1
        at = np.arange(len(starts))
        stop = np.minimum(at + words - 1, last)
        stop = np.where(count[line] < words, first[line] + count[line] - 1, stop)
        use = np.where(count[line] < words, at == first[line], at + words <= first[line] + count[line])
        hashes, line = span_hashes(data, starts[use], ends[stop[use]]), line[use]
        edges = np.searchsorted(line, np.arange(hi - lo + 1))
        out += [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:])]
    return out


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """SuperMinHash of each set: (sets, places) of uint64, step in the high half and a
    random fraction in the low. An empty set keeps the largest value everywhere."""
    width = np.uint64(32)
    found = np.full(len(sets) * places, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if len(owner) else np.zeros(0, np.uint64)
    order = None
    for step in range(places):
        if not len(owner):
            break
        drawn = mix(element + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        swap = step + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(places - step) >> width).astype(np.int64)
        if step == 0:
            place, first = swap, swap
        else:
            rows = np.arange(len(owner))
            if order is None:
                order = np.tile(np.arange(places, dtype=np.uint8), (len(owner), 1))
                order[rows, first] = 0
            place = order[rows, swap].astype(np.int64)
            order[rows, swap] = order[:, step]
        np.minimum.at(found, owner * places + place, np.uint64(step) << width | drawn >> width)
        open_sets = (found.reshape(len(sets), places) >> width > np.uint64(step)).any(axis=1)
        stay = open_sets[owner]
        owner, element, first = owner[stay], element[stay], first[stay]
        order = order if order is None else order[stay]
    return found.reshape(len(sets), places)


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` places, different between bands."""
    grouped = signature.reshape(len(signature), -1, rows)
    keys = np.arange(1, grouped.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    keys = np.broadcast_to(keys, grouped.shape[:2])
    for i in range(rows):
        keys = mix(keys * np.uint64(31) + grouped[:, :, i])
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, "text", 2 * CHUNK):
            sets = shingle_sets(texts_of(part["text"]))
            signed = np.concatenate([signatures(sets[a:b]) for a, b in chunks([8 * len(s) for s in sets], CHUNK)])
            keys = bands(signed)
            node = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"], "_t": part["_t"], "_u": part["_u"],
                "n": pa.array([len(s) for s in sets], pa.int64()), "node": pa.array(node, pa.int64()),
                "bands": pa.array(list(keys), pa.list_(pa.int64())),
                "sketch": pa.array([bytes(r) for r in signed.astype(np.uint8)], pa.binary())})


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs (a, b, text_a, text_b), those with 100 * intersection >= 75 * union."""
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
        keep = []
        for lo, hi in chunks([1 << 12] * len(a), CHUNK):
            pair = []
            for ids, texts in ((a, batch["text_a"]), (b, batch["text_b"])):
                new = {i: k for k, i in enumerate(ids[lo:hi]) if i not in known}
                texts = texts_of(texts.slice(lo, hi - lo))
                known |= dict(zip(new, shingle_sets([texts[k] for k in new.values()])))
                pair.append([known[i] for i in ids[lo:hi]])
            for x, y in zip(*pair):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            last = b[hi - 1]
            known = {last: known[last]}  # pairs come in the order of b
        chosen = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_pydict({"a": batch["a"].filter(chosen), "b": batch["b"].filter(chosen)})


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text): the text of a class is that of one of its documents."""
    wanted = nodes.join(classes.select("node", "_t", "_u", "first_id"), "node")
    own = docs.select("doc_id", "text", *text_keys()).withColumnRenamed("doc_id", "first_id")
    same = [F.col("w._t") == F.col("d._t"), F.col("w._u") == F.col("d._u"), F.col("w.first_id").eqNullSafe(F.col("d.first_id"))]
    return materialize(own.alias("d").join(wanted.alias("w"), same).select("w.node", "d.text"), "texts")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are links."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts(ends, classes, docs)
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    rows = both.select("a", "b", "text_a", "text_b").sortWithinPartitions("b", "a")
    return materialize(rows.mapInArrow(_similar, "a long, b long").distinct(), "links")


def links_across(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links between members (node, label, n, block, sketch, text) of different components, as
    few as join what they join: pairs that are connected by then are not looked at.

    Of two blocks, only pairs across them are looked at.
    """
    node, label, n, block = (np.array([r[i] for r in rows], np.int64) for i in range(4))
    sketch = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(len(rows), -1)
    label = np.unique(label, return_inverse=True)[1]
    two = block.min() != block.max()
    sets: dict[int, np.ndarray] = {}
    links = []

    def shingles(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_sets([rows[i][5]])[0]
        return sets[i]

    for i in range(len(rows)):
        others = slice(i + 1, None)
        fit = (label[others] != label[i]) & (4 * np.minimum(n[others], n[i]) >= 3 * np.maximum(n[others], n[i]))
        if two:
            fit &= block[others] != block[i]
        near = np.flatnonzero(fit)
        if len(near):
            near = near[(sketch[others][near] == sketch[i]).mean(axis=1) >= LOW]
        for j in (near + i + 1).tolist():
            if label[i] != label[j]:
                x, y = shingles(i), shingles(j)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    links.append((int(node[i]), int(node[j])))
                    label[label == label[j]] = label[i]
    return links


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (bucket, low, high): one group is held, at most two blocks."""
    held: list[tuple] = []
    now = None

    def done() -> pa.RecordBatch:
        links = links_across(held)
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    for batch in batches:
        names = ("bucket", "low", "high", "node", "label", "n", "block", "sketch")
        for bucket, low, high, *member in zip(*(batch[c].to_pylist() for c in names), texts_of(batch["text"])):
            if (bucket, low, high) != now:
                if len(held) > 1:
                    yield done()
                held, now = [], (bucket, low, high)
            held.append(tuple(member))
    if len(held) > 1:
        yield done()


def _open_links(members: DataFrame, classes: DataFrame, docs: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Links between components that meet in a bucket."""
    labelled = members.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    stats = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"))
    held = materialize(labelled.join(stats.where("lo <> hi").select("bucket", "m"), "bucket"), "open")
    texts = _texts(held.select("node").distinct(), classes, docs)
    parts = F.ceil(F.col("m") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    spread = held.select("bucket", "node", "label", own.alias("block"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    rows = spread.join(classes.select("node", "n", "sketch").join(texts, "node"), "node").select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "node", "label", "n", "block", "sketch", "text")
    dealt = rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")
    return materialize(dealt.mapInArrow(_across, "a long, b long"), "links")


def near_copies(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    * null, empty and wordless texts: no shingles, linked with nothing, their own component;
    * equal texts and equal sets: one component; repeated rows keep their number;
    * component_id is the smallest doc_id; null ids don't count, and a row with a null id is
      kept only if its component has no id;
    * an empty table gives no rows; other columns are ignored.
    """
    return _resolved(docs, block).drop("_t", "_u")


def _resolved(docs: DataFrame, block: int) -> DataFrame:
    docs = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _t long, _u long, n long, node long, bands array<long>, sketch binary"
    signed = materialize(docs.select("doc_id", "text", *text_keys()).mapInArrow(_sign, schema), "signatures")
    grouped = signed.where("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "_t", "_u")).alias("f"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        F.min("doc_id").alias("least_id"))
    classes = materialize(grouped.select("node", "n", "bands", "sketch", "least_id", F.col("f.doc_id").alias("first_id"), "f._t", "f._u"), "classes")
    all_members = classes.select("node", F.explode("bands").alias("bucket"))
    heads = all_members.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head <> last")
    members = materialize(all_members.join(heads.select("bucket", "head"), "bucket"), "members")
    stars = members.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    links = _verified(materialize(stars.groupBy("a").agg(F.min("b").alias("b")), "pairs"), classes, docs)
    labels = materialize(connected(links), "labels")
    of_a, of_b = (labels.select(F.col("node").alias(c), F.col("label").alias("label_" + c)) for c in "ab")
    apart = F.coalesce("label_a", "a") != F.coalesce("label_b", "b")
    rest = stars.distinct().join(of_a, "a", "left").join(of_b, "b", "left").where(apart).select("a", "b")
    links = links.union(_verified(materialize(rest, "pairs"), classes, docs))
    labels = materialize(connected(links), "labels")
    links = links.union(_open_links(members.select("bucket", "node"), classes, docs, labels, block))
    labels = materialize(connected(links), "labels")
    in_links = classes.select("node", "least_id").join(labels, "node")
    least = in_links.groupBy("label").agg(F.min("least_id").alias("linked_id"))
    linked = in_links.join(least, "label").select("node", "linked_id")
    by_node = classes.select("node", "least_id").join(linked, "node", "left").select(
        "node", F.coalesce("linked_id", "least_id").alias("component"))
    rows = signed.select("doc_id", "_t", "_u", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(by_node, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "_t", "_u", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` with one document for each group of near copies, all columns kept.

    The document with the smallest id stays; of repeated rows of it, one. Of rows with null ids
    (in groups without an id), one of each text stays.
    """
    kept = _resolved(docs, block).where("kept").groupBy("doc_id", "_t", "_u").agg(F.count("*").alias("_copies"))
    t, u = text_keys()
    same = [F.col("k.doc_id").eqNullSafe(F.col("d.doc_id")), F.col("k._t") == t, F.col("k._u") == u]
    rows = docs.alias("d").join(kept.alias("k"), same)
    single = rows.where(F.col("k._copies") == 1).select("d.*")
    repeated = rows.where(F.col("k._copies") > 1).select("d.*").dropDuplicates(["doc_id", "text"])
    return single.union(repeated)
