"""Repeated passages by the common-prefix intervals of an enhanced suffix array.

The suffix array is sparse: it holds the suffixes at anchors. An anchor is the place of the
smallest hash of 200 bytes among 201 neighbouring ones, so every string of 400 bytes
contains an anchor, at the same offset wherever it occurs (winnowing, Schleimer et al. 2003),
about one byte in a hundred is one, and only suffixes that begin with the same 200 bytes can
matter to each other. Counting those, combined before the shuffle, leaves the few anchors
that occur more than once.

Suffixes of one anchor are sorted with their common-prefix lengths. A stack scan gives the
intervals, all suffixes with d bytes in common. Within an interval the bytes before the
anchors are sorted too: members with x bytes in common on the left, of which the
interval has several kinds (left-extension diversity), are the occurrences of a maximal repeat of x + d
bytes, and all of them are found, not only neighbours. Bytes are looked at up to 400 from the
anchor, as any longer repeat contains other anchors.

Equal surroundings of an anchor are one member, and copies of a text one text, so copies add no work. An anchor with more
different surroundings than GROUP, a documented parameter, is not gathered: its windows are counted by a hash, with
the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import byte_slices, mix, span_hashes, text_keys, texts_of
from changeflow.session import materialize

LENGTH = 400
#: Different surroundings of one anchor that a task compares.
GROUP = 20_000
CHUNK = 1 << 20
#: Rows that become Python objects together.
AT_ONCE = 1000
END = 1 << 31


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The minimum (or maximum) of every ``width`` consecutive values."""
    pick, fill = (np.minimum, np.iinfo(np.uint64).max) if least else (np.maximum, 0)
    n = len(values)
    blocks = np.full(-(-n // width) * width, fill, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[: n - width + 1], ahead[width - 1: n])


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash of the anchor, hash of its surroundings) of all anchors of a few texts."""
    gram = length // 2
    width = length - gram + 1
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(size)
    begin = stop - size
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at = np.arange(len(data) - gram + 1)
    hashes = span_hashes(data, at, at + gram)
    windows = _sliding(hashes, width, True)
    inside = np.zeros(len(windows) + 1, np.int64)
    long = size >= length
    np.add.at(inside, begin[long], 1)
    np.add.at(inside, stop[long] - length + 1, -1)
    windows[np.cumsum(inside[:-1]) == 0] = 0
    padded = np.zeros(len(windows) + 2 * (width - 1), np.uint64)
    padded[width - 1: width - 1 + len(windows)] = windows
    place = np.flatnonzero((hashes == _sliding(padded, width, False)) & (hashes > 0))
    text = np.searchsorted(stop, place, side="right")
    left = np.maximum(begin[text], place - (length - gram))
    around = span_hashes(data, left, np.minimum(stop[text], place + length))
    around = mix(around + (place - left).astype(np.uint64))
    return text, place - begin[text], hashes[place].view(np.int64), around.view(np.int64)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, common prefix) of all intervals of a suffix array with a prefix of
    ``least`` at least: lcp[i] is that of the suffixes i and i + 1."""
    stack: list[tuple[int, int]] = []  # prefix, first
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield first, i, top
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class Least:
    """The smallest of any range of an array, by ranges of powers of two."""

    def __init__(self, values: list[int]):
        self.levels = [np.array(values, np.int32)]
        while len(self.levels[-1]) > 1 << len(self.levels) - 1:
            step, below = 1 << len(self.levels) - 1, self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The smallest of each range [lo, hi), none of which is empty."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int32)
        for k in np.unique(level).tolist():
            own = level == k
            out[own] = np.minimum(self.levels[k][lo[own]], self.levels[k][hi[own] - (1 << k)])
        return out


def groups(members: list[tuple[bytes, bytes]], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, list[tuple[int, int, int]]]]:
    """The maximal repeats of ``length`` bytes or more, by the interval of the suffix array that they are in:
    (bytes to the right, members in the order of the bytes to the left, [(first, last, bytes to the left), ...]).

    A member is the reversed bytes before an anchor and the bytes from it on. A repeat is that of the members first
    to last; inner ones come before those around them.
    """
    order = sorted(range(len(members)), key=lambda i: members[i][1])
    right = [members[i][1] for i in order]
    lcp = [common(a, b) for a, b in zip(right, right[1:])]
    longest_left = max((len(m[0]) for m in members), default=0)
    found = list(intervals(lcp, length - longest_left))
    if not found:
        return
    by_left = np.array(sorted(range(len(order)), key=lambda i: members[order[i]][0]))
    left = [members[order[i]][0] for i in by_left]
    shared_left = Least([common(a, b) for a, b in zip(left, left[1:])])
    rank, member, prefix = np.empty(len(order), np.int64), np.array(order), np.array(lcp)
    rank[by_left] = np.arange(len(order))
    for first, last, depth in found:
        ranks = np.sort(rank[first:last + 1])
        shared = shared_left.of(ranks[:-1], ranks[1:])
        near = shared >= length - depth
        if not near.any():
            continue
        # Diverse to the right: neighbours that part right after ``depth`` bytes. To the left they are by construction.
        branch = np.concatenate(([0], np.cumsum(prefix[first:last] == depth)))[by_left[ranks] - first]
        parted = np.concatenate(([0], np.cumsum(branch[1:] != branch[:-1])))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], near.view(np.int8), [0]))))
        repeats = []
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if parted[hi] > parted[lo]:
                own = parted[lo:hi + 1].tolist()
                repeats += [(lo + a, lo + b, more) for a, b, more in intervals(shared[lo:hi].tolist(), length - depth) if own[b] > own[a]]
        if repeats:
            yield depth, member[by_left[ranks]], repeats


def maximal_repeats(members: list[tuple[bytes, bytes]], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes to the left, bytes to the right, members) of the maximal repeats of ``length`` bytes or more."""
    for depth, inside, repeats in groups(members, length):
        for first, last, more in repeats:
            yield more, depth, inside[first:last + 1].tolist()


def coverage(members: list[tuple[bytes, bytes]], length: int = LENGTH) -> list[tuple[int, int]]:
    """How far the maximal repeats of each member reach to the left and to the right of its anchor; (0, 0)
    if it is in none. All of them contain the anchor, so together they are one range."""
    left, right = np.zeros(len(members), np.int64), np.zeros(len(members), np.int64)
    for depth, inside, repeats in groups(members, length):
        most = np.full(len(inside), -1)
        for first, last, more in reversed(repeats):  # inner ones share more
            most[first:last + 1] = more
        held = most >= 0
        own = inside[held]
        left[own] = np.maximum(left[own], most[held])
        right[own] = np.maximum(right[own], depth)
    return list(zip(left.tolist(), right.tolist()))


def _find(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, "text", CHUNK):
            text, place, h, c = anchors(texts_of(part["text"]), length)
            own = pa.array(text, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "h": pa.array(h), "c": pa.array(c), **{name: part[name].take(own) for name in ("_t", "_u")},
                "pos": pa.array(place.astype(np.int32)), "doc": part["doc_id"].take(own)})


def _surroundings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes around the wanted anchors of each text."""
    gram = length // 2
    for batch in batches:
        for i in range(batch.num_rows):
            text, wanted = (batch["text"][i].as_buffer() or b"").to_pybytes(), batch["wanted"][i].values
            n, pos = len(wanted), wanted.field("pos").to_pylist()
            for lo in range(0, n, AT_ONCE):
                some = pos[lo:lo + AT_ONCE]
                yield pa.RecordBatch.from_pydict({
                    **{name: wanted.field(name).slice(lo, AT_ONCE) for name in ("h", "c", "m")},
                    **{name: pa.array([batch[name][i].as_py()] * len(some), pa.int64()) for name in ("_t", "_u")}, "pos": pa.array(some, pa.int32()),
                    "left": pa.array([text[max(0, p - (length - gram)): p][::-1] for p in some], pa.binary()),
                    "right": pa.array([text[p: p + length] for p in some], pa.binary())})


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(anchor, its members) of rows that come sorted by anchor; one group is held. A repeated row comes once."""
    held: dict[int, tuple] = {}
    now = None
    for batch in batches:
        for lo in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(lo, AT_ONCE)
            for h, c, *row in zip(*(part[name].to_pylist() for name in ("h", "c", "_t", "_u", "pos", "left", "right"))):
                if h != now:
                    if len(held) > 1:
                        yield now, list(held.values())
                    held, now = {}, h
                held[c] = tuple(row)
    if len(held) > 1:
        yield now, list(held.values())


def _spans(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One span for each member of an anchor's maximal repeats."""
    for _, rows in _gathered(batches):
        reach = coverage([(r[3], r[4]) for r in rows], length)
        out = [(t, u, pos - left, pos + right) for (t, u, pos, *_), (left, right) in zip(rows, reach) if right]
        columns = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_t", "_u", "a", "b"])


def _groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every occurrence of every maximal repeat of each anchor."""
    names = ["h", "number", "_t", "_u", "a", "b"]
    for h, rows in _gathered(batches):
        t, u, pos = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        for number, (left, right, members) in enumerate(maximal_repeats([(r[3], r[4]) for r in rows], length)):
            own = np.array(members)
            columns = (np.full(len(own), h), np.full(len(own), number), t[own], u[own], pos[own] - left, pos[own] + right)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every window of ``length`` bytes that holds the anchor, as two hashes."""
    gram = length // 2
    for batch in batches:
        for t, u, pos, left, right in (r for lo in range(0, batch.num_rows, AT_ONCE)
                                       for r in zip(*(batch[c].slice(lo, AT_ONCE).to_pylist() for c in ("_t", "_u", "pos", "left", "right")))):
            data = np.frombuffer(left[::-1] + right, np.uint8)
            at = np.arange(min(len(data) - length, length - gram, len(left)) + 1)
            if len(at):
                first = span_hashes(data, at, at + length)
                second = mix(span_hashes(255 - data, at, at + length))
                n = len(at)
                yield pa.RecordBatch.from_pydict({
                    "w1": pa.array(first.view(np.int64)), "w2": pa.array(second.view(np.int64)), "_t": pa.array([t] * n, pa.int64()),
                    "_u": pa.array([u] * n, pa.int64()), "a": pa.array(at + pos - len(left))})


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in byte_slices(whole, "text", CHUNK)):
        made: list[tuple] = []
        for text, spans in zip(texts_of(batch["text"]), batch["spans"].to_pylist()):
            n, removed, runs, kept, at = len(text), 0, 0, [], 0
            reach = -1
            for a, b in sorted((max(s["a"], 0), min(s["b"], n)) for s in spans or ()):
                if b - a < length:
                    continue
                runs += a > reach
                if b > reach:
                    start = max(a, at)
                    kept.append(text[at:start])
                    removed += b - start
                    at = reach = b
            kept.append(text[at:])
            made.append((n, removed, runs, hashlib.sha256(b"".join(kept)).hexdigest()))
        columns = list(zip(*made)) if made else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _anchored(keyed: DataFrame, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Anchors that occur more than once, one row for each distinct text and place; their kinds of surroundings with
    one place of each; and the bytes around those places for anchors with several kinds.

    Every join is between written tables, so that Spark can split the rows of a hot anchor over tasks.
    """
    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"h long, c long, _t long, _u long, pos int, doc {kind}"
    found = keyed.select("doc_id", "_t", "_u", "text").where(F.octet_length("text") >= length).mapInArrow(lambda b: _find(b, length), schema)
    # Copies of a text are one row from here on, with one of its documents.
    distinct = materialize(found.groupBy("h", "c", "_t", "_u", "pos").agg(F.min("doc").alias("doc")), "anchors")
    repeated = materialize(distinct.groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("n > 1").select(
        "h", (F.col("lo") != F.col("hi")).alias("several")), "repeated")
    hits = materialize(distinct.join(repeated, "h"), "hits")
    kinds = materialize(hits.groupBy("h", "c", "several").agg(F.count("*").alias("n"), F.min(F.struct("_t", "_u", "pos", "doc")).alias("one")), "kinds")
    sizes = materialize(kinds.where("several").groupBy("h").agg(F.count("*").alias("m")), "sizes")
    wanted = kinds.where("several").join(sizes, "h").select("h", "c", "m", "one.*").groupBy("_t", "_u", "doc").agg(
        F.collect_list(F.struct("pos", "h", "c", "m")).alias("wanted"))
    same = [F.col("k._t") == F.col("w._t"), F.col("k._u") == F.col("w._u"), F.col("k.doc_id").eqNullSafe(F.col("w.doc"))]
    own = keyed.alias("k").join(materialize(wanted, "wanted").alias("w"), same).select("k.text", "k._t", "k._u", "w.wanted")
    around = own.mapInArrow(lambda b: _surroundings(b, length), "h long, c long, m long, _t long, _u long, pos int, left binary, right binary")
    return hits, kinds, materialize(around, "surroundings")


def _by_anchor(around: DataFrame, parts: int) -> DataFrame:
    return around.repartition(parts, "h").sortWithinPartitions("h")


def repeat_spans(keyed: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(_t, _u, a, b): byte ranges of texts that are repeats of ``length`` bytes or more, of all
    rows of ``keyed`` (doc_id, text, _t, _u). Ranges may overlap, end beyond the text or be too
    short for a repeat once they are cut to the text; the latter are none."""
    gram = length // 2
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits, kinds, around = _anchored(keyed, length)
    # Equal surroundings elsewhere: all of them are a repeat.
    alike = materialize(kinds.where("n > 1").select("h", "c"), "alike")
    whole = hits.join(alike, ["h", "c"]).select(
        "_t", "_u", (F.col("pos") - (length - gram)).cast("long").alias("a"), (F.col("pos") + length).cast("long").alias("b"))
    usual = _by_anchor(around.where(F.col("m") <= group), parts)
    by_intervals = usual.mapInArrow(lambda b: _spans(b, length), "_t long, _u long, a long, b long")
    windows = around.where(F.col("m") > group).mapInArrow(lambda b: _windows(b, length), "w1 long, w2 long, _t long, _u long, a long")
    twice = windows.groupBy("w1", "w2").agg(F.min(F.xxhash64("_t", "_u", "a")).alias("lo"), F.max(F.xxhash64("_t", "_u", "a")).alias("hi")) \
        .where("lo <> hi").select("w1", "w2")
    by_windows = windows.join(materialize(twice, "windows"), ["w1", "w2"]).select("_t", "_u", "a", (F.col("a") + length).alias("b"))
    copies = keyed.groupBy("_t", "_u").agg(F.count("*").alias("n")).where("n > 1").select(
        "_t", "_u", F.lit(0).cast("long").alias("a"), F.lit(END).cast("long").alias("b"))
    return whole.union(by_intervals).union(by_windows).union(copies)


def repeat_groups(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(anchor, number, text_key, first, last): all occurrences of all maximal repeats of ``length`` bytes or more.

    ``anchor`` and ``number`` name a group, ``text_key`` (two hashes) the text, ``first`` and ``last`` the byte range. A repeat
    is looked at up to ``length`` bytes from each anchor in it, so one that holds several anchors is several groups.
    Equal surroundings of an anchor are one occurrence, with one of their texts. Null and short texts have none, and an empty table gives no rows;
    all members of an anchor meet in one task.
    """
    keyed = docs.select("doc_id", "text", *text_keys())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _by_anchor(_anchored(keyed, length)[2], parts).mapInArrow(lambda b: _groups(b, length), "h long, number long, _t long, _u long, a long, b long")
    return rows.select(F.col("h").alias("anchor"), "number", F.struct("_t", "_u").alias("text_key"), F.col("a").alias("first"), F.col("b").alias("last"))


def cut_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text).

    Bytes covered by a string of ``length`` bytes that also starts anywhere else, in the same or in
    another document, are removed. Null is empty; a text shorter than ``length`` loses
    nothing; repeated rows are copies of each other; other columns are ignored; an empty
    table gives no rows.
    """
    keyed = docs.select("doc_id", "text", *text_keys())
    spans = repeat_spans(keyed, length, group).groupBy("_t", "_u").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    rows = keyed.join(spans, ["_t", "_u"], "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _cut(b, length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
