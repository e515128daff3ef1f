"""Cross-tokenizer alignment with corpus-wide pair counts in a minimal perfect hash.

Both tokenizers cut the same bytes. The places where both have a token's end divide a document into
groups, and the tokens of a group are linked with each other.

1. Documents are tokenised once, in chunks, and their ids are written; a chunk's distinct pairs of
   linked ids, with the number of its documents that hold them, are written beside them.
2. The distinct pairs are dealt to slices by a hash. Each slice gets a minimal perfect hash
   (levels of bit arrays, Limasset et al. 2017): its n pairs have the numbers 0 to n - 1. The pairs
   stand beside it by number, so that a pair that isn't in the slice is recognised.
3. Counting needs no keys any more: tasks add a part of the chunks' counts into a dense vector
   by number, and vectors are summed in a tree, a few at a time.
4. The slices answer each chunk's pairs with their counts. The second pass aligns the chunk's
   documents again, from the ids, and looks its pairs up.

Slices hold distinct keys and chunks are cut by bytes, so nothing here has a hot key: a pair that
every document has is one row for each chunk.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import byte_slices, chunks, mix, worker_cache
from changeflow.llm.simple8b import Encoder, beside
from changeflow.session import materialize, scratch_dir

#: Bytes of the texts of a chunk; a longer text is a chunk of its own.
CHUNK = 1 << 21
#: Ids of a row of a chunk; a document is never cut.
PIECE = 1 << 17
#: Distinct pairs of a slice, about.
SLICE = 1 << 18
#: Rows of a chunk's pairs that one task adds into a vector, about, and vectors that are summed at a time.
ROWS = 1 << 19
FAN = 8
#: Links that are looked at together. A larger group is looked at by distinct ids.
LINKS = 1 << 18
#: Words whose ids a worker remembers, and words after those, forgotten together.
REMEMBERED = 100_000
RECENT = 60_000
#: Bits for each key on a level of the hash.
GAMMA = 2


class Tokenizers:
    """Both tokenizers, asked once for each distinct word of a chunk.

    Neither joins across a single space between visible characters (for B, no piece has its space sign after another
    character; a model that has one is given whole texts only), so such a text is the ids of its words, each with the
    space before it. Other texts are encoded whole.
    """

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a = Encoder(path_a)
        self.a.tokenizer.encode_special_tokens = True
        letters = {c: b for b, c in self.a.letters.items()} | {chr(b): b for b in range(256) if b not in self.a.letters}
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.b = SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.width_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.width_b = np.array([len(x) for x in self.bytes_b], np.int64)
        #: How ids are kept.
        self.kind = "<u2" if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else "<u4"
        # Every byte has a token and nothing is normalised: A's tokens always join to the text.
        self.lossless = self.a.tokenizer.normalizer is None and set(letters.values()) == {x[0] for x in self.bytes_a if len(x) == 1}
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.recent: dict[str, tuple[bytes, bytes] | None] = {}

    def _checked(self, units: list[str], ids_a: list[bytes], ids_b: list[list[int]]) -> list[tuple[bytes, bytes] | None]:
        """Ids of each unit; None if the tokens' bytes aren't those of a space and the unit."""
        out: list[tuple[bytes, bytes] | None] = []
        of_b = self.bytes_b.__getitem__
        for unit, a, b in zip(units, ids_a, ids_b):
            want = b" " + unit.encode()
            same = b"".join(map(of_b, b)) == want and (self.lossless or b"".join([self.bytes_a[i] for i in np.frombuffer(a, "<u4").tolist()]) == want)
            out.append((a, array("I", b).tobytes()) if same else None)
        return out

    def _words(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        known, recent = self.known, self.recent
        if len(recent) > RECENT:
            recent.clear()
        new = [w for w in words if w not in known and w not in recent]
        found = zip(new, self._checked(new, self.a.words([" " + w for w in new]), self.b.encode(new) if new else []))
        (known if len(known) < REMEMBERED else recent).update(found)
        return [known[w] if w in known else recent[w] for w in words]

    def encode(self, texts: list[str]) -> tuple[list[int], list[np.ndarray]]:
        """The order in which texts are returned, and four arrays: all ids of A, the number of each text, the same of B.

        A text that is empty or has other bytes in A's or B's tokens has no ids.
        """
        plain = [self.by_word and t != "" and not beside(" " + t) and not t.endswith(" ") for t in texts]
        order = [i for i, p in enumerate(plain) if p] + [i for i, p in enumerate(plain) if not p]
        split = pc.split_pattern(pa.array(compress(texts, plain), pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        others = [t for t, p in zip(texts, plain) if not p]
        filled = [t for t in others if t]
        rows = self._words(coded.dictionary.to_pylist())
        n_words = len(rows)
        rows += self._checked(filled, self.a.whole([" " + t for t in filled]) if filled else [], self.b.encode(filled) if filled else [])
        # The units of each text are rows: its words, or itself.
        units = np.concatenate((coded.indices.to_numpy().astype(np.int64), n_words + np.arange(len(filled))))
        n_units = np.concatenate((np.diff(split.offsets.to_numpy()), np.array([t != "" for t in others], np.int64))).astype(np.int64)
        owner = np.repeat(np.arange(len(order)), n_units)
        bad = np.array([r is None for r in rows], bool)
        spoiled = np.zeros(len(order), bool)
        spoiled[owner[bad[units]]] = True
        stay = ~spoiled[owner]
        units, owner = units[stay], owner[stay]
        out = []
        for side in range(2):
            coded_rows = [r[side] if r else b"" for r in rows]
            sizes = np.array([len(r) >> 2 for r in coded_rows], np.int64)
            flat = np.frombuffer(b"".join(coded_rows), "<u4")
            length = sizes[units]
            step = np.cumsum(sizes)[units] - np.cumsum(length)
            out.append(flat[np.repeat(step, length) + np.arange(int(length.sum()))])
            out.append(np.bincount(owner, weights=length, minlength=len(order)).astype(np.int64))
        return order, out


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    kept = worker_cache("tokenizer pairs")
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Tokenizers(path_a, path_b)
    return kept[path_a, path_b]


class Widths:
    """What stages after the first need of the tokenizers: the bytes of each id, and how ids are kept."""

    def __init__(self, own: Tokenizers):
        self.width_a, self.width_b, self.kind = own.width_a, own.width_b, own.kind

    def forget(self) -> Widths:
        """A reused worker lets the tokenizers and their words go."""
        worker_cache("tokenizer pairs").clear()
        return self


class Alignment:
    """The groups of a few texts one after the other: ids of both sides, their numbers for each text, and bytes of each id."""

    def __init__(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, width_a: np.ndarray, width_b: np.ndarray):
        self.width_a, self.width_b = len(width_a), len(width_b)
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        self.n_a, self.n_b = n_a, n_b
        end_a, end_b = np.cumsum(width_a[self.a]), np.cumsum(width_b[self.b])
        mark = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        #: The last token of its group.
        self.last_a, self.last_b = mark[end_a] == 3, mark[end_b] == 3
        self.group_a = np.cumsum(self.last_a) - self.last_a
        self.group_b = np.cumsum(self.last_b) - self.last_b
        self.groups = int(self.last_a.sum())
        self.size_a = np.bincount(self.group_a, minlength=self.groups)
        self.size_b = np.bincount(self.group_b, minlength=self.groups)
        self.first_a = np.cumsum(self.size_a) - self.size_a
        self.first_b = np.cumsum(self.size_b) - self.size_b
        self.doc_a = np.repeat(np.arange(len(n_a)), n_a)

    def n_groups(self) -> np.ndarray:
        return np.bincount(self.doc_a[self.last_a], minlength=len(self.n_a))

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | int]]:
        """(text, pair, how often) of all links, a bounded number at a time; a pair is (id of A) << 32 | (id of B)."""
        product = self.size_a * self.size_b
        large = product > LINKS
        each = np.where(large[self.group_a], 0, self.size_b[self.group_a]) if len(self.a) else np.zeros(0, np.int64)
        total = np.concatenate(([0], np.cumsum(each)))
        lo = 0
        while lo < len(self.a):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + LINKS, side="right")) - 1)
            n = each[lo:hi]
            at = np.repeat(np.arange(lo, hi), n)
            if len(at):
                k = np.arange(len(at)) - np.repeat(total[lo:hi] - total[lo], n)
                yield self.doc_a[at], self.a[at] << 32 | self.b[self.first_b[self.group_a[at]] + k], 1
            lo = hi
        for g in np.flatnonzero(large).tolist():
            a, times_a = np.unique(self.a[self.first_a[g]: self.first_a[g] + self.size_a[g]], return_counts=True)
            b, times_b = np.unique(self.b[self.first_b[g]: self.first_b[g] + self.size_b[g]], return_counts=True)
            rows = max(1, LINKS // len(b))
            for lo in range(0, len(a), rows):
                pair = (a[lo:lo + rows, None] << 32 | b[None, :]).ravel()
                yield np.full(len(pair), self.doc_a[self.first_a[g]]), pair, (times_a[lo:lo + rows, None] * times_b[None, :]).ravel()

    def documents_of_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs and how many of the texts hold each."""
        # One number for a text and a pair.
        each = self.width_a * self.width_b
        found = [np.zeros(0, np.int64)]
        for doc, pair, _ in self.links():
            found.append(np.unique(doc * each + (pair >> 32) * self.width_b + (pair & 0xFFFFFFFF)))
        every = np.unique(np.concatenate(found)) if len(found) > 2 else found[-1]  # a text may lie in several parts
        pair, n = np.unique(every % each, return_counts=True)
        return pair // self.width_b << 32 | pair % self.width_b, n

    def listings(self, table: list[bytes]) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text. ``table`` is that of listing_table."""
        size_a, size_b = len(table[0]), len(table[2])
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + self.first_b[self.group_a]] = self.a + size_a * self.last_a
        code[np.arange(len(self.b)) + (self.first_a + self.size_a)[self.group_b]] = self.b + 2 * size_a + size_b * self.last_b
        words = np.concatenate(table)[code] if len(code) else code
        cuts = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        for lo, hi in zip(cuts, cuts[1:]):
            yield b"".join(words[lo:hi].tolist())[:-1]


def listing_table(size_a: int, size_b: int) -> list[np.ndarray]:
    """Decimal ids with the sign after them: within a group of A, at its end, and the same of B."""
    return [np.array([b"%d%s" % (i, sign) for i in range(size)], object) for size, sign in ((size_a, b","), (size_a, b"|"), (size_b, b","), (size_b, b";"))]


def _level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[list[int], bytes]:
    """Sizes and bits of the levels of a minimal perfect hash of distinct int64 keys.

    On each level a key that is alone at its place stays there; the others go on.
    """
    sizes, bits = [], []
    while len(keys):
        size = -(-GAMMA * len(keys) // 8) * 8
        at = _level(keys, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone).tobytes())
        keys = keys[~alone[at]]
    return sizes, b"".join(bits)


class Numbers:
    """The numbers of a slice's keys. ``keys``, by number, may come later: without them an unknown key has any number."""

    def __init__(self, sizes: list[int], bits: bytes, keys: np.ndarray | None = None):
        flags = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        self.sizes, self.keys = sizes, keys
        self.flags, self.rank = flags, np.cumsum(flags) - flags

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that aren't in the slice."""
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + _level(keys[left], level, size)
            found = self.flags[at]
            out[left[found]] = self.rank[at[found]]
            left, start = left[~found], start + size
        if self.keys is not None:
            out[(out < 0) | (self.keys[out] != keys)] = -1
        return out


def _tokenised(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(chunk, docs, n_a, n_b, a, b): some rows for each chunk, one after the other, written once. The ids are packed, as they
    are shuffled once more, in pieces that the JVM moves with ease."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own, chunk = tokenizers(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in byte_slices(batch, "text", CHUNK):
                order, (a, n_a, b, n_b) = own.encode([t or "" for t in part["text"].to_pylist()])
                ids = part["doc_id"].take(pa.array(order, pa.int64()))
                ends_a, ends_b = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))
                for lo, hi in chunks((n_a + n_b).tolist(), PIECE):
                    sides = ((a[ends_a[lo]:ends_a[hi]], n_a[lo:hi]), (b[ends_b[lo]:ends_b[hi]], n_b[lo:hi]))
                    yield pa.RecordBatch.from_pydict({
                        "chunk": pa.array([chunk], pa.int64()), "docs": pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), ids.slice(lo, hi - lo)),
                        **{f"n_{c}": pa.array([n], pa.list_(pa.int64())) for c, (_, n) in zip("ab", sides)},
                        **{c: pa.array([pa.compress(x.astype(own.kind), "zstd", asbytes=True)], pa.binary()) for c, (x, _) in zip("ab", sides)}})
                chunk += 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = scratch_dir(docs.sparkSession, "aligned-ids")
    rows = docs.select("doc_id", "text").mapInArrow(run, f"chunk long, docs array<{kind}>, n_a array<long>, n_b array<long>, a binary, b binary")
    rows.write.parquet(out)
    return docs.sparkSession.read.schema(rows.schema).parquet(out)


def _alignment(rows: pa.Table | pa.RecordBatch, lo: int, hi: int, own: Widths) -> Alignment:
    """The documents of the rows lo to hi - 1."""
    size, sides = np.dtype(own.kind).itemsize, []
    for c in "ab":
        n = [rows[f"n_{c}"][i].values.to_numpy() for i in range(lo, hi)]
        ids = [np.frombuffer(pa.decompress(rows[c][lo + k].as_buffer(), int(x.sum()) * size, "zstd"), own.kind) for k, x in enumerate(n)]
        sides += [np.concatenate(ids), np.concatenate(n)]
    return Alignment(*sides, own.width_a, own.width_b)


def _pairs(chunks: DataFrame, widths: Broadcast) -> DataFrame:
    """(chunk, pair, n): the distinct pairs of each chunk and how many of its documents hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = widths.value.forget()
        for batch in batches:
            chunk = batch["chunk"].to_numpy()
            # A chunk that lies in two batches has two rows for some pairs: their sum counts.
            edges = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
            for lo, hi in zip(edges, edges[1:]):
                if hi > lo:
                    pair, n = _alignment(batch, lo, hi, own).documents_of_pairs()
                    yield pa.RecordBatch.from_pydict({
                        "chunk": pa.array(np.full(len(pair), chunk[lo], np.int64)), "pair": pa.array(pair, pa.int64()), "n": pa.array(n, pa.int64())})

    return materialize(chunks.mapInArrow(run, "chunk long, pair long, n long"), "pairs")


def _numbers(table: pa.Table) -> Numbers:
    return Numbers(table["sizes"][0].as_py(), table["bits"][0].as_py(), np.frombuffer(table["keys"][0].as_buffer(), "<i8"))


def _built(table: pa.Table) -> pa.Table:
    keys = table["pair"].to_numpy()
    sizes, bits = perfect_hash(keys)
    by_number = np.empty(len(keys), "<i8")
    by_number[Numbers(sizes, bits).of(keys)] = keys
    return pa.table({"slice": table["slice"].slice(0, 1), "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([bits], pa.binary()),
                     "keys": pa.array([by_number.tobytes()], pa.binary())})


def _added(key: tuple, pairs: pa.Table, numbers: pa.Table) -> pa.Table:
    """One dense vector of a part of a slice's counts."""
    own = _numbers(numbers)
    vector = np.zeros(len(own.keys), "<i8")
    at = own.of(pairs["pair"].to_numpy())
    if (at < 0).any():
        raise ValueError("a pair is missing in its slice")
    np.add.at(vector, at, pairs["n"].to_numpy())
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([vector.tobytes()], pa.binary())})


def _summed(key: tuple, table: pa.Table) -> pa.Table:
    vector = sum(np.frombuffer(v.as_buffer(), "<i8") for v in table["counts"])
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": pa.array([vector.astype("<i8").tobytes()], pa.binary())})


def pair_counts(pairs: DataFrame, size_a: int, per_slice: int = SLICE, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(slice, sizes, bits, keys, counts) of every slice, and the rows of ``pairs`` (chunk, pair, n) with ``count`` and ``best``.

    ``count`` is the sum of n over all rows of a pair, ``best`` whether no pair of the same id of A has more.
    """
    spark = pairs.sparkSession
    keys = materialize(pairs.select("pair").distinct(), "keys")
    slices = max(1, -(-keys.count() // per_slice))
    total = pairs.count()
    parts = 1
    while slices * parts * rows < total:
        parts *= FAN
    own = F.pmod(F.xxhash64("pair"), F.lit(slices)).alias("slice")
    numbers = materialize(keys.select(own, "pair").groupBy("slice").applyInArrow(_built, "slice long, sizes array<long>, bits binary, keys binary"), "numbers")
    dealt = pairs.select(own, F.pmod(F.xxhash64("chunk"), F.lit(parts)).alias("part"), "chunk", "pair", "n")
    to_parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    by_part = dealt.groupBy("slice", "part")
    schema = "slice long, part long, counts binary"
    vectors = materialize(by_part.cogroup(numbers.select("*", to_parts).groupBy("slice", "part")).applyInArrow(_if_both(_added, schema), schema), "vectors")
    while parts > 1:
        level = vectors.select("slice", F.expr(f"part div {FAN}").alias("part"), "counts").groupBy("slice", "part")
        vectors, parts = materialize(level.applyInArrow(_summed, schema), "vectors"), parts // FAN
    counted = materialize(numbers.join(vectors.select("slice", "counts"), "slice"), "slices")

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(size_a, np.int64)
        for batch in batches:
            for key, n in zip(batch["keys"], batch["counts"]):
                np.maximum.at(most, np.frombuffer(key.as_buffer(), "<i8") >> 32, np.frombuffer(n.as_buffer(), "<i8"))
        held = np.flatnonzero(most)
        yield pa.RecordBatch.from_pydict({"a": pa.array(held, pa.int64()), "most": pa.array(most[held], pa.int64())})

    # At most one number for each id of A goes through the driver.
    most = np.zeros(size_a, np.int64)
    for r in counted.select("keys", "counts").mapInArrow(highest, "a long, most long").groupBy("a").agg(F.max("most").alias("most")).collect():
        most[r["a"]] = r["most"]
    shared = spark.sparkContext.broadcast(most)

    def answer(key: tuple, pairs: pa.Table, numbers: pa.Table) -> pa.Table:
        at = _numbers(numbers).of(pairs["pair"].to_numpy())
        if (at < 0).any():
            raise ValueError("a pair is missing in its slice")
        count = np.frombuffer(numbers["counts"][0].as_buffer(), "<i8")[at]
        best = count == shared.value[pairs["pair"].to_numpy() >> 32]
        return pa.table({"chunk": pairs["chunk"], "pair": pairs["pair"], "count": pa.array(count), "best": pa.array(best)})

    asked = dealt.select("slice", F.pmod(F.xxhash64("chunk"), F.lit(max(1, -(-total // (slices * rows))))).alias("part"), "chunk", "pair")
    answers = asked.groupBy("slice", "part")
    n_parts = max(1, -(-total // (slices * rows)))
    to_parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))).alias("part")
    schema = "chunk long, pair long, count long, best boolean"
    return counted, answers.cogroup(counted.select("*", to_parts).groupBy("slice", "part")).applyInArrow(_if_both(answer, schema), schema)


def _if_both(fn, ddl: str):
    """``fn`` of a cogroup's tables; no rows if one side has none."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return schema.empty_table()
        return fn(key, left, right)

    return run


def align(docs: DataFrame, path_a: str, path_b: str, per_slice: int = SLICE, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text).

    A encodes a space and the text, B the text. Texts that are null or empty, or whose tokens of A or B
    don't join to a space and the text, have no tokens: zeros and an empty groups_sha256. Special tokens in texts are plain
    text. Every row is a document, repeated rows count each; ties for an id's highest count are all best;
    an empty table gives no rows; a text is held whole, one chunk of a worker at a time; other columns are ignored.
    """
    local = Tokenizers(path_a, path_b)
    size_a, size_b = len(local.bytes_a), len(local.bytes_b)
    widths = docs.sparkSession.sparkContext.broadcast(Widths(local))  # bounded by the vocabularies
    del local
    chunks = _tokenised(docs, path_a, path_b)
    _, answers = pair_counts(_pairs(chunks, widths), size_a, per_slice, rows)
    kind = chunks.schema["docs"].dataType.elementType.simpleString()

    def digest(left: pa.Table, right: pa.Table) -> pa.Table:
        own = widths.value.forget()
        kept = worker_cache("listings")
        table = kept.get((size_a, size_b)) or kept.setdefault((size_a, size_b), listing_table(size_a, size_b))
        order = np.argsort(pair := right["pair"].to_numpy())
        pair, count, best = pair[order], right["count"].to_numpy()[order], np.asarray(right["best"]).astype(np.int64)[order]
        columns: dict[str, list] = {name: [] for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")}
        for i in range(left.num_rows):
            aligned = _alignment(left, i, i + 1, own)
            n_links, n_best, count_sum = (np.zeros(len(aligned.n_a), np.int64) for _ in range(3))
            for doc, linked, times in aligned.links():
                at = np.searchsorted(pair, linked)
                if (at == len(pair)).any() or (pair[at] != linked).any():
                    raise ValueError("a pair has no count")
                np.add.at(n_links, doc, times)
                np.add.at(n_best, doc, best[at] * times)
                np.add.at(count_sum, doc, count[at] * times)
            digests = [hashlib.sha256(x).hexdigest() if x else "" for x in aligned.listings(table)]
            for name, values in zip(columns, (aligned.n_a, aligned.n_b, aligned.n_groups(), n_links, n_best, count_sum, digests)):
                columns[name].append(pa.array(values, pa.string() if name == "groups_sha256" else pa.int64()))
        docs = pa.concat_arrays([left["docs"][i].values for i in range(left.num_rows)])
        return pa.table({"doc_id": docs, **{name: pa.concat_arrays(parts) for name, parts in columns.items()}})

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        digest, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
