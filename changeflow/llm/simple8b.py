"""Token ids in a word-aligned binary format: Simple-8b (Anh and Moffat 2010).

A 64-bit word is a 4-bit selector and 60 bits that hold as many ids of one width as fit. Selector 0 is
an escape: the next word is one id as it is. Ids are packed in blocks of whole documents;
a block carries the offset of each document's ids, so a block is decoded by array
operations, one per selector, without looking at other blocks.

A file set is a Parquet folder, so any store that Spark writes to will do. A row is a block: ``part`` and
``block`` give the order, ``before`` the ids of the part before the block, ``doc_ids``
and ``offsets`` the documents, ``words`` the packed ids (little-endian).
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import byte_slices, worker_cache
from changeflow.session import scratch_dir

#: Ids of a word and bits of an id, by selector from 1.
LAYOUTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 0
#: Ids of a block, about; a longer document makes a longer block.
BLOCK_IDS = 1 << 16
END = 0
#: Pieces that a worker remembers the ids of, and the bytes of the longest one.
REMEMBERED = 1_000_000
LONGEST = 64
#: Bytes of texts that are encoded together.
CHUNK = 1 << 24
#: Words that are encoded as one text.
JOINED = 100

#: Ids of a word, by selector.
COUNTS = np.array([1] + [count for count, _ in LAYOUTS], np.uint8)
LIMITS = np.array([1 << bits for _, bits in LAYOUTS], np.uint64)


def _needs() -> np.ndarray:
    kept = worker_cache("needs")
    if "table" not in kept:
        kept["table"] = np.searchsorted(LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)
    return kept["table"]


def pack(ids: np.ndarray) -> np.ndarray:
    """Words of the ids (uint64, any value). The last word may hold zeros beyond the ids."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    # The narrowest layout that holds each id; zeros follow the last one.
    need = np.zeros(n + 60, np.uint8)
    if n and ids.max() < 1 << 16:
        need[:n] = _needs()[ids.astype(np.uint16)]
    else:
        need[:n] = np.searchsorted(LIMITS, ids, side="right")
    choice = np.zeros(n, np.uint8)  # ids above 60 bits stay at the escape
    for layout in range(len(LAYOUTS) - 1, -1, -1):  # denser layouts override
        count = LAYOUTS[layout][0]
        fits, have = need <= layout, 1
        while have < count:  # from runs of `have` to longer ones, by doubling
            more = min(have, count - have)
            fits, have = fits[: len(fits) - more] & fits[more:], have + more
        fits = fits[:n]
        if fits.any():
            np.copyto(choice[: len(fits)], layout + 1, where=fits, casting="unsafe")
        elif layout < 7:
            break  # denser layouts need longer runs of smaller ids
    steps = COUNTS[choice].tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    selectors = choice[starts] if n else np.zeros(0, np.uint8)
    place = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(selectors == ESCAPE)[:-1])) if n else starts
    words = np.zeros(len(starts) + int((selectors == ESCAPE).sum()), np.uint64)
    padded = np.concatenate((ids, np.zeros(60, np.uint64)))
    for selector in np.unique(selectors).tolist():
        own = np.flatnonzero(selectors == selector)
        first = starts[own]
        if selector == ESCAPE:
            words[place[own] + 1] = ids[first]
            continue
        count, bits = LAYOUTS[selector - 1]
        word = np.full(len(own), selector << 60, np.uint64)
        for k in range(count):
            word |= padded[k:][first] << np.uint64(bits * k)
        words[place[own]] = word
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first n ids of packed words."""
    words = np.asarray(words, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    if (selectors == ESCAPE).any():
        plain, escaped = np.ones(len(words), bool), np.zeros(len(words), bool)
        at = 0
        for at in np.flatnonzero(selectors == ESCAPE):
            if plain[at]:
                escaped[at], plain[at + 1] = True, False
        values = np.concatenate((words[1:], np.zeros(1, np.uint64)))
        selectors, escaped, values, words = selectors[plain], escaped[plain], values[plain], words[plain]
    else:
        escaped, values = np.zeros(len(words), bool), words
    counts = COUNTS[selectors].astype(np.int64)
    place = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(int(place[-1]), np.uint64)
    for selector in np.unique(selectors[~escaped]).tolist():
        count, bits = LAYOUTS[selector - 1]
        own = np.flatnonzero((selectors == selector) & ~escaped)
        for k in range(count):
            out[place[own] + k] = words[own] >> np.uint64(bits * k) & np.uint64((1 << bits) - 1)
    out[place[:-1][escaped]] = values[escaped]
    return out[:n]


#: A space beside other white space; for ASCII, as plain strings, which are found faster.
BESIDE = re.compile(r" \s|\s ")
BESIDE_ASCII = ["  ", *(pair for c in "\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f" for pair in (" " + c, c + " "))]


def beside(text: str) -> bool:
    return any(map(text.__contains__, BESIDE_ASCII)) if text.isascii() else BESIDE.search(text) is not None


def _bytes(chosen: str | Iterable[int]) -> np.ndarray:
    """Flags of the chosen bytes, by byte."""
    table = np.zeros(256, bool)
    table[[ord(c) if isinstance(c, str) else c for c in chosen]] = True
    return table


WHITE = _bytes("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")
GRAPHIC = _bytes(range(33, 127))
LETTER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
SIGN = GRAPHIC & ~LETTER & ~_bytes("0123456789")
#: First bytes of the white space beyond ASCII, and of much else.
WIDE2, WIDE3 = _bytes([0xC2]), _bytes([0xE1, 0xE2, 0xE3])
#: After 0xC3: letters, all but the signs of multiplication and division.
LATIN = _bytes([b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])


def unsure(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Places of a space that has other white space beside it, or a character beyond ASCII that may be white space.
    ``begin`` are the first bytes of the texts that ``data`` is made of."""
    space, white = data == 32, WHITE[data]
    near = np.zeros(len(data), bool)
    near[:-1] = space[:-1] & (white[1:] | WIDE2[data[1:]] | WIDE3[data[1:]]) | white[:-1] & space[1:]
    inner = begin[(begin > 0) & (begin < len(data))]
    near[inner - 1] = False
    near[2:] |= space[2:] & WIDE2[data[:-2]]
    near[3:] |= space[3:] & WIDE3[data[:-3]]
    return np.flatnonzero(near)


def cuts(data: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer parts texts without neighbouring white space, whatever comes before and after, as flags: before a space,
    between a letter and a sign, and after a line's end that follows a visible character."""
    cut = data == 32
    letter = LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & LATIN[data[1:]]
    cut[1:] |= letter[:-1] & SIGN[data[1:]]
    ends = np.flatnonzero(data[:-1] == 10)
    ends = ends[ends > 0]
    after = data[ends + 1]
    cut[ends[GRAPHIC[data[ends - 1]] & (LETTER[after] | (after == 0xC3))] + 1] = True
    return cut


class Encoder:
    """The tokenizer, asked once for each distinct word.

    The pre-tokenizer never joins across a single space between two visible characters, nor from a letter to a sign, so such a text
    is the ids of its pieces, each with the space before it. Any other text, and any
    with a special token in it, goes to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.path = path
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each id: one letter stands for one
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the vocabulary
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(256 + n) for n, b in enumerate(hidden)}
        # Pieces that are remembered, and the ids of all of them one after another.
        self.known, self.ids, self.sizes = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    @cached_property
    def by_space(self):
        """The tokenizer for words of a space and letters, which needs to look for spaces only."""
        from tokenizers import Tokenizer, pre_tokenizers

        made = Tokenizer.from_file(self.path)
        made.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return made

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words that each begin with a space and end in a visible character.

        The pre-tokenizer leaves a space and letters in one piece, which the model takes as it is; other words
        are encoded in joined texts, cut by their bytes.
        """
        out: list[bytes] = [b""] * len(words)
        rest: list[int] = []
        tokenize, letter = self.tokenizer.model.tokenize, self.letters
        for i, w in enumerate(words):
            if w[1:].isalpha() and max(w) < "\u2000":
                out[i] = array("I", [t.id for t in tokenize(w.encode().decode("latin-1").translate(letter))]).tobytes()
            else:
                rest.append(i)
        for lo in range(0, len(rest), JOINED):
            part = [words[i] for i in rest[lo:lo + JOINED]]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(w.encode()) for w in part])
            cuts = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
            flat, at = ids.tobytes(), 0
            for i, cut in zip(rest[lo:lo + JOINED], (4 * cuts).tolist()):
                out[i] = flat[at:cut]
                at = cut
        return out

    def lettered(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of a space and letters, one after another, and how many each has."""
        found = [np.array(self.by_space.encode_batch_fast(["".join(words[lo:lo + JOINED])], add_special_tokens=False)[0].ids, np.uint32)
                 for lo in range(0, len(words), JOINED)]
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words], dtype=np.int64)
        return ids, np.diff(np.searchsorted(np.cumsum(self.width[ids]), ends) + 1, prepend=0)

    def rows(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The pieces in another order, their ids one after another, and how many each has."""
        words: tuple[list[str], list[str], list[str]] = [], [], []
        for w in pieces.to_pylist():
            spaced = w[:1] == " "
            words[0 if spaced and w[1:].isalpha() and (w.isascii() or max(w) < "\u2000") else 1 if spaced and not w[-1].isspace() else 2].append(w)
        ids, sizes = self.lettered(words[0])
        rest = self.words(words[1]) + self.whole(words[2])
        return (pa.array(words[0] + words[1] + words[2], pa.large_string()), np.concatenate((ids, np.frombuffer(b"".join(rest), "<u4"))),
                np.concatenate((sizes, np.array([len(r) >> 2 for r in rest], np.int64))))

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none), one after another, and how many each has: each distinct piece is looked up once, its
        ids are laid out by array operations."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
        if len(texts) == 0 or offsets[0] == offsets[-1]:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
        offsets = offsets - offsets[0]
        begin, end = offsets[:-1], offsets[1:]
        filled = end > begin
        cut = cuts(data)
        doubtful = np.unique(np.searchsorted(end, unsure(data, begin), side="right"))
        whole = np.zeros(len(texts), bool)
        whole[filled] = data[end[filled] - 1] == 32
        whole[doubtful] |= np.array([beside(t) for t in texts.take(pa.array(doubtful)).to_pylist()], bool)
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(whole):
            cut[begin[i]:end[i]] = False
        cut[begin[filled]] = True
        at = np.append(np.flatnonzero(cut), len(data))
        pieces = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        row, ids, sizes = self._looked_up(pieces.dictionary_encode())
        length = sizes[row]
        stop = np.cumsum(length)
        step = (np.cumsum(sizes) - sizes)[row] - stop + length
        upto = np.concatenate(([0], stop))[np.searchsorted(at, offsets)]
        return ids[np.repeat(step, length) + np.arange(stop[-1])], np.diff(upto)

    def _looked_up(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The row of each piece, the ids of all rows one after another, and how many each has."""
        found = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.known), -1).to_numpy()
        new, new_ids, new_sizes = self.rows(coded.dictionary.filter(pa.array(found < 0)))
        rows, ids, sizes = pa.concat_arrays([self.known, new]), np.concatenate((self.ids, new_ids)), np.concatenate((self.sizes, new_sizes))
        place = found.astype(np.int64)
        place[found < 0] = len(self.known) + pc.index_in(coded.dictionary.filter(pa.array(found < 0)), value_set=new).to_numpy()
        keep = pc.binary_length(rows).to_numpy() <= LONGEST
        if len(rows) > REMEMBERED:  # from here on, those of this batch
            used = np.zeros(len(rows), bool)
            used[place] = True
            keep &= used
        self.known, self.ids, self.sizes = (rows, ids, sizes) if keep.all() else (rows.filter(pa.array(keep)), ids[np.repeat(keep, sizes)], sizes[keep])
        return place[coded.indices.to_numpy()], ids, sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        ids, sizes = self.flat(pa.array(texts, pa.large_string()))
        laid, ends = ids.astype("<u4").tobytes(), np.cumsum(4 * sizes).tolist()
        return [laid[a:b] for a, b in zip([0, *ends], ends)]


def encoder(path: str) -> Encoder:
    kept = worker_cache("encoders")
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def write_ids(docs: DataFrame, out: str, tokenizer: str, end: int = END) -> None:
    """Encode every text, append ``end``, and write the blocks in ascending order of doc_id.

    Null and empty texts are the end id alone; null ids come first; equal ids come in the order
    of a hash of the text; repeated rows are written each; an empty table writes no rows;
    other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        before = number = 0
        held_docs: list[int | None] = []
        held_sizes = np.zeros(0, np.int64)
        held_ids = np.zeros(0, np.uint32)

        def blocks(least: int) -> Iterator[pa.RecordBatch]:
            """Leading documents of ``least`` ids together, as long as there are."""
            nonlocal before, number, held_docs, held_sizes, held_ids
            ends, first, done = np.cumsum(held_sizes), 0, 0
            while first < len(ends) and ends[-1] - done >= least:
                last = int(np.searchsorted(ends, done + least)) + 1
                ids, sizes = held_ids[done: ends[last - 1]], held_sizes[first:last]
                made = {"part": [part], "block": [number], "before": [before], "n_ids": [len(ids)], "doc_ids": [held_docs[first:last]],
                        "offsets": [np.concatenate(([0], np.cumsum(sizes))).tolist()], "words": [pack(ids).astype("<u8").tobytes()]}
                number, before, first, done = number + 1, before + len(ids), last, int(ends[last - 1])
                yield pa.RecordBatch.from_pydict(made, schema=arrow)
            held_docs, held_sizes, held_ids = held_docs[first:], held_sizes[first:], held_ids[done:]

        for batch in batches:
            for some in byte_slices(batch, "text", CHUNK):
                ids, sizes = coder.flat(some["text"])
                sizes = sizes + 1
                own = np.ones(len(ids) + len(sizes), bool)
                own[np.cumsum(sizes) - 1] = False
                ended = np.full(len(own), end, np.uint32)
                ended[own] = ids
                held_docs += some["doc_id"].to_pylist()
                held_sizes, held_ids = np.concatenate((held_sizes, sizes)), np.concatenate((held_ids, ended))
                yield from blocks(BLOCK_IDS)
        if held_docs:
            yield from blocks(len(held_ids))

    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string())),
                       ("offsets", pa.list_(pa.int64())), ("words", pa.binary())])
    rows = docs.select("doc_id", "text")
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    made = dealt.mapInArrow(run, f"part int, block int, before long, n_ids long, doc_ids array<{kind}>, offsets array<long>, words binary")
    made.write.option("compression", "zstd").parquet(out)


def read_ids(spark, path: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), and with ``ids`` the ids, of every document of a file set.

    ``start`` is the number of ids of all documents before it. Parts are counted from their blocks'
    headers: one number for each part goes through the driver.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(sizes):
        base[part], total = total, total + sizes[part]
    shared = spark.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in ("part", "before", "n_ids", "offsets", "words")}
                found = unpack(np.frombuffer(row["words"], "<u8"), row["n_ids"]).astype("<u4")
                cuts = row["offsets"]
                made = {"doc_id": batch["doc_ids"][i].values, "start": pa.array([shared.value[row["part"]] + row["before"] + c for c in cuts[:-1]], pa.int64()),
                        "n_tokens": pa.array([b - a for a, b in zip(cuts, cuts[1:])], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(found[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())}
                if ids:
                    made["ids"] = pa.array([found[a:b].astype(np.int64).tolist() for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(made)

    schema = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    return blocks.select("part", "before", "n_ids", "doc_ids", "offsets", "words").mapInArrow(run, schema)


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids below the shared folder and read them back."""
    out = scratch_dir(docs.sparkSession, "tokens")
    write_ids(docs, out, tokenizer)
    return read_ids(docs.sparkSession, out)
