"""Language identification by interpolated Kneser-Ney character models.

Texts become lower-case letters with one separator between words. Counts of four-character
strings are gathered from all training documents, per language and combined in each task before
the shuffle; continuation counts of the lower orders follow from them. The model keeps
every string in sorted arrays of 64-bit keys, four characters of 16 bits each, next to the
log-probability of every language. It is cut by the two middle characters in slices of about
MAX_GRAMS strings, which are built, broadcast and read one at a time and give the same numbers as a whole.
The language of the lowest cross-entropy per character wins. A text whose
cross-entropy lies far above that of known text of its language is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import chunks, fold, worker_cache
from changeflow.session import materialize

ORDER = 4
#: Four-character strings of a slice of the model, about, over all languages together.
MAX_GRAMS = 1_000_000
#: Deviations above the usual cross-entropy from which a text is of no known language.
REJECT = 6.0
CHUNK = 1 << 20
UND = "und"


def letters() -> np.ndarray:
    """Symbol of each code point below 65536: its lower-case letter, 0 if it is none."""
    kept = worker_cache("letters")
    if "table" not in kept:
        table = np.zeros(1 << 16, np.uint64)
        for i in range(1 << 16):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else i
        kept["table"] = table
    return kept["table"]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the four-character string that ends at each character, the text of each, and letters per text."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    stop = np.cumsum([len(t) + 1 for t in texts])
    found = letters()[np.minimum(points, 0xFFFF)]
    for point in np.unique(points[points > 0xFFFF]).tolist():
        found[points == point] = 0xE000 + point % 0x1900 if chr(point).isalpha() else 0
    before = np.concatenate((np.zeros(1, np.uint64), found[:-1]))
    keep = np.flatnonzero((found > 0) | (before > 0))
    text = np.searchsorted(stop, keep, side="right")
    text = np.minimum(text, len(texts) - 1)
    sequence = found[keep]
    count = np.bincount(text[sequence > 0], minlength=len(texts))
    padded = np.zeros(len(sequence) + 3 * (len(texts) + 1), np.uint64)
    place = np.arange(len(sequence)) + 3 * (text + 1)
    padded[place] = sequence
    key = padded[place]
    for back in (1, 2, 3):
        key = key | padded[place - back] << np.uint64(16 * back)
    return key, text, count


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        keys, ns = (np.concatenate(x) for x in zip(*held[lang]))
        keys, where = np.unique(keys, return_inverse=True)
        return keys, np.bincount(where, ns).astype(np.int64)

    for batch in batches:
        texts, langs = batch["text"].to_pylist(), batch["lang"].to_pylist()
        for lang in set(langs):
            own = [t for t, l in zip(texts, langs) if l == lang and t]
            for lo, hi in chunks([len(t) for t in own], CHUNK):
                key, _, _ = symbols(own[lo:hi])
                held.setdefault(lang, []).append(np.unique(key, return_counts=True))
                if len(held[lang]) > 16:
                    held[lang] = [merged(lang)]
    for lang in held:
        keys, ns = merged(lang)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()), "key": pa.array(keys.view(np.int64)), "n": pa.array(ns)})


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, key, n): counts of all training documents."""
    known = docs.where("lang is not null and text is not null").where(fold() != 0).select("text", F.col("lang").cast("string").alias("lang"))
    return known.mapInArrow(_count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


class Model:
    """Interpolated Kneser-Ney models of several languages over one set of strings."""

    def __init__(self, langs: list[str], tables: dict[str, tuple[np.ndarray, np.ndarray]], pairs: dict | None = None, tallies: dict | None = None):
        """``tables`` of a slice need what slices do not show: the order 2 counts and, by (lang, order), how
        many strings of orders 3 and 4 are counted once and twice."""
        self.langs = langs
        counts = {}
        for lang in langs:
            key, n = tables[lang]
            order = np.argsort(key)
            counts[lang] = {ORDER: (key[order], n[order])}
            for k in range(ORDER - 1, 0, -1):  # on how many different characters do they follow?
                shorter = counts[lang][k + 1][0] & np.uint64((1 << 16 * k) - 1)
                counts[lang][k] = pairs[lang] if pairs is not None and k == 2 else np.unique(shorter, return_counts=True)
        self.alphabet = 1 + len(np.unique(np.concatenate([counts[lang][1][0] for lang in langs] or [np.zeros(0, np.uint64)])))
        self.parts = {lang: {k: self._smoothed(*counts[lang][k], (tallies or {}).get((lang, k))) for k in counts[lang]} for lang in langs}
        self.keys, self.logs, self.contexts, self.backoffs = {}, {}, {}, {}
        for k in range(1, ORDER + 1):
            self.keys[k] = np.unique(np.concatenate([counts[lang][k][0] for lang in langs] or [np.zeros(0, np.uint64)]))
            self.logs[k] = np.log(np.stack([self._probability(lang, k, self.keys[k]) for lang in langs], 1)).astype(np.float32) if langs else None
            self.contexts[k] = np.unique(self.keys[k] >> np.uint64(16))
            self.backoffs[k] = np.log(np.stack([self._backoff(lang, k, self.contexts[k]) for lang in langs], 1)).astype(np.float32) if langs else None
        del self.parts

    @classmethod
    def of(cls, state: dict) -> "Model":
        """A model from its ``vars``, which is what is broadcast."""
        model = cls.__new__(cls)
        model.__dict__.update(state)
        return model

    @staticmethod
    def _smoothed(key, n, tally=None):
        once, twice = tally or (int((n == 1).sum()), int((n == 2).sum()))
        discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once and twice else 0.75
        context, where = np.unique(key >> np.uint64(16), return_inverse=True)
        return key, n, discount, context, np.bincount(where, n, len(context)), np.bincount(where, minlength=len(context))

    def _find(self, sorted_keys, wanted):
        if not len(sorted_keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
        return at, sorted_keys[at] == wanted

    def _backoff(self, lang, k, context):
        _, _, discount, contexts, total, kinds = self.parts[lang][k]
        at, hit = self._find(contexts, context)
        out = np.ones(len(context))
        out[hit] = discount * kinds[at[hit]] / total[at[hit]]
        return out

    def _probability(self, lang, k, key):
        if k == 0:
            return np.full(len(key), 1 / self.alphabet)
        keys, n, discount, contexts, total, _ = self.parts[lang][k]
        lower = self._probability(lang, k - 1, key & np.uint64((1 << 16 * (k - 1)) - 1))
        at, hit = self._find(keys, key)
        out = self._backoff(lang, k, key >> np.uint64(16)) * lower
        own = self._find(contexts, key[hit] >> np.uint64(16))[0]
        out[hit] += np.maximum(n[at[hit]] - discount, 0) / total[own]
        return out

    def log_probabilities(self, key: np.ndarray, k: int = ORDER) -> np.ndarray:
        """A row for each string, a column for each language."""
        if k == 0:
            return np.full((len(key), len(self.langs)), -np.log(self.alphabet), np.float32)
        at, hit = self._find(self.keys[k], key)
        if hit.all():
            return self.logs[k][at]
        out = np.empty((len(key), len(self.langs)), np.float32)
        out[hit] = self.logs[k][at[hit]]
        rest = key[~hit]
        where, known = self._find(self.contexts[k], rest >> np.uint64(16))
        lower = self.log_probabilities(rest & np.uint64((1 << 16 * (k - 1)) - 1), k - 1)
        lower[known] += self.backoffs[k][where[known]]
        out[~hit] = lower
        return out


class Slices:
    """A model in slices: broadcasts of the ``vars`` of each."""

    def __init__(self, langs: list[str], shared: list):
        self.langs, self.shared = langs, shared
        self.usual = np.zeros((len(langs), 2))
        self.chunk = CHUNK * min(max(len(shared), 1), 4)  # fewer reads of many slices

    def log_probabilities(self, key: np.ndarray) -> np.ndarray:
        out = np.empty((len(key), len(self.langs)), np.float32)
        slices = (key >> np.uint64(16) & np.uint64(0xFFFFFFFF)) % np.uint64(max(len(self.shared), 1))
        for i, part in enumerate(self.shared):
            at = np.flatnonzero(slices == i)
            if len(at):
                out[at] = Model.of(part.value).log_probabilities(key[at])
                if len(self.shared) > 1:  # one slice in memory at a time
                    part.__dict__.pop("_value", None)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and its letters."""
        key, text, count = symbols(texts)
        logs = self.log_probabilities(key)
        size = np.bincount(text, minlength=len(texts))
        total = np.stack([np.bincount(text, logs[:, i], len(texts)) for i in range(len(self.langs))], 1) if self.langs else np.zeros((len(texts), 0))
        return -total / np.maximum(size, 1)[:, None], count

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        entropy, count = self.entropies(texts)
        none = count == 0
        if not self.langs:
            return [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        best = entropy.argmin(1)
        low = entropy[np.arange(len(texts)), best]
        mean, deviation = self.usual[best].T
        far = (low - mean) / np.maximum(deviation, 0.02)
        # Neighbouring characters depend on each other: a text counts as a fifth of its characters.
        weight = np.minimum(np.maximum(count, 1) / 5, 200)[:, None]
        posterior = 1 / np.exp(-(entropy - low[:, None]) * weight).sum(1)
        score = posterior / (1 + np.exp(np.clip(far - REJECT, -30, 30)))
        lang = [UND if n else self.langs[i] for n, i in zip(none, best)]
        return lang, np.where(none, 0.0, score), none | (far > REJECT)


def _entropies(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, langs = [t or "" for t in batch["text"].to_pylist()], batch["lang"].to_pylist()
        place = {lang: i for i, lang in enumerate(model.langs)}
        for lo, hi in chunks([len(t) for t in texts], model.chunk):
            entropy, count = model.entropies(texts[lo:hi])
            rows = [(l, float(e[place[l]])) for l, e, c in zip(langs[lo:hi], entropy, count) if c and l in place]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([r[0] for r in rows], pa.string()), "e": pa.array([r[1] for r in rows], pa.float64())})


def _slices(counts: DataFrame, max_grams: int) -> Slices:
    """All of ``counts``. A slice of about ``max_grams`` rows, or the rows of one pair of characters, and the
    counts of all pairs go through the driver at a time."""
    short = counts.groupBy("lang", F.col("key").bitwiseAND((1 << 48) - 1).alias("key")).agg(F.count("*").alias("n"))
    tallies, total = {}, 0
    for order, table in ((3, short), (4, counts)):
        for r in table.groupBy("lang").agg(F.count("*").alias("all"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect():
            tallies[r["lang"], order] = r["once"], r["twice"]
            total += r["all"] if order == ORDER else 0
    langs = sorted({lang for lang, _ in tallies})

    def by_lang(df: DataFrame) -> dict:
        table = df.select("lang", "key", "n").orderBy("lang", "key").toArrow()
        names, key, n = np.array(table["lang"].to_pylist(), object), table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
        out = {}
        for lang in langs:
            own = names == lang
            order = np.argsort(key[own])
            out[lang] = key[own][order], n[own][order]
        return out

    pairs = by_lang(short.groupBy("lang", F.col("key").bitwiseAND((1 << 32) - 1).alias("key")).agg(F.count("*").alias("n")))
    size = -(-total // max_grams) if langs else 0
    size += size > 1 and size % 2 == 0  # odd, so that both characters count
    middle = F.shiftrightunsigned("key", 16).bitwiseAND(0xFFFFFFFF)
    cut = counts.withColumn("part", F.pmod(middle, F.lit(max(size, 1))))
    if size > 1:
        cut = materialize(cut.sort("part"), "slices")
    context = counts.sparkSession.sparkContext
    return Slices(langs, [context.broadcast(vars(Model(langs, by_lang(cut.where(F.col("part") == i)), pairs, tallies))) for i in range(size)])


def train(docs: DataFrame, max_grams: int = MAX_GRAMS) -> Slices:
    """The model of all documents with a language whose fold is not 0, and what cross-entropy is usual in all of them;
    see _slices for what goes through the driver."""
    model = _slices(materialize(gram_counts(docs), "grams"), max_grams)
    langs = model.langs
    known = docs.where("lang is not null and text is not null").where(fold() != 0)
    known = known.select("text", F.col("lang").cast("string").alias("lang"))
    usual = known.mapInArrow(lambda b: _entropies(model, b), "lang string, e double").groupBy("lang").agg(
        F.avg("e").alias("mean"), F.stddev_pop("e").alias("sd")).collect()
    for r in usual:
        model.usual[langs.index(r["lang"])] = r["mean"], r["sd"]
    model.usual[(model.usual == 0).all(1)] = np.inf, 1.0  # no text: reject nothing
    return model


def identify(docs: DataFrame, model: Slices, reject: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of ``docs`` (doc_id, text).

    Null texts and texts without letters are ``und`` with score 0. With ``reject``, rejected texts
    are ``und`` too. Equal entropies: the first language by name. Repeated rows and null ids
    stay; other columns are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for lo, hi in chunks([len(t) for t in texts], model.chunk):
                lang, score, far = model.predict(texts[lo:hi])
                lang = [UND if reject and f else l for l, f in zip(lang, far)]
                yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"].slice(lo, hi - lo), "lang_pred": pa.array(lang, pa.string()),
                                                  "score": pa.array(score, pa.float64()), "rejected": pa.array(far, pa.bool_())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected): see train and identify."""
    found = identify(docs, train(docs))
    return found.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score", "rejected")
