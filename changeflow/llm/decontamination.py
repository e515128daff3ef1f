"""Benchmark decontamination by a prefix-filtered set join, in native expressions only.

A window is a run of 10 words of an item, a set of (word, offset) tokens. A document contains
it only if it contains every token, so the necessary prefix is one token, and the rarest in
the corpus gives the fewest candidates. Word counts come from all documents. A document
word equal to a window's rarest one fixes where the window would start; the start must not
be negative and the window must end within the document (positional and length bounds);
then all words are compared there.

Documents are tokenised once and written; both passes over their words read that table.
The windows' table is broadcast only up to a counted size, beyond it the joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.functions.parsing import once
from changeflow.llm.common import text_keys
from changeflow.session import materialize

WINDOW = 10
#: Rows of the windows' tables up to which they are broadcast: some 40 MB.
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything of ASCII that is neither a digit nor a lower-case letter.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_text(text: str = "text") -> Column:
    """The words of a text after lower-casing A-Z, one space between them; null has none."""
    value = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(value, BETWEEN, " "))


def word_list(joined: str) -> Column:
    return F.when(F.col(joined) == "", F.array().cast("array<string>")).otherwise(F.split(joined, " "))


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(window, size, items): every distinct window text with the sorted ids of its items.

    Items with no words have none; a shorter item is one window.
    """
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_text().alias("_joined")) \
        .where("_joined <> ''").select("item_id", word_list("_joined").alias("words"))
    starts = words.select("item_id", "words", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (width - 1)))).alias("s"))
    cut = starts.select("item_id", F.slice("words", F.col("s"), width).alias("w"))
    return cut.groupBy(F.array_join("w", " ").alias("window"), F.size("w").alias("size")).agg(F.collect_set("item_id").alias("items"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    * null or wordless texts: 0 words, not contaminated, the hash of the empty text;
    * null item ids take part in hits and are left out of the items; equal items both count;
    * repeated rows are judged each; empty tables give no rows, or no hits; other columns
      are ignored.
    """
    return _judged(docs, items, width).drop("_t", "_u")


def _judged(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    joined = once(docs.select("doc_id", *text_keys(), "text"), "joined", words_text())
    n_words = F.size(word_list("joined")).cast("long").alias("n_words")
    table = materialize(joined.select("doc_id", "_t", "_u", n_words, "joined"), "words")
    wanted = materialize(windows(items, width), "windows")
    n_windows = wanted.count()

    # The rarest word of each window, by its count in all documents.
    tokens = wanted.select("window", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    in_docs = table.select(F.explode(F.split("joined", " ")).alias("word"))
    vocabulary = tokens.select("word").distinct()
    counts = in_docs.join(_small(vocabulary, n_windows * width), "word").groupBy("word").agg(F.count("*").alias("n"))
    rare = tokens.join(_small(counts, n_windows * width), "word").groupBy("window").agg(
        F.count("*").alias("known"), F.min(F.struct("n", "word", "offset")).alias("r"))
    # A window with a word that no document has occurs nowhere.
    prefix = materialize(rare.join(wanted, "window").where("known = size").select(
        "window", "size", "items", F.col("r.word").alias("word"), F.col("r.offset").alias("offset")), "prefix")

    at = table.select("_t", "_u", "n_words", F.posexplode(F.split("joined", " ")).alias("pos", "word"))
    start = F.col("pos") - F.col("offset")
    fits = [F.col("at.word") == F.col("p.word"), start >= 0, start + F.col("size") <= F.col("n_words")]
    found = at.alias("at").join(_small(prefix, n_windows).alias("p"), fits).select("_t", "_u", start.alias("start"), "size", "window", "items")
    candidates = found.groupBy("_t", "_u").agg(F.collect_set(F.struct("start", "size", "window", "items")).alias("found"))

    # Verification on the whole texts: words and what holds are computed once a row.
    rows = table.join(candidates, ["_t", "_u"], "left")
    none = F.array().cast(candidates.schema["found"].dataType)
    listed = once(rows, "words", F.when(F.col("found").isNotNull(), F.split("joined", " ")))
    real = F.filter(F.coalesce("found", none), lambda c: F.array_join(F.slice("words", c["start"] + 1, c["size"]), " ") == c["window"])
    checked = once(listed.select("doc_id", "_t", "_u", "n_words", "words", "found"), "real", real)
    covered = F.array_distinct(F.flatten(F.transform("real", lambda c: F.sequence(c["start"], c["start"] + c["size"] - 1))))
    ids = F.sort_array(F.array_distinct(F.flatten(F.transform("real", lambda c: c["items"]))))
    final = once(once(checked, "n_hit", F.size(covered).cast("long")), "ids", ids)
    return final.select("doc_id", "_t", "_u", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept. A judgement is of the text alone, so all copies go.

    Null, empty and wordless texts stay, repeated rows too; without items, or items with words, nothing goes; an empty
    table gives no rows.
    """
    hit = _judged(docs, items, width).where("contaminated").select("_t", "_u").distinct()
    t, u = text_keys()
    return docs.alias("d").join(hit.alias("h"), [F.col("h._t") == t, F.col("h._u") == u], "left_anti")
