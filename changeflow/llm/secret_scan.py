"""Secret scan by corpus-wide ownership frequency, in native expressions only.

Patterns find candidates. What tells a leaked credential from the example key of a manual is who holds
it: the hash of each candidate's value is counted over all documents by distinct repositories and
owners. A value that several owners hold is an example; one that a single owner holds and that looks
like random text is live. The count also opens a wider net than the patterns with a keyword: any long
run of mixed characters is a candidate, and becomes a span if it is live.

Texts are read once. What is kept of a document are its candidates: places, hashes and looks, not
values. Counting combines before each shuffle, so a value in a third of all documents is one row a
task. Labels come back to texts, not to documents, and copies of a text are one row there.

Positions. Splitting a text at a pattern gives the pieces between its matches, so the running sums
of the lengths of pieces and matches are the places of leftmost non-overlapping matches, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.functions.parsing import once
from changeflow.llm.common import text_keys
from changeflow.session import materialize

#: The patterns of the base kinds, in the order in which they are listed. Only the first can
#: fail after it matched (its value has to have 6 characters): the others are maximal runs, of which a shorter
#: one contains no longer one, so their least length stands in the pattern.
PATTERNS = {
    "assign": r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
LEAST_VALUE = 6
#: The wider net: a long run of characters that needs no keyword.
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
#: Random looks: a digit, a letter and so many different characters.
VARIETY = 8
#: Distinct owners from which on a value is an example.
WIDE = 3
#: Kinds by their order among spans of one start. ``live``: from the wider net.
KINDS = [*PATTERNS, "live"]
#: Rows up to which labels are broadcast: some 8 MB.
BROADCAST_ROWS = 200_000
#: Matches whose places are summed up one by one; longer lists are blocks of so many.
BLOCK = 256

SPAN = "array<struct<start:int,end:int,h1:long,h2:long,varied:boolean>>"


def _varied(value: Column) -> Column:
    """Looks like random text: mixed characters, many different ones."""
    several = F.size(F.array_distinct(F.split(value, ""))) >= VARIETY
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & several


def spans_of(text: str, pattern: str, group: bool = False) -> Column:
    """Places, value hashes and looks of all matches of ``pattern``; with ``group`` its first group is the value.

    A text without a match is looked through once.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if group else found
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("match"), values.alias("value"))
    none = F.array().cast(SPAN)

    def add(held: Column, row: Column) -> Column:
        start = held["at"] + F.length(row["piece"])
        end = start + F.length(row["match"])
        value = row["value"]
        span = F.struct(start.alias("start"), end.alias("end"), F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(7919), value).alias("h2"),
                        F.coalesce(_varied(value), F.lit(False)).alias("varied"))
        # After the last match comes a piece alone.
        none_here = row["match"].isNull() | (F.length(value) < LEAST_VALUE)
        return F.struct(F.coalesce(end, start).alias("at"), F.when(none_here, held["out"]).otherwise(F.concat(held["out"], F.array(span).cast(SPAN))).alias("out"))

    def placed(block: Column) -> Column:
        """The places of a block's matches, from its own beginning, and its length."""
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("out")), add)

    def follow(held: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda s: s.withField("start", s["start"] + held["at"]).withField("end", s["end"] + held["at"]))
        return F.struct((held["at"] + block["at"]).alias("at"), F.concat(held["out"], F.array(moved)).alias("out"))

    def all_places(rows: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(rows), F.lit(BLOCK)), lambda first: placed(F.slice(rows, first, BLOCK)))
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.aggregate(blocks, nothing, follow, lambda held: F.flatten(held["out"]))

    # An array of one holds the rows, so that they are made once.
    return F.when(F.col(text).rlike(pattern), F.transform(F.array(rows), all_places)[0]).otherwise(none)


def _apart(spans: str, base: Column) -> Column:
    """Spans that touch none of ``base``."""
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(doc_id, owner, repository, _t, _u, assign, access, hex, mixed): the candidates of each document, without its text."""
    rows = docs.select("doc_id", F.col(owner).alias("owner"), F.col(repository).alias("repository"), *text_keys(), F.coalesce("text", F.lit("")).alias("text"))
    for kind, pattern in PATTERNS.items():
        rows = once(rows, kind, spans_of("text", pattern, group=kind == "assign"))
    rows = once(rows, "wide", spans_of("text", MIXED))
    mixed = F.filter(_apart("wide", F.concat(*PATTERNS)), lambda s: s["varied"])
    return rows.select("doc_id", "owner", "repository", "_t", "_u", *PATTERNS, mixed.alias("mixed"))


def ownership(found: DataFrame, wide: int = WIDE) -> DataFrame:
    """(h1, h2, n_repositories, n_owners, label) of each candidate value.

    ``example``: ``wide`` owners or more; ``live``: one owner (rows without an owner are one of their own)
    and random looks; ``plain``: the rest.
    """
    every = found.select(F.struct(F.col("owner")).alias("owner"), F.struct(F.col("repository")).alias("repository"), F.explode(F.concat(*PATTERNS, "mixed")).alias("s"))
    rows = every.select("owner", "repository", "s.h1", "s.h2", "s.varied")
    counted = rows.groupBy("h1", "h2").agg(
        F.count_distinct("repository").alias("n_repositories"), F.count_distinct("owner").alias("n_owners"), F.bool_or("varied").alias("varied"))
    label = F.when(F.col("n_owners") >= wide, "example").when((F.col("n_owners") == 1) & F.col("varied"), "live").otherwise("plain")
    return counted.select("h1", "h2", "n_repositories", "n_owners", label.alias("label"))


def _tagged(spans: str, k: int, *more: str) -> Column:
    """(start, k, end) of each span, in this order for sorting, and more of its fields."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), *(s[f].alias(f) for f in more)))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", wide: int = WIDE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_example, n_live) of every row of ``docs`` (doc_id, text and the two named columns).

    ``spans`` has the base spans and those of live values of the wider net, as kind:start:end by
    start, then kind. ``n_example`` and ``n_live`` count the document's spans, base and wider, whose value is an
    example or live.

    * null and empty texts: no spans, the hash of the empty text;
    * null owners are one owner, null repositories one repository; repeated rows are judged each and, being
      one repository of one owner, change no count;
    * equal starts: in the order of KINDS; an empty table gives no rows; texts are scanned whole;
      other columns are ignored.
    """
    found = materialize(candidates(docs, owner, repository), "candidates")
    labels = materialize(ownership(found, wide), "ownership")
    telling = labels.where("label <> 'plain'").select("h1", "h2", "label")
    tagged = F.concat(*(_tagged(kind, k, "h1", "h2") for k, kind in enumerate([*PATTERNS, "mixed"])))
    of_texts = found.select("_t", "_u", F.explode(tagged).alias("s")).select("_t", "_u", "s.*").distinct()
    live = F.col("label") == "live"
    wider = F.when(live & (F.col("k") == len(PATTERNS)), F.struct("start", "k", "end"))
    by_text = of_texts.join(_small(telling), ["h1", "h2"]).groupBy("_t", "_u").agg(
        F.count_if(F.col("label") == "example").alias("n_example"), F.count_if(live).alias("n_live"), F.collect_set(wider).alias("wider"))
    rows = found.join(_small(materialize(by_text, "labelled")), ["_t", "_u"], "left")

    kinds = F.array(*(F.lit(k) for k in KINDS))
    base = F.concat(*(_tagged(kind, k) for k, kind in enumerate(PATTERNS)))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", kinds[s["k"]], s["start"], s["end"])), ",")

    every = F.concat(base, F.coalesce("wider", F.array().cast("array<struct<start:int,k:int,end:int>>")))
    return rows.select(
        "doc_id", *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in PATTERNS), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(every).alias("spans"), F.coalesce("n_example", F.lit(0)).alias("n_example"), F.coalesce("n_live", F.lit(0)).alias("n_live"))
