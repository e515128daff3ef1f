"""One query for each operator, with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changeflow.llm.common import read
from changeflow.session import materialize, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op2_hypergeometric_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: shard counts at most one apart."""
    from changeflow.llm.sharding import shuffle_into_shards

    value = F.coalesce("text", F.lit(""))
    # Written, so that whole documents are dealt, exchanged and permuted.
    docs = materialize(shuffle_into_shards(read(spark, sf_dir, "documents")), "shards")
    return docs.select(
        "doc_id", (F.octet_length(value) + 16).cast("long").alias("size"), F.crc32(value.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_JOINED = r"""trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'))"""


@query("op5_rare_prefix_decontamination", f"""
WITH bench AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_JOINED} AS j FROM benchmark),
bw AS (SELECT item_id, string_split(j, ' ') AS w FROM bench WHERE j <> ''),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, s, s + 9), ' ') AS win, least(len(w), 10) AS size
        FROM bw, UNNEST(range(1, greatest(1, len(w) - 9) + 1)) AS t(s)),
d AS (SELECT doc_id, CASE WHEN j = '' THEN [] ELSE string_split(j, ' ') END AS w FROM (SELECT doc_id, {_JOINED} AS j FROM documents)),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win
          FROM d, sizes, UNNEST(range(1, len(w) - size + 2)) AS t(s)),
hit AS (SELECT doc_id, s, g.size, item_id FROM grams g JOIN win ON g.win = win.win AND g.size = win.size),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, UNNEST(range(s, s + size)) AS u(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain windows of benchmark items."""
    from changeflow.llm.decontamination import contamination

    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op6_superminhash_near_copies")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents of similarity 0.75 or more."""
    from changeflow.llm.superminhash import near_copies

    return near_copies(read(spark, sf_dir, "documents"))


@query("op8_ftrl_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    from changeflow.llm.toxicity import toxicity

    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_pfair_mixture")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out so that every prefix has the sources at their target weights."""
    from changeflow.llm.pfair import mix

    # Written, so that whole documents are mixed.
    docs = materialize(mix(read(spark, sf_dir, "documents")), "mixture")
    return docs.select("doc_id", "source", "mix_epoch", "mix_block", "mix_slot", "mix_position")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query("op1_tree_scored_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from changeflow.llm.html_text import extract

    return extract(read(spark, sf_dir, "pages"))


@query("op3_interval_tree_repeats")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated passages."""
    from changeflow.llm.repeats import cut_repeats

    return cut_repeats(read(spark, sf_dir, "documents"))


@query("op4_simple8b_tokens")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written and read back."""
    import public_tokenizers

    from changeflow.llm.simple8b import token_files

    return token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_kneser_ney_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    from changeflow.llm.langid import languages

    return languages(read(spark, sf_dir, "documents"))


@query("op9_edit_embedding_prints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    from changeflow.llm.editprint import fingerprints

    return fingerprints(read(spark, sf_dir, "documents"))


@query("op11_bag_ranked_search", r"""
WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (SELECT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, term, count(*) AS q FROM asked GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM q) GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM size),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
score AS (SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM score WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    from changeflow.llm.lexical import search

    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _secrets_sql() -> str:
    from changeflow.llm.secret_scan import MIXED, PATTERNS, VARIETY, WIDE

    quoted = {kind: pattern.replace("'", "''") for kind, pattern in [*PATTERNS.items(), ("live", MIXED)]}
    matched = " UNION ALL ".join(f"""
      SELECT doc_id, source, '{kind}' AS kind, {k} AS k, string_split_regex(text, '{p}') AS pieces, regexp_extract_all(text, '{p}') AS found,
        regexp_extract_all(text, '{p}', {int(kind == "assign")}) AS vals FROM d WHERE regexp_matches(text, '{p}')""" for k, (kind, p) in enumerate(quoted.items()))
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
matched AS ({matched}),
numbered AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matched),
span AS (SELECT doc_id, source, kind, k, vals[i] AS v,
    CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(found[i]) AS n
  FROM numbered WHERE length(vals[i]) >= 6),
base AS (SELECT *, a + n AS b FROM span WHERE kind <> 'live'),
looks AS (SELECT *, a + n AS b, regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= {VARIETY} AS varied FROM span),
cand AS (SELECT * FROM looks l WHERE kind <> 'live' OR (varied AND NOT EXISTS (SELECT 1 FROM base o WHERE o.doc_id = l.doc_id AND l.a < o.b AND o.a < l.b))),
owned AS (SELECT v, count(DISTINCT source) AS owners, bool_or(varied) AS varied FROM cand GROUP BY v),
label AS (SELECT v, CASE WHEN owners >= {WIDE} THEN 'example' WHEN owners = 1 AND varied THEN 'live' ELSE 'plain' END AS label FROM owned),
told AS (SELECT doc_id, kind, k, a, concat(kind, ':', a, ':', b) AS word, label FROM cand JOIN label USING (v)),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(word, ',' ORDER BY a, k) FILTER (kind <> 'live') AS base, string_agg(word, ',' ORDER BY a, k) FILTER (kind <> 'live' OR label = 'live') AS spans,
    count(*) FILTER (label = 'example') AS n_example, count(*) FILTER (label = 'live') AS n_live FROM told GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_example, 0) AS n_example, coalesce(n_live, 0) AS n_live FROM d LEFT JOIN per USING (doc_id)"""


@query("op13_ownership_secret_scan", _secrets_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, told from examples by the owners of their values."""
    from changeflow.llm.secret_scan import scan

    return scan(read(spark, sf_dir, "documents"))


@query("op12_pair_hash_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over every document, with corpus-wide pair counts."""
    import public_tokenizers

    from changeflow.llm.alignment import align

    return align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
