"""op11: ranked search against a plain version."""

import math
import random
import re
from collections import Counter

import pytest

from changeflow.llm import lexical
from conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=10):
    bags = [(doc, terms(text)) for doc, text in docs]
    bags = [(doc, len(t), Counter(t)) for doc, t in bags if t]
    total = sum(n for _, n, _ in bags)
    df = Counter(t for *_, bag in bags for t in bag)
    out = []
    for item, text in set(items):
        wanted = terms(text)
        weights = [(t, math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))) for t in wanted]
        found = []
        for doc, n, bag in bags:
            m = 25 + 75 * n * len(bags) // total
            score = sum(w * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m)) for t, w in weights)
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, k + 1, doc, -score) for k, (score, _, doc) in enumerate(sorted(found, key=lambda r: r[:2] if r[1] else r)[:top])]
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def frames(spark, docs, items):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n long, terms string")
    return docs, spark.createDataFrame([(i, t, 2) for i, t in items], "item_id string, text string, score int")


@pytest.mark.parametrize("block", [1, 2, 256])
def test_equals_a_plain_version(spark, block):
    """Copies of one bag in other texts, ties, nulls, empty and long texts, repeated rows and items."""
    rng = random.Random(4)
    word = lambda: rng.choice(["Alpha", "beta", "GAMMA", "délta", "ÉTÉ", "日本", "a1", "9", "zeta", "eta"])
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    docs += [(200 + i, "beta, gamma; unknown" + " filler" * 3 + "." * i) for i in range(40)]  # one class
    docs += [(300, None), (301, ""), (302, "... -- !"), (None, "zeta eta"), (None, "zeta eta"), (303, "zeta eta"), (5, docs[5][1]), (5, docs[5][1]),
             (400, "alpha " * 3000 + "beta"), (401, "x\x00beta\x7fgamma_Delta")]
    items = [("a", "alpha Beta beta"), ("b", "gamma delta"), ("c", "nothing here"), ("d", None), ("e", ""), (None, "zeta"), ("a", "alpha Beta beta"), ("a", "eta"),
             ("f", "été 日本"), ("g", "beta gamma unknown filler")]
    docs_df, items_df = frames(spark, docs, items)
    assert result(lexical.search(docs_df, items_df, block=block)) == expected(docs, items)


def test_documents(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert result(lexical.search(docs.repartition(5), items)) == want


def test_top_of_one_and_empty_tables(spark):
    docs, items = [(2, "a b"), (1, "a b"), (3, "b")], [(1, "a"), (2, "b")]
    docs_df, items_df = frames(spark, docs, items)
    assert result(lexical.search(docs_df, items_df, top=1)) == sorted([(i, r, d, s) for i, r, d, s in
                                                                      [(str(i), r, d, s) for i, r, d, s in expected(docs, items, 1)]], key=str)
    assert lexical.search(docs_df.limit(0), items_df).collect() == [] == lexical.search(docs_df, items_df.limit(0)).collect()


def test_classes_are_scored_not_documents(spark):
    """However many copies there are, their bag is one class."""
    docs = [(i, "alpha beta") for i in range(300)] + [(1000 + i, "alpha") for i in range(5)]
    docs_df, items_df = frames(spark, docs, [("i", "alpha beta")])
    got = lexical.search(docs_df, items_df).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(10)) and len({r["score"] for r in got}) == 1
