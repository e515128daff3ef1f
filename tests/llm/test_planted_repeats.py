"""Planted passages are told by ``n_removed``: those of 400 bytes go, shorter ones stay whatever their number of words."""

import random

from changeflow.llm import repeats


def test_planted_passages_show_in_n_removed(spark):
    rng = random.Random(8)
    text = lambda n, letters: " ".join("".join(rng.choice("abcdefghij") for _ in range(letters)) for _ in range(n))
    long, short = text(60, 7), text(55, 6)  # 479 and 384 bytes
    # Another letter around each passage, so that no byte beside it repeats by chance.
    rows = [(i, text(80, 5) + chr(65 + i) + {0: long, 1: short}.get(i % 3, "") + chr(65 + i) + text(80, 5)) for i in range(24)]
    got = {r["doc_id"]: r for r in repeats.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for i, whole in rows:
        assert got[i]["n_removed"] == (len(long) if i % 3 == 0 else 0)
        assert got[i]["n_bytes"] == len(whole)
