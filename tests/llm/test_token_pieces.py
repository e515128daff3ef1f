"""Texts are cut into pieces where the pre-tokenizer cuts them, so a word with a sign after it is no other word."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest

from changeflow.llm import simple8b

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_a_word_is_asked_for_once_whatever_sign_follows(tokenizer):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefghé") for _ in range(7)) for _ in range(200)})
    coder = simple8b.Encoder(tokenizer)
    coder.encode(["x " + " ".join(w + sign for w in words) for sign in ("", ",", ".", "!", ".\nX", " -")])
    assert len(coder.known) <= len(words) + 20


def test_random_texts_equal_the_library(tokenizer, monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    any_white = [*"ab  \n\n\t.,'s't-(1 2é×÷ß…«» 　 \u0085 \x1f\r中文кир́😀ª²", "<|endoftext|>", "'ll", " 's", ".\n", "\n\n"]
    single = [*"ab.,'s-1é×…中к²😀", " ", " ", " ", " a", "\na", ".\nB", "\né"]
    texts = ["".join(rng.choice(kind) for _ in range(rng.randrange(40))) for kind in (any_white, single) for _ in range(8000)]
    want = [e.ids for e in Tokenizer.from_file(tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
    for remembered, step in ((1_000_000, 16_000), (500, 900)):
        monkeypatch.setattr(simple8b, "REMEMBERED", remembered)
        coder, got = simple8b.Encoder(tokenizer), []
        for lo in range(0, len(texts), step):
            got += [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts[lo:lo + step])]
        assert got == want
        assert remembered > 500 or len(coder.known) < 12_000
    ids, sizes = coder.flat(pa.array(["zz", None, "a b", ""]).slice(1))
    assert sizes.tolist() == [0, 2, 0] and ids.tolist() == want_of(tokenizer, "a b")


def want_of(tokenizer, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).encode(text, add_special_tokens=False).ids


def test_blocks_hold_whole_documents_in_order(spark, tokenizer, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * (i % 50) + "end" if i % 7 else None) for i in range(400)], "doc_id long, text string").repartition(3)
    folder = simple8b.scratch_dir(spark, "test-tokens")
    monkeypatch.setattr(simple8b, "BLOCK_IDS", 300)
    simple8b.write_ids(docs, folder, tokenizer)
    blocks = spark.read.parquet(folder).orderBy("part", "block").collect()
    assert [i for b in blocks for i in b["doc_ids"]] == list(range(400))
    assert all(b["offsets"][-1] == b["n_ids"] and len(b["offsets"]) == len(b["doc_ids"]) + 1 for b in blocks)
    read = simple8b.read_ids(spark, folder, ids=True).orderBy("doc_id").collect()
    assert [r["start"] for r in read] == np.cumsum([0, *(r["n_tokens"] for r in read)])[:-1].tolist()
    assert all(r["ids"][-1] == 0 and len(r["ids"]) == r["n_tokens"] for r in read)
