"""op12: alignment of two tokenizers against a plain version, and the perfect hash by itself."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from changeflow.llm import alignment as A
from conftest import SF, rows

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def tokens(text):
    """Ids and bytes of both sides by the libraries alone; none if their bytes differ from the text's."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders

    if not hasattr(tokens, "a"):
        tokens.a, tokens.b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
        tokens.a.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        tokens.letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    if not text:
        return [], []
    a = [(i, bytes(tokens.letters[c] for c in tokens.a.id_to_token(i))) for i in tokens.a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in tokens.b.encode(text):
        piece = tokens.b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if tokens.b.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == want else ([], [])


def groups(a, b):
    def ends(side):
        at, out = 0, []
        for _, x in side:
            at += len(x)
            out.append(at)
        return out

    ends_a, ends_b = ends(a), ends(b)
    found, lo_a, lo_b = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        hi_a, hi_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        found.append(([i for i, _ in a[lo_a:hi_a]], [i for i, _ in b[lo_b:hi_b]]))
        lo_a, lo_b = hi_a, hi_b
    return found


def expected(docs):
    every = [(doc, *tokens(text)) for doc, text in docs]
    every = [(doc, a, b, groups(a, b)) for doc, a, b in every]
    held = Counter()
    for *_, g in every:
        held.update({(x, y) for own_a, own_b in g for x in own_a for y in own_b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc, a, b, g in every:
        links = [(x, y) for own_a, own_b in g for x in own_a for y in own_b]
        listing = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((doc, len(a), len(b), len(g), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(listing.encode()).hexdigest() if listing else ""))
    return sorted(out, key=lambda r: (r[0] is None, r))


def result(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r))


ODD = ["", None, "a", " lead", "trail ", "two  spaces", "tab\tand\nnew\n\nlines", "x \n y", "<|endoftext|> in <s>text</s> <0x41> <unk>",
       "▁ sign", "naïve café üß", "日本語のテキスト \U0001f926\U0001f3fc", "no break   wide", "\x00 zero \x1f", "a" * 5000, "1234567890" * 40,
       " ", "\n", "don't they're I'LL", "é combining", "ab" * 3000 + " " + "same words here same words here"]


def test_odd_texts(spark):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(7, ODD[6]), (None, "two  spaces"), (None, "a")]
    df = spark.createDataFrame([(d, t, "s", 0) for d, t in docs], "doc_id long, text string, chunk string, pair long")
    assert result(A.align(df, BYTE, PIECE)) == expected(docs)


def test_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = rows(df)
    want = expected(docs)
    assert result(A.align(df, BYTE, PIECE)) == want
    # Many slices, a tree of several levels.
    assert result(A.align(df.repartition(6), BYTE, PIECE, per_slice=3000, rows=20)) == want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id int, text string")
    assert A.align(df, BYTE, PIECE).collect() == []


def test_chunks_and_links_in_parts(spark, monkeypatch):
    """The same results in small chunks, and with groups that are looked at by distinct ids."""
    own = A.Tokenizers(BYTE, PIECE)
    texts = ["a" * 701 + "b", "xyxyxyx" * 90, "plain words and more words", "1234567890" * 40]
    order, (a, n_a, b, n_b) = own.encode(texts)

    def all_links():
        aligned = A.Alignment(a, n_a, b, n_b, own.width_a, own.width_b)
        found = Counter()
        for doc, pair, times in aligned.links():
            for d, p, t in zip(doc.tolist(), pair.tolist(), np.broadcast_to(times, len(pair)).tolist()):
                found[d, p] += t
        return found, {tuple(map(int, x)) for x in zip(*aligned.documents_of_pairs())}

    whole = all_links()
    for links in (3, 7, 100):
        monkeypatch.setattr(A, "LINKS", links)
        assert all_links() == whole


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
    sizes, bits = A.perfect_hash(keys)
    number = A.Numbers(sizes, bits).of(keys)
    assert sorted(number.tolist()) == list(range(len(keys)))
    by_number = np.empty(len(keys), np.int64)
    by_number[number] = keys
    checked = A.Numbers(sizes, bits, by_number)
    assert (checked.of(keys) == number).all()
    if n > 1:
        strangers = np.setdiff1d(keys + 1, keys)
        assert (checked.of(strangers) == -1).all()
