"""The vectorised models and walks against step-by-step versions in plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from changeflow.llm import editprint, langid, toxicity
from changeflow.llm.common import mix


def key(gram):
    out = 0
    for c in gram:
        out = out << 16 | c
    return out


def plain_kneser_ney(counts, alphabet):
    """p(gram) of interpolated Kneser-Ney from the counts of 4-grams (tuples), with one discount for each order."""
    levels = {4: dict(counts)}
    for k in (3, 2, 1):
        before = defaultdict(set)
        for gram in levels[k + 1]:
            before[gram[1:]].add(gram[0])
        levels[k] = {gram: len(s) for gram, s in before.items()}
    discount, total, kinds = {}, {}, {}
    for k, found in levels.items():
        once, twice = (sum(n == x for n in found.values()) for x in (1, 2))
        discount[k] = min(max(once / (once + 2 * twice), 0.1), 0.95) if once and twice else 0.75
        total[k], kinds[k] = Counter(), Counter()
        for gram, n in found.items():
            total[k][gram[:-1]] += n
            kinds[k][gram[:-1]] += 1

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / alphabet
        context = gram[:-1]
        lower = p(gram[1:])
        if context not in total[k]:
            return lower
        own = max(levels[k].get(gram, 0) - discount[k], 0) if gram in levels[k] else 0
        return own / total[k][context] + discount[k] * kinds[k][context] / total[k][context] * lower

    return p


@pytest.mark.parametrize("seed", range(4))
def test_language_model(seed):
    rng = random.Random(seed)
    counts = {}
    for lang, letters in (("a", range(1, 6)), ("b", range(3, 12))):
        text = [rng.choice(list(letters)) for _ in range(600)]
        counts[lang] = Counter(tuple(text[i:i + 4]) for i in range(len(text) - 3))
    tables = {lang: (np.array([key(g) for g in c], np.uint64), np.array(list(c.values()), np.int64)) for lang, c in counts.items()}
    model = langid.Model(sorted(counts), tables)
    alphabet = 1 + len({g[-1] for c in counts.values() for g in c})
    assert model.alphabet == alphabet
    grams = [tuple(rng.choice(range(1, 14)) for _ in range(4)) for _ in range(300)] + [g for c in counts.values() for g in list(c)[:100]]
    got = model.log_probabilities(np.array([key(g) for g in grams], np.uint64))
    for i, lang in enumerate(sorted(counts)):
        p = plain_kneser_ney(counts[lang], alphabet)
        assert np.allclose(got[:, i], [math.log(p(g)) for g in grams], atol=2e-4)
        # A distribution over the next character: the alphabet and one for all others.
        known = [c for c in range(1, 14) if (c,) in {g[-1:] for x in counts.values() for g in x}]
        assert abs(sum(p((1, 3, 4, c)) for c in known) - 1) < 1 / alphabet + 1e-9


def plain_ftrl(examples):
    """FTRL-proximal, one coordinate at a time."""
    z, n, z0, n0 = defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    rng = np.random.default_rng(8)
    for _ in range(toxicity.EPOCHS):
        for e in rng.permutation(len(examples)):
            places, label = examples[e]
            w = {i: weight(i) for i in places.tolist()}
            bias = -z0 / ((toxicity.BETA + math.sqrt(n0)) / toxicity.ALPHA)
            g = 1 / (1 + math.exp(-min(max(sum(w.values()) + bias, -30), 30))) - label
            for i in w:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w[i]
                n[i] += g * g
            z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / toxicity.ALPHA * bias
            n0 += g * g
    return {i: weight(i) for i in z if weight(i)}, -z0 / ((toxicity.BETA + math.sqrt(n0)) / toxicity.ALPHA)


def test_logistic_regression():
    rng = random.Random(6)
    examples = []
    for _ in range(400):
        label = rng.random() < 0.3
        own = {rng.randrange(50) for _ in range(6)} | ({100 + rng.randrange(4)} if label else {200 + rng.randrange(4)})
        examples.append((np.array(sorted(own), np.int32), int(label)))
    at, w, bias = toxicity.fit(examples)
    want, want_bias = plain_ftrl(examples)
    assert dict(zip(at.tolist(), w.tolist())) == pytest.approx(want, rel=1e-4) and bias == pytest.approx(want_bias, rel=1e-6)
    assert want and max(want, key=want.get) in range(100, 104)


def plain_print(text):
    """The fingerprint by a walk that writes one character at each step."""
    moves = np.random.default_rng(editprint.SEED).integers(0, 2, (editprint.PERIOD, editprint.CLASSES), np.uint8)
    moves[editprint.PERIOD - 1] = 1
    written, i = [], 0
    while i < len(text):
        c = ord(text[i])
        written.append(c)
        kind = int(mix(np.array([c], np.uint64))[0]) % editprint.CLASSES
        i += int(moves[(len(written) - 1) % editprint.PERIOD, kind])
    if not written:
        return ""
    levels = max(1, (len(written) - 1).bit_length() - 1)
    out = ""
    for places in editprint.SAMPLED[:levels]:
        for place in places.tolist():
            out += "-" if place >= len(written) else "%x" % (int(mix(np.array([written[place] + editprint.SEED], np.uint64))[0]) >> 60)
    return out


@pytest.mark.parametrize("text", ["", "a", "ab", "é日\U0001f926", "the same text again " * 40, "x" * 6000, "line\n" * 2000])
def test_fingerprint(text):
    rng = random.Random(len(text))
    others = ["".join(rng.choice("abc d") for _ in range(rng.randrange(300))) for _ in range(12)]
    texts = [text, *others]
    assert [r[2] for r in editprint.compare([*texts, ""])] == [plain_print(t) for t in texts]
