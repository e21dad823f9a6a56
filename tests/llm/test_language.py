import math
import re
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vitrina.llm import language

from .conftest import EDGE, WORDS, make_docs


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x20\x09-\x0d]+", low) + [None]


def brute(rows):
    """The model by dictionaries."""
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    one, two = Counter(), Counter()
    for (_, t), h in zip(rows, held):
        if not h:
            own = tokens(t)
            one.update(own)
            two.update(zip(["<s>", *own], own))
    total, size = sum(one.values()), len(one)
    n_docs = held.count(False)
    a, context = Counter(), defaultdict(Counter)
    for (v, w), c in two.items():
        a[w] += 1
        context[v][min(c, 3)] += 1
    of = lambda counts, k: sum(1 for x in counts.values() if x == k)
    d2 = language.discounts(*(of(two, k) for k in (1, 2, 3, 4)))
    d1 = language.discounts(*(of(a, k) for k in (1, 2, 3, 4)))
    types = len(two)
    n = [0, of(a, 1), of(a, 2), sum(1 for x in a.values() if x > 2)]

    def p_word(w):
        rest = sum(d1[k] * n[k] for k in (1, 2, 3)) / types if types else 1
        return (a[w] - d1[min(a[w], 3)]) / max(types, 1) + rest / (size + 1)

    def p_pair(v, w):
        c = n_docs if v == "<s>" else one[v]
        if not c:
            return p_word(w)
        x = two[(v, w)]
        return (x - d2[min(x, 3)]) / c + sum(d2[k] * context[v][k] for k in (1, 2, 3)) / c * p_word(w)

    out = {}
    for (i, t), h in zip(rows, held):
        own = tokens(t)
        base = sum(math.log10((one[w] + 1) / (total + size + 1)) for w in own)
        score = sum(math.log10(p_pair(v, w)) for v, w in zip(["<s>", *own], own))
        out.setdefault(i, []).append((h, len(own), sum(one[w] > 0 for w in own), total, base, score))
    vocabulary = [*one, "never seen"]
    for v in ["<s>", "alpha", "beta", "never seen"]:  # every context's probabilities add up to 1
        assert not one or abs(sum(p_pair(v, w) for w in vocabulary) - 1) < 1e-9
    return out


def same(got, want):
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert found.keys() == want.keys()
    for i, rows in want.items():
        for x, y in zip(sorted(found[i]), sorted(rows)):
            assert x[:4] == y[:4] and np.allclose(x[4:], y[4:], rtol=1e-9, atol=1e-9), (i, x, y)


@pytest.mark.parametrize("hot", [1000, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    r = random.Random(9)
    rows = EDGE + [(100 + k, " ".join(r.choices(WORDS, k=r.randrange(60), weights=[60, *range(1, 20)]))) for k in range(150)]
    monkeypatch.setattr(language, "HOT_TOKENS", hot)
    monkeypatch.setattr(language, "LEAST_PAIR_SHARDS", 5)
    same(language.score_documents(make_docs(spark, rows)).collect(), brute(rows))


def test_empty_and_untrained(spark, no_docs):
    assert language.score_documents(no_docs).count() == 0
    row = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = language.score_documents(make_docs(spark, [(row, "a b")], parts=0)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0)]


def test_mix_is_inverted():
    x = np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (language.unmix(language.mix(x)) == x).all()
