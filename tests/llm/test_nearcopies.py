import random
from collections import Counter

import numpy as np
import pytest

from vitrina.llm import nearcopies as nc

from .conftest import EDGE, make_docs


def bag(text):
    w = (text or "").encode().lower().split()
    return Counter([tuple(w[k: k + 5]) for k in range(len(w) - 4)] or ([tuple(w)] if w else []))


def similar(a, b):
    if not a or not b:
        return a == b
    return 5 * sum((a & b).values()) >= 4 * sum((a | b).values())


def brute(rows):
    """Class of each row by comparing all pairs."""
    bags = [bag(t) for _, t in rows]
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if similar(bags[i], bags[j]):
                head[root(i)] = root(j)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(k)
    out = []
    for own in groups.values():
        ids = [rows[k][0] for k in own]
        out += [(i, min((x for x in ids if x is not None), default=None), len(own)) for i in ids]
    return sorted(out, key=str)


def corpus(seed=6):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, i = [], 100
    for family in range(25):
        base = r.choices(vocabulary, k=r.randrange(30, 300))
        for _ in range(r.randrange(1, 9)):
            own = list(base)
            for _ in range(r.randrange(0, 1 + len(own) // 60)):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((i, " ".join(own)))
            i += 1
    common = r.choices(vocabulary, k=60)  # a passage shared by many documents
    for _ in range(60):
        rows.append((i, " ".join(r.choices(vocabulary, k=60) + common)))
        i += 1
    for n in (3, 30, 300):  # repeated shingles: the counts decide
        rows += [(i, "a b c d e " * n), (i + 1, "a b c d e " * n + "f"), (i + 2, "a b c d e " * (2 * n))]
        i += 3
    return rows


def test_classes_equal_brute_force(spark):
    rows = EDGE + corpus()
    got = nc.classes(make_docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=str) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({(r.class_id, r.class_size) for r in got if r.class_id is not None}) + sum(1 for r in kept if r.class_id is None)
    assert all(r.doc_id == r.class_id for r in kept)


def test_chain_of_copies_is_one_class(spark):
    r = random.Random(3)
    words = [f"v{k}" for k in range(3000)]
    rows = [(k, " ".join(words[k * 12: k * 12 + 200])) for k in range(40)]  # neighbours overlap by 0.9, far ones not at all
    r.shuffle(rows)
    assert {x.class_id for x in nc.classes(make_docs(spark, rows)).collect()} == {0}


@pytest.mark.parametrize("counts", [([1] * 300, [1] * 300), ([3, 1, 7, 2] * 60, [2, 1, 9, 4] * 60)])
def test_signature_estimates_weighted_jaccard(counts):
    draw = np.random.default_rng(5)
    x = draw.integers(1, 1 << 62, 400).astype(np.uint64)
    a, b = x[:300][: len(counts[0])], x[60:360][: len(counts[1])]
    ca, cb = map(np.array, counts)
    left, right = dict(zip(a.tolist(), ca.tolist())), dict(zip(b.tolist(), cb.tolist()))
    keys = left.keys() | right.keys()
    want = sum(min(left.get(k, 0), right.get(k, 0)) for k in keys) / sum(max(left.get(k, 0), right.get(k, 0)) for k in keys)
    sig = nc.signatures(np.concatenate([a, b]), np.concatenate([ca, cb]), np.repeat([0, 1], [len(a), len(b)]), 2, slots=4000)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.035


def test_signature_does_not_depend_on_the_block():
    x = np.random.default_rng(1).integers(1, 1 << 62, 50).astype(np.uint64)
    c = np.arange(1, 51)
    both = nc.signatures(np.concatenate([x, x[:9]]), np.concatenate([c, c[:9]]), np.repeat([0, 2], [50, 9]), 3)
    assert (both[0] == nc.signatures(x, c, np.zeros(50, int), 1)[0]).all() and not both[1].any()
    assert (both[2] == nc.signatures(x[:9], c[:9], np.zeros(9, int), 1)[0]).all()


def test_kept_documents_and_empty_table(spark, edge_docs, no_docs):
    assert nc.classes(no_docs).count() == 0 and nc.keep_first(no_docs).count() == 0
    kept = nc.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == nc.classes(edge_docs).where("kept").count() == len({frozenset(bag(t).items()) for _, t in EDGE})


def test_texts_that_share_only_a_passage_are_not_all_compared(spark, monkeypatch):
    """Short texts around one passage meet in bands; their rare shingles keep them apart, near copies among them aside."""
    r = random.Random(4)
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join(passage + [f"q{k}x{j}" for j in range(r.randrange(9, 12))])) for k in range(150)]
    rows += [(200 + k, rows[k][1] + " end") for k in range(20)]
    seen = []
    verify = nc.verified
    monkeypatch.setattr(nc, "verified", lambda pairs, bags: seen.append(pairs.count()) or verify(pairs, bags))
    got = nc.classes(make_docs(spark, rows)).collect()
    assert sorted(((x.doc_id, x.class_id, x.class_size) for x in got), key=str) == brute(rows)
    assert sum(seen) < 10 * len(rows)
