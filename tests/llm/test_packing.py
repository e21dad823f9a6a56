import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vitrina.llm import packing
from vitrina.llm.bpe import library_class
from vitrina.llm.queries import vocab_path

from .conftest import EDGE, make_docs
from .test_bpe import LONG, random_texts, reference  # noqa: F401


def check_layout(rows, capacity):
    """No overlap, no gap, no sequence above the capacity; returns the number of sequences."""
    bins = defaultdict(list)
    for sequence, offset, length in rows:
        bins[sequence].append((offset, length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def spread(counts, capacity):
    rows, seen = [], Counter()
    for length, first, n, per_bin, sequence, offset in packing.plan_counts(counts, capacity):
        assert first == seen[length]
        seen[length] += n
        rows += [(sequence + i // per_bin, offset + i % per_bin * length, length) for i in range(n)]
    assert seen == Counter({k: v for k, v in counts.items() if v and k < capacity})
    return rows


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    r = random.Random(seed)
    capacity = r.choice([16, 100, 1024])
    counts = {k: r.choice([0, 1, 2, 7, r.randrange(400)]) for k in range(1, capacity + 1) if r.random() < r.choice([0.1, 0.6, 1])}
    n = check_layout(spread(counts, capacity), capacity)
    tokens = sum(k * v for k, v in counts.items() if k < capacity)
    first_fit = first_fit_decreasing(counts, capacity) if sum(counts.values()) < 4000 else None
    assert n >= -(-tokens // capacity)
    assert first_fit is None or n <= first_fit * 1.01 + 1


def first_fit_decreasing(counts, capacity):
    space = []
    for k in sorted((k for k in counts if k < capacity), reverse=True):
        for _ in range(counts[k]):
            at = next((i for i, s in enumerate(space) if s >= k), None)
            if at is None:
                space.append(capacity - k)
            else:
                space[at] -= k
    return len(space)


def test_fast_encoder_equals_the_library(reference):  # noqa: F811
    encoder = packing.fast_encoder(vocab_path())
    for t in random_texts(1000, 8):
        assert encoder.encode_to_numpy(t, allowed_special=set(encoder._special_tokens)).tolist() == reference.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("k", range(len(LONG)))
def test_very_long_runs_equal_the_library(reference, k):  # noqa: F811
    assert packing.encode_text(packing.fast_encoder(vocab_path()), LONG[k]).tolist() == reference.encode(LONG[k], add_special_tokens=False).ids


def test_blanks_are_the_patterns(monkeypatch):
    every = "".join(chr(p) for p in [*range(0xD800), *range(0xE000, 0x110000)])
    assert "".join(re.findall(f"[{packing.BLANK_CHARS}]", every)) == "".join(re.findall(f"[{library_class(chr(92) + 's')}]", every))
    monkeypatch.setattr(packing, "BLANK_RUNS", re.compile(f"[{packing.BLANK_CHARS}]{{2,}}"))
    monkeypatch.setattr(packing, "LONG_BLANKS", 1)
    encoder = packing.fast_encoder(vocab_path())
    for t in random_texts(600, 5):
        for plain, special in ((True, set()), (False, encoder.special_tokens_set)):
            want = encoder.encode(t, allowed_special=special, disallowed_special=())
            assert packing.encode_text(encoder, t, plain).tolist() == want, t


def test_pack_a_text_of_two_million_blanks(spark):
    rows = [(1, " " * 2_000_000 + "x"), (2, "a"), (3, "\n" * 2_000_000)]
    got = packing.pack_documents(make_docs(spark, rows), vocab_path()).collect()
    sizes = Counter()
    for r in got:
        sizes[r.doc_id] += r.length
    assert sizes == {1: len(LONG[0]), 2: 2, 3: sizes[3]} and sizes[3] > 1000
    check_layout([(r.sequence_id, r.offset, r.length) for r in got], 1024)


def test_packed_documents(spark, edge_docs, no_docs, reference, monkeypatch):  # noqa: F811
    monkeypatch.setattr(packing, "PIECES_PER_SALT", 2)
    got = packing.pack_documents(edge_docs, vocab_path()).collect()
    want = []
    for i, t in EDGE:
        ids = [*reference.encode(t or "", add_special_tokens=False).ids, 2]
        for k, (s, n) in enumerate(packing.piece_bounds(len(ids), 1024)):
            want.append((i, k, s, n, zlib.crc32(np.array(ids[s: s + n], "<u4").tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=str) == sorted(want, key=str)
    check_layout([(r.sequence_id, r.offset, r.length) for r in got], 1024)
    assert packing.pack_documents(no_docs, vocab_path()).count() == 0
