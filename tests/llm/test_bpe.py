import hashlib
import random

import numpy as np
import pytest

from vitrina.llm import bpe
from vitrina.llm.queries import vocab_path

from .conftest import EDGE

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(vocab_path())


def random_texts(n=3000, seed=3):
    r = random.Random(seed)
    some = [chr(c) for c in [*range(0, 0x180), 0x2000, 0x2028, 0x3000, 0xFEFF, 0x200B, 0x180E, 0x1680, 0x1F600, 0x4E2D, 0x661, 0xB2, 0x301]] + ["<|endoftext|>", "'s", "  ", "\n"]
    out = ["".join(r.choice(some) for _ in range(r.randrange(30))) for _ in range(n)]
    return out + ["".join(r.choice("aab ") for _ in range(r.randrange(40))) for _ in range(n)] + ["a" * 5000, "ab" * 3000, " " * 999, "\n" * 77]


def test_ids_and_text_equal_the_library(reference):
    vocab, texts = bpe.vocabulary(vocab_path()), random_texts()
    ids, ends = bpe.encode_block(vocab, texts)
    lo = 0
    for t, e, hi in zip(texts, reference.encode_batch(texts, add_special_tokens=False), ends.tolist()):
        own = ids[lo:hi].tolist()
        assert own == e.ids, t
        assert bpe.decode(vocab, own) == reference.decode(e.ids, skip_special_tokens=False)
        lo = hi


@pytest.mark.parametrize("template", ["{c}'s ok", "a{c}'re", " {c}1", "{c}{c} {c}", "x {c} ", "1{c}a"])
def test_every_code_point_equals_the_library(reference, template):
    points = [*range(1, 0xD800), *range(0xE000, 0x110000, 7), *range(0x10000, 0x20000)]
    vocab = bpe.vocabulary(vocab_path())
    for lo in range(0, len(points), 40_000):
        texts = [template.format(c=chr(p)) for p in points[lo: lo + 40_000]]
        ids, ends = bpe.encode_block(vocab, texts)
        want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
        assert ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
        assert ids.tolist() == [i for w in want for i in w]


LONG = [" " * 2_000_000 + "x", "x" + "\n" * 2_000_000, " \n" * 600_000 + " end", "ab" * 1_000_000, "\u3000" * 800_000 + "'s", "a" + " " * 30_000 + "<|endoftext|>" + " " * 30_000]


@pytest.mark.parametrize("k", range(len(LONG)))
def test_very_long_runs_equal_the_library(reference, k):
    ids, _ = bpe.encode_block(bpe.vocabulary(vocab_path()), [LONG[k]])
    assert ids.tolist() == reference.encode(LONG[k], add_special_tokens=False).ids


def test_query_rows(spark, edge_docs, no_docs, reference):
    got = bpe.round_trip(edge_docs, vocab_path()).collect()
    want = []
    for i, t in EDGE:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        text = reference.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip(no_docs, vocab_path()).count() == 0


def test_encode_then_decode(spark, edge_docs):
    back = bpe.decode_documents(bpe.encode_documents(edge_docs, vocab_path()), vocab_path()).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in EDGE), key=str)
