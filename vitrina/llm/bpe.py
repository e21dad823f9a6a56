"""Byte-level BPE encoding and decoding by a pair occurrence index.

The texts of a block of rows are split into words; each distinct word of the
block becomes a run of byte symbols in one array. An index maps every pair
that has a rank to all its positions in the block. Active ranks are taken in
ascending order from a heap: the positions of a rank are checked, merged
together, and the pairs that arise left and right enter the lists of their own
(always higher) ranks. Decoding joins the byte strings of the ids.

Defined results: a null text is empty; an empty text has no ids and decodes to
an empty string; a special token's string in a text is that token; repeated
rows are encoded each; a null doc_id is passed on.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitrina.llm.shared import id_text

# Fixed value: the split pattern of byte-level BPE vocabularies.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text that share one pair index; it bounds a task's memory.
BLOCK_CHARS = 6_000_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=None)
def library_class(pattern: str) -> str:
    """The characters that a one-character pattern of the tokenizers library matches, as ranges of a character class.

    Letters, numbers and blanks are those of the library's own Unicode
    tables: its splitter removes them from a text of all code points.
    """
    from tokenizers import Regex, pre_tokenizers

    def point(place: int) -> int:  # the code point at a place of the text, which has no surrogates
        return place if place < 0xD800 else place + 0x800

    n = 0x110000 - 0x800
    rest = pre_tokenizers.Split(Regex(f"{pattern}+"), "removed").pre_tokenize_str("".join(chr(point(k)) for k in range(n)))
    out, at = [], 0
    for lo, hi in [*(span for _, span in rest), (n, n)]:
        if lo > at:
            out.append(f"\\U{point(at):08x}-\\U{point(lo - 1):08x}")
        at = hi
    return "".join(out)


@lru_cache(maxsize=1)
def word_pattern() -> re.Pattern:
    """``WORDS`` with the library's classes spelled out."""
    letter, number, blank = (library_class(p) for p in (r"\p{L}", r"\p{N}", r"\s"))
    out = WORDS.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}{letter}{number}]").replace(r"(?!\S)", f"(?![^{blank}])")
    return re.compile(out.replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]").replace(r"\s", f"[{blank}]"))


class Vocabulary:
    """A byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back, ids = byte_alphabet(), spec["model"]["vocab"]
        raw = {w: bytes(back[c] for c in w) for w in ids}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for w, i in ids.items():
            self.token_bytes[i] = raw[w]
        for w, i in self.special.items():
            self.token_bytes[i] = w.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in back.items():
            self.byte_id[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        self.left = keys >> 32
        self.right = keys & 0xFFFFFFFF
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; a special token's string stays whole."""
        words = word_pattern()
        if self.specials is None or not any(s in text for s in self.special):
            return words.findall(text)
        out = []
        for k, part in enumerate(self.specials.split(text)):
            out += [part] if k % 2 else words.findall(part)
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Numbering(dict):
    """Numbers new keys in the order in which they first appear."""

    def __missing__(self, key):
        value = self[key] = len(self)
        return value


def merge_all(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of a block, concatenated, and the number of each word's ids."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    sym = vocab.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    n = len(sym)
    ends = np.cumsum(lens)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends[lens > 0] - 1] = -1
    before[(ends - lens)[lens > 0]] = -1
    alive = np.ones(n, bool)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray) -> None:
        """Add positions to the lists of their pairs' ranks."""
        rank = vocab.ranks(sym[at], sym[after[at]])
        known = rank >= 0
        at, rank = at[known], rank[known]
        if not len(at):
            return
        by = np.argsort(rank, kind="stable")
        at, rank = at[by], rank[by]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(at)]
        firsts = rank[bounds[:-1]].tolist()
        for k, r in enumerate(firsts):
            part = at[bounds[k]: bounds[k + 1]]
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(heap, r)

    enter(np.flatnonzero(after >= 0))
    while heap:
        r = heapq.heappop(heap)
        lists = index.pop(r)
        at = np.unique(np.concatenate(lists))
        a, b = vocab.left[r], vocab.right[r]
        follow = after[at]
        ok = alive[at] & (sym[at] == a) & (follow >= 0)
        ok &= sym[follow] == b
        at = at[ok]
        if not len(at):
            continue
        if a == b and len(at) > 1:  # in a run of equal symbols every second pair, from the left
            fresh = np.append(True, after[at[:-1]] != at[1:])
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
        gone = after[at]
        beyond = after[gone]
        sym[at] = vocab.merged[r]
        alive[gone] = False
        after[at] = beyond
        has = beyond >= 0
        before[beyond[has]] = at[has]
        prior = before[at]
        enter(np.concatenate([prior[prior >= 0], at[has]]))
    owner = np.repeat(np.arange(len(words)), lens)
    return sym[alive], np.bincount(owner[alive], minlength=len(words))


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of all runs, one run after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


def encode_block(vocab: Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (uint32, concatenated) and the end of each text in them."""
    number = Numbering()
    parts, ends = [], []
    for text in texts:
        pieces = vocab.pieces(text)
        parts.append(np.fromiter(map(number.__getitem__, pieces), np.int32, len(pieces)))
    words = list(number)
    special = [(k, vocab.special[w]) for w, k in number.items() if w in vocab.special]
    ids, count = merge_all(vocab, words)
    if special:  # whole tokens instead of the merges of their strings
        first = np.cumsum(count) - count
        keep = np.ones(len(ids), bool)
        for k, i in special:
            ids[first[k]] = i
            keep[first[k] + 1: first[k] + count[k]] = False
            count[k] = 1
        ids = ids[keep]
    first = np.cumsum(count) - count
    ids = ids.astype("<u4")
    out = []
    for part in parts:
        out.append(ids[ragged(first[part], count[part])])
        ends.append(len(out[-1]))
    return np.concatenate(out) if out else ids[:0], np.cumsum(ends, dtype=np.int64)


def blocks(columns: list[list], size: int = BLOCK_CHARS):
    """Cut parallel columns (the last holds texts) into blocks of about ``size`` characters."""
    lo = total = 0
    texts = columns[-1]
    for hi, text in enumerate(texts, 1):
        total += len(text)
        if total >= size or hi == len(texts):
            yield [c[lo:hi] for c in columns]
            lo, total = hi, 0


def decode(vocab: Vocabulary, ids) -> str:
    """The text of a list of ids, special tokens included."""
    return b"".join(map(vocab.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<long>): the ids of every document."""

    def run(batches):
        vocab = vocabulary(vocab_path)
        for batch in batches:
            for keys, texts in blocks([batch.column(0).to_pylist(), batch.column(1).to_pylist()]):
                ids, ends = encode_block(vocab, texts)
                offsets = pa.array(np.append(0, ends), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))], ["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<long>")


def decode_documents(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""

    def run(batches):
        vocab = vocabulary(vocab_path)
        for batch in batches:
            texts = [decode(vocab, ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text decoded from them.

    One pass: a block's ids are digested and decoded where they arise, so
    neither ids nor texts are shuffled.
    """

    def run(batches):
        vocab = vocabulary(vocab_path)
        for batch in batches:
            for keys, texts in blocks([batch.column(0).to_pylist(), batch.column(1).to_pylist()]):
                ids, ends = encode_block(vocab, texts)
                rows, lo = [], 0
                for hi in ends.tolist():
                    own = ids[lo:hi]
                    text = decode(vocab, own.tolist())
                    rows.append((hi - lo, hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
                    lo = hi
                n, a, b = map(list, zip(*rows)) if rows else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
