"""Perplexity by an interpolated modified Kneser-Ney model of word pairs.

Spark counts words and pairs: a task counts a block of tokens in sorted arrays
and sends one blob per shard; a shard merges its blobs, writes one file of
sorted 64-bit keys with counts into the shared folder, and passes on what the
lower order needs. Scoring tasks memory-map these files and look up the sorted
distinct words and pairs of a block, so no model is collected, broadcast or
held in a task's own memory.

Word ids are ranks in the sorted array of word hashes, so the key of a pair is
a mix of two ids. Pairs are dealt to shards by their first word; a first word
with more tokens than a shard should hold is dealt by both words, which its
count in the vocabulary tells every reader.

Model: p(w|v) = (c(vw) - D(c(vw))) / c(v) + (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v) * p(w),
p(w) = (a(w) - D'(a(w))) / A + (D'1 n'1 + D'2 n'2 + D'3 n'3) / A / (V + 1), where a(w) is
the number of different words before w and A their sum; a document starts
behind a boundary word and ends with an end token.

Defined results: a null text is empty and has one token, its end; a null doc_id
counts as an empty id text; repeated rows count and are scored each; without
training rows every probability is 1/(V+1) = 1; a word that was not seen has
a(w) = 0 and, as first word of a pair, falls back to p(w).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.shared import id_text, mapped, new_folder, pack_arrays, put_bytes, unpack_arrays, written

END = 0x9E3779B97F4A7C15
#: Tokens that a task counts and scores at a time (scoring holds more arrays for each token).
BLOCK_TOKENS, SCORE_TOKENS = 3_000_000, 700_000
#: Bytes of text for each shard of pairs and of words; least numbers of shards.
PAIR_SHARD_BYTES, WORD_SHARD_BYTES = 16 << 20, 256 << 20
LEAST_PAIR_SHARDS, LEAST_WORD_SHARDS = 64, 48
#: A first word with fewer tokens is never dealt by both words of a pair.
HOT_TOKENS = 1000
FOLDS, HELD_OUT = 7, 2
MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BACK1, BACK2 = pow(MIX1, -1, 1 << 64), pow(MIX2, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX1)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(BACK2)
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(BACK1)
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


class WordHashes(dict):
    """Hash of a word, remembered; emptied when it grows too large."""

    def __missing__(self, word):
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def token_hashes(text: str, memo: WordHashes) -> np.ndarray:
    """Hashes of a text's words, then the end token's."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def token_blocks(batches, size: int = BLOCK_TOKENS):
    """(ids, tokens, end of each document) for blocks of whole documents."""
    memo, ids, parts, total = WordHashes(), [], [], 0
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        for k, key in enumerate(keys):
            parts.append(token_hashes(texts[k].as_py(), memo))
            ids.append(key)
            total += len(parts[-1])
            if total >= size:
                yield ids, np.concatenate(parts), np.cumsum([len(p) for p in parts])
                ids, parts, total = [], [], 0
    if ids:
        yield ids, np.concatenate(parts), np.cumsum([len(p) for p in parts])


def small(a: np.ndarray) -> np.ndarray:
    """Counts in the narrowest unsigned type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    by = np.argsort(keys, kind="stable")
    keys = keys[by]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return (keys[first], *(np.add.reduceat(v[by].astype(np.int64), first) if len(first) else v[:0].astype(np.int64) for v in values))


def dealt(shard: np.ndarray, *arrays: np.ndarray) -> pa.RecordBatch:
    """Rows (shard, data) of arrays that are sorted by shard."""
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, int)
    ends = np.append(cuts[1:], len(shard))
    data = [pack_arrays(*(small(a[lo:hi]) if k else a[lo:hi] for k, a in enumerate(arrays))) for lo, hi in zip(cuts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(shard[cuts].astype(np.int32), pa.int32()), pa.array(data, pa.binary())], ["shard", "data"])


def gathered(table: pa.Table, column: str = "data") -> list[np.ndarray]:
    """The arrays of all blobs of a shard, each joined over the blobs."""
    parts = [unpack_arrays(b.as_buffer()) for b in table[column].combine_chunks()] if table.num_rows else []
    return [np.concatenate(p) for p in zip(*parts)]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Even ranges of the 64-bit keys, in key order."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


@lru_cache(maxsize=4096)
def array_file(uri: str) -> list[np.ndarray]:
    return unpack_arrays(mapped(uri))


class Words:
    """Sorted hash arrays of the vocabulary in a shared folder; ids are ranks."""

    def __init__(self, folder: str, starts: np.ndarray):
        self.folder, self.starts = folder, starts  # starts: first id of each shard, then the number of words

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of sorted hashes; -1 and 0 for unknown words."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(shard_of(hashes, len(self.starts) - 1), np.arange(len(self.starts)))
        for s in range(len(self.starts) - 1):
            own = hashes[cuts[s]: cuts[s + 1]]
            if len(own) and self.starts[s + 1] > self.starts[s]:
                keys, c = array_file(f"{self.folder}/words-{s}")
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[at] == own
                ids[cuts[s]: cuts[s + 1]] = np.where(hit, at + self.starts[s], -1)
                counts[cuts[s]: cuts[s + 1]] = np.where(hit, c[at], 0)
        return ids, counts

    def stats(self, ids: np.ndarray) -> list[np.ndarray]:
        """a, n1, n2, n3 of ids (sorted by id, -1 first; zeros for -1)."""
        out = [np.zeros(len(ids), np.int64) for _ in range(4)]
        bounds = np.append(self.starts[:-1], self.starts[-1] + 1)  # the boundary word's id is the last
        cuts = np.searchsorted(ids, bounds)
        for s in range(len(self.starts) - 1):
            own = ids[cuts[s]: cuts[s + 1]]
            if len(own):
                for a, v in zip(out, array_file(f"{self.folder}/stats-{s}")):
                    a[cuts[s]: cuts[s + 1]] = v[own - self.starts[s]]
        return out


def pair_shards(keys: np.ndarray, v: np.ndarray, v_count: np.ndarray, shards: int, hot: int) -> np.ndarray:
    """Shard of each pair: by its first word, or by both for a frequent first word."""
    return shard_of(np.where(v_count > hot, keys, mix(v.astype(np.uint64))), shards)


def pairs_of(tokens: np.ndarray, ends: np.ndarray, words: Words, n_docs: int):
    """Ids and counts of each token and of the word before it (the boundary word at a document's start)."""
    unique, back = np.unique(tokens, return_inverse=True)
    ids, counts = words.find(unique)
    w, c = ids[back], counts[back]
    v, vc = np.empty_like(w), np.empty_like(c)
    v[1:], vc[1:] = w[:-1], c[:-1]
    firsts = np.append(0, ends[:-1])
    v[firsts], vc[firsts] = words.starts[-1], n_docs
    return w, c, v, vc


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """D for counts 0, 1, 2, 3 and more, from the numbers of keys with count 1 to 4."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [k - (k + 1) * y * b / a if a else 0.5 * k for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1))])


class Model:
    """Where a fitted model's files are, and its few global numbers."""

    def __init__(self, folder: str, shards: int, starts: np.ndarray, tokens: int, docs: int, hot: int):
        self.folder, self.shards, self.words = folder, shards, Words(folder, starts)
        self.tokens, self.docs, self.hot = tokens, docs, hot
        self.pair_d = self.word_d = np.zeros(4)
        self.word_n, self.types = np.zeros(4, np.int64), 0

    @property
    def vocabulary(self) -> int:
        return int(self.words.starts[-1])

    def pair_counts(self, v: np.ndarray, w: np.ndarray, v_count: np.ndarray) -> np.ndarray:
        """c(vw) of pairs of known words."""
        x, back = np.unique((v.astype(np.uint64) << np.uint64(32)) | w.astype(np.uint64), return_inverse=True)
        first = np.zeros(len(x), np.int64)
        first[back] = v_count
        keys = mix(x)
        shard = pair_shards(keys, x >> np.uint64(32), first, self.shards, self.hot)
        by = np.lexsort((keys, shard))
        keys, shard = keys[by], shard[by]
        out = np.zeros(len(x), np.int64)
        cuts = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in range(self.shards):
            own = keys[cuts[s]: cuts[s + 1]]
            if len(own):
                have, c = array_file(f"{self.folder}/pairs-{s}")
                if len(have):
                    at = np.minimum(np.searchsorted(have, own), len(have) - 1)
                    out[by[cuts[s]: cuts[s + 1]]] = np.where(have[at] == own, c[at], 0)
        return out[back]

    def score(self, tokens: np.ndarray, ends: np.ndarray):
        """Per document: known tokens, base score, model score (log10)."""
        w, c, v, vc = pairs_of(tokens, ends, self.words, self.docs)
        known = c > 0
        total, size = self.tokens, self.vocabulary
        base = np.log10((c + 1) / (total + 1 * (size + 1)))
        ids, back = np.unique(np.concatenate([w, v]), return_inverse=True)
        stats = self.words.stats(ids) if size else [np.zeros(len(ids), np.int64)] * 4
        a = stats[0][back[: len(w)]]
        n = [x[back[len(w):]] for x in stats[1:]]
        rest = (self.word_d[1:] * self.word_n[1:]).sum() / self.types if self.types else 1.0
        p = (a - self.word_d[np.minimum(a, 3)]) / max(self.types, 1) + rest / (size + 1)
        pair = np.zeros(len(w), np.int64)
        both = known & (v >= 0) & (vc > 0)
        if both.any():
            pair[both] = self.pair_counts(v[both], w[both], vc[both])
        d = self.pair_d
        seen = (v >= 0) & (vc > 0)
        from_pair = (pair - d[np.minimum(pair, 3)]) / np.maximum(vc, 1)
        back_off = (d[1] * n[0] + d[2] * n[1] + d[3] * n[2]) / np.maximum(vc, 1)
        p = np.where(seen, from_pair + back_off * p, p)
        firsts = np.append(0, ends[:-1])
        return np.add.reduceat(known.astype(np.int64), firsts), np.add.reduceat(base, firsts), np.add.reduceat(np.log10(p), firsts)


def fit(docs: DataFrame) -> Model:
    """Count all documents (doc_id, text) and write the model's array files."""
    spark = docs.sparkSession
    folder = new_folder(spark, "language")
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    text_bytes, n_docs = size["b"] or 0, size["n"]
    shards = max(LEAST_PAIR_SHARDS, -(-text_bytes // PAIR_SHARD_BYTES))
    word_shards = max(LEAST_WORD_SHARDS, -(-text_bytes // WORD_SHARD_BYTES))
    blob = "shard int, data binary"

    def count_words(batches):
        for _, tokens, _ in token_blocks(batches):
            keys, counts = np.unique(tokens, return_counts=True)
            yield dealt(shard_of(keys, word_shards), keys, counts)

    def merge_words(key, table):
        keys, counts = summed(*gathered(table))
        put_bytes(f"{folder}/words-{key[0].as_py()}", pack_arrays(keys, small(counts)))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "n": [len(keys)], "total": [int(counts.sum())]})

    found = docs.mapInArrow(count_words, blob).groupBy("shard").applyInArrow(merge_words, "shard int, n long, total long").collect()
    sizes = np.zeros(word_shards, np.int64)
    for r in found:  # one row per shard of the vocabulary
        sizes[r["shard"]] = r["n"]
    starts = np.append(0, np.cumsum(sizes))
    tokens = sum(r["total"] for r in found)
    if starts[-1] >= 1 << 32:
        raise ValueError("the vocabulary has 2^32 words or more; pair keys hold 32-bit word ids")
    model = Model(folder, shards, starts, tokens, n_docs, hot=max(HOT_TOKENS, tokens // (4 * shards)))

    def count_pairs(batches):
        for _, tokens, ends in token_blocks(batches):
            w, _, v, vc = pairs_of(tokens, ends, model.words, n_docs)
            x, at, counts = np.unique((v.astype(np.uint64) << np.uint64(32)) | w.astype(np.uint64), return_index=True, return_counts=True)
            keys = mix(x)
            shard = pair_shards(keys, v[at], vc[at], shards, model.hot)
            by = np.lexsort((keys, shard))
            yield dealt(shard[by], keys[by], counts[by])

    def merge_pairs(key, table):
        keys, counts = summed(*gathered(table))
        put_bytes(f"{folder}/pairs-{key[0].as_py()}", pack_arrays(keys, small(counts)))
        x = unmix(keys)
        v, w = (x >> np.uint64(32)).astype(np.int64), (x & np.uint64(0xFFFFFFFF)).astype(np.int64)
        group, n1, n2, n3 = summed(v, counts == 1, counts == 2, counts > 2)
        after, types = summed(w, np.ones(len(w), np.int64))
        out = []
        for kind, ids, values in ((0, group, (n1, n2, n3)), (1, after, (types,))):
            shard = np.minimum(np.searchsorted(starts, ids, "right") - 1, word_shards - 1)
            cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(shard)]):
                gaps = small(np.diff(ids[lo:hi], prepend=starts[shard[lo]]))
                out.append((int(shard[lo]), kind, pack_arrays(gaps, *(small(a[lo:hi]) for a in values)), None))
        out.append((-1, 2, None, [int((counts == k).sum()) for k in (1, 2, 3, 4)]))
        s, k, d, n = zip(*out)
        return pa.table([pa.array(s, pa.int32()), pa.array(k, pa.int32()), pa.array(d, pa.binary()), pa.array(n, pa.list_(pa.int64()))], names=["shard", "kind", "data", "n"])

    def merge_stats(key, table):
        s = key[0].as_py()
        base = int(starts[s])
        sums = np.zeros((4, int(sizes[s]) + 1), np.int64)  # one more for the boundary word
        for kind, data in zip(table["kind"].to_pylist(), table["data"].combine_chunks()):
            gaps, *values = unpack_arrays(data.as_buffer())
            ids = np.cumsum(gaps, dtype=np.int64)
            for row, a in zip((1, 2, 3) if kind == 0 else (0,), values):
                sums[row, ids] += a
        put_bytes(f"{folder}/stats-{s}", pack_arrays(*map(small, sums)))
        a = sums[0]
        return pa.table({"types": [int(a.sum())], "n1": [int((a == 1).sum())], "n2": [int((a == 2).sum())], "n3": [int((a == 3).sum())], "n4": [int((a == 4).sum())], "more": [int((a > 2).sum())]})

    if not n_docs:
        return model
    pairs = docs.mapInArrow(count_pairs, blob).groupBy("shard").applyInArrow(merge_pairs, "shard int, kind int, data binary, n array<long>")
    pairs = written(pairs, "pairs")
    counts = pairs.where("kind = 2").agg(*(F.sum(F.col("n")[k]) for k in range(4))).first()
    model.pair_d = discounts(*(x or 0 for x in counts))
    stats = pairs.where("kind < 2").select("shard", "kind", "data").groupBy("shard").applyInArrow(merge_stats, "types long, n1 long, n2 long, n3 long, n4 long, more long")
    r = stats.agg(*(F.sum(c).alias(c) for c in stats.columns)).first()
    model.types = r["types"] or 0
    model.word_d = discounts(*(r[c] or 0 for c in ("n1", "n2", "n3", "n4")))
    model.word_n = np.array([0, r["n1"] or 0, r["n2"] or 0, r["more"] or 0])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document."""

    def run(batches):
        for ids, tokens, ends in token_blocks(batches, SCORE_TOKENS):
            known, base, own = model.score(tokens, ends)
            n = np.diff(ends, prepend=0)
            arrays = [pa.array(ids, pa.int64()), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(own)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(col):
    """Whether a row's id leaves it out of training (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(FOLDS) == HELD_OUT


def score_documents(docs: DataFrame) -> DataFrame:
    """Fit on the training rows and score all rows: columns of ``score`` and held_out."""
    docs = id_text(docs)
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
