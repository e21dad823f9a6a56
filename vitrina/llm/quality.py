"""Quality classifier: supervised subword embeddings, trained by numpy SGD.

A document's features are its words, pairs of neighbouring words, the
character n-grams of its words and, for each word, how far back the same word
stood (a shared feature for each power of two, so that repetition of unseen
words has a vector too). All are hashed to buckets; the document is the mean
of their vectors, and a softmax layer gives the class probabilities. Vectors
and layer are learned together by stochastic gradient descent on labelled
rows.

Training uses at most ``TRAIN_ROWS`` labelled rows, those with the smallest
hash of their id: their features are made by the tasks that read them and one
bounded task runs the descent. Scoring covers all rows in one pass without a
shuffle; since layer and mean are linear, each bucket needs only the
difference of its two class scores.

Defined results: a null text is empty; an empty text has the zero vector, so
its score is the layer's bias alone; labels other than 0 and 1 and null labels
are not used, of contradicting labels of an id the lower counts; with labels of one class or none, every score is the share of
label 1 (0.5 without labels); repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.bpe import Numbering, blocks
from vitrina.llm.shared import id_text

BUCKETS, DIM = 1 << 16, 8
#: Features for the distance to the same word before: one for each power of two, the last for none.
DISTANCES = 8
NGRAMS = (2, 3, 4)
TRAIN_ROWS = 4_000
#: Characters of text that a task handles at a time.
BLOCK_CHARS = 1_500_000
EPOCHS, RATE, SEED = 5, 1.0, 11
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def scatter(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (overflow wraps)."""
    x = (x ^ (x >> np.uint64(32))) * K2
    x = (x ^ (x >> np.uint64(29))) * K1
    return x ^ (x >> np.uint64(32))


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) % BUCKETS


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word; buckets of all words and n-grams, word after word; their number per word."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(points)) - first[owner]
    hashes = scatter(np.add.reduceat(scatter(points + (place.astype(np.uint64) << np.uint64(32))), first))
    found, owners = [bucket(hashes)], [np.arange(len(words))]
    h = points + K1
    for n in range(2, max(NGRAMS) + 1):
        h = scatter(h[:-1] * K1 + points[n - 1:])
        if n in NGRAMS:
            whole = place[: len(h)] + n <= size[owner[: len(h)]]
            found.append(bucket(h[whole] + np.uint64(n)))
            owners.append(owner[: len(h)][whole])
    owners = np.concatenate(owners)
    by = np.argsort(owners, kind="stable")
    return hashes, np.concatenate(found)[by], np.bincount(owners, minlength=len(words))


def distances(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Feature of each token's distance to the same word before it in its document."""
    by = np.lexsort((doc, words)) if len(words) else np.zeros(0, int)
    gap = np.full(len(words), 1 << 40)
    same = (words[by][1:] == words[by][:-1]) & (doc[by][1:] == doc[by][:-1])
    gap[by[1:][same]] = (by[1:] - by[:-1])[same]
    return np.minimum(np.log2(gap).astype(np.int64), DISTANCES - 1)


class Block:
    """Tokens of a block of texts: word numbers, owners and the words' own features."""

    def __init__(self, texts: list[str]):
        number = Numbering()
        parts = []
        for text in texts:
            words = text.split()
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        self.n = len(texts)
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(self.n), [len(p) for p in parts])
        self.hashes, self.buckets, self.size = word_features(list(number))
        h = self.hashes[self.words]
        self.joined = self.doc[1:] == self.doc[:-1]
        self.pairs = bucket(scatter(h[:-1] * K2 + h[1:]))[self.joined]
        self.pair_doc = self.doc[1:][self.joined]
        self.gaps = BUCKETS + distances(self.words, self.doc)

    def means(self, value: np.ndarray) -> np.ndarray:
        """Mean over each document's features of one value per bucket (0 for an empty text)."""
        first = np.cumsum(self.size) - self.size
        own = np.add.reduceat(value[self.buckets], first) if len(first) else np.zeros(0)
        total = np.bincount(self.doc, own[self.words] + value[self.gaps], self.n)
        total += np.bincount(self.pair_doc, value[self.pairs], self.n)
        count = np.bincount(self.doc, self.size[self.words] + 1, self.n) + np.bincount(self.pair_doc, minlength=self.n)
        return total / np.maximum(count, 1)

    def counts(self):
        """Distinct buckets of each document and their counts, in as few bytes as hold them."""
        first = np.cumsum(self.size) - self.size
        ends, pair_ends = np.cumsum(np.bincount(self.doc, minlength=self.n)), np.cumsum(np.bincount(self.pair_doc, minlength=self.n))
        lo = pair_lo = 0
        for hi, pair_hi in zip(ends, pair_ends):
            words = self.words[lo:hi]
            own = [self.buckets[first[w]: first[w] + self.size[w]] for w in words]
            found, count = np.unique(np.concatenate([*own, self.pairs[pair_lo:pair_hi], self.gaps[lo:hi]]).astype(np.int32), return_counts=True)
            yield found, count.astype(np.min_scalar_type(int(count.max(initial=0))))
            lo, pair_lo = hi, pair_hi

    def documents(self):
        """Distinct buckets of each document and their shares."""
        for found, count in self.counts():
            yield found, shares(count)


def shares(count: np.ndarray) -> np.ndarray:
    return (count.astype(np.float64) / max(int(count.sum()), 1)).astype(np.float32)


def descend(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED):
    """Bucket vectors, layer and bias after stochastic gradient descent; rows are buckets and counts."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIM, 1 / DIM, (BUCKETS + DISTANCES, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, n = epochs * len(rows), 0
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            found, share = rows[k][0], shares(rows[k][1])
            now = np.float32(rate * (1 - n / steps))
            n += 1
            mean = share @ vectors[found]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            grad = p / p.sum()
            grad[labels[k]] -= 1
            back = grad @ layer
            layer -= now * np.outer(grad, mean)
            bias -= now * np.float32(0.1) * grad
            vectors[found] -= now * share[:, None] * back
    return vectors, layer, bias


def held_out(col):
    """Whether a row's id leaves it out of training (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(FOLDS) == HELD_OUT


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> DataFrame:
    """(text, label) of at most ``bound`` labelled rows, those with the smallest id hashes."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("label").alias("label"))  # of contradicting labels the lower
    n = usable.count()
    if n > 2 * bound:  # about twice the bound, so that no task has many rows to sort
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(2 * bound / n * (1 << 30)))
    chosen = usable.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id").limit(bound)
    # the broadcast side has at most ``bound`` rows of 12 bytes
    rows = id_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    return rows.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("r")).select("doc_id", "r.*")


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS):
    """(class score difference of each bucket, bias difference)."""

    def features(batches):
        for batch in batches:
            for own, y, texts in blocks([batch.column(c).to_pylist() for c in ("doc_id", "label", "text")], BLOCK_CHARS):
                found, count = zip(*Block(texts).counts()) if texts else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(y, pa.int32()), pa.array([f.tobytes() for f in found], pa.binary()), pa.array([c.tobytes() for c in count], pa.binary())], ["doc_id", "label", "found", "count"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, y, rows = [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            y += batch.column("label").to_pylist()
            for a, b in zip(batch.column("found").to_pylist(), batch.column("count").to_pylist()):
                found = np.frombuffer(a, np.int32)
                rows.append((found, np.frombuffer(b, f"u{len(b) // max(len(found), 1) or 1}")))
        by = np.argsort(ids)  # the same order whatever block arrives first
        y, rows = np.array(y, np.int64)[by], [rows[k] for k in by]
        both = 0 < y.sum() < len(y)
        if both:
            vectors, layer, bias = descend(rows, y)
            value, constant = vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])
        else:
            value, constant = np.zeros(0, np.float32), float("inf") if y.all() else -float("inf")
        yield pa.RecordBatch.from_pydict({"value": pa.array([value.astype(np.float32).tobytes()], pa.binary()), "constant": pa.array([constant], pa.float64())})

    rows = training_rows(docs, labels, bound).mapInArrow(features, "doc_id long, label int, found binary, count binary")
    model = rows.groupBy().applyInArrow(learn, "value binary, constant double").collect()
    if not model:
        return np.zeros(BUCKETS + DISTANCES, np.float32), 0.0
    value = np.frombuffer(model[0]["value"], np.float32)
    return value if len(value) else np.zeros(BUCKETS + DISTANCES, np.float32), model[0]["constant"]


def scores(texts: list[str], model) -> np.ndarray:
    value, constant = model
    z = Block(texts).means(value.astype(np.float64)) + constant
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-z))


def score_documents(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, bound)

    def run(batches):
        for batch in batches:
            for keys, texts in blocks([batch.column(0).to_pylist(), batch.column(1).to_pylist()], BLOCK_CHARS):
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(scores(texts, model), pa.float64())], ["doc_id", "score"])

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> DataFrame:
    """The documents predicted 1, with all their columns; each row is judged where it is read."""
    model = fit(docs, labels, bound)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            good = [scores(texts, model) >= THRESHOLD for (texts,) in blocks([[t or "" for t in batch.column(at).to_pylist()]], BLOCK_CHARS)]
            yield batch.filter(pa.array(np.concatenate(good) if good else [], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
