"""Quality rules learned by gradient-boosted trees over document statistics.

Every document is described by ``STATISTICS``, computed from its whole text:
counts of words, characters, symbols, repeated lines and repeated three-word
windows, and shares made of them. A document with fewer than ``LEAST_WORDS``
words, or with more than half of its words in repeated windows, fails at once.
The verdict on the others is the sum of small regression trees, boosted on the
logistic loss with second-order gains over binned statistics. Trees never let
the score rise with a statistic named in ``FALLING``: a split that would is
refused, and the middle of an allowed one bounds all values below it.

Learning uses at most ``TRAIN_ROWS`` labelled rows, those with the smallest
hash of their id (a documented sample): tasks turn them into statistics where
they read them, and one bounded task grows the trees, from rows in id order.
Scoring covers all rows in one pass without a shuffle: all trees lie in five
flat arrays, and every level is one indexing step for all rows and trees.

Defined results: a null text has no words and fails; lines are split at line
feeds only, and a line without a word is no repeated line; labels other than 0
and 1 and null labels or ids are not used, and of an id with several labels the
lowest counts; with labels of one class or none no tree is grown and every
score is the share of label 1 (0.5 without labels), so only the base rules and
``THRESHOLD`` decide; repeated rows are judged each; a null doc_id is passed on.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.bpe import Numbering
from vitrina.llm.shared import id_text

BLANKS = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: A document is kept unless the trees give label 1 a lower probability.
THRESHOLD = 0.35
TRAIN_ROWS = 20_000
TREES, LEVELS, RATE, BINS, LEAST_ROWS, LAMBDA = 120, 4, 0.1, 64, 10, 1.0
HASH_RANGE = 1 << 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "top_word", "digits", "capitals",
              "stops", "commas", "lines", "beyond_ascii", "longest", "short_words", "entropy")
FALLING = ("symbols", "dup_lines", "repeats")


def byte_mask(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


IS_SYMBOL, IS_BLANK, IS_DIGIT = byte_mask(SYMBOLS), byte_mask(BLANKS), byte_mask(b"0123456789")
IS_CAPITAL, IS_STOP, IS_BEYOND = byte_mask(bytes(range(65, 91))), byte_mask(b".!?"), byte_mask(bytes(range(192, 256)))
#: Every byte that begins a code point (all but the continuation bytes of UTF-8).
IS_FIRST = ~byte_mask(bytes(range(128, 192)))


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Number of each three-word window, equal for equal windows; ``n`` bounds the word numbers."""
    if n < 1 << 21:
        return (words[:-2] * n + words[1:-1]) * n + words[2:]
    pairs = np.unique(words[:-1] * n + words[1:], return_inverse=True)[1]
    return pairs[:-1] * n + words[2:]


def repeated_words(words: np.ndarray, n: int) -> int:
    """Words inside a three-word window that stands in the text twice or more."""
    if len(words) < 4:
        return 0
    _, number, count = np.unique(windows(words, n), return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[number] > 1)
    mark = np.zeros(len(words), bool)
    for k in range(3):
        mark[at + k] = True
    return int(mark.sum())


def describe(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts and the statistics of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    number = Numbering()
    words = raw.split()  # at the six ASCII blanks
    n = len(words)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(by_byte[IS_FIRST].sum() - by_byte[IS_BLANK].sum())
    symbols = int(by_byte[IS_SYMBOL].sum())
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    dup = len(lines) - len(set(lines))
    repeats = repeated_words(ids, len(number))
    w, c = max(n, 1), max(chars, 1)
    count = np.bincount(ids, minlength=1)
    length = np.fromiter(map(len, number), np.int64, len(number))
    share = count[count > 0] / w
    stats = (np.log1p(n), chars / w, symbols / c, dup / max(len(lines), 1), repeats / w, len(number) / w, count.max() / w,
             by_byte[IS_DIGIT].sum() / c, by_byte[IS_CAPITAL].sum() / c, by_byte[IS_STOP].sum() / w, by_byte[44] / w, len(lines) / w,
             by_byte[IS_BEYOND].sum() / c, np.log1p(length.max(initial=0)), count[: len(length)][length <= 2].sum() / w,
             -(share * np.log(share)).sum() / np.log(w + 1))
    return (n, chars, symbols, dup, repeats), tuple(map(float, stats))


@dataclass
class Forest:
    """All trees in flat arrays; a leaf points at itself, so every row takes the same number of steps."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(LEVELS):
            node = np.where(x[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        return self.base + self.value[node].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-self.margin(x)))


def best_split(hist: np.ndarray, low: float, high: float, falling: np.ndarray):
    """(gain, feature, bin, left value, right value) of the best allowed split; hist is (feature, bin, [gradient, curvature, rows])."""
    left = hist.cumsum(1)[:, :-1]
    total = hist[0].sum(0)
    right = total - left

    def value(part):
        return np.clip(-part[..., 0] / (part[..., 1] + LAMBDA), low, high)

    def gain(part, v):
        return -(part[..., 0] * v + 0.5 * (part[..., 1] + LAMBDA) * v * v)

    a, b = value(left), value(right)
    own = value(total)
    won = gain(left, a) + gain(right, b) - gain(total, own)
    fine = (left[..., 2] >= LEAST_ROWS) & (right[..., 2] >= LEAST_ROWS) & ~(falling[:, None] & (b > a))
    won = np.where(fine, won, -np.inf)
    f, k = np.unravel_index(np.argmax(won), won.shape)
    return won[f, k], int(f), int(k), float(a[f, k]), float(b[f, k]), float(own)


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost trees on statistics ``x`` and labels ``y`` (0 or 1)."""
    rate = float(y.mean()) if len(y) else 0.5
    prior = np.log(rate / (1 - rate)) if 0 < rate < 1 else (np.inf if rate == 1 else -np.inf)
    parts: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value", "roots")}
    if len(y) and 0 < rate < 1:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(x.shape[1])], 1)
        falling = np.array([s in FALLING for s in STATISTICS])
        offset = np.arange(x.shape[1]) * BINS
        margin = np.full(len(y), prior)

        def node(feature=0, cut=np.inf, value=0.0) -> int:
            at = len(parts["feature"])
            for name, v in zip(("feature", "cut", "left", "right", "value"), (feature, cut, at, at, value)):
                parts[name].append(v)
            return at

        def histogram(rows):
            flat = (binned[rows] + offset).ravel()
            size = x.shape[1] * BINS
            return np.stack([np.bincount(flat, np.repeat(w[rows], x.shape[1]), size) for w in (slope, bend, np.ones(len(y)))], 1).reshape(-1, BINS, 3)

        def branch(rows, level, low, high) -> int:
            gain, f, k, a, b, own = best_split(histogram(rows), low, high, falling)
            if level == LEVELS or gain <= 1e-9 or k >= len(cuts[f]):
                margin[rows] += RATE * own
                return node(value=RATE * own)
            at = node(f, float(cuts[f][k]))
            goes = binned[rows, f] <= k
            middle = (a + b) / 2
            bounds = ((middle, high), (low, middle)) if falling[f] else ((low, high), (low, high))
            parts["left"][at] = branch(rows[goes], level + 1, *bounds[0])
            parts["right"][at] = branch(rows[~goes], level + 1, *bounds[1])
            return at

        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            slope, bend = p - y, np.maximum(p * (1 - p), 1e-12)
            parts["roots"].append(branch(np.arange(len(y)), 0, -np.inf, np.inf))
    kind = {"feature": np.int64, "left": np.int64, "right": np.int64, "roots": np.int64}
    return Forest(**{k: np.array(v, kind.get(k, np.float64)) for k, v in parts.items()}, base=float(prior))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, label) of about ``bound`` labelled rows at most, by a hash of their ids."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.min("label").alias("label"))
    n = usable.count()
    if n > bound:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)) < int(bound / n * HASH_RANGE))
    # about ``bound`` rows of 12 bytes at most
    return id_text(docs).join(F.broadcast(usable), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> Forest:
    """The trees learned from ``labels.quality``."""

    def describe_rows(batches):
        for batch in batches:
            stats = [np.array(describe(t.as_py())[1]).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(stats, pa.binary())], ["doc_id", "label", "stats"])

    def learn(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("doc_id", "label", "stats"))))
        x = np.array([np.frombuffer(r[2]) for r in rows]).reshape(-1, len(STATISTICS))
        forest = grow(x, np.array([r[1] for r in rows], np.float64))
        return pa.table({"forest": pa.array([pickle.dumps(forest)], pa.binary())})

    rows = training_rows(docs, labels, bound).mapInArrow(describe_rows, "doc_id long, label int, stats binary")
    found = rows.groupBy().applyInArrow(learn, "forest binary").collect()
    none = np.zeros((0, len(STATISTICS)))
    return pickle.loads(found[0]["forest"]) if found else grow(none, np.zeros(0))


def judge(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, score, kept."""

    def run(batches):
        for batch in batches:
            rows = [describe(t.as_py()) for t in batch.column("text")]
            counts = np.array([r[0] for r in rows], np.int64).reshape(-1, len(COUNTS))
            score = forest.score(np.array([r[1] for r in rows]).reshape(-1, len(STATISTICS)))
            words, repeats = counts[:, 0], counts[:, 4]
            failed = (words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts.T), pa.array(failed), pa.array(score, pa.float64()), pa.array(~failed & (score >= threshold))],
                ["doc_id", *COUNTS, "base_failed", "score", "kept"])

    kinds = ", ".join(f"{c} long" for c in COUNTS)
    return id_text(docs).mapInArrow(run, f"doc_id long, {kinds}, base_failed boolean, score double, kept boolean")


def judge_documents(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> DataFrame:
    """Learn from the labels and judge every document."""
    return judge(docs, fit(docs, labels, bound))
