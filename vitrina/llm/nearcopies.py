"""Near-duplicate classes by BagMinHash signatures over word shingles.

A document is the multiset of its five-word shingles. Its signature comes from
hierarchical Poisson processes: the weights of a shingle are discretised to
counts and cut into dyadic blocks (0,1], (1,2], (2,4], (4,8], ...; each block
of each shingle has its own process of random points in time, with a rate
equal to the block's width, and a point belongs to a level inside the block
found by halving it. A document sees the points at levels up to its count. Each
point falls into one of m slots, and the earliest point of a slot is the
slot's signature: two documents agree in a slot with the probability of their
weighted Jaccard similarity. Points are drawn in time order and a document
stops when its slots are full, so a long document costs little more than one
comparison for each shingle.

Signatures are banded. Texts that share a band are candidates; they are
verified by the exact overlap of their multisets (sum of minima over sum of
maxima, at least ``THRESHOLD``), and verified links form classes.

Equal multisets are one "text" from the start, so copies cost one row. In a
band's bucket the text that meets most others is compared with all of them.
The texts of buckets that are then not all in one class are grouped again by
each of their rarest shingles, so many that a pair similar enough shares one
(``rare_first``; a passage that thousands of texts share is not rare, and
brings none of them together). In each of these groups about 4, 12, 48, ...
texts are compared with the others, until every pair of a group is in one
class, is compared, or can't overlap enough by the weights that lie before
the shared shingle. No group is gathered in one task, and no pair that is
linked already is emitted.

Defined results: words are split at ASCII white space, A-Z lower-cased; a text
of one to four words is one shingle; texts without words are equal to each
other and to nothing else; a null text has no words; the class id is the
smallest doc_id of the class (null only if all are), and exactly one row of a
class is kept, one with that id; repeated rows are members each.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.language import WordHashes
from vitrina.llm.shared import id_text, keep_rows, small_batches, written

SHINGLE, BANDS, ROWS = 5, 25, 5
SLOTS = BANDS * ROWS
#: Similarity of a link, as numerator and denominator.
THRESHOLD = (4, 5)
#: Words that a task handles at a time.
BLOCK_WORDS = 250_000
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)


def scatter(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (overflow wraps)."""
    x = (x ^ (x >> np.uint64(32))) * K2
    x = (x ^ (x >> np.uint64(29))) * K1
    return x ^ (x >> np.uint64(32))


def wrapped(n: int, factor: np.uint64) -> np.uint64:
    """n times a 64-bit number, modulo 2^64."""
    return np.uint64(n * int(factor) & 0xFFFFFFFFFFFFFFFF)


def shingles(text: str, memo: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a text and their counts."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - size + 1, min(len(h), 1))
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        out = (out + h[k: k + n]) * K3 + np.uint64(k + 1)
    return np.unique(scatter(out), return_counts=True)


def uniform(h: np.ndarray) -> np.ndarray:
    """A number in (0, 1] for each hash."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


def signatures(shingle: np.ndarray, count: np.ndarray, doc: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """Signature (uint64, documents x slots) of all documents of a block.

    ``doc`` names the document of each (shingle, count). Documents without
    shingles keep zeros.
    """
    out = np.zeros((n_docs, slots), np.uint64)
    weight = np.bincount(doc, count, n_docs)
    todo = np.flatnonzero(weight > 0)
    limit = np.zeros(n_docs)
    limit[todo] = slots / weight[todo] * (np.log(slots) + 4)
    while len(todo):
        chosen = np.zeros(n_docs, bool)
        chosen[todo] = True
        at = np.flatnonzero(chosen[doc])
        out[todo] = 0
        best = np.full(n_docs * slots, np.inf)
        win = np.zeros(n_docs * slots, np.uint64)
        level = 0
        while len(at):  # one dyadic block of levels at a time
            low, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
            seed = scatter(shingle[at] + wrapped(level, K3))
            draw_points(seed, count[at], doc[at], low, width, limit, best, win, slots)
            level += 1
            at = at[count[at] > (1 << (level - 1))]
        filled = np.isfinite(best.reshape(n_docs, slots)).all(axis=1)
        done = todo[filled[todo]]
        out[done] = win.reshape(n_docs, slots)[done]
        todo = todo[~filled[todo]]
        limit[todo] *= 2  # some slot stayed empty: a longer time
    return out


def draw_points(seed, count, doc, low, width, limit, best, win, slots) -> None:
    """Points of one block of levels up to each document's time limit; earliest of each slot into best, win."""
    time = np.zeros(len(seed))
    bound = limit[doc]
    k = 0
    while len(seed):
        k += 1
        h = scatter(seed + wrapped(k, K1))
        time = time - np.log(uniform(h)) / width
        going = time <= bound
        seed, count, doc, time, bound, h = (a[going] for a in (seed, count, doc, time, bound, h))
        point = scatter(h ^ K2)
        seen = slice(None)
        if width > 1:  # the point's level: halving the block down to one count
            place = low + 1 + (scatter(point ^ K3) % np.uint64(width)).astype(np.int64)
            seen = place <= count
        slot = doc[seen] * slots + (point[seen] % np.uint64(slots)).astype(np.int64)
        t = time[seen]
        np.minimum.at(best, slot, t)
        first = best[slot] == t
        win[slot[first]] = point[seen][first]


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key for each band (documents x bands); the band's number is part of it."""
    part = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * K3, part.shape[:2])
    for r in range(rows):
        key = scatter(key * K1 + part[:, :, r])
    return key


def digest(found: np.ndarray, count: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes() + count.astype("<i8").tobytes(), digest_size=16).digest()


def word_blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_WORDS):
    """(first row, shingle multisets) of runs of rows with about ``size`` words."""
    memo, lo, total, own = WordHashes(), 0, 0, []
    texts = batch.column(column)
    for k in range(batch.num_rows):
        own.append(shingles(texts[k].as_py(), memo))
        total += len(own[-1][0]) + SHINGLE
        if total >= size or k + 1 == batch.num_rows:
            yield lo, own
            lo, total, own = k + 1, 0, []


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, digest, bands) of every row."""

    def run(batches):
        for batch in batches:
            for lo, own in word_blocks(batch, "text"):
                n = [len(x) for x, _ in own]
                sig = signatures(np.concatenate([x for x, _ in own]), np.concatenate([c for _, c in own]), np.repeat(np.arange(len(own)), n), len(own))
                keys = band_keys(sig).view(np.int64)
                rows = np.array(n) > 0
                offsets = np.append(0, np.cumsum(rows * BANDS)).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[rows].ravel()))
                part = batch.slice(lo, len(own))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array([digest(*x) for x in own], pa.binary()), bands], ["doc_id", "text_key", "digest", "bands"])

    keyed = docs.withColumn("text_key", F.md5(F.col("text").cast("binary")))
    return keyed.mapInArrow(run, "doc_id long, text_key string, digest binary, bands array<long>")


def multisets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tid, bag) of the wanted texts (doc_id, digest, tid): their shingles and counts, from one of their rows."""

    def run(batches):
        for batch in batches:
            for lo, own in word_blocks(batch, "text"):
                part = batch.slice(lo, len(own))
                hit = [k for k, d in enumerate(part.column("digest").to_pylist()) if digest(*own[k]) == d]
                bags = [own[k][0].tobytes() + own[k][1].astype("<u4").tobytes() for k in hit]
                yield pa.RecordBatch.from_arrays([part.column("tid").take(pa.array(hit, pa.int64())), pa.array(bags, pa.binary())], ["tid", "bag"])

    own = docs.alias("d").join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")))
    return own.select("text", "tid", "digest").mapInArrow(run, "tid long, bag binary").dropDuplicates(["tid"])


def overlap(a: bytes, b: bytes) -> tuple[int, int]:
    """Sum of minima and sum of maxima of two multisets (8 bytes of hash, then 4 of count, for each shingle)."""
    n, m = len(a) // 12, len(b) // 12
    xs, ys = np.frombuffer(a, np.uint64, n), np.frombuffer(b, np.uint64, m)
    xc, yc = (np.frombuffer(c, "<u4", k, 8 * k).astype(np.int64) for c, k in ((a, n), (b, m)))
    _, i, j = np.intersect1d(xs, ys, assume_unique=True, return_indices=True)
    low = int(np.minimum(xc[i], yc[j]).sum())
    return low, int(xc.sum()) + int(yc.sum()) - low


def verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("bag_a"), batch.column("bag_b")):
                low, high = overlap(x.as_py(), y.as_py())
                ok.append(low * THRESHOLD[1] >= high * THRESHOLD[0])
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = bags.select(F.col("tid").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("tid").alias("b"), F.col("bag").alias("bag_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(tid, label): the smallest id connected with each linked id that isn't it, by alternating large and small stars.

    ``links`` is a written table of distinct pairs (a, b), a > b. Ends when
    every id that has a smaller neighbour has no other one: each class is then
    a star around its smallest id.
    """
    links = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        least = written(least, "stars")
        if least.where("m < u and n > 1").isEmpty():
            return links.select(F.col("u").alias("tid"), F.col("v").alias("label"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "stars")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        links = written(small, "links")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links (a, b): classes are joined as wholes, by the links between their labels."""
    own = links
    for end in ("a", "b"):
        own = own.join(labels.withColumnRenamed("tid", end), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    own = own.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    moved = components(written(own, "links"))
    to = moved.select(F.col("tid").alias("label"), F.col("label").alias("to"))
    old = labels.join(to, "label", "left").select("tid", F.coalesce("to", "label").alias("label"))
    return written(old.unionByName(moved), "labels")


def rare_first(bags: DataFrame) -> DataFrame:
    """(w, tid, n, at, stays): the shingles by which a text of weight n can be found, rarest in these texts first.

    Two texts of similarity t overlap in at least t times the greater weight
    and 2t / (1 + t) times the smaller one. So with one order of all shingles
    (rarest first), the first shingle that they share lies in each text's
    first part: ``at``, the weight before it, leaves room for that overlap.
    ``stays`` marks the shingles that suffice when the text is the smaller of
    the two.
    """

    def run(batches):
        for batch in batches:
            for tid, bag in zip(batch.column("tid").to_pylist(), batch.column("bag")):
                raw = bag.as_py()
                k = len(raw) // 12
                count = np.frombuffer(raw, "<u4", k, 8 * k).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(raw, np.int64, k)), pa.array(np.full(k, tid)), pa.array(count), pa.array(np.full(k, count.sum()))],
                    ["w", "tid", "c", "n"])

    with small_batches(bags.sparkSession):
        tokens = written(bags.select("tid", "bag").mapInArrow(run, "w long, tid long, c long, n long"), "tokens")
    often = tokens.groupBy("w").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    before = Window.partitionBy("tid").orderBy("df", "w").rowsBetween(Window.unboundedPreceding, -1)
    ordered = tokens.join(often, "w", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    ordered = ordered.withColumn("at", F.coalesce(F.sum("c").over(before), F.lit(0)))
    p, q = THRESHOLD
    found = ordered.where((F.col("df") > 1) & (F.col("at") * q <= F.col("n") * (q - p)))
    return found.select("w", "tid", "n", "at", (F.col("at") * (p + q) <= F.col("n") * (q - p)).alias("stays"))


def compared(pairs: DataFrame, tried: list[DataFrame], bags: DataFrame) -> DataFrame | None:
    """The links among new pairs, which are added to ``tried``; None if there are none."""
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    if tried:
        pairs = pairs.join(reduce(DataFrame.unionByName, tried), ["a", "b"], "left_anti")
    pairs = written(pairs, "pairs")
    if pairs.isEmpty():
        return None
    tried.append(pairs)
    with small_batches(bags.sparkSession):
        found = written(verified(pairs, bags), "verified")
    return None if found.isEmpty() else found


def split_groups(members: DataFrame, key: str, labels: DataFrame) -> DataFrame:
    """The members (with ``label``) of the groups that lie in several classes."""
    own = written(members.join(labels, "tid", "left").withColumn("label", F.coalesce("label", "tid")), "labelled")
    split = own.groupBy(key).agg(F.min("label").alias("one"), F.max("label").alias("other")).where("one <> other")
    return own.join(split.select(key), key)


def text_classes(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """(tid, label) of the texts that have a link; ``texts`` has tid, digest, bands, doc_id."""
    members = texts.select("tid", F.explode("bands").alias("key"))
    shared = written(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    own = written(members.join(shared, "key").select("key", "tid", "n"), "members")
    # texts that meet many others come first: the original of a group of copies is close to all of them
    degree = written(own.groupBy("tid").agg(F.sum("n").alias("degree")), "degrees")
    buckets = written(own.join(degree, "tid").select("key", "tid", "n", "degree"), "buckets")
    heads = buckets.groupBy("key").agg(F.max(F.struct("degree", (-F.col("tid")).alias("minus"))).alias("head"))
    heads = written(heads.select("key", (-F.col("head.minus")).alias("pivot")), "heads")
    wanted = texts.select("tid", "doc_id", "digest").join(buckets.select("tid").distinct(), "tid")
    with small_batches(docs.sparkSession):
        bags = written(multisets(docs, wanted), "bags")
    tried: list[DataFrame] = []
    first = compared(buckets.join(heads, "key").where("tid <> pivot").select(F.col("tid").alias("a"), F.col("pivot").alias("b")), tried, bags)
    none = members.select("tid", F.col("tid").alias("label")).limit(0)
    labels = none if first is None else components(first)
    # what its first text does not bring into one class: a bucket's texts that share rare shingles
    open_ = split_groups(buckets.where("n > 2").select("key", "tid"), "key", labels).select("tid").distinct()
    entries = written(rare_first(bags.join(open_, "tid")), "entries")
    width = entries.groupBy("w").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("stays").cast("long")).alias("width")).where("size > 1 and width > 0")
    place = F.pmod(F.xxhash64("tid", "w"), F.col("width"))
    entries = written(entries.join(width.select("w", "width"), "w").withColumn("place", F.when(F.col("stays"), place)), "entries")
    lo, hi, own = 0, 4, None
    while True:
        # without new links the classes are the same, and so are the groups
        own = written(split_groups(entries.where(F.col("width") > lo), "w", labels), "open") if own is None else own.where(F.col("width") > lo)
        if own.isEmpty():
            return labels
        pivots = own.where((F.col("place") >= lo) & (F.col("place") < hi))
        pivots = pivots.select("w", F.col("tid").alias("b"), F.col("label").alias("label_b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"))
        room = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
        enough = room * sum(THRESHOLD) >= (F.col("n") + F.col("n_b")) * THRESHOLD[0]
        pairs = own.join(pivots, "w").where((F.col("label") != F.col("label_b")) & (F.col("n") >= F.col("n_b")) & enough)
        found = compared(pairs.select(F.col("tid").alias("a"), "b"), tried, bags)
        if found is not None:
            labels, own = merged(labels, found), None
        lo, hi = hi, hi * 4


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, class_id, class_size, kept, text_key (md5 of the text)."""
    docs = id_text(docs)
    with small_batches(docs.sparkSession):
        rows = written(signed(docs).withColumn("row", F.monotonically_increasing_id()), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    texts = rows.groupBy("digest", "bands").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    texts = written(texts.select("digest", "bands", "n", "first", F.col("first.doc_id").alias("doc_id"), F.monotonically_increasing_id().alias("tid")), "texts")
    labels = text_classes(texts, docs)
    named = written(texts.join(labels, "tid", "left").select("digest", "n", "first", F.coalesce("label", "tid").alias("label")), "named")
    whole = written(named.groupBy("label").agg(F.sum("n").alias("class_size"), F.min("first").alias("head")), "classes")
    texts = written(named.join(whole, "label").select("digest", "class_size", "head"), "texts")
    out = rows.join(texts, "digest")
    return out.select("doc_id", F.col("head.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("head.row")).alias("kept"), "text_key")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns."""
    kept = classes(docs).where("kept")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return keep_rows(docs, digest, kept.select("doc_id", F.col("text_key").alias("digest")))
