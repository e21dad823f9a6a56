"""Best-fit packing of token pieces by large-item matching.

A piece longer than a third of the capacity ("large") shares its sequence with
at most one other large piece. Large pieces are matched greedily, the longest
with the longest partner that still fits; smaller pieces then fill the
remaining gaps best-fit, longest first.

Only the number of pieces of each length decides, so the plan is made from at
most ``capacity`` counts, whatever the number of documents. The plan says, for
the i-th piece of each length, its sequence and offset; Spark numbers the
pieces of a length (salted, so that a frequent length is not one task) and
looks up the plan. Texts and ids are never shuffled.

Defined results: a null or empty text is one piece that holds only the end id;
a full piece is a sequence of its own; repeated rows are packed each; equal
lengths are numbered by an order of (salt, doc_id, piece), so ties only swap
places of equal length; an empty table packs into no sequences.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.bpe import WORDS, Vocabulary
from vitrina.llm.shared import id_text, small_batches, written

CAPACITY = 1024
END_ID = 2
#: Pieces of one length and salt, on average at most; it bounds a numbering task.
PIECES_PER_SALT = 2_000
PIECE_TYPE = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def fast_encoder(vocab_path: str):
    """A tiktoken encoder with the ranks of a byte-level BPE file; its ids are the tokenizers library's."""
    import tiktoken

    with open(vocab_path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = Vocabulary(vocab_path)
    merged = [vocab.token_bytes[i] for i in vocab.merged.tolist()]
    single = [vocab.token_bytes[i] for i in vocab.byte_id.tolist()]
    ids = spec["model"]["vocab"]
    ranks = {vocab.token_bytes[i]: i for i in ids.values()}
    if len(set(single) | set(merged)) != len(ranks) or any(ranks[merged[k]] > ranks[merged[k + 1]] for k in range(len(merged) - 1)):
        raise ValueError("ids of this vocabulary don't follow its merge ranks")
    return tiktoken.Encoding("bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=vocab.special)


#: A run of blanks of this length or more is split off before the encoder's pattern, which goes back over it, sees it.
LONG_BLANKS = 10_000
# The characters that the pattern's \\s matches.
BLANK_CHARS = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK_RUNS = re.compile(f"[{BLANK_CHARS}]{{{LONG_BLANKS},}}")


def encode_text(encoder, text: str, plain: bool = False) -> np.ndarray:
    """Ids of a text; with ``plain`` the strings of special tokens are ordinary text.

    Of a run of blanks before another character all but the last blank are one
    word, at a text's end the whole run is; such long runs are merged alone.
    """
    special = set() if plain else encoder.special_tokens_set

    def part(piece: str) -> np.ndarray:
        return encoder.encode_to_numpy(piece, allowed_special=special, disallowed_special=())

    if len(text) < LONG_BLANKS:
        return part(text)
    out, at = [], 0
    for run in BLANK_RUNS.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += [part(text[at: run.start()]), np.array(encoder._encode_single_piece(text[run.start(): end]), np.uint32)]
        at = end
    return np.concatenate([*out, part(text[at:])]) if out else part(text)


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the capacity."""
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


def tokenize(docs: DataFrame, vocab_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents; ``with_ids`` adds each piece's ids."""

    def run(batches):
        encoder = fast_encoder(vocab_path)
        for batch in batches:
            rows, ids_out = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode_text(encoder, text.as_py()), end_id).astype("<u4")
                for k, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    own = ids[start: start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(own.tobytes())))
                    if with_ids:
                        ids_out.append(own.tolist())
            columns = list(zip(*rows)) if rows else [()] * 5
            arrays = [pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(columns)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return id_text(docs).mapInArrow(run, PIECE_TYPE + (", ids array<long>" if with_ids else ""))


def plan_counts(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, n, per_bin, sequence, offset) of the packing plan.

    Pieces number ``first`` to ``first + n - 1`` of a length lie ``per_bin`` to
    a sequence, from sequence ``sequence`` on, at ``offset`` in it. Each row
    covers a run of equal sequences, so the work depends on the number of
    lengths, not of pieces.
    """
    left = {k: int(v) for k, v in counts.items() if v and k < capacity}
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, number of sequences)
    sizes: list[int] = []  # the gaps, sorted
    opened = 0

    def add(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                sizes.insert(bisect_left(sizes, gap), gap)
            gaps[gap].append((first, n))

    def place(length: int, n: int, per_bin: int, sequence: int, offset: int) -> None:
        rows.append((length, used[length], n, per_bin, sequence, offset))
        used[length] += n
        left[length] -= n

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for a in large:
        for b in large:
            if not left[a]:
                break
            if b > a or a + b > capacity or not left[b]:
                continue
            n = left[a] // 2 if a == b else min(left[a], left[b])
            if not n:
                continue
            if a == b:
                place(a, 2 * n, 2, opened, 0)
            else:
                place(a, n, 1, opened, 0)
                place(b, n, 1, opened, a)
            add(capacity - a - b, opened, n)
            opened += n
        if n := left[a]:
            place(a, n, 1, opened, 0)
            add(capacity - a, opened, n)
            opened += n
    for size in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(sizes, size)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first, n = capacity, opened, -(-left[size] // (capacity // size))
                opened += n
            each = gap // size
            full = min(n, left[size] // each)
            if full:
                place(size, full * each, each, first, capacity - gap)
                add(gap - each * size, first, full)
            if full < n and left[size]:  # the last few pieces go to one sequence
                rest = left[size]
                place(size, rest, rest, first + full, capacity - gap)
                add(gap - rest * size, first + full, 1)
                full += 1
            add(gap, first + full, n - full)
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces (doc_id, piece, length, ...).

    The plan's counts are the only thing that reaches the driver: at most one
    row for each length below the capacity. The plan is broadcast: its size
    depends on the capacity alone.
    """
    spark = pieces.sparkSession
    with small_batches(spark):
        pieces = written(pieces, "pieces")
    per_length = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    salts = max(1, -(-max(per_length.values(), default=1) // PIECES_PER_SALT))
    full_ids = F.col("length") >= capacity
    # full pieces need no number within their length: an id of the row's own place suffices
    full = pieces.where(full_ids).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    salted = pieces.where(~full_ids).withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    cells = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    numbered = salted.withColumn("_k", F.row_number().over(within) - 1).join(cells, ["length", "_salt"])
    numbered = numbered.withColumn("_i", F.col("_before") + F.col("_k"))
    rows = plan_counts(per_length, capacity)
    by_length: dict[int, list] = {}
    for length, *rest in rows:
        by_length.setdefault(length, []).append(rest)
    plan = spark.createDataFrame([(k, v) for k, v in by_length.items()], "length long, _runs array<array<long>>")
    run = F.element_at(F.filter("_runs", lambda r: (F.col("_i") >= r[0]) & (F.col("_i") < r[0] + r[1])), 1)
    placed = numbered.join(F.broadcast(plan), "length").withColumn("_run", run)
    nth = F.col("_i") - F.col("_run")[0]
    placed = placed.withColumn("sequence_id", F.col("_run")[3] + F.floor(nth / F.col("_run")[2]))
    placed = placed.withColumn("offset", F.col("_run")[4] + F.pmod(nth, F.col("_run")[2]) * F.col("length"))
    return placed.select(full.columns).unionByName(full)


def pack_documents(docs: DataFrame, vocab_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack documents: one row per piece with its sequence and offset."""
    return pack(tokenize(docs, vocab_path, capacity, end_id, with_ids), capacity)
