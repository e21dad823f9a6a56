"""Cross-tokenizer alignment as an Arrow-native pipeline.

Both tokenizers' ids are list columns. Flattened with their parent indices and
summed within each document (a cumulative sum less its value at the document's
start) they give the byte offset at which each token ends. An Acero hash join
on the key (document, end) finds the offsets where tokens of both end; these
cut a document into groups. All pairs of a group's ids are links. A long group
is first reduced to its different ids with their numbers by
``Table.group_by``, so the work follows the different pairs.

1. Tasks encode and align blocks of documents; the aligned ids are written once
   (two bytes an id and one bit for the ends of groups).
2. Tasks count, for each id pair, the documents of their blocks that hold it
   (``Table.group_by``); Spark sums these partial counts. The counts are written
   as sorted arrays, dealt by first id, to the shared folder.
3. Tasks read the aligned ids again, look up their blocks' different pairs in
   the memory-mapped arrays and sum up each document.

Size bounds: both vocabularies have at most 65,536 ids, so the number of
different pairs is bounded by the vocabularies, whatever the number of
documents. Nothing reaches the driver and nothing is broadcast.

Defined results: null and empty texts, and texts that a tokenizer's pieces do
not spell out byte for byte (normalised characters, dropped blanks), have no
tokens: zeros and an empty ``groups_sha256``; special tokens' strings are plain
text; repeated rows are documents of their own; a null doc_id is passed on;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.bpe import Vocabulary, blocks, ragged
from vitrina.llm.language import array_file
from vitrina.llm.packing import encode_text, fast_encoder
from vitrina.llm.shared import id_text, new_folder, pack_arrays, put_bytes, small_batches, written

#: Characters of text that are encoded, and tokens that are counted, at a time; files of counts; counts a task holds before it passes them on.
BLOCK_CHARS, BLOCK_TOKENS, SHARDS, HELD_COUNTS = 1_500_000, 600_000, 64, 1_500_000
#: A group with more links than this is reduced to its different ids first.
LONG_GROUP = 64
DOCUMENT = 1 << 40
ALIGNED = "doc_id long, a binary, b binary, a_ends binary, b_ends binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Pieces:
    """The two tokenizers: ids of a text, and the bytes that every id stands for."""

    def __init__(self, byte_vocab: str, piece_vocab: str):
        import sentencepiece

        self.bytes_encoder = fast_encoder(byte_vocab)
        self.a_bytes = Vocabulary(byte_vocab).token_bytes
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_vocab)
        self.b_bytes = [self.spelled(k) for k in range(self.pieces.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.sizes = [pa.array([len(b) for b in table], pa.int64()) for table in (self.a_bytes, self.b_bytes)]
        self.names = [pa.array(list(map(str, range(len(table)))), pa.string()) for table in (self.a_bytes, self.b_bytes)]

    def spelled(self, k: int) -> bytes:
        if self.pieces.is_control(k) or self.pieces.is_unknown(k):
            return b""
        piece = self.pieces.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(k) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none where one of them doesn't spell the text."""
        none = np.zeros(0, np.uint16)
        if not text:
            return none, none
        spaced = " " + text
        b = self.pieces.encode(text)
        raw = spaced.encode("utf-8", "surrogatepass")
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return none, none
        a = encode_text(self.bytes_encoder, spaced, plain=True)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != raw:
            return none, none
        return a.astype(np.uint16), np.array(b, np.uint16)


@lru_cache(maxsize=2)
def both_tokenizers(byte_vocab: str, piece_vocab: str) -> Pieces:
    return Pieces(byte_vocab, piece_vocab)


def list_column(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.uint16), pa.uint16()))


def token_ends(ids: pa.ListArray, size: pa.Array) -> pa.Table:
    """(key, token): document and byte offset at which each token ends."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    length = size.take(flat)
    total = pc.cumulative_sum(length)
    before = np.append(0, total.to_numpy())[ids.offsets.to_numpy()[:-1]]  # the sum at each document's start
    end = pc.subtract(total, pa.array(before).take(doc))
    return pa.table({"key": pc.add(pc.multiply(doc, DOCUMENT), end), "token": pa.array(np.arange(len(flat)))})


def group_ends(a: pa.ListArray, b: pa.ListArray, sizes: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, last token of a and last token of b of every group, in order."""
    both = token_ends(a, sizes[0]).join(token_ends(b, sizes[1]), "key", join_type="inner", right_suffix="_b", use_threads=False).sort_by("key")
    return both["key"].to_numpy() // DOCUMENT, both["token"].to_numpy(), both["token_b"].to_numpy()


def spans(last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and number of tokens of groups that follow one another."""
    first = np.append(0, last[:-1] + 1) if len(last) else last
    return first, last - first + 1


def joined_groups(names, flats, ends, docs: np.ndarray, n: int) -> pa.Array:
    """The text ``a1,a2|b1;a3|b2`` of each of ``n`` documents."""
    sides = []
    for name, flat, last in zip(names, flats, ends):
        offsets = pa.array(np.append(0, last + 1).astype(np.int32))
        sides.append(pc.binary_join(pa.ListArray.from_arrays(offsets, name.take(flat)), ","))
    groups = pc.binary_join_element_wise(*sides, "|")
    offsets = np.searchsorted(docs, np.arange(n + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), groups), ";")


def marks(last: np.ndarray, n: int, offsets: np.ndarray) -> list[bytes]:
    """For each document the bits that say which tokens end a group."""
    at = np.zeros(n, bool)
    at[last] = True
    return [np.packbits(at[lo:hi]).tobytes() for lo, hi in zip(offsets[:-1], offsets[1:])]


def align_block(pieces: Pieces, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
    """Aligned ids and group figures of a block of documents."""
    parts = [pieces.encode(t) for t in texts]
    ids = [list_column([p[k] for p in parts]) for k in (0, 1)]
    docs, *last = group_ends(*ids, pieces.sizes)
    counts = [spans(x)[1] for x in last]
    text = joined_groups(pieces.names, [i.values for i in ids], last, docs, len(texts))
    digests = [hashlib.sha256(t.as_buffer()).hexdigest() if len(p[0]) else "" for t, p in zip(text, parts)]
    bits = [marks(x, len(i.values), i.offsets.to_numpy()) for x, i in zip(last, ids)]
    links = np.zeros(len(texts), np.int64)
    np.add.at(links, docs, counts[0] * counts[1])
    numbers = [np.array([len(p[0]) for p in parts]), np.array([len(p[1]) for p in parts]), np.bincount(docs, minlength=len(texts)), links]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), *(pa.array([p[k].tobytes() for p in parts], pa.binary()) for k in (0, 1)), *(pa.array(b, pa.binary()) for b in bits),
         *(pa.array(x.astype(np.int64), pa.int64()) for x in numbers), pa.array(digests, pa.string())],
        [f.split()[0] for f in ALIGNED.split(", ")])


def align_documents(docs: DataFrame, byte_vocab: str, piece_vocab: str) -> DataFrame:
    """Per document: ids of both tokenizers, ends of their groups, and the groups' figures."""

    def run(batches):
        pieces = both_tokenizers(byte_vocab, piece_vocab)
        for batch in batches:
            for keys, texts in blocks([batch.column(0).to_pylist(), batch.column(1).to_pylist()], BLOCK_CHARS):
                yield align_block(pieces, keys, texts)

    return id_text(docs).mapInArrow(run, ALIGNED)


def aligned_blocks(batches):
    """(first row, end row, ids of a and b, last tokens of their groups, document of each group) of blocks of rows."""
    for batch in batches:
        sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        block = np.cumsum(sizes) // BLOCK_TOKENS
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(sizes)] if len(sizes) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            flats, lasts, owners = [], [], []
            for ids, ends in (("a", "a_ends"), ("b", "b_ends")):
                parts = [np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column(ids)[lo:hi]]
                bits = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(p)) for x, p in zip(batch.column(ends)[lo:hi], parts)]
                flats.append(np.concatenate(parts).astype(np.int64))
                lasts.append(np.flatnonzero(np.concatenate(bits)))
                owners.append(np.repeat(np.arange(hi - lo), [len(p) for p in parts]))
            yield lo, hi, flats, lasts, owners[0][lasts[0]]


def different(flat: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, number) of the different ids of each group, sorted by group."""
    t = pa.table({"group": group, "id": flat}).group_by(["group", "id"]).aggregate([("id", "count")]).sort_by([("group", "ascending"), ("id", "ascending")])
    return t["group"].to_numpy(), t["id"].to_numpy(), t["id_count"].to_numpy()


def products(ga, a, na, gb, b, nb) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, number) of all pairs of an a and a b of one group; rows are sorted by group."""
    lo = np.searchsorted(gb, ga, "left")
    many = np.searchsorted(gb, ga, "right") - lo
    at = ragged(lo, many)
    return np.repeat(ga, many), np.repeat(a, many) << 16 | b[at], np.repeat(na, many) * nb[at]


def links(flats, lasts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, number of links) of a block; a pair may come in several rows of a group that is short."""
    counts = [spans(x)[1] for x in lasts]
    long = np.minimum(*counts) > 1
    long &= counts[0] * counts[1] > LONG_GROUP
    sides = []
    for flat, n in zip(flats, counts):
        group = np.repeat(np.arange(len(n)), n)
        if long.any():
            far = long[group]
            g, i, m = different(flat[far], group[far])
            group, flat, m = np.append(group[~far], g), np.append(flat[~far], i), np.append(np.ones(int((~far).sum()), np.int64), m)
            by = np.argsort(group, kind="stable")
            sides += [group[by], flat[by], m[by]]
        else:
            sides += [group, flat, np.ones(len(flat), np.int64)]
    return products(*sides)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): in how many documents an id pair is linked; pair = a x 65536 + b."""

    def run(batches):
        held, size = [], 0
        for _, _, flats, lasts, docs in aligned_blocks(batches):
            group, pair, _ = links(flats, lasts)
            once = pa.table({"doc": docs[group], "pair": pair}).group_by(["doc", "pair"]).aggregate([])
            held.append(once.group_by("pair").aggregate([("doc", "count")]))
            size += held[-1].num_rows
            if size > HELD_COUNTS:
                held = [merged(held)]
                size = held[0].num_rows
                if size > HELD_COUNTS // 2:
                    yield from out(held[0])
                    held, size = [], 0
        if held:
            yield from out(merged(held))

    def merged(tables):
        t = pa.concat_tables(tables).group_by("pair").aggregate([("doc_count", "sum")])
        return t.rename_columns({"doc_count_sum": "doc_count"})

    def out(t):
        return t.select(["pair", "doc_count"]).rename_columns(["pair", "n"]).to_batches(max_chunksize=1 << 18)

    columns = aligned.where("n_a > 0").select("a", "b", "a_ends", "b_ends", "n_a", "n_b")
    return columns.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def shard_file(folder: str, shard: int) -> str:
    return f"{folder}/{shard}"


def count_files(counts: DataFrame, folder: str) -> None:
    """Write the counts as sorted arrays (pairs, counts, whether a count is its first id's highest), dealt by first id."""

    def run(batches):
        shard, held = None, []
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else np.zeros(0, int)
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(numbers)]):
                if held and shard != numbers[lo]:
                    yield save(shard, held)
                    held = []
                shard = int(numbers[lo])
                held.append([batch.column(c).to_numpy()[lo:hi] for c in ("pair", "n")])
        if held:
            yield save(shard, held)

    def save(shard, held):
        pair, n = (np.concatenate(x) for x in zip(*held))
        first = np.flatnonzero(np.append(True, pair[1:] >> 16 != pair[:-1] >> 16))
        top = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(pair))))
        put_bytes(shard_file(folder, shard), pack_arrays(pair.astype(np.uint32), n, (n == top).astype(np.uint8)))
        return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "pairs": pa.array([len(pair)], pa.int64())})

    shard = (F.shiftright("pair", 16) % SHARDS).cast("int")
    rows = counts.withColumn("shard", shard).repartitionById(SHARDS, "shard").sortWithinPartitions("shard", "pair")
    rows.mapInArrow(run, "shard int, pairs long").write.format("noop").mode("overwrite").save()


def looked_up(pairs: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Count of each of the sorted different pairs, and whether it is its first id's highest."""
    count, top = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    shard = (pairs >> 16) % SHARDS
    by = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[by], np.arange(SHARDS + 1))
    for k in range(SHARDS):
        own = by[cuts[k]: cuts[k + 1]]
        if len(own):
            keys, n, best = array_file(shard_file(folder, k))
            at = np.searchsorted(keys, pairs[own].astype(np.uint32))
            count[own], top[own] = n[at], best[at]
    return count, top


def alignment_scores(docs: DataFrame, byte_vocab: str, piece_vocab: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    with small_batches(spark):
        aligned = written(align_documents(docs, byte_vocab, piece_vocab), "aligned", "zstd")
    folder = new_folder(spark, "pair-counts")
    count_files(pair_counts(aligned), folder)

    def run(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for lo, hi, flats, lasts, docs in aligned_blocks([batch]):
                group, pair, n = links(flats, lasts)
                pairs, at = np.unique(pair, return_inverse=True)
                count, top = looked_up(pairs, folder)
                own = docs[group]
                np.add.at(best[lo:hi], own, n * top[at])
                np.add.at(total[lo:hi], own, n * count[at])
            yield pa.RecordBatch.from_arrays([*columns[:5], pa.array(best), pa.array(total), columns[5]],
                                             ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return aligned.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
