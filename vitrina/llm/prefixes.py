"""Prefix trie of conversations by a splitter skeleton.

Every conversation becomes a path: one token of 24 bytes for each turn (16 of
the SHA-256 of role and text, 8 for the text's length). Conversations are dealt
to shards by ranges of (path, conv_id). A node of the trie that is no prefix of
a splitter's path has all its members in one shard, which finishes it alone
from its sorted rows. The prefixes of the splitters' paths form the skeleton:
the trie of these paths is broadcast, every shard adds its own members' share
to the skeleton nodes it meets, and one reduction by node sums the shares.

All figures of a skeleton node are sums of shares: what shards know (members,
children and leaves outside the skeleton, members x bytes), what the trie of
splitters knows (children and bytes inside it) and, after the reduction, which
of the skeleton's own ends have no children.

Size bounds: ``SAMPLE_BYTES`` of sampled paths reach the driver, of which one
splitter a shard is broadcast; when paths are long there are fewer shards. A
conversation that is repeated very often is cut by conv_id, so it spans shards.
A task holds the tokens (24 bytes a turn, never the texts) of the at most nine
conversations that are rebuilt from one another.

Defined results: a null role or text is empty; a null turn comes first; turns of
equal number (repeated rows too) are ordered by their token, so their order is
always the same; rows without conv_id take no part; c % 5 has the sign of c, as
in SQL; a conversation left without turns ends at the root; an empty table has
no nodes, not even a root; columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.sizing import bounded_broadcast
from vitrina.llm.bpe import ragged
from vitrina.llm.shared import written

TOKEN = 24
FAMILY, HEADS = 5, 9
#: Bytes of paths for each shard; sampled conversations for each shard; bytes of sampled paths on the driver.
SHARD_BYTES, SAMPLES, SAMPLE_BYTES = 8 << 20, 32, 64 << 20
#: Ids in one piece of a skeleton node's list of ends.
PIECE_IDS = 16_384
HASH_RANGE = 1 << 30
NODE_TYPE = ("kind int, node long, shard long, seq long, conv_id long, depth long, parent_conv_id long, n_convs long, "
             "n_children long, n_leaves long, saved_tokens long, ends string")
LOCAL, SHARE, PIECE = 0, 1, 2


def turn_tokens(turns: DataFrame) -> DataFrame:
    """(home, conv_id, turn, token): ``home`` is the conversation whose first turns are taken."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    token = F.unhex(F.concat(F.substring(named, 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))
    conv = F.col("conv_id").cast("long")
    rows = turns.where(F.col("conv_id").isNotNull())
    return rows.select((conv - conv % FAMILY).alias("home"), conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"), token.alias("token"))


def heads(conv_id: int) -> int:
    """How many turns a conversation takes from its home."""
    return zlib.crc32(str(conv_id).encode()) % HEADS


def rebuilt(home: np.ndarray, conv: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(conv_id, path length in turns, all paths' tokens) of whole families, sorted by home, conversation and turn."""
    first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
    size = np.diff(np.append(first, len(conv)))
    ids = conv[first]
    at = {c: k for k, c in enumerate(ids.tolist())}
    base = np.array([at.get(c, -1) for c in home[first].tolist()], np.int64)
    h = np.array([heads(c) for c in ids.tolist()], np.int64)
    taken = np.where(base >= 0, np.minimum(h, size[base]), 0)
    own = np.maximum(size - h, 0)
    starts = np.stack([first[base], first + h], 1).ravel()
    index = ragged(starts, np.stack([taken, own], 1).ravel())
    return ids, taken + own, tokens[index]


def token_matrix(column: pa.Array) -> np.ndarray:
    """Tokens of a binary column, one row each."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[ends[0]: ends[-1]].reshape(-1, TOKEN)


def binary_column(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path binary) of every rebuilt conversation."""

    def run(batches):
        held = None
        for batch in batches:
            rows = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), token_matrix(batch.column(2))] if batch.num_rows else None
            if rows is None:
                continue
            held = rows if held is None else [np.concatenate(p) for p in zip(held, rows)]
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last family may go on in the next batch
            if cut:
                yield out(*rebuilt(*(a[:cut] for a in held)))
                held = [a[cut:] for a in held]
        if held is not None:
            yield out(*rebuilt(*held))

    def out(ids, turns_, tokens):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), binary_column(turns_ * TOKEN, tokens)], ["conv_id", "path"])

    rows = turn_tokens(turns).repartition("home").sortWithinPartitions("home", "conv_id", F.col("turn").asc_nulls_first(), "token")
    return rows.select("home", "conv_id", "token").mapInArrow(run, "conv_id long, path binary")


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of first turns that two paths share."""
    end = min(len(a), len(b))
    if a[:end] == b[:end]:
        return end // TOKEN
    at = 0
    while a[at: at + TOKEN] == b[at: at + TOKEN]:
        at += TOKEN
    return at // TOKEN


class Skeleton:
    """The trie of the splitters' paths: node numbers along each path, and what is known before any shard is read."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.keys = splitters
        self.nodes: list[list[int]] = []  # node of each depth along a splitter's path
        self.parent, self.depth, self.bytes = [-1], [0], [0]
        before = b""
        for path, _ in splitters:
            own = self.nodes[-1][: shared_turns(before, path) + 1] if self.nodes else [0]
            for d in range(len(own), len(path) // TOKEN + 1):
                self.parent.append(own[-1])
                self.depth.append(d)
                self.bytes.append(int.from_bytes(path[d * TOKEN - 8: d * TOKEN], "big"))
                own.append(len(self.parent) - 1)
            self.nodes.append(own)
            before = path
        self.children = [0] * len(self.parent)
        self.bytes_below = list(self.bytes)
        for k in range(len(self.parent) - 1, 0, -1):  # children have larger numbers than their parents
            self.children[self.parent[k]] += 1
            self.bytes_below[self.parent[k]] += self.bytes_below[k]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.keys, (path, conv_id))

    def met(self, shard: int, path: bytes) -> list[int]:
        """Skeleton nodes along a path of this shard, from the root (only its two splitters can share more)."""
        best = [0]
        for k in (shard - 1, shard):
            if 0 <= k < len(self.keys):
                n = shared_turns(path, self.keys[k][0]) + 1
                if n > len(best):
                    best = self.nodes[k][:n]
        return best

    def table(self, spark) -> DataFrame:
        """One row for each skeleton node; the ends of the trie carry the nodes above them."""
        above: list[list[int] | None] = [None] * len(self.parent)
        for own in self.nodes or [[0]]:
            if not self.children[own[-1]]:
                above[own[-1]] = own
        n = len(self.parent)
        return spark.createDataFrame(pa.table({
            "node": pa.array(range(n), pa.int64()), "parent": pa.array([None, *self.parent[1:]], pa.int64()), "depth": pa.array(self.depth, pa.int64()),
            "inner": pa.array(self.children, pa.int64()), "bytes": pa.array(self.bytes_below, pa.int64()), "above": pa.array(above, pa.list_(pa.int64()))}))


def splitters(paths: DataFrame) -> list[tuple[bytes, int]]:
    """Range splitters (path, conv_id) of about equal shards, from a bounded sample."""
    total = paths.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("path") + TOKEN).alias("bytes")).first()
    if not total["n"]:
        return []
    slots = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = min(total["n"], max(slots, -(-total["bytes"] // SHARD_BYTES)))
    wanted = max(1, min(shards * SAMPLES, SAMPLE_BYTES * total["n"] // total["bytes"]))
    share = min(HASH_RANGE, wanted * HASH_RANGE // total["n"])
    rows = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(HASH_RANGE)) < share).collect()
    found = sorted((bytes(r["path"]), r["conv_id"]) for r in rows)
    shards = min(shards, len(found))
    return [found[k * len(found) // shards] for k in range(1, shards)]


class Shard:
    """Nodes of one shard while its sorted rows pass: columns by node, a stack of the nodes still open."""

    COLUMNS = ("parent", "skeleton", "depth", "bytes", "least", "convs", "children", "leaves", "saved")

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.frame = number, skeleton
        for name in self.COLUMNS:
            setattr(self, name, array("q"))
        self.digests: list[str | None] = []
        self.open: list[int] = []
        self.path: bytes | None = None
        self.ids: list[int] = []
        self.digest = None
        self.pieces: list[tuple[int, int, str]] = []

    def start(self, skeleton: int, depth: int, size: int) -> None:
        for name, value in zip(self.COLUMNS, (self.open[-1] if self.open else -1, skeleton, depth, size, 1 << 62, 0, 0, 0, 0)):
            getattr(self, name).append(value)
        self.digests.append(None)
        self.open.append(len(self.parent) - 1)

    def close(self) -> None:
        v = self.open.pop()
        own = self.skeleton[v] < 0
        if own and not self.children[v]:
            self.leaves[v] = 1
        self.saved[v] += (self.convs[v] - own) * self.bytes[v]
        if self.open:
            u = self.open[-1]
            self.least[u] = min(self.least[u], self.least[v])
            self.convs[u] += self.convs[v]
            self.children[u] += own
            self.leaves[u] += self.leaves[v]
            self.saved[u] += self.saved[v]

    def flush(self) -> None:
        """Pass on the ids that end at the present path's node."""
        if not self.ids:
            return
        v, text = self.open[-1], ",".join(map(str, self.ids))
        if self.skeleton[v] >= 0:
            self.pieces.append((self.skeleton[v], len(self.pieces), text))
        else:
            if self.digest is None:
                self.digest = hashlib.sha256()
            else:
                text = "," + text
            self.digest.update(text.encode())
        self.ids = []

    def end_path(self) -> None:
        self.flush()
        if self.digest is not None:
            self.digests[self.open[-1]] = self.digest.hexdigest()
            self.digest = None

    def add(self, path: bytes, conv_id: int) -> None:
        if path != self.path:
            keep = 0
            if self.path is not None:
                self.end_path()
                keep = shared_turns(self.path, path) + 1
            while len(self.open) > keep:
                self.close()
            met = self.frame.met(self.number, path)
            for d in range(len(self.open), len(path) // TOKEN + 1):
                self.start(met[d] if d < len(met) else -1, d, int.from_bytes(path[d * TOKEN - 8: d * TOKEN], "big") if d else 0)
            self.path = path
        v = self.open[-1]
        self.least[v] = min(self.least[v], conv_id)
        self.convs[v] += 1
        self.ids.append(conv_id)
        if len(self.ids) >= PIECE_IDS:
            self.flush()

    def finish(self) -> pa.RecordBatch:
        """Rows of finished nodes, shares of skeleton nodes and pieces of their ends."""
        if self.path is not None:
            self.end_path()
        while self.open:
            self.close()
        c = {name: np.frombuffer(getattr(self, name), np.int64) if len(self.parent) else np.zeros(0, np.int64) for name in self.COLUMNS}
        n, m = len(self.parent), len(self.pieces)
        own = c["skeleton"] < 0
        up = np.maximum(c["parent"], 0)
        shared = own & (c["skeleton"][up] >= 0)  # the parent's smallest member is known after the reduction only
        node = np.where(own, np.where(shared, c["skeleton"][up], -1), c["skeleton"])

        def column(values, mask=None):
            mask = np.append(np.zeros(n, bool) if mask is None else mask, np.ones(m, bool))
            return pa.array(np.append(values, np.zeros(m, np.int64)), pa.int64(), mask=mask)

        empty = hashlib.sha256(b"").hexdigest()
        ends = [(d or empty) if o else None for d, o in zip(self.digests, own.tolist())] + [p[2] for p in self.pieces]
        kind = np.append(np.where(own, LOCAL, SHARE), np.full(m, PIECE)).astype(np.int32)
        nodes = np.append(node, np.array([p[0] for p in self.pieces], np.int64))
        return pa.RecordBatch.from_arrays([
            pa.array(kind, pa.int32()), pa.array(nodes, pa.int64(), mask=nodes < 0), pa.array(np.full(n + m, self.number), pa.int64()),
            pa.array(np.append(np.zeros(n, np.int64), np.array([p[1] for p in self.pieces], np.int64)), pa.int64()),
            column(c["least"]), column(c["depth"]), column(c["least"][up] if n else c["least"], mask=~own | shared), column(c["convs"]), column(c["children"]),
            column(c["leaves"]), column(c["saved"]), pa.array(ends, pa.string())],
            [f.split()[0] for f in NODE_TYPE.split(", ")])


def shard_nodes(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Every shard's finished nodes, shares and pieces."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)  # one splitter a shard, within SAMPLE_BYTES

    def deal(batches):
        for batch in batches:
            numbers = [shared.value.shard(p, c) for c, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), batch.column(0), batch.column(1)], ["shard", "conv_id", "path"])

    def grow(batches):
        shard = None
        for batch in batches:
            for number, conv_id, path in zip(*(c.to_pylist() for c in batch.columns)):
                if shard is None or shard.number != number:
                    if shard is not None:
                        yield shard.finish()
                    shard = Shard(number, shared.value)
                shard.add(path, conv_id)
        if shard is not None:
            yield shard.finish()

    dealt = paths.mapInArrow(deal, "shard int, conv_id long, path binary")
    return dealt.repartitionById(len(skeleton.keys) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(grow, NODE_TYPE)


def joined_ends(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of a skeleton node's ends, streamed piece by piece in their order."""

    def run(batches):
        node = digest = None
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != node:
                    if digest is not None:
                        yield row(node, digest)
                    node, digest = own, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
        if digest is not None:
            yield row(node, digest)

    def row(node, digest):
        return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.int64()), "ends_sha256": pa.array([digest.hexdigest()], pa.string())})

    return pieces.repartition("node").sortWithinPartitions("node", "shard", "seq").select("node", "ends").mapInArrow(run, "node long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = written(conversation_paths(turns), "paths")
    skeleton = Skeleton(splitters(paths))
    rows = written(shard_nodes(paths, skeleton), "trie")
    known = skeleton.table(paths.sparkSession)
    sums = rows.where(F.col("kind") == SHARE).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    nodes = written(known.join(sums, "node"), "skeleton")
    bare = nodes.where("above is not null and n_children = 0").select(F.explode("above").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("bare"))
    ends = joined_ends(rows.where(F.col("kind") == PIECE))
    up = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.sha2(F.lit(b""), 256)
    shared = nodes.join(up, "parent", "left").join(bare, "node", "left").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_children") + F.col("inner")).alias("n_children"),
        (F.col("n_leaves") + F.coalesce("bare", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") - F.col("bytes")).alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"))
    least = bounded_broadcast(nodes.select("node", F.col("conv_id").alias("least")), checkpoint=False)
    own = rows.where(F.col("kind") == LOCAL).join(least, "node", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "least").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.col("ends").alias("ends_sha256"))
    return shared.unionByName(own)
