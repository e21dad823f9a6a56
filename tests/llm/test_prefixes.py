import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from vitrina.llm import prefixes

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def token(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).digest()[:16], len(text)


def brute(rows):
    """All nodes from plain prefix sets."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, token(role, text)))
    convs = {c: [t[2] for t in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        home = int(c - (abs(c) % 5) * (1 if c >= 0 else -1))
        paths[c] = tuple(convs.get(home, [])[:h] + convs[c][h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * (p[-1][1] if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows, parts=3):
    """With columns whose names the operator uses inside."""
    data = [(*r, "x", b"y", -1, "z") for r in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, home string, path binary, shard int, node string").repartition(parts)


def result(turns):
    return sorted((tuple(r) for r in prefixes.prefix_trie(turns).select(*COLUMNS).collect()), key=str)


EDGE = [(None, 0, "user", "no id"), (None, None, None, None), (1, None, None, None), (1, None, None, None), (1, 3, "user", "é\U0001f600"), (1, 3, "user", "a"),
        (1, 3, None, "a"), (2, 0, "", ""), (2, 1, "user", "x" * 50_000), (-3, 0, "user", "hello"), (-3, 1, "a", "b"), (-4, 2, "user", "hello"), (0, 0, "user", "hello"),
        (2 ** 40, 7, "user", "hello"), (4, 0, "us", "erhello"), (4, 0, "us", "erhello")]


def test_edge_rows_equal_brute_force(spark):
    assert result(conversations(spark, EDGE)) == brute(EDGE)


def test_empty_table_has_no_nodes(spark):
    assert result(conversations(spark, EDGE).where("1 = 0")) == []


def test_one_turnless_conversation_is_the_root(spark):
    only = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(only, 0, "user", "gone")]
    assert result(conversations(spark, rows)) == brute(rows)
    assert result(conversations(spark, rows))[0][:7] == (only, 0, None, 1, 0, 1, 0)


@pytest.mark.parametrize("seed,shards", [(1, 2), (2, 13), (3, 40)])
def test_shards_and_hot_paths_equal_brute_force(spark, monkeypatch, seed, shards):
    draw = random.Random(seed)
    rows = []
    for c in range(260):
        kind = draw.random()
        if kind < 0.35:  # one conversation, very often
            rows += [(c, t, "user", f"common {t}") for t in range(12)]
        else:
            rows += [(c, t, draw.choice(["user", "assistant"]), draw.choice("ab") * draw.randint(0, 1 + t)) for t in range(draw.randint(0, 14))]
    monkeypatch.setattr(prefixes, "SHARD_BYTES", 1)
    turns = conversations(spark, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        assert result(turns) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ends_in_pieces(monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE_IDS", 7)
    path = b"a" * 16 + (3).to_bytes(8, "big")
    other = path + b"b" * 16 + (4).to_bytes(8, "big")
    skeleton = prefixes.Skeleton([(path, 20), (path, 40)])
    shard = prefixes.Shard(1, skeleton)
    for c in range(20, 40):
        shard.add(path, c)
    assert [p[0] for p in shard.pieces] == [1, 1]
    rows = shard.finish().to_pylist()
    assert ",".join(r["ends"] for r in sorted((r for r in rows if r["kind"] == prefixes.PIECE), key=lambda r: r["seq"])) == ",".join(map(str, range(20, 40)))
    assert {(r["node"], r["n_convs"]) for r in rows if r["kind"] == prefixes.SHARE} == {(0, 20), (1, 20)}
    local = prefixes.Shard(2, skeleton)
    for c in range(50, 90):
        local.add(other, c)
    (row,) = [r for r in local.finish().to_pylist() if r["kind"] == prefixes.LOCAL]
    assert row["ends"] == hashlib.sha256(",".join(map(str, range(50, 90))).encode()).hexdigest() and row["n_convs"] == 40


def test_long_conversation(spark):
    rows = [(5, t, "user", str(t)) for t in range(700)] + [(6, t, "user", str(t)) for t in range(650)] + [(7, t, "user", str(t % 3)) for t in range(500)]
    assert result(conversations(spark, rows)) == brute(rows)


def test_families_that_span_batches(spark):
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(50) for t in range(9)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert result(conversations(spark, rows, 1).where(F.col("conv_id") >= 0)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
