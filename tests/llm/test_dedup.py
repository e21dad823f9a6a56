import hashlib
from collections import defaultdict

import pytest

from vitrina.llm import dedup

from .conftest import EDGE, WORDS, make_docs


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    out = []
    for i, t in rows:
        own = groups[fold(t)]
        out.append((i, max((x for x in own if x is not None), default=None), len(own), hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 2])
def test_groups_equal_brute_force(spark, bits):
    import random

    r = random.Random(5)
    base = [" ".join(r.choices(WORDS, k=n)) for n in (3, 300, 900, 2500)]
    rows = EDGE + [(100 + k, base[k % 4].upper() if k % 3 else base[k % 4]) for k in range(40)] + [(200 + k, base[3][:-k - 1] + "!") for k in range(5)]
    got = dedup.exact_groups(make_docs(spark, rows), hash_bits=bits).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows)
    # one row of each group stays, one with the largest id
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_chunks_join_to_the_text(spark, edge_docs):
    from pyspark.sql import functions as F

    text = F.coalesce("text", F.lit(""))
    bad = edge_docs.where(F.array_join(dedup.chunked(text), "") != text)
    assert bad.count() == 0


def test_kept_documents_and_empty_table(spark, edge_docs, no_docs):
    kept = dedup.keep_exact(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({fold(t) for _, t in EDGE})
    assert dedup.exact_groups(no_docs).count() == 0 and dedup.keep_exact(no_docs).count() == 0


def test_no_python_in_the_plan(spark, edge_docs):
    plan = dedup.exact_groups(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rows_stay_whole_whatever_their_columns_are_called(spark):
    from vitrina.llm import nearcopies

    text = " ".join(WORDS * 3)
    rows = [(1, "One", "k1", 1, "a"), (2, text, "k2", 2, "b"), (2, text, "k0", 3, "c"), (2, text.upper(), None, 4, "d"), (None, "", "k4", 5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, row int, key string")
    for keep in (dedup.keep_exact, nearcopies.keep_first):
        for parts in (1, 4):
            out = keep(docs.repartition(parts))
            assert out.columns == docs.columns
            got = {r["doc_id"]: tuple(r) for r in out.collect()}
            assert set(got) == {1, 2, None} and got[1] == rows[0] and got[None] == rows[4]
            assert got[2] in rows
    # of equal rows the smallest by the other columns in order
    same = spark.createDataFrame([r for r in rows[1:3]], docs.schema)
    assert {tuple(r) for keep in (dedup.keep_exact, nearcopies.keep_first) for r in keep(same.repartition(3)).collect()} == {rows[2]}
