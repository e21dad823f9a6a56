import zlib

import numpy as np
import pytest

import corpus_pipeline
from vitrina.llm import packing, quality
from vitrina.llm.queries import table

from .test_bpe import reference  # noqa: F401
from .test_dedup import fold
from .test_nearcopies import bag, similar
from .test_packing import check_layout
from .test_pii import brute as spans
from tests.conftest import SMALL


def near_classes(rows):
    bags = [bag(t) for _, t in rows]
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if similar(bags[i], bags[j]):
                head[root(i)] = root(j)
    out = {}
    for k, (i, _) in enumerate(rows):
        out.setdefault(root(k), []).append(i)
    return list(out.values())


def test_stages_equal_brute_force(spark, reference):  # noqa: F811
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    good = {r.doc_id for r in quality.score_documents(docs, table(spark, SMALL, "labels")).where("predicted = 1").collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    one = corpus_pipeline.quality_stage(spark, docs, SMALL)
    assert one.columns == columns and {r.doc_id: r.text for r in one.collect()} == rows
    by_text = {}
    for i, t in rows.items():
        by_text[fold(t)] = max(i, by_text.get(fold(t), i))
    two = corpus_pipeline.exact_stage(spark, one, SMALL)
    rows = {i: rows[i] for i in by_text.values()}
    assert two.columns == columns and {r.doc_id: r.text for r in two.collect()} == rows
    keep = {min(own) for own in near_classes(list(rows.items()))}
    three = corpus_pipeline.near_stage(spark, two, SMALL)
    rows = {i: rows[i] for i in keep}
    assert three.columns == columns and {r.doc_id: r.text for r in three.collect()} == rows
    four = corpus_pipeline.pii_stage(spark, three, SMALL)
    clean = {r.doc_id: r.text for r in four.collect()}
    assert four.columns == columns and clean.keys() == rows.keys()
    assert all(not spans(t) for t in clean.values())
    assert all(clean[i] == t for i, t in rows.items() if not spans(t) and "[" not in clean[i])
    assert [r for r in four.collect() if r.text is not None and "[" in r.text and r.n_chars != len(r.text)] == []
    five = corpus_pipeline.packing_stage(spark, four, SMALL).collect()
    want = []
    for i, t in clean.items():
        ids = [*reference.encode(t, add_special_tokens=False).ids, 2]
        want += [(i, k, s, n, zlib.crc32(np.array(ids[s: s + n], "<u4").tobytes())) for k, (s, n) in enumerate(packing.piece_bounds(len(ids), 1024))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in five) == sorted(want)
    check_layout([(r.sequence_id, r.offset, r.length) for r in five], 1024)
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in five)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_edge_rows(spark, edge_docs, no_docs, stage):
    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, edge_docs, SMALL)
    assert out.count() > 0 or stage == 0
    if stage < 4:
        assert out.columns == edge_docs.columns
    assert f(spark, no_docs, SMALL).count() == 0


def test_kinds_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 11))
