import random
import zlib

import numpy as np

from vitrina.llm import quality
from vitrina.llm.queries import table

from .conftest import EDGE, WORDS, make_docs
from tests.conftest import MEDIUM


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def corpus(n=400):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text = " ".join("".join(r.choices(WORDS, k=2)) for _ in range(r.randrange(20, 80)))
        bad = i % 4 == 0
        if bad:
            text = " ".join(w + r.choice(["&&&", "###"]) for w in text.split()) if i % 8 else " ".join(w for w in text.split() for _ in range(6))
        rows.append((i, text))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(make_docs(spark, rows), lab).collect()
    want = {i: y for i, y, _ in labels}
    own = [r for r in got if r.held_out]
    assert {r.doc_id for r in own} == {i for i in want if held(i)} and len(got) == len(rows)
    assert np.mean([r.predicted == want[r.doc_id] for r in own]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_given_labels_held_out_accuracy(spark):
    lab = table(spark, MEDIUM, "labels")
    got = quality.score_documents(table(spark, MEDIUM, "documents"), lab).where("held_out").join(lab, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.95


def test_held_out_labels_have_no_influence(spark):
    rows, labels = corpus(120)
    docs = make_docs(spark, rows)
    one = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    other = spark.createDataFrame([(i, 1 - y if held(i) else y, 1) for i, y, _ in labels], "doc_id long, quality int, toxic int")
    assert sorted(quality.score_documents(docs, one).collect()) == sorted(quality.score_documents(docs, other).collect())


def test_edge_rows_and_missing_labels(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.score_documents(edge_docs, none).collect()
    assert len(got) == len(EDGE) and {r.score for r in got} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_documents(edge_docs, ones).collect()} == {1.0}
    assert quality.score_documents(no_docs, ones).count() == 0
    kept = quality.keep_good(edge_docs, ones)
    assert kept.columns == edge_docs.columns and kept.count() == len(EDGE)


def test_mean_of_vectors_equals_a_plain_loop():
    texts = ["alpha beta alpha", "", "beta beta beta gamma"]
    value = np.random.default_rng(0).normal(size=quality.BUCKETS + quality.DISTANCES)
    block = quality.Block(texts)
    plain = [float(share @ value[found]) if len(found) else 0.0 for found, share in block.documents()]
    assert np.allclose(block.means(value), plain, atol=1e-6)


def test_four_thousand_labelled_rows_are_used(spark):
    n = 6_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality", "0 AS toxic")
    assert quality.training_rows(docs, labels).count() == 4_000


def test_counts_keep_their_values_in_few_bytes():
    texts = ["a " * 70_000 + "b", "", "alpha beta alpha"]
    block = quality.Block(texts)
    for (found, count), (same, share) in zip(block.counts(), block.documents()):
        assert np.array_equal(found, same) and np.array_equal(quality.shares(count), share)
        assert count.dtype == (np.uint32 if len(found) and count.max() > 65_535 else np.uint8)
    assert next(block.counts())[1].max() >= 69_999
