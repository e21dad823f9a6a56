import random
import re

import numpy as np
import pytest

from vitrina.llm import doc_rules

from .conftest import make_docs


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    found = {}
    for k in range(len(words) - 2):
        found.setdefault(tuple(words[k: k + 3]), []).append(k)
    covered = {k + j for at in found.values() if len(at) > 1 for k in at for j in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, score string")


DRAW = random.Random(5)
PLAIN = [(k, " ".join("".join(DRAW.choice("abcdefghinorstu") for _ in range(DRAW.randint(2, 8))) + DRAW.choice(["", "", ",", "."]) for _ in range(90))) for k in range(60)]
JUNK = [(100 + k, " ".join(f"w{k}a{j}{'#' * (1 + j % 3)} | <x{j}>" for j in range(40))) for k in range(60)]
LABELS = [(i, 1, 0, "t", "s") for i, _ in PLAIN] + [(i, 0, 0, "t", "s") for i, _ in JUNK]


def texts(seed):
    draw = random.Random(seed)
    for _ in range(120):
        parts = ["a", "b", "é", "#", "|x", "\n", "\n\n", " ", "\t", "\x0b", "\x0c", "\r", "\x85", " ", "\xa0", "中", "\U0001f600", "a b c\n"]
        yield "".join(draw.choice(parts) for _ in range(draw.choice([0, 3, 30, 300])))


@pytest.mark.parametrize("seed", range(4))
def test_counts_equal_brute_force(seed):
    for text in texts(seed):
        assert doc_rules.describe(text)[0] == brute(text)[:5], repr(text)


def test_windows_of_very_many_words_do_not_collide():
    words = np.array([5, 9, (1 << 22) - 1, 7, 5, 9, (1 << 22) - 1, 3])
    assert doc_rules.repeated_words(words, 1 << 22) == 6
    assert doc_rules.repeated_words(words[:6], 1 << 22) == 0


def test_edge_rows(spark, edge_docs):
    got = doc_rules.judge_documents(edge_docs, labels(spark, LABELS)).collect()
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in edge_docs.collect()), key=str)
    assert sorted(((r["doc_id"], *(r[c] for c in doc_rules.COUNTS), r["base_failed"]) for r in got), key=str) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_learned_verdict_on_unseen_rows(spark):
    unseen = [(i + 1000, t.replace("a", "o")) for i, t in PLAIN] + [(i + 1000, t.replace("w", "v")) for i, t in JUNK]
    docs = make_docs(spark, PLAIN + JUNK + unseen)
    conflict = [(0, None, 0, "", ""), (None, 1, 0, "", ""), (1, 7, 0, "", "")]
    got = {r["doc_id"]: r for r in doc_rules.judge_documents(docs, labels(spark, LABELS + conflict)).collect()}
    assert all(got[i + 1000]["kept"] for i, _ in PLAIN)
    assert not any(got[i + 1000]["kept"] for i, _ in JUNK) and not any(got[i + 1000]["base_failed"] for i, _ in JUNK)
    again = {r["doc_id"]: r["score"] for r in doc_rules.judge_documents(docs.repartition(5), labels(spark, LABELS + conflict).repartition(4)).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


@pytest.mark.parametrize("own,score", [([], 0.5), ([(0, 1, 0, "", "")], 1.0), ([(0, 0, 0, "", "")], 0.0)])
def test_labels_of_one_class_or_none(spark, own, score):
    got = doc_rules.judge_documents(make_docs(spark, PLAIN), labels(spark, own)).collect()
    assert {r["score"] for r in got} == {score} and all(r["kept"] == (score >= doc_rules.THRESHOLD) for r in got)


def test_empty_table(spark, no_docs):
    assert doc_rules.judge_documents(no_docs, labels(spark, LABELS)).collect() == []


def walk(forest, row):
    """Sum of the leaves by plain recursion."""
    def value(at):
        if forest.left[at] == at:
            return forest.value[at]
        return value(forest.left[at] if row[forest.feature[at]] <= forest.cut[at] else forest.right[at])
    return forest.base + sum(value(r) for r in forest.roots)


def test_flat_arrays_equal_recursion_and_scores_fall_with_named_statistics():
    draw = np.random.default_rng(3)
    x = draw.random((900, len(doc_rules.STATISTICS)))
    f = [doc_rules.STATISTICS.index(s) for s in doc_rules.FALLING]
    y = ((np.sin(9 * x[:, f[0]]) + x[:, 0] + 0.5 * draw.random(900)) > 0.9).astype(float)  # rises and falls with it
    forest = doc_rules.grow(x, y)
    assert np.allclose(forest.margin(x[:50]), [walk(forest, r) for r in x[:50]])
    for k in f:
        grid = np.repeat(x[:40], 60, axis=0)
        grid[:, k] = np.tile(np.linspace(-0.1, 1.1, 60), 40)
        assert (np.diff(forest.margin(grid).reshape(40, 60), axis=1) <= 1e-12).all()
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.75


def test_held_out_accuracy_on_the_given_table(spark):
    docs, own = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    forest = doc_rules.fit(docs, own.where("doc_id % 4 <> 1"))
    held = doc_rules.judge(docs, forest).join(own.where("doc_id % 4 = 1"), "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in held]) >= 0.98
    assert np.mean([r["kept"] for r in held if r["quality"] == 1]) >= 0.99
