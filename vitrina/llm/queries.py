"""Registered queries of the llm operators: thin digests with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrina.llm import alignment, bpe, dedup, doc_rules, language, licences, nearcopies, packing, pii, prefixes, quality, suffixes, topk


def vocab_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file (installed on every worker)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    groups = dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents")).drop("n_added")


def op3_language_model(spark, sf_dir):
    return language.score_documents(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark, sf_dir):
    return suffixes.clean_digests(table(spark, sf_dir, "documents"))


def op5_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocab_path())


def op6_packing(spark, sf_dir):
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), vocab_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_quality(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash(spark, sf_dir):
    return nearcopies.classes(table(spark, sf_dir, "documents")).drop("text_key")


def op9_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_topk(spark, sf_dir):
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op11_quality_rules(spark, sf_dir):
    return doc_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_alignment(spark, sf_dir):
    return alignment.alignment_scores(table(spark, sf_dir, "documents"), vocab_path(), vocab_path("piece_bpe_32k.model"))


def op13_prefix_trie(spark, sf_dir):
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_pii, op3_language_model, op4_suffix_dedup, op5_bpe,
    op6_packing, op7_quality, op8_minhash, op9_licences, op10_topk, op11_quality_rules,
    op12_alignment, op13_prefix_trie)}

ORACLES = {
    "op1_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
""",
    "op10_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
      FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op13_prefix_trie": """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
tokens AS (SELECT conv_id, turn, left(sha256(strlen(role) || ':' || role || text), 32) || printf('%016X', strlen(text)) AS token, strlen(text) AS size FROM t),
own AS (SELECT conv_id, list(token ORDER BY turn NULLS FIRST, token) AS turns, list(size ORDER BY turn NULLS FIRST, token) AS sizes,
               xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT)),
                   lambda crc, byte: list_reduce([xor(crc, byte)] || CAST(range(8) AS UBIGINT[]),
                       lambda a, i: xor(a >> 1, CAST(3988292384 AS UBIGINT) * (a & 1))), CAST(4294967295 AS UBIGINT)), CAST(4294967295 AS UBIGINT)) % 9 AS h
        FROM tokens GROUP BY conv_id),
paths AS (SELECT o.conv_id, coalesce(b.turns[:o.h], []) || coalesce(o.turns[o.h + 1:], []) AS path,
                 coalesce(b.sizes[:o.h], []) || coalesce(o.sizes[o.h + 1:], []) AS sizes
          FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
firsts AS (SELECT conv_id, path, sizes, unnest(range(len(path) + 1)) AS depth FROM paths),
nodes AS (SELECT path[:depth] AS node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(any_value(sizes[depth]), 0) AS size,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
          FROM firsts GROUP BY path[:depth]),
children AS (SELECT node[:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.node = c.node),
below AS (SELECT node[:top] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved
          FROM (SELECT *, unnest(range(depth + 1)) AS top FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON n.node = b.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[:n.depth - 1]
""",
}
