"""Exact dedup with content-defined chunk recipes, in DataFrame operations only.

A normalised text is cut where its own bytes say so: after at least
``MIN_CHUNK`` characters at the next boundary pattern, at ``MAX_CHUNK`` at the
latest. Chunks are deduplicated by hash and content, which verifies the hash
as the chunk's identifier; chunks that share a hash but not the content get a
rank as well. Documents are then compared by their ordered identifier lists,
so a long text moves once, as chunks, and copies of a chunk in one task are
combined before the shuffle.

Defined results: a null text is empty, and empty texts are equal; texts are
equal if they are identical after lower-casing A-Z only; the row with the
largest doc_id stays (a null doc_id counts as smallest); rows that repeat a
doc_id and its text are one group of which exactly one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.shared import id_text, keep_rows, written

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: A chunk ends behind one of these character pairs (about one position in a hundred of prose).
BOUNDARY = r"(?<=[aeiou][ \n.,;]|[0-9][0-9]|[<>{}()\[\]=|/\\]{2})(?<=[aiu.0-9<{(=|/].)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    return rf"(?s).{{{least},{most}}}?(?:{BOUNDARY})|.{{1,{most}}}"


def chunked(text):
    """The chunks of a text; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern()), F.lit(0))


def chunk_hash(chunk, hash_bits: int = 64):
    """A chunk's hash. Fewer bits force collisions, for tests."""
    h = F.xxhash64(chunk)
    return h if hash_bits >= 64 else h.bitwiseAND(F.lit((1 << hash_bits) - 1))


def exact_groups(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    normal = id_text(docs).select("doc_id", F.translate("text", UPPER, LOWER).alias("text"))
    cut = normal.select("doc_id", F.sha2("text", 256).alias("text_sha256"), chunked(F.col("text")).alias("chunks"))
    recipes = cut.select("doc_id", "text_sha256", F.transform("chunks", lambda c: chunk_hash(c, hash_bits)).alias("recipe"))
    recipes = written(recipes.withColumn("row", F.monotonically_increasing_id()), "recipes")

    # distinct chunks: the content travels once, combined in each task first
    chunks = normal.select(F.explode(chunked(F.col("text"))).alias("chunk"))
    distinct = chunks.select(chunk_hash(F.col("chunk"), hash_bits).alias("h"), "chunk").groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("n"))
    # a hash with several contents is no identifier yet
    unclear = written(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("h"), "unclear")
    if not unclear.isEmpty():
        recipes = written(ranked_recipes(normal, recipes, unclear, hash_bits), "recipes")
    else:
        recipes = recipes.withColumn("recipe", F.transform("recipe", lambda h: F.struct(h.alias("h"), F.lit(0).alias("rank"))))

    key = [F.xxhash64("recipe").alias("k1"), F.hash("recipe").alias("k2")]
    last = F.max(F.struct("doc_id", (-F.col("row")).alias("minus_row")))
    groups = recipes.select(*key, "recipe", "doc_id", "row").groupBy("k1", "k2", "recipe").agg(F.count(F.lit(1)).alias("group_size"), last.alias("last"))
    groups = written(groups.where("group_size > 1"), "groups")  # a bare table: AQE can split a hot group's join
    g = groups.select("k1", "k2", F.col("recipe").alias("same"), "group_size", "last")
    d = recipes.select(*key, "recipe", "doc_id", "row", "text_sha256").alias("d")
    joined = d.join(g, (F.col("d.k1") == g["k1"]) & (F.col("d.k2") == g["k2"]) & (F.col("d.recipe") == g["same"]), "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "d.doc_id",
        F.when(alone, F.col("d.doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("last.minus_row") == -F.col("row"))).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"))


def ranked_recipes(normal: DataFrame, recipes: DataFrame, unclear: DataFrame, hash_bits: int) -> DataFrame:
    """Recipes of (hash, rank): chunks with an unclear hash are ranked by content."""
    pos = normal.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.posexplode(chunked(F.col("text"))).alias("pos", "chunk"))
    pos = pos.withColumn("h", chunk_hash(F.col("chunk"), hash_bits)).join(unclear, "h")
    content = pos.groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("n"))
    content = written(content.withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("chunk"))).drop("n"), "contents")
    # a document is named by (doc_id, digest) here; rows that share both have the same chunks
    own = pos.join(content, ["h", "chunk"]).select("doc_id", "text_sha256", "pos", "rank").distinct()
    own = own.groupBy("doc_id", "text_sha256").agg(F.map_from_entries(F.collect_list(F.struct("pos", "rank"))).alias("ranks"))
    out = recipes.alias("r").join(own.alias("o"), F.col("r.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("r.text_sha256") == F.col("o.text_sha256")), "left")
    recipe = F.transform("recipe", lambda h, i: F.struct(h.alias("h"), F.coalesce(F.try_element_at("ranks", i), F.lit(0)).alias("rank")))
    return out.select("r.doc_id", "r.text_sha256", recipe.alias("recipe"), "row")


def keep_exact(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns (of equal rows one)."""
    kept = exact_groups(docs).where("kept")
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), 256)
    return keep_rows(docs, digest, kept.select("doc_id", F.col("text_sha256").alias("digest")))
