"""Exact duplicates by deterministic block naming.

A text is cut into blocks of fixed size. Distinct blocks are sorted and take
their rank as an integer name; then adjacent names of a text are paired,
distinct pairs are sorted and named again, until one name is left. Two texts
have the same name on the same level if and only if they are equal: blocks
are told apart by content, pairs by both names.

Only distinct blocks are shuffled with their content. Rows of a text carry a
64-bit hash of each block; where one hash has several contents (which is
looked up, not assumed), the content decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import DOCUMENT_COLUMNS, SPACE, by_row, documents, sorted_names, text_of, with_row
from lakeloom.session import materialise

BLOCK_CHARS = 4096


def _blocks(docs: DataFrame, block_chars: int, hash_bits: int) -> DataFrame:
    """Row number, id, sizes and the blocks of the normalised text, one (empty) block for an empty text."""
    blocks = F.regexp_extract_all("_norm", F.lit("(?s).{1,%d}" % block_chars), 0)
    keep = F.lit(-1 if hash_bits == 64 else (1 << hash_bits) - 1).cast("long")
    return (with_row(docs.select("doc_id", text_of().alias("_text")), "_row")
            .withColumn("_norm", F.regexp_replace("_text", SPACE + "+", ""))
            .withColumn("_blocks", F.when(F.col("_norm") == "", F.array(F.lit(""))).otherwise(blocks))
            .withColumn("_hashes", F.transform("_blocks", lambda b: F.xxhash64(b).bitwiseAND(keep))))


def name_texts(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64) -> DataFrame:
    """(_row, doc_id, n_points, text_sha256, level, name): equal texts, and only these, share (level, name).

    ``docs`` has doc_id and text and is read twice, so it must be a stored
    table. ``hash_bits`` below 64 makes the hashes of blocks collide (tests).
    """
    cut = _blocks(docs, block_chars, hash_bits)
    rows = materialise(cut.select("_row", "doc_id", F.length("_text").alias("n_points"),
                                  F.sha2("_norm", 256).alias("text_sha256"), "_hashes"), "rows")
    # Distinct contents; copies of a hot block are folded by the task that reads them.
    contents = (cut.select(F.explode(F.arrays_zip("_hashes", "_blocks")).alias("z"))
                .select(F.col("z._hashes").alias("h"), F.col("z._blocks").alias("block")).distinct())
    per_hash = materialise(contents.groupBy("h").agg(F.count("*").alias("contents")), "block-hashes")
    parts = rows.select("_row", F.size("_hashes").alias("_n"), F.posexplode("_hashes").alias("_pos", "h"))
    if per_hash.where("contents > 1").isEmpty():
        names = sorted_names(per_hash, ["h"], "name")
        named = parts.join(names, "h")
    else:
        clash = materialise(per_hash.where("contents > 1").select("h"), "clashes")
        order = contents.join(clash, "h").select(
            "h", "block", F.row_number().over(Window.partitionBy("h").orderBy("block")).alias("k"))
        order = materialise(order, "clash-contents")
        keys = per_hash.where("contents = 1").select("h", F.lit(0).alias("k")).union(order.select("h", "k"))
        names = sorted_names(keys, ["h", "k"], "name")
        # The texts with such a hash are read once more, now with the contents at hand.
        exact = (cut.select("_row", F.posexplode(F.arrays_zip("_hashes", "_blocks")).alias("_pos", "z"))
                 .select("_row", "_pos", F.col("z._hashes").alias("h"), F.col("z._blocks").alias("block"))
                 .join(order, ["h", "block"]).select("_row", "_pos", "k"))
        named = (parts.join(exact, ["_row", "_pos"], "left").withColumn("k", F.coalesce("k", F.lit(0)))
                 .join(names, ["h", "k"]))
    current = materialise(named.select("_row", "_n", "_pos", "name"), "named")
    last = current.agg(F.max("_n")).first()[0] or 1
    level, done = 0, [current.where("_n = 1").select("_row", F.lit(0).alias("level"), "name")]
    width = 1
    while width < last:
        level, width = level + 1, width * 2
        pairs = (current.where(F.col("_n") > width // 2)
                 .groupBy("_row", "_n", F.shiftright("_pos", 1).alias("_pos"))
                 .agg(F.max(F.when(F.col("_pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("_pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")))
        pairs = materialise(pairs, "pairs")
        names = sorted_names(pairs.select("a", "b").distinct(), ["a", "b"], "name")
        current = materialise(pairs.join(names, ["a", "b"]).select("_row", "_n", "_pos", "name"), "named")
        done.append(current.where(F.col("_n") <= width).select("_row", F.lit(level).alias("level"), "name"))
    named = done[0]
    for more in done[1:]:
        named = named.union(more)
    return rows.drop("_hashes").join(named, "_row")


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the row number ``_row``.

    Equal texts are identical after deleting white space; null counts as
    empty, and empty texts form one group. Of a group the row with the most
    code points stays, then the smallest doc_id (null last), then the first
    row, so that of repeated rows exactly one stays. An empty table gives no
    rows; further columns are ignored.
    """
    named = materialise(name_texts(docs, block_chars, hash_bits), "texts")
    first = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("z"),
                           F.col("doc_id").alias("doc_id"), F.col("_row").alias("row")))
    groups = named.groupBy("level", "name").agg(first.alias("first"), F.count("*").alias("group_size"))
    groups = materialise(groups, "groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("first.row")).alias("kept"), "text_sha256", "_row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (a stored table) that stay, with all their columns."""
    dropped = materialise(exact_groups(docs).where("not kept").select("_row"), "dropped")
    return by_row(with_row(docs, "_row"), dropped, "left_anti").drop("_row")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).drop("_row")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs).select(*DOCUMENT_COLUMNS)


_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')"
SQL = f"""
WITH d AS (SELECT doc_id, {_NORM} AS norm, length(coalesce(text, '')) AS n FROM documents),
g AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g"""
