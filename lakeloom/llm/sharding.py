"""Placement of documents by a hierarchical weighted hash tree.

A document descends from the root over regions and racks to a shard. On every
level each child draws a number from the hash of the document's id and the
child's name, scaled by the child's weight, and the highest draw wins. A child
whose weight stays the same draws the same numbers, so that a change of weight
moves documents only into or out of the subtree it belongs to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import documents, text_of
from lakeloom.session import materialise

#: Shards of a rack and racks of a region in the default tree, and rows (about) that one task numbers.
RACK_SHARDS, REGION_RACKS, NUMBER_ROWS = 4, 2, 1_000_000
SHARDS = 16


def tree(shards: int, base: int = SHARDS) -> dict[str, dict[str, dict[int, float]]]:
    """region -> rack -> {shard: weight}. The first ``base`` shards fill racks and regions.

    Every shard after them opens a region of its own: the subtrees that were
    there keep their weights, and only the new one draws documents.
    """
    out: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        rack = shard // RACK_SHARDS
        region, rack = (f"r{rack // REGION_RACKS}", f"k{rack}") if shard < base else (f"new{shard}", f"new{shard}")
        out.setdefault(region, {}).setdefault(rack, {})[shard] = 1.0
    return out


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, path: str, weight: float) -> Column:
    """ln(u) / weight for a uniform u of (0, 1) that key and path decide: its maximum falls to a child by its weight."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11).cast("double")
    return F.log((bits + 0.5) / float(1 << 53)) / weight


def place(key: Column, node, path: str = "") -> Column:
    """The shard under ``node`` that the key draws. Children without weight draw nothing; ties fall to the first name."""
    if not isinstance(node, dict):
        raise ValueError("a tree has children")
    children = [(name, child) for name, child in node.items() if _weight(child) > 0]
    if not children:
        raise ValueError(f"nothing has weight under {path or 'the root'}")
    draws = [_draw(key, f"{path}/{name}", _weight(child)) for name, child in children]
    targets = [place(key, child, f"{path}/{name}") if isinstance(child, dict) else F.lit(name)
               for name, child in children]
    if len(children) == 1:
        return targets[0]
    best = F.greatest(*draws)
    return reduce(lambda rest, pair: F.when(pair[0] == best, pair[1]).otherwise(rest),
                  list(zip(draws, targets))[-2::-1], targets[-1])


def numbered(rows: DataFrame, shard: str, order: list[str], out: str, chunks: int) -> DataFrame:
    """Add a gapless number from 0 within each shard.

    A shard is cut into ``chunks`` by the hash of its order columns; the rows of
    a chunk are numbered in one task, and chunks follow one another.
    """
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    sizes = rows.groupBy(shard, "_chunk").agg(F.count("*").alias("_rows"))
    # shards x chunks rows of three numbers.
    before = sizes.select(shard, "_chunk", (F.sum("_rows").over(Window.partitionBy(shard).orderBy("_chunk"))
                                            - F.col("_rows")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(shard, "_chunk").orderBy(*order)) - 1
    return (rows.withColumn("_local", local).join(F.broadcast(before), [shard, "_chunk"])
            .withColumn(out, (F.col("_before") + F.col("_local")).cast("long")).drop("_chunk", "_before", "_local"))


def assign(docs: DataFrame, shards: int = SHARDS, layout: dict | None = None, grown: dict | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs`` (doc_id, text).

    The law is ``key``: doc_id and the tree decide. Size is the text's bytes in
    UTF-8 plus 1 (null: 1, with the checksum of the empty text). Rows with the
    same doc_id, null included, go to the same shard and take slots of their
    own. An empty table gives no rows; other columns are ignored.
    """
    key = F.col("doc_id")
    rows = docs.select(
        "doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        place(key, layout or tree(shards)).cast("int").alias("shard"),
        place(key, grown or tree(shards + 1)).cast("int").alias("grown_shard"))
    rows = materialise(rows, "placed")
    chunks = max(4, -(-rows.count() // NUMBER_ROWS))
    # A doc_id that very many rows share is spread by what else tells rows apart.
    return numbered(rows, "shard", ["doc_id", "size", "text_crc32"], "slot", chunks).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir))
