"""Line dedup by pairwise alignment.

Documents that share a line are brought together: each one with the first
document that has the line, if it is rare or long, and with the first one that
has it together with the line after it. The lines of a pair are aligned with
patience diff, and blocks that both have in the same order are deleted from
the later document. A rare or long line that an earlier document has goes
wherever it stands; only common short lines must stand in a block.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import documents, small_batches, text_of, with_row
from lakeloom.session import materialise

#: Documents that a rare line has at most, code points of a long line, and lines of a block of common short lines at least.
RARE_DOCS, LONG_CHARS, BLOCK_LINES = 50, 32, 2


def places_of(lines: list, among: Iterable[int]) -> dict[Hashable, list[int]]:
    """Each line with its places."""
    out = {}
    for i in among:
        out.setdefault(lines[i], []).append(i)
    return out


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned equal places (i, j) of two rows of lines, both ascending.

    Equal ends are matched first, then lines that occur once on either side,
    by their longest ascending sequence; the stretches between are aligned in
    the same way. In a stretch without such a line the n-th one of a line goes
    with its n-th on the other side. A stack stands for the recursion.
    """
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once = Counter(a[a0:a1])
        there = Counter(b[b0:b1])
        at = {b[j]: j for j in range(b0, b1) if there[b[j]] == 1}
        pairs = [(i, at[a[i]]) for i in range(a0, a1) if once[a[i]] == 1 and a[i] in at]
        if not pairs:
            places, seen = places_of(b, range(b0, b1)), Counter()
            for i in range(a0, a1):
                if seen[a[i]] < len(places.get(a[i], ())):
                    pairs.append((i, places[a[i]][seen[a[i]]]))
                    seen[a[i]] += 1
        if not pairs:
            continue
        tops, piles, back = [], [], []
        for n, (_, j) in enumerate(pairs):
            k = bisect_left(tops, j)
            back.append(piles[k - 1] if k else -1)
            if k == len(tops):
                tops.append(j)
                piles.append(n)
            else:
                tops[k], piles[k] = j, n
        chain, n = [], piles[-1]
        while n >= 0:
            chain.append(pairs[n])
            n = back[n]
        edges = [(a0 - 1, b0 - 1), *reversed(chain), (a1, b1)]
        out += chain
        stack += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


def neighbours(lines: list[int], size: int) -> Iterator[tuple[tuple[int, ...], list[int]]]:
    """Each ``size`` lines in a row that are not blank (false) with the numbers of blank lines between them, and their places."""
    full = [i for i, x in enumerate(lines) if x]
    for k in range(len(full) - size + 1):
        at = full[k:k + size]
        yield (*(lines[i] for i in at), *(j - i for i, j in zip(at, at[1:]))), at


def aligned_again(a: list, b: list) -> Iterator[int]:
    """Places of ``a`` that are aligned with ``b`` in one of many rounds, each without what the rounds before aligned.

    Where a round aligns less than half of its part, the two halves of the rest
    are aligned apart from each other, so that rows in reversed order do not
    take a round each. A round meets as many of the equal places of ``b`` as
    its part has, from the front.
    """
    there = places_of(b, range(len(b)))
    parts = [[i for i, x in enumerate(a) if x in there]]
    while parts:
        part = parts.pop()
        near = sorted(j for x, n in Counter(a[i] for i in part).items() for j in there[x][:n])
        found = {i for i, _ in patience([a[i] for i in part], [b[j] for j in near])}
        yield from (part[n] for n in found)
        rest = [i for n, i in enumerate(part) if n not in found]
        cut = len(rest) if 2 * len(found) >= len(part) else len(rest) // 2
        if len(part) > 1:
            parts += [half for half in (rest[:cut], rest[cut:]) if half]


def common_blocks(a: list[int], b: list[int], least: int = BLOCK_LINES, alone: Iterable[int] = ()) -> list[int]:
    """Places in ``a`` of the aligned blocks with at least ``least`` neighbouring lines that are not blank (false).

    The first alignment is that of the lines. The later ones align blocks: each
    ``least`` lines in a row (two at least) that are not blank, and each of the lines ``alone``.
    """
    places, block = set(), []
    for i, j in patience(a, b) + [(-9, -9)]:
        if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(bool(a[x]) for x, _ in block) >= least:
                places.update(x for x, _ in block)
            block = []
        block.append((i, j))
    size, single = max(least, 2), set(alone)
    # A block that lies in what is deleted needs no other place.
    mine, theirs = ([(key, at) for key, at in blocks(lines, size, single) if lines is b or not places.issuperset(at)]
                    for lines in (a, b))
    for n in aligned_again([key for key, _ in mine], [key for key, _ in theirs]):
        at = mine[n][1]
        places.update(range(at[0], at[-1] + 1))
    return sorted(places)


def blocks(lines: list[int], size: int, single: set[int]) -> Iterator[tuple[tuple[int, ...], list[int]]]:
    """The lines of ``single`` and each ``size`` neighbours, with their places."""
    yield from (((x,), [i]) for i, x in enumerate(lines) if x in single)
    yield from neighbours(lines, size)


def repeated_lines(docs: DataFrame, rare_docs: int | None = None, least: int | None = None) -> DataFrame:
    """(_row, partners, places): lines (from 0) of the rows of ``docs`` (a stored table) that go, and partners looked at.

    Lines end at a line feed; white space at their ends does not count, and
    blank lines only count inside a block. Earlier is a smaller doc_id (null
    last), then an earlier row. Of documents with the same lines the first one
    is aligned for all; from the others everything goes. Null and empty texts
    have one blank line and are left alone. Lines are compared by a hash of 63
    bits and by whether they are long.

    Lines of at most RARE_DOCS documents and long ones count alone, others in
    blocks of BLOCK_LINES. ``rare_docs`` replaces the first rule by a bound
    without regard to length, and lines up to it then find partners only
    alone; ``least`` holds for the blocks of all lines.
    """
    small_batches(docs.sparkSession)
    trimmed = F.transform(F.split(text_of(), "\n", -1), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")))
    lines = F.transform(trimmed, lambda x: F.when(x == "", F.lit(0)).otherwise(
        F.xxhash64(x).bitwiseAND(F.lit(-2)) + (F.length(x) >= LONG_CHARS).cast("long")))
    rows = materialise(with_row(docs.select("doc_id", "text"), "_row").select(
        "_row", "doc_id", lines.alias("lines")).where(F.exists("lines", lambda h: h != 0))
        .withColumn("digest", F.sha2(F.array_join(F.transform("lines", lambda h: h.cast("string")), ","), 256)), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("_row").alias("r"))
    firsts = materialise(rows.groupBy("digest").agg(F.min(order).alias("o")).select(F.col("o.r").alias("_row"), "o"), "firsts")
    texts = materialise(rows.join(firsts, "_row").select("_row", "o", "lines"), "texts")
    copies = rows.join(firsts.select("_row"), "_row", "left_anti").select(
        "_row", F.sequence(F.lit(0), F.size("lines") - 1).alias("places"), F.lit(1).alias("partners"))
    counts = materialise(texts.select(F.explode(F.array_distinct("lines")).alias("h")).where("h <> 0")
                         .groupBy("h").agg(F.count("*").alias("docs")).where("docs > 1"), "line-counts")
    # Each line that is not blank with the next such line and its distance.
    full = F.filter(F.transform("lines", lambda h, i: F.struct(h.alias("h"), i.alias("i"))), lambda x: x["h"] != 0)
    each = texts.select("_row", "o", full.alias("f")).select("_row", "o", F.posexplode("f").alias("k", "l"), "f").select(
        "_row", "o", "l.h", F.get("f", F.col("k") + 1).alias("n"), F.col("l.i").alias("i")).select(
        "_row", "o", "h", F.col("n.h").alias("next"), (F.col("n.i") - F.col("i")).alias("step"))
    rare = F.col("docs") <= (RARE_DOCS if rare_docs is None else rare_docs)
    if rare_docs is None:
        rare = rare | (F.col("h") % 2 != 0)
    paired = F.col("next").isNotNull() & (F.lit(rare_docs is None) | ~rare)
    keys = F.array(F.when(rare, F.struct(F.col("h").alias("key"), F.lit(True).alias("rare"))),
                   F.when(paired, F.struct(F.xxhash64("h", "step", "next").alias("key"), F.lit(False).alias("rare"))))
    keyed = each.join(counts, "h").select("_row", "o", F.explode(F.array_compact(keys)).alias("k")).select(
        "_row", "o", "k.key", "k.rare").distinct()
    keyed = materialise(keyed, "line-keys")
    holders = materialise(keyed.groupBy("key", "rare").agg(F.min("o").alias("first"), F.count("*").alias("n"))
                          .where("n > 1").select("key", "rare", F.col("first.r").alias("first")), "holders")
    alone = F.collect_list(F.when(F.col("rare"), F.col("key"))) if least is None else F.first(F.expr("array(0L)"))
    pairs = materialise(keyed.join(holders, ["key", "rare"]).where("_row <> first").groupBy("_row", "first").agg(
        alone.alias("alone")), "line-pairs")
    first = texts.select(F.col("_row").alias("first"), F.col("lines").alias("earlier"))
    both = pairs.join(texts.select("_row", "lines"), "_row").join(first, "first").select("_row", "lines", "earlier", "alone")
    shortest = BLOCK_LINES if least is None else least

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [common_blocks(a, b, shortest, {x for x in c if x}) for a, b, c in zip(
                *(batch.column(name).to_pylist() for name in ("lines", "earlier", "alone")))]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found, pa.list_(pa.int32()))], ["_row", "places"])

    aligned = both.mapInArrow(align, "_row long, places array<int>")
    merged = aligned.groupBy("_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
                                         F.count("*").cast("int").alias("partners"))
    return merged.union(copies.select("_row", "places", "partners"))


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (a stored table) with ``text`` less the repeated lines, and n_lines, n_removed, n_partners.

    Columns of these names are replaced, others stay.
    """
    new = ["n_lines", "n_removed", "n_partners"]
    found = materialise(repeated_lines(docs, **options), "removed-lines")
    kept = [c for c in docs.columns if c.lower() not in new]
    joined = with_row(docs.select(*kept), "_row").join(found.hint("shuffle_hash"), "_row", "left").drop("_row")
    place, names = kept.index("text"), kept + new
    schema = joined.drop("places").withColumnRenamed("partners", "n_partners").selectExpr(
        *[f"`{c}`" for c in kept], "0L AS n_lines", "0L AS n_removed", "CAST(n_partners AS LONG) AS n_partners").schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed = [], [], []
            for text, places in zip(batch.column(place).to_pylist(), batch.column("places").to_pylist()):
                lines, gone = (text or "").split("\n"), set(places or ())
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
                sizes.append(len(lines))
                removed.append(len(gone))
            columns = [batch.column(i) for i in range(len(kept))]
            columns[place] = pa.array(texts, pa.string())
            partners = [p or 0 for p in batch.column("partners").to_pylist()]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.int64()) for c in (sizes, removed, partners))], names)

    return joined.mapInArrow(cut, schema)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "n_partners", F.sha2(text_of(), 256).alias("text_sha256"),
                          F.length(text_of()).cast("long").alias("n_points"))
