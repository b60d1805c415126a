"""Self-join of documents on the Jaccard similarity of their word n-grams, by T-occurrence search.

Two sets of sizes m and n are similar enough if they share at least T =
ceil(s / (1 + s) (m + n)) shingles. Inverted lists of shingles give, for each
document, the documents that occur on at least T of its lists: the short lists
are merged with a heap, the longest are only probed with binary search for the
documents found so far (DivideSkip).

How documents come together in a task:

1. One pass hashes the shingles. Rows with equal sets form a class, and one of
   them stands for it from here on.
2. Documents are ordered by how common their shingles are. Any two similar sets
   share one of their rarest 1 - s shingles (prefix filter), whatever the order
   is, as long as it is one order for all. Counting all shingles is not needed
   for that: a quarter of them, chosen by hash, comes first in the order and is
   counted exactly; a document that has too few of these sends all its own.
   Counting moves packed arrays: every run of documents sends each range of
   hashes its distinct keys, and gets back a count per key in the same order.
3. Shingles in two or more prefixes link documents, if their sizes and what is
   left of either after the shingle allow T common ones. Of a similar pair the
   first common shingle always does; one that documents share by chance seldom
   does, so chance does not chain them. Connected documents form a candidate
   group; anything similar lies within one. Only documents in such groups are
   read again.
4. Each group is searched as above. A large group is dealt out in blocks, each
   pair of blocks a task of its own, so that no group is held by one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import DOCUMENT_COLUMNS, by_row, components, documents, runs_of, small_batches, text_of, with_row
from lakeloom.session import materialise

#: Words of a shingle, percent of similarity, and the share (one in so many) of the hashes that are counted.
WORDS, PERCENT, SHARE = 4, 85, 4
#: Rows of a run, keys of a range (about), and documents of a block.
RUN_ROWS, RANGE_KEYS, BLOCK_DOCS = 2048, 2_000_000, 1024

_SPACE = np.zeros(256, np.bool_)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = 0xD1342543DE82EF95


class Shingler:
    """Hashes of the distinct word n-grams of texts: words end at white space, A-Z count as a-z."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self._power = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)

    def _powers(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._power) < size:
            for name, factor in (("_power", _FACTOR), ("_inverse", pow(_FACTOR, -1, 1 << 64))):
                row = np.full(size, factor, np.uint64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=np.uint64))
        return self._power, self._inverse

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text, its shingles' hashes, sorted and distinct. Fewer words than a shingle has are one shingle."""
        out = []
        for run in runs_of([(t or "").encode().lower() for t in texts]):
            out += self._run(run)
        return out

    def _run(self, raw: list[bytes]) -> list[np.ndarray]:
        code = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        power, inverse = self._powers(len(code) + 1)
        space = _SPACE[code]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        start, end = edge[::2], edge[1::2]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[code] * power[:len(code)], dtype=np.uint64)))
        word = _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
        bounds = np.cumsum([0] + [len(r) + 1 for r in raw])
        first = np.searchsorted(start, bounds)
        out = []
        gram = np.zeros(0, np.uint64)
        if len(word) >= self.words:
            gram = word[:len(word) - self.words + 1].copy()
            for i in range(1, self.words):
                gram = _mix(gram * np.uint64(0x9FB21C651E98DF25) + word[i:len(word) - self.words + 1 + i])
        for a, b in zip(first, first[1:]):
            if b - a >= self.words:
                found = np.sort(gram[a:b - self.words + 1])
                out.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
            elif b > a:
                whole = word[a:a + 1] + np.uint64(b - a)
                for i in range(a + 1, b):
                    whole = _mix(whole * np.uint64(0x9FB21C651E98DF25) + word[i:i + 1])
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def counted(hashes: np.ndarray, share: int) -> np.ndarray:
    """Marks the hashes that are counted for every document."""
    return _mix(hashes) % np.uint64(share) == 0


def _runs(docs: DataFrame, words: int, percent: int, share: int, run_rows: int) -> DataFrame:
    """(run, docs, keys): rows of a run with size and digest of their sets, and the packed hashes they send."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held = Shingler(words), []

        def emit() -> pa.RecordBatch:
            rows, ids, sizes, digests, sent, keys = [], [], [], [], [], []
            for row, doc_id, found in held:
                mine = found[counted(found, share)]
                if len(mine) < prefix_size(len(found), percent):
                    mine = found
                rows.append(row)
                ids.append(doc_id)
                sizes.append(len(found))
                digests.append(blake2b(found.tobytes(), digest_size=16).digest())
                sent.append(len(mine))
                keys.append(mine.tobytes())
            listed = [[{"row": r, "doc_id": d, "n": n, "digest": g, "sent": s}
                       for r, d, n, g, s in zip(rows, ids, sizes, digests, sent)]]
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[0]], pa.int64()), pa.array(listed, _DOCS), pa.array([b"".join(keys)], pa.binary())],
                ["run", "docs", "keys"])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows = batch.column("_row").to_pylist()
            held += zip(rows, ids, shingler(texts))
            if len(held) >= run_rows:
                yield emit()
                held = []
        if held:
            yield emit()

    numbered = with_row(docs.select("doc_id", text_of().alias("text")), "_row")
    return numbered.mapInArrow(
        task, "run long, docs array<struct<row:long,doc_id:long,n:int,digest:binary,sent:int>>, keys binary")


_DOCS = pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("digest", pa.binary()),
                            ("sent", pa.int32())]))


def count_code(count: np.ndarray) -> np.ndarray:
    """One byte per count, in the order of the counts: exact to 127, then eight steps for each doubling."""
    return np.where(count < 128, count, np.minimum(127 + 8 * np.log2(np.maximum(count, 128) / 127), 255)).astype(np.uint8)


def common_counts(runs: DataFrame, bits: int) -> DataFrame:
    """(run, codes): for the distinct sorted keys of each run, how many documents of all runs have them.

    A key is the top ``bits`` + 32 bits of a hash; its range is the top ``bits``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, blob in zip(batch.column("run").to_pylist(), batch.column("keys").to_pylist()):
                keys, counts = np.unique(np.frombuffer(blob, np.uint64) >> np.uint64(32 - bits), return_counts=True)
                part = (keys >> np.uint64(32)).astype(np.int64)
                cuts = np.searchsorted(part, np.arange((1 << bits) + 1))
                full = np.flatnonzero(np.diff(cuts))
                low, counts = keys.astype(np.uint32), np.minimum(counts, 1 << 30).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int64()), pa.array([run] * len(full), pa.int64()),
                    pa.array([low[cuts[r]:cuts[r + 1]].tobytes() for r in full], pa.binary()),
                    pa.array([_packed(counts[cuts[r]:cuts[r + 1]]) for r in full], pa.binary())],
                    ["part", "run", "keys", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint32) for k in group["keys"]]
        flat = np.concatenate(keys)
        counts = np.concatenate([_unpacked(c, len(k)) for c, k in zip(group["counts"], keys)])
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        sums = np.add.reduceat(counts[order], np.flatnonzero(new))
        codes = np.empty(len(flat), np.uint8)
        codes[order] = count_code(sums)[np.cumsum(new) - 1]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return pd.DataFrame({"run": group["run"], "part": group["part"],
                             "codes": [c.tobytes() for c in np.split(codes, cuts)]})

    sent = runs.select("run", "keys").mapInArrow(send, "part long, run long, keys binary, counts binary")
    answers = sent.groupBy("part").applyInPandas(add, "run long, part long, codes binary")
    # A run's answers together are one byte for each of its keys.
    return answers.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("part", "codes"))).alias("answers"))


def _packed(counts: np.ndarray) -> bytes:
    """Counts as bytes where they fit, which is the rule."""
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else counts.tobytes()


def _unpacked(blob: bytes, size: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint8 if len(blob) == size else np.uint32).astype(np.int64)


def _prefixes(runs: DataFrame, counts: DataFrame, bits: int, percent: int, share: int) -> DataFrame:
    """(token, row, n, place): the shingles of each prefix that another document has too, with size and place in the order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sizes, blob, answers in zip(batch.column("docs").to_pylist(), batch.column("keys").to_pylist(),
                                            batch.column("answers").to_pylist()):
                flat = np.frombuffer(blob, np.uint64)
                keys = np.unique(flat >> np.uint64(32 - bits))
                codes = np.frombuffer(b"".join(a["codes"] for a in answers or []), np.uint8)
                code = codes[np.searchsorted(keys, flat >> np.uint64(32 - bits))] if len(flat) else codes
                tokens, rows, ns, places, at = [], [], [], [], 0
                for d in sizes:
                    mine, common = flat[at:at + d["sent"]], code[at:at + d["sent"]].astype(np.int64)
                    at += d["sent"]
                    if not len(mine):
                        continue
                    # The order of all shingles: counted ones first, then by count, then by hash (as they are sorted).
                    order = np.argsort(np.where(counted(mine, share), common, common + 256), kind="stable")
                    chosen = order[:prefix_size(d["n"], percent)]
                    place = np.flatnonzero(common[chosen] > 1)
                    tokens.append(mine[chosen[place]].view(np.int64))
                    rows.append(np.full(len(place), d["row"], np.int64))
                    ns.append(np.full(len(place), d["n"], np.int64))
                    places.append(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), t)
                     for x, t in ((tokens, pa.int64()), (rows, pa.int64()), (ns, pa.int32()), (places, pa.int32()))],
                    ["token", "row", "n", "place"])

    slim = runs.select("run", "keys", F.transform("docs", lambda d: F.struct(d["row"].alias("row"), d["n"].alias("n"),
                                                                            d["sent"].alias("sent"))).alias("docs"))
    return slim.join(counts, "run", "left").mapInArrow(task, "token long, row long, n int, place int")


def chained(prefixes: DataFrame, percent: int) -> DataFrame:
    """(row, hub): documents that a shingle of ``prefixes`` (token, row, n, place) links, each with the first of its chain.

    Sets of sizes m and n, of which r and q are left from the shingle on, can
    be similar only if min(r, q) >= T, that is if either size is at most the
    other's ``reach``. Where that is no less than its own size, a set is an
    interval from size to reach, and two such sets are linked if their intervals
    meet. The other sets (late shingles) are never linked with each other, and
    the intervals that hold such a set's reach and size all meet. So one pass
    in the order of the lesser of size and reach finds the chains, without pairs.
    """
    reach = F.floor((F.col("n") - F.col("place")).cast("long") * (100 + percent) / F.lit(percent)) - F.col("n")
    sized = prefixes.withColumn("reach", reach).withColumn("late", F.col("reach") < F.col("n"))
    sized = sized.withColumn("at", F.least("n", "reach"))
    order = Window.partitionBy("token").orderBy("at", "late", "row")
    early = F.when(~F.col("late"), F.col("reach"))
    before = F.max(early).over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = F.coalesce(F.col("n") <= F.col("before"), F.lit(False))
    first = F.when(~F.col("late") & ~F.col("met"), F.col("row"))
    hub = F.last(first, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    swept = sized.withColumn("before", before).withColumn("met", met).withColumn("hub", hub)
    return swept.where("met").select("row", "hub")


def search(sets: list[np.ndarray], percent: int, side: list[int] | None = None) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of similar sets by T-occurrence search; with ``side``, only pairs of different sides.

    Sets are taken by size, and each one asks the smaller ones before it.
    """
    order = sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: (len(sets[i]), i))
    sizes = np.array([len(sets[i]) for i in order])
    if not len(order):
        return
    flat = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(order)), sizes)
    by_token = np.argsort(flat, kind="stable")
    new = np.concatenate(([True], flat[by_token][1:] != flat[by_token][:-1]))
    begin = np.append(np.flatnonzero(new), len(flat))
    token = np.empty(len(flat), np.int64)
    token[by_token] = np.cumsum(new) - 1
    postings = owner[by_token]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    for q in range(1, len(order)):
        n = int(sizes[q])
        least = (percent * n + 99) // 100
        low = int(np.searchsorted(sizes[:q], least))
        if low == q:
            continue
        need = -(-percent * (n + int(sizes[low])) // (100 + percent))
        # Of each list, the part that is neither too small a set nor past the query.
        lists = []
        for t in token[ends[q]:ends[q + 1]]:
            row = postings[begin[t]:begin[t + 1]]
            row = row[np.searchsorted(row, low):np.searchsorted(row, q)] if len(row) > 1 else row[:0]
            if len(row):
                lists.append(row)
        if len(lists) < need:
            continue
        lists.sort(key=len, reverse=True)
        longest = len(lists[0])
        skipped = min(need - 1, int(need / (0.0085 * np.log2(longest + 1) + 1)))
        # With many postings left to merge, as many lists as possible are probed instead.
        if sum(map(len, lists[skipped:])) > 256:
            skipped = need - 1
        found, times, last, count = [], [], -1, 0
        for d in heapq.merge(*(row.tolist() for row in lists[skipped:])):
            if d != last:
                if count >= need - skipped:
                    found.append(last)
                    times.append(count)
                last, count = d, 0
            count += 1
        if count >= need - skipped:
            found.append(last)
            times.append(count)
        if not found:
            continue
        found, times = np.array(found), np.array(times)
        for row in lists[:skipped]:
            at = np.searchsorted(row, found)
            at[at == len(row)] = 0
            times += row[at] == found
        for d in found[times * (100 + percent) >= percent * (n + sizes[found])].tolist():
            if side is None or side[order[d]] != side[order[q]]:
                yield order[d], order[q]


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, share: int = SHARE,
                   run_rows: int = RUN_ROWS, range_keys: int = RANGE_KEYS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per input row: _row, doc_id, n_shingles, component_id, n_links and ``group`` (a key of the component).

    ``docs`` (doc_id, text; a stored table, as it is read twice) may have other
    columns, which are ignored. Null texts and texts without words have no
    shingle and link with nothing. Repeated rows link with each other. A null
    doc_id counts as larger than any other. Shingles are compared by 64-bit
    hashes. ``n_links`` counts the other rows linked to a row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    runs = materialise(_runs(docs, words, percent, share, run_rows), "runs")
    rows = runs.select(F.explode("docs").alias("d")).select("d.row", "d.doc_id", "d.n", "d.digest")
    classes = materialise(rows.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("low"), F.count("*").alias("copies")), "classes")
    keys = runs.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    bits = max(0, min(32, int(np.ceil(np.log2(max(1, keys / 8 / range_keys)))) + 3))
    prefixes = _prefixes(runs, common_counts(runs, bits), bits, percent, share)
    reps = classes.select(F.col("rep").alias("row"))
    near = chained(prefixes.join(reps, "row", "left_semi"), percent)
    near = components(near.select(F.col("row").alias("a"), F.col("hub").alias("b")), "candidates")
    near = materialise(near.select(F.col("node").alias("_row"), F.col("component").alias("part")), "candidates")
    blocks = (near.groupBy("part").agg(F.ceil(F.count("*") / block_docs).cast("int").alias("blocks")))
    near = materialise(near.join(blocks, "part").join(
        classes.select(F.col("rep").alias("_row"), "copies"), "_row"), "candidates")

    def hash_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            found = [s.tobytes() for s in shingler(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_row", "part", "blocks", "copies")),
                                              pa.array(found, pa.binary())], ["_row", "part", "blocks", "copies", "keys"])

    texts = with_row(docs.select(text_of().alias("text")), "_row")
    sets = by_row(texts, near, "inner").select("_row", "part", "blocks", "copies", "text").mapInArrow(
        hash_sets, "_row long, part long, blocks int, copies long, keys binary")
    # A document meets every block of its group; two documents of different blocks meet in one task only.
    block = F.pmod(F.xxhash64("_row"), F.col("blocks")).cast("int")
    dealt = (sets.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))

    def find(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row", ignore_index=True)
        sets = [np.frombuffer(k, np.uint64) for k in group["keys"]]
        across = group["i"].iloc[0] != group["j"].iloc[0]
        parent, links = list(range(len(sets))), np.zeros(len(sets), np.int64)
        copies = group["copies"].to_numpy()

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for a, b in search(sets, percent, group["block"].tolist() if across else None):
            links[a] += copies[b]
            links[b] += copies[a]
            a, b = sorted((root(a), root(b)))
            parent[b] = a
        linked = np.flatnonzero(links)
        return pd.DataFrame({"row": group["_row"].to_numpy()[linked], "links": links[linked],
                             "hub": [int(group["_row"].iloc[root(i)]) for i in linked]})

    found = materialise(dealt.groupBy("part", "i", "j").applyInPandas(find, "row long, links long, hub long"), "links")
    linked = components(found.select(F.col("row").alias("a"), F.col("hub").alias("b")), "linked")
    linked = linked.select(F.col("node").alias("rep"), F.col("component").alias("group"))
    links = found.groupBy(F.col("row").alias("rep")).agg(F.sum("links").alias("links"))
    known = materialise(classes.join(linked, "rep", "left").join(links, "rep", "left")
                        .withColumn("group", F.coalesce("group", "rep")), "known")
    low = known.groupBy("group").agg(F.min("low").alias("component_id"))
    known = materialise(known.join(low, "group").select(
        "digest", "group", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "known")
    empty = rows.where("n = 0").select(
        F.col("row").alias("_row"), "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"), F.col("row").alias("group"))
    return rows.where("n > 0").join(known, "digest").select(
        F.col("row").alias("_row"), "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "n_links",
        "group").union(empty)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (a stored table) without all but one of each group: the smallest doc_id, then the first row."""
    found = materialise(similar_groups(docs, **options).select("_row", "doc_id", "group"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_row")).alias("first")
    kept = found.groupBy("group").agg(first).select("group", F.col("first._row").alias("kept"))
    dropped = materialise(found.join(kept, "group").where("_row <> kept").select("_row"), "dropped")
    return by_row(with_row(docs, "_row"), dropped, "left_anti").drop("_row")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "n_links")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group. In the pipeline: five words and a similarity of 0.8."""
    return one_of_each(docs, words=5, percent=80).select(*DOCUMENT_COLUMNS)
