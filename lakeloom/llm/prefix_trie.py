"""Conversation prefix trie, rolled up by centroid decomposition.

Prefixes of conversations are told apart by a polynomial hash modulo a prime
of 127 bits, whose values over neighbouring blocks of turns are put together,
so that no task holds all turns of a conversation. A node of the trie is a
prefix; it is named by its smallest member and its depth, and each member's
row of owners, depth by depth, is a level-ancestor table.

Totals of subtrees come from a centroid decomposition of the parent edges: a
component is split at the node that leaves no part above half of it; what lies
below the centroid (it included) is added up and added to every node on the
path from the centroid to the component's top; the parts are split in turn. As
long as a component has more than ``SMALL`` nodes this is done by joins, all
such components of a round at once; the others are each one row of a table and
are split inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.turns import block_of, conversations, ordered
from lakeloom.session import materialise

#: Modulus and base of the prefix hash.
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1234567F4A7C15F39CC0605 % ((1 << 127) - 1)
#: Nodes up to which a component is split inside a task.
SMALL = 4096
#: Conversation ids that are joined in one row before they are hashed.
CHUNK = 4096
ROOT = bytes(16)


def _number(digest: str) -> int:
    """Value of a turn: its digest, never 0."""
    return int(digest[:30], 16) + 1


def _mapped(table: DataFrame, schema: str, rows) -> DataFrame:
    """What ``rows`` (a generator of tuples) makes of each row of ``table``, given as a tuple."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [out for row in zip(*(c.to_pylist() for c in batch.columns)) for out in rows(*row)]
            for first in range(0, len(made), 10_000):
                columns = list(zip(*made[first:first + 10_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
    return table.mapInArrow(task, schema)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, start, before, hashes, points): hashes of the prefixes of each conversation, a block of turns a row; stored.

    ``start`` is the place of the block's first turn, ``before`` the hash of
    the turns in front of it, ``points`` the code points of each turn's text.
    Turns are ordered by turn, nulls first, equal ones by a digest; rows
    without conv_id are left out.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = ordered(turns.where("conv_id is not null").select(
        "conv_id", "turn", F.md5(F.concat(role, F.lit("\0"), text).cast("binary")).alias("digest"),
        F.length(text).cast("bigint").alias("points")), ["conv_id", "turn", "digest"], "turns")
    pieces = materialise(
        rows.groupBy("conv_id", block_of().alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("_at", "digest", "points"))).alias("t"))
        .select("conv_id", "block", F.col("t.digest").alias("digests"), F.col("t.points").alias("points")), "pieces")
    several = pieces.groupBy("conv_id").agg(F.count("*").alias("pieces")).where("pieces > 1").select("conv_id")

    def total(conv, block, digests):
        value = 0
        for d in digests:
            value = (value * BASE + _number(d)) % PRIME
        yield conv, block, len(digests), value.to_bytes(16)

    def starts(conv, parts):
        place = value = 0
        for part in parts:
            yield conv, part["block"], place, value.to_bytes(16)
            place += part["n"]
            value = (value * pow(BASE, part["n"], PRIME) + int.from_bytes(part["value"])) % PRIME

    def hashed(conv, digests, points, start, before):
        value, hashes = int.from_bytes(before), []
        for d in digests:
            value = (value * BASE + _number(d)) % PRIME
            hashes.append(value.to_bytes(16))
        yield conv, start, before, hashes, points

    totals = _mapped(pieces.join(several, "conv_id", "left_semi").select("conv_id", "block", "digests"),
                     "conv_id bigint, block bigint, n bigint, value binary", total)
    begun = _mapped(totals.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "n", "value")))),
                    "conv_id bigint, block bigint, start bigint, before binary", starts)
    placed = pieces.join(begun, ["conv_id", "block"], "left").select(
        "conv_id", "digests", "points", F.coalesce("start", F.lit(0).cast("bigint")), F.coalesce("before", F.lit(ROOT)))
    return materialise(_mapped(placed, "conv_id bigint, start bigint, before binary, hashes array<binary>, points array<bigint>", hashed),
                       "prefixes")


def members(own: DataFrame, head: int = 6, base: int = 100) -> DataFrame:
    """(conv_id, length, depth, node, parent, points): every prefix of every rebuilt conversation, from the empty one; stored.

    Conversation c is rebuilt from the first h turns of conversation c - c % ``base`` and its own turns after its
    first h, where h is a checksum of c modulo ``head``; ``head`` = 1 leaves all as they are.
    """
    first = F.transform(F.slice("hashes", 1, head), lambda x, i: F.struct(
        (F.col("start") + i).alias("pos"), x.alias("hash"), F.get("points", i).alias("points")))
    known = own.groupBy("conv_id").agg(
        F.sum(F.size("hashes")).alias("n"),
        F.slice(F.sort_array(F.flatten(F.collect_list(F.when(F.col("start") < head, first)))), 1, head).alias("heads"))
    known = materialise(known.withColumns({"h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).cast("int"),
                                           "from": F.col("conv_id") - F.col("conv_id") % base}), "heads")
    lent = known.select(F.col("conv_id").alias("from"), F.col("heads").alias("lent"))
    none = F.lit(ROOT)
    plan = known.join(lent, "from", "left").withColumn(
        "head", F.when(F.col("lent").isNotNull(), F.slice("lent", 1, F.col("h"))).otherwise(F.slice("heads", 1, 0)))
    plan = materialise(plan.select(
        "conv_id", "h", "head", F.size("head").alias("taken"),
        (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("bigint").alias("length"),
        F.coalesce(F.get("head", F.size("head") - 1)["hash"], none).alias("reached"),
        F.coalesce(F.get("heads", F.col("h") - 1)["hash"], none).alias("left")), "plans")
    roots = plan.select("conv_id", "length", F.lit(0).cast("bigint").alias("depth"), none.alias("node"),
                        F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("points"))
    taken = plan.select("conv_id", "length", "head", F.posexplode("head").alias("i", "t")).select(
        "conv_id", "length", (F.col("i") + 1).cast("bigint").alias("depth"), F.col("t.hash").alias("node"),
        F.coalesce(F.get("head", F.col("i") - 1)["hash"], none).alias("parent"), F.col("t.points").alias("points"))

    def moved(conv, start, before, hashes, points, h, taken, length, reached, left):
        """Prefixes of the own turns, with the head that was taken over in the place of the own first turns."""
        shift = (int.from_bytes(reached) - int.from_bytes(left)) % PRIME
        begin = max(start, h)
        power = pow(BASE, begin - h, PRIME)
        value = (int.from_bytes(before if begin == start else hashes[begin - start - 1]) + shift * power) % PRIME
        node = reached if begin == h else value.to_bytes(16)
        for pos in range(begin, start + len(hashes)):
            parent, own_hash = node, hashes[pos - start]
            if shift:
                power = power * BASE % PRIME
                node = ((int.from_bytes(own_hash) + shift * power) % PRIME).to_bytes(16)
            else:
                node = own_hash
            yield conv, length, taken + pos - h + 1, node, parent, points[pos - start]

    rest = own.join(plan.select("conv_id", "h", "taken", "length", "reached", "left"), "conv_id").where(
        F.col("start") + F.size("hashes") > F.col("h"))
    later = _mapped(rest, "conv_id bigint, length bigint, depth bigint, node binary, parent binary, points bigint", moved)
    return materialise(roots.unionByName(taken).unionByName(later), "members")


def paths(found: DataFrame) -> DataFrame:
    """(conv_id, depth, owner, parent_owner, length, n_convs, points, leaf): for every prefix its node's name; stored.

    ``owner`` is the smallest member of the node; the node itself is the row whose conv_id is its owner.
    """
    nodes = found.groupBy("depth", "node").agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), (F.max("length") == F.col("depth")).alias("leaf"))
    named = materialise(found.join(nodes, ["depth", "node"]).select("conv_id", "depth", "owner", "length", "n_convs", "points", "leaf"), "named")
    above = named.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_owner"))
    return materialise(named.join(above, ["conv_id", "depth"], "left"), "paths")


def subtree_sizes(path: DataFrame) -> DataFrame:
    """(conv_id, depth, size): nodes below and with each node.

    The nodes that a member owns are the end of its row; below a node lie all of them for each member but its owner.
    """
    own = path.groupBy("conv_id").agg(F.count_if(F.col("owner") == F.col("conv_id")).alias("own"))
    counted = path.join(own, "conv_id")
    mine = F.col("owner") == F.col("conv_id")
    return counted.groupBy(F.col("owner").alias("conv_id"), "depth").agg(
        F.sum(F.when(mine, F.col("length") - F.col("depth") + 1).otherwise(F.col("own"))).alias("size"))


def split_small(nodes: list[tuple], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Subtree totals of ``values`` in one component by centroid decomposition.

    ``nodes`` are (conv, depth, conv of the parent), shallower ones first.
    """
    place = {(c, d): i for i, (c, d, _) in enumerate(nodes)}
    parent = [place.get((p, d - 1), -1) for _, d, p in nodes]
    width = len(values[0])
    out = [[0] * width for _ in nodes]
    part = [0] * len(nodes)
    stack, names = [list(range(len(nodes)))], 1
    while stack:
        rows = stack.pop()
        name = part[rows[0]]
        size = dict.fromkeys(rows, 1)
        for v in reversed(rows[1:]):
            size[parent[v]] += size[v]
        # The deepest node that still holds half of the component.
        centre = min((v for v in rows if 2 * size[v] >= len(rows)), key=lambda v: (size[v], -v))
        below, parts = {centre: -1}, {}
        total = list(values[centre])
        rest = []
        for v in rows:
            if v == centre:
                continue
            if (branch := below.get(parent[v])) is None or part[parent[v]] != name and parent[v] != centre:
                rest.append(v)
                continue
            below[v] = v if branch == -1 else branch
            parts.setdefault(below[v], []).append(v)
            for k in range(width):
                total[k] += values[v][k]
        v = centre
        while True:
            for k in range(width):
                out[v][k] += total[k]
            if v == rows[0]:
                break
            v = parent[v]
        for group in (rest, *parts.values()):
            if group:
                for v in group:
                    part[v] = names
                names += 1
                stack.append(group)
        part[centre] = -1
    return out


def totals(path: DataFrame, values: list[str], small: int = SMALL) -> DataFrame:
    """(conv_id, depth, *values): the sums of ``values`` over the subtree of each node of ``path``.

    ``path`` has the columns of ``paths`` and the ``values`` (long), which count where conv_id is the owner.
    """
    key, sums = ["conv_id", "depth"], [F.sum(v).alias(v) for v in values]
    steps = path.select("conv_id", F.col("depth").alias("at"), "owner", "parent_owner")
    nodes = path.where("owner = conv_id").select(*key, "parent_owner", *values)
    top = F.struct(F.min("conv_id").alias("c"), F.lit(0).cast("bigint").alias("d"))
    one = nodes.agg(top.alias("top"), F.count("*").alias("nodes")).first()
    if not one["nodes"]:
        return nodes.select(*key, *values)
    active = nodes.join(subtree_sizes(path), key).withColumns(
        {"top_c": F.lit(one["top"]["c"]), "top_d": F.lit(one["top"]["d"]), "total": F.lit(one["nodes"]).cast("bigint")})
    added, done = [], []
    component = ["top_c", "top_d"]
    while True:
        active = materialise(active, "components")
        done.append(active.where(F.col("total") <= small))
        large = active.where(F.col("total") > small)
        if large.isEmpty():
            break
        centres = materialise(
            large.where(2 * F.col("size") >= F.col("total")).groupBy(*component)
            .agg(F.min_by(F.struct("conv_id", "depth", "size"), F.struct("size", -F.col("depth"))).alias("c"))
            .select(*component, F.col("c.conv_id").alias("centre"), F.col("c.depth").alias("level"), F.col("c.size").alias("cut")), "centres")
        # Where its owner's row passes, one level below the centroid, tells whether a node lies below it and in which part.
        near = large.join(centres, component).withColumn("at", F.col("level") + 1)
        deeper = F.col("depth") > F.col("level")
        placed = near.join(steps.withColumnsRenamed({"owner": "branch", "parent_owner": "under"}), ["conv_id", "at"], "left")
        inside = deeper & (F.col("under") == F.col("centre"))
        itself = (F.col("conv_id") == F.col("centre")) & (F.col("depth") == F.col("level"))
        placed = materialise(placed.withColumns({"below": F.coalesce(inside, F.lit(False)), "centred": itself}), "split")
        gained = placed.where("below or centred").groupBy(*component).agg(*sums)
        # Path from the centroid to the top of its component.
        climbed = materialise(centres.join(gained, component).join(steps.withColumnRenamed("conv_id", "centre"), "centre")
                              .where(F.col("at").between(F.col("top_d"), F.col("level")))
                              .select(F.col("owner").alias("conv_id"), F.col("at").alias("depth"), "cut", *values), "climbed")
        added.append(climbed.select(*key, *values))
        kept = placed.where("not centred").join(climbed.select(*key, F.col("cut").alias("less")), key, "left")
        below = F.col("below")
        moved = kept.select(
            *key, "parent_owner", *values,
            F.when(below, F.col("size")).otherwise(F.col("size") - F.coalesce("less", F.lit(0))).alias("size"),
            F.when(below, F.col("branch")).otherwise(F.col("top_c")).alias("top_c"),
            F.when(below, F.col("at")).otherwise(F.col("top_d")).alias("top_d"), "total", "cut", below.alias("below"))
        # The size of a part is that of its top.
        tops = moved.where((F.col("conv_id") == F.col("top_c")) & (F.col("depth") == F.col("top_d"))).select(*component, F.col("size").alias("total"))
        active = moved.drop("total", "cut", "below").join(tops, component).select(*active.columns)
    listed = done[0]
    for more in done[1:]:
        listed = listed.unionByName(more)
    names = ", ".join(f"{v} bigint" for v in values)

    def rolled(rows):
        nodes = [(r["conv_id"], r["depth"], r["parent_owner"]) for r in rows]
        for (c, d, _), sums in zip(nodes, split_small(nodes, [tuple(r[v] for v in values) for r in rows])):
            yield c, d, *sums

    parts = listed.groupBy(*component).agg(F.sort_array(F.collect_list(F.struct("depth", "conv_id", "parent_owner", *values))).alias("rows"))
    result = _mapped(parts.select("rows"), f"conv_id bigint, depth bigint, {names}", rolled)
    for more in added:
        result = result.unionByName(more)
    return result.groupBy(*key).agg(*sums)


def end_digests(path: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end: their ids, ascending, comma-joined.

    Ids are sorted over all tasks and joined to chunks where they lie; only chunks of a node come together, and pass one by one.
    """
    order = ["owner", "depth", "conv_id"]
    ends = path.where("depth = length").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(columns)],
                                              ["owner", "depth", "first", "ids"])

        for batch in batches:
            out = []
            for owner, depth, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if held != (owner, depth) or len(ids) == CHUNK:
                    if ids:
                        out.append((*held, ids[0], ",".join(map(str, ids))))
                    held, ids = (owner, depth), []
                ids.append(conv)
            yield batch_of(out)
        if ids:
            yield batch_of([(*held, ids[0], ",".join(map(str, ids)))])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hasher = None, None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 2 else pa.int64()) for i, c in enumerate(columns)],
                                              ["conv_id", "depth", "ends_sha256"])

        for batch in batches:
            out = []
            for owner, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if held != (owner, depth):
                    if held:
                        out.append((*held, hasher.hexdigest()))
                    held, hasher = (owner, depth), sha256(ids.encode())
                else:
                    hasher.update(("," + ids).encode())
            yield batch_of(out)
        if held:
            yield batch_of([(*held, hasher.hexdigest())])

    chunked = ends.mapInArrow(chunks, "owner bigint, depth bigint, first bigint, ids string")
    return (chunked.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
            .mapInArrow(digests, "conv_id bigint, depth bigint, ends_sha256 string"))


def trie(turns: DataFrame, head: int = 6, base: int = 100, small: int = SMALL) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node of the prefix trie.

    ``turns`` has (conv_id, turn, role, text); null role or text counts as
    empty, rows without conv_id are left out, other columns are ignored.
    Repeated rows are turns of their own. An empty table has no node.
    """
    path = paths(members(prefixes(turns.select("conv_id", "turn", "role", "text")), head, base))
    key = ["conv_id", "depth"]
    path = path.withColumns({"n_leaves": F.col("leaf").cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("points")})
    node = path.where("owner = conv_id")
    nothing = F.lit(None).cast("bigint")
    # All that is known of a node comes together in one shuffle.
    parts = (
        node.select(*key, F.col("parent_owner").alias("parent_conv_id"), "n_convs", F.lit(0).alias("n_children"), nothing.alias("n_leaves"),
                    nothing.alias("saved_tokens"), F.lit(None).cast("string").alias("ends_sha256"))
        .unionByName(node.where("depth > 0").select(F.col("parent_owner").alias("conv_id"), (F.col("depth") - 1).alias("depth"),
                                                    F.lit(1).alias("n_children")), allowMissingColumns=True)
        .unionByName(totals(path, ["n_leaves", "saved_tokens"], small), allowMissingColumns=True)
        .unionByName(end_digests(path), allowMissingColumns=True))
    return parts.groupBy(*key).agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.max("n_leaves").alias("n_leaves"), F.max("saved_tokens").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(conversations(spark, sf_dir))
