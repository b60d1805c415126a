"""Conversation structure repair by prefix-doubling path ranking.

Every turn may be kept, given another role or deleted, and empty turns may be
inserted, until the roles are none or ``s?(ua)+``. A cost DP from the end gives
the cheapest cost of every node (turn, state of the role pattern). Of the arcs
that keep to that cost each node takes the one of least rank; ranks of audits
(the edits' initials) of one letter are doubled to audits of two, four, eight
letters, along with the pointers to the node so many edits on, until all audits
have ended. The least path is then read letter by letter through the doubled
pointers, all letters of all conversations at once.

Conversations are cut into pieces of at most 4,096 turns. A conversation of
several pieces is solved through cost matrices of its pieces (entry state by
exit state), so that no task holds all its turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACE, small_batches
from lakeloom.llm.turns import block_of, conversations, ordered
from lakeloom.session import materialise

# Codes of a role's initial, of a turn's first fault, and costs of the edits.
INITIALS, OTHER = "uas", 3
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
LETTERS = np.frombuffer(b"DIKR", np.uint8)
# States of the pattern: nothing yet, after s, after u, after a; the state that a role's initial leads to, and the role that is due.
KEEP = np.array([[2, -1, 1, -1], [2, -1, -1, -1], [-1, 3, -1, -1], [2, -1, -1, -1]])
DUE = np.array([2, 2, 3, 2])
DUE_ROLE = ["user", "user", "assistant", "user"]
#: Cost, and edits, from the state after the last turn.
END, END_EDITS = np.array([0, 2 * INSERT, INSERT, 0]), ["", "II", "I", ""]
FAR = 1 << 40


def node_costs(codes: np.ndarray, begin: np.ndarray, exits: np.ndarray) -> np.ndarray:
    """Cheapest cost from every node to the end of its piece, (turns + pieces) x 4; ``exits`` is the cost from there on.

    Turn r of piece p is row r + p, the end of the piece is the row after its last turn.
    """
    pieces = len(begin) - 1
    cost = np.full((len(codes) + pieces, 4), FAR, np.int64)
    ends = begin[1:] + np.arange(pieces)
    cost[ends] = exits
    sizes = np.diff(begin)
    by_size = np.argsort(-sizes, kind="stable")
    for step in range(1, int(sizes.max(initial=0)) + 1):
        active = by_size[:np.searchsorted(-sizes[by_size], -step, side="right")]
        row = ends[active] - step
        code = codes[row - active]
        own = arc_costs(code, cost[row + 1]).min(axis=2)
        # Inserts lead from u to a and back, and from the start to u.
        own[:, 2], own[:, 3] = np.minimum(own[:, 2], own[:, 3] + INSERT), np.minimum(own[:, 3], own[:, 2] + INSERT)
        own[:, :2] = np.minimum(own[:, :2], own[:, 2:3] + INSERT)
        cost[row] = own
    return cost


def arc_costs(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Cost by Delete, Keep and Rerole for each turn and state, given the costs after the turn: turns x 4 x 3."""
    initial, fault = code & 3, code >> 2
    due = (fault == TRUNCATED) * UNFINISHED
    free = (fault != BLANK) & (fault != DUPLICATE)
    target = KEEP.T[initial]
    kept = np.where((target >= 0) & free[:, None], np.take_along_axis(after, np.maximum(target, 0), 1) + due[:, None], FAR)
    changed = np.where(free[:, None], after[:, DUE] + REROLE + due[:, None], FAR)
    return np.minimum(np.stack((after + DELETE, kept, changed), 2), FAR)


def doubled(label: np.ndarray, pointer: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Rank of every node's whole audit, pointers over 1, 2, 4, ... edits, and the length of the audit.

    ``label`` ranks the one edit at a node (0: the audit ends there, and the
    node points to itself). Ranks of audits of n letters, taken at a node and n
    edits on, rank those of 2n letters.
    """
    rank, length, pointers = label, (label > 0).astype(np.int64), [pointer]
    while (label[pointers[-1]] > 0).any():
        on = pointers[-1]
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[on], return_inverse=True)[1]
        length = length + length[on]
        pointers.append(on[on])
    return rank, pointers, length


def solve(codes: np.ndarray, begin: np.ndarray, exits: np.ndarray, entries: list[int]):
    """Least cheapest audits of pieces: (costs, exit states, letters, cuts), piece by piece and entry state by entry state."""
    pieces = len(begin) - 1
    cost = node_costs(codes, begin, exits)
    turn = np.arange(len(codes)) + np.repeat(np.arange(pieces), np.diff(begin))
    own, after = cost[turn], cost[turn + 1]
    arcs = arc_costs(codes, after)
    # Edits by the rank of their letters: D, I, K, R.
    options = np.stack((arcs[:, :, 0], own[:, DUE] + INSERT, arcs[:, :, 1], arcs[:, :, 2]), 2)
    best = (options == own[:, :, None]) & (own < FAR)[:, :, None]
    choice = best.argmax(axis=2)
    state = np.arange(4)
    target = np.maximum(KEEP.T[codes & 3], 0)
    to = np.where(choice == 0, (turn[:, None] + 1) * 4 + state, np.where(
        choice == 1, turn[:, None] * 4 + DUE, np.where(choice == 2, (turn[:, None] + 1) * 4 + target, (turn[:, None] + 1) * 4 + DUE)))
    pointer = np.arange(cost.size).reshape(cost.shape)
    label = np.zeros(cost.shape, np.int64)
    pointer[turn] = np.where(best.any(axis=2), to, pointer[turn])
    label[turn] = np.where(best.any(axis=2), choice + 1, 0)
    label, pointer = label.ravel(), pointer.ravel()
    _, pointers, length = doubled(label, pointer)
    starts = ((begin[:-1] + np.arange(pieces))[:, None] * 4 + np.array(entries)).ravel()
    sizes = length[starts]
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    node, step = np.repeat(starts, sizes), np.arange(cuts[-1]) - np.repeat(cuts[:-1], sizes)
    for k, on in enumerate(pointers):
        node = np.where(step >> k & 1, on[node], node)
    return cost.ravel()[starts], pointers[-1][starts] % 4, LETTERS[label[node] - 1].tobytes().decode(), cuts


def illegal_pairs(codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Neighbours inside each piece whose initials are neither su, ua nor au."""
    initial = codes & 3
    a, b = initial[:-1], initial[1:]
    bad = ~(((a == 2) & (b == 0)) | ((a == 0) & (b == 1)) | ((a == 1) & (b == 0)))
    inner = np.ones(max(len(codes) - 1, 0), bool)
    edges = begin[1:-1]
    inner[edges[(edges > 0) & (edges < len(codes))] - 1] = False
    return np.diff(np.concatenate(([0], np.cumsum(bad & inner), [(bad & inner).sum()]))[begin]) if len(codes) else np.zeros(len(begin) - 1, int)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    begin = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[begin[0]:begin[-1]].astype(np.int64), begin - begin[0]


def _fields(codes: np.ndarray, begin: np.ndarray) -> dict[str, list]:
    return {"illegal": illegal_pairs(codes, begin).tolist(), "first": (codes[begin[:-1]] & 3).tolist(),
            "last": (codes[begin[1:] - 1] & 3).tolist()}


def _mapped(table: DataFrame, schema: str, keep: list[str], make) -> DataFrame:
    """Columns ``keep`` and what ``make`` returns for each batch, as named lists."""
    from pyspark.sql.types import StructType
    names = StructType.fromDDL(schema).names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = make(batch)
                yield pa.RecordBatch.from_pydict({n: batch.column(batch.schema.names.index(n)) if n in keep else made[n] for n in names})
    return table.mapInArrow(task, schema)


def _whole(batch: pa.RecordBatch) -> dict[str, list]:
    """Costs and audits of conversations of one piece."""
    codes, begin = _flat(batch.column("codes"))
    cost, exits, letters, cuts = solve(codes, begin, np.tile(END, (len(begin) - 1, 1)), [0])
    audits = [letters[a:b] + END_EDITS[e] for a, b, e in zip(cuts.tolist(), cuts[1:].tolist(), exits.tolist())]
    return {"cost": cost.tolist(), "audit": audits, "illegal": illegal_pairs(codes, begin).tolist()}


def _matrices(batch: pa.RecordBatch) -> dict[str, list]:
    """Costs of pieces by entry and exit state."""
    codes, begin = _flat(batch.column("codes"))
    pieces = len(begin) - 1
    columns = []
    for state in range(4):
        exits = np.full((pieces, 4), FAR)
        exits[:, state] = 0
        columns.append(node_costs(codes, begin, exits)[begin[:-1] + np.arange(pieces)])
    return {"matrix": np.stack(columns, 2).reshape(pieces, 16).tolist(), **_fields(codes, begin)}


def _exits(batch: pa.RecordBatch) -> dict[str, list]:
    """Costs from the end of every piece of conversations, from the last piece to the first."""
    out = []
    for pieces in batch.column("pieces").to_pylist():
        cost, exits = END, []
        for piece in reversed(pieces):
            exits.append({"block": piece["block"], "exits": cost.tolist()})
            cost = np.minimum((np.array(piece["matrix"]).reshape(4, 4) + cost).min(axis=1), FAR)
        out.append(exits)
    return {"exits": out}


def _entries(batch: pa.RecordBatch) -> dict[str, list]:
    """Audits of pieces for each state that they may be entered in."""
    codes, begin = _flat(batch.column("codes"))
    exits, _ = _flat(batch.column("exits"))
    cost, out, letters, cuts = solve(codes, begin, exits.reshape(-1, 4), [0, 1, 2, 3])
    audits = [letters[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
    return {"costs": cost.reshape(-1, 4).tolist(), "ends": out.reshape(-1, 4).tolist(),
            "audits": [audits[i:i + 4] for i in range(0, len(audits), 4)], **_fields(codes, begin)}


def _joined(batch: pa.RecordBatch) -> dict[str, list]:
    """Audits of conversations from those of their pieces."""
    out = {"cost": [], "audit": [], "illegal": []}
    pairs = {(2, 0), (0, 1), (1, 0)}
    for pieces in batch.column("pieces").to_pylist():
        state, audit, illegal = 0, [], 0
        for before, piece in zip([None, *pieces], pieces):
            audit.append(piece["audits"][state])
            state = piece["ends"][state]
            illegal += piece["illegal"] + (before is not None and (before["last"], piece["first"]) not in pairs)
        out["cost"].append(pieces[0]["costs"][0])
        out["audit"].append("".join(audit) + END_EDITS[state])
        out["illegal"].append(illegal)
    return out


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, code, _at): turns in order, with their role's initial and first fault (initial + 4 x fault); stored.

    Turns are ordered by turn, nulls first; equal turns by a digest of role and text, so that repeated turns are neighbours.
    """
    initial = F.substring("role", 1, 1)
    code = F.lit(OTHER)
    for i, letter in enumerate(INITIALS):
        code = F.when(initial == letter, i).otherwise(code)
    ends = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), -1, 1).isin(".", "!", "?")
    rows = ordered(turns.select(
        "conv_id", "turn", turn_digest().alias("digest"), code.alias("initial"),
        F.col("text").rlike(f"[^{SPACE[1:-1]}]").alias("filled"), ends.alias("ends")), ["conv_id", "turn", "digest"], "turns")
    # The first of equal turns, looked up by its unique place: no conversation is a hot key of the join.
    first = rows.groupBy("conv_id", "digest").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("first"))
    fault = (F.when(~F.col("filled"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ends"), TRUNCATED).otherwise(0))
    return materialise(rows.join(first, "_at", "left").select(
        "conv_id", "turn", "_at", (F.col("initial") + 4 * fault).cast("tinyint").alias("code")), "faults")


def turn_digest() -> Column:
    """Digest of role and text."""
    return F.md5(F.concat("role", F.lit("\0"), "text").cast("binary"))


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, illegal) of the conversations of ``faults``; stored."""
    blocks = Window.partitionBy("conv_id").orderBy("block")
    pieces = materialise(
        rows.groupBy("conv_id", block_of().alias("block"))
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "code"))), lambda r: r["code"]).alias("codes"))
        .withColumn("single", F.lag("block").over(blocks).isNull() & F.lead("block").over(blocks).isNull()), "pieces")
    result = "conv_id bigint, cost bigint, audit string, illegal bigint"
    single = _mapped(pieces.where("single").select("conv_id", "codes"), result, ["conv_id"], _whole)
    several = pieces.where("not single").select("conv_id", "block", "codes")
    edges = "illegal bigint, first bigint, last bigint"
    listed = lambda df: df.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "block", *[c for c in df.columns if c not in ("conv_id", "block")]))).alias("pieces"))
    matrices = _mapped(several, "conv_id bigint, block bigint, matrix array<bigint>", ["conv_id", "block"], _matrices)
    exits = (_mapped(listed(matrices), "conv_id bigint, exits array<struct<block:bigint,exits:array<bigint>>>", ["conv_id"], _exits)
             .select(F.col("conv_id").alias("_conv"), F.explode("exits").alias("e"))
             .select("_conv", F.col("e.block").alias("_block"), "e.exits"))
    entered = _mapped(several.join(exits, several.conv_id.eqNullSafe(exits["_conv"]) & (several.block == exits["_block"]))
                      .select("conv_id", "block", "codes", "exits"),
                      f"conv_id bigint, block bigint, costs array<bigint>, ends array<bigint>, audits array<string>, {edges}",
                      ["conv_id", "block"], _entries)
    return materialise(single.unionByName(_mapped(listed(entered), result, ["conv_id"], _joined)), "audits")


def reports(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``turns``, and of ``ids`` (conv_id).

    Conversations without turns have zeros and an empty audit.
    """
    rows = faults(turns)
    fault = F.shiftright("code", 2)
    counted = (rows.groupBy("conv_id", "turn")
               .agg(*[F.count_if(fault == f).alias(n) for n, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))])
               .groupBy("conv_id")
               .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"),
                    *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")]))
    every = (turns if ids is None else ids).select("conv_id").distinct()
    found = audits(rows)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    c, f = counted.withColumnRenamed("conv_id", "_c"), found.withColumnRenamed("conv_id", "_f")
    return (every.join(c, F.col("conv_id").eqNullSafe(F.col("_c")), "left").join(f, F.col("conv_id").eqNullSafe(F.col("_f")), "left")
            .select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names], F.coalesce("audit", F.lit("")).alias("audit")))


EDITS = "conv_id bigint, step bigint, edit string, role string, text string, report struct<{}>".format(", ".join(
    f"{n}:bigint" for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")) + ", audit:string")


def edits(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, step, edit, role, text, report): the cheapest repair of every conversation, edit by edit.

    ``turns`` has (conv_id, turn, role, text); null role or text counts as one
    space, other columns are ignored. Step 0 of a conversation is its
    ``report``; the steps after it are its edits in order, with the role and
    text that result, or that are deleted (edit D). Equal turns of a
    conversation are ordered by a digest; repeated rows are duplicates; null
    ids are one conversation, and an empty table gives an empty one. Rows of a
    conversation are neighbours, in order, in one partition. The texts are
    shuffled once and pass one by one; a task keeps the audit of one
    conversation.
    """
    small_batches(turns.sparkSession)
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    turns = turns.select("conv_id", "turn", space("role"), space("text"))
    told = reports(turns, ids)
    report = F.struct(*[c for c in told.columns if c != "conv_id"])
    none = lambda kind: F.lit(None).cast(kind)
    rows = (told.select("conv_id", F.lit(0).alias("kind"), none("bigint").alias("turn"), none("string").alias("digest"),
                        none("string").alias("role"), none("string").alias("text"), report.alias("report"))
            .unionByName(turns.select("conv_id", F.lit(1).alias("kind"), "turn", turn_digest().alias("digest"), "role", "text",
                                      none(told.select(report.alias("r")).schema["r"].dataType.simpleString()).alias("report"))))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "digest")]
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text", "report")
    names = ["conv_id", "step", "edit", "role", "text", "report"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, step, out = None, "", 0, 0, 0, []

        def add(edit: str | None, role: str | None, text: str | None, report=None) -> None:
            nonlocal step
            out.append((conv, step, edit, role, text, report))
            step += 1

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                add("I", DUE_ROLE[state], "")
                at, state = at + 1, DUE[state]

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[1] == 0:
                    inserts()
                    conv, audit, at, state, step = row[0], row[4]["audit"], 0, 0, 0
                    add(None, None, None, row[4])
                    continue
                inserts()
                edit, role = audit[at], row[2]
                at += 1
                if edit == "K":
                    state = KEEP[state][INITIALS.index(role[0])]
                elif edit == "R":
                    role, state = DUE_ROLE[state], DUE[state]
                add(edit, role, row[3])
            yield _batch(out, names)
            out = []
        inserts()
        yield _batch(out, names)

    return dealt.mapInArrow(task, EDITS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    report = pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), report]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def repaired(edited: DataFrame) -> DataFrame:
    """(conv_id, step, role, text): the turns that the ``edits`` leave, in the order of their steps."""
    return edited.where("edit in ('K', 'R', 'I')").select("conv_id", "step", "role", "text")


def damaged(table: DataFrame) -> DataFrame:
    """``table`` with turns dropped, emptied, left without their stops, repeated and given to the user, by a checksum of their place."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return (table.withColumn("_kind", kind).where("_kind <> 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
                    F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy")).drop("_copy"))


def digests(edited: DataFrame) -> DataFrame:
    """(conv_id, report, repaired_sha256): one row per conversation of ``edits``, whose rows pass one by one."""
    report = edited.schema["report"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hasher, first = None, None, True

        def done(out: list[tuple]) -> None:
            if held is not None:
                out.append((*held, hasher.hexdigest()))

        names = ["conv_id", "report", "repaired_sha256"]
        kind = None
        for batch in batches:
            out = []
            kind = batch.schema.field("report").type
            for conv, _, edit, role, text, told in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if edit is None:
                    done(out)
                    held, hasher, first = (conv, told), sha256(), True
                elif edit != "D":
                    hasher.update((("" if first else "\n") + f"{role}:{text}").encode())
                    first = False
            yield _reported(out, kind, names)
        if held is not None:
            out = []
            done(out)
            yield _reported(out, kind, names)

    return edited.mapInArrow(task, f"conv_id bigint, report {report}, repaired_sha256 string")


def _reported(rows: list[tuple], report: pa.DataType, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), report, pa.string()))], names)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = conversations(spark, sf_dir).select("conv_id", "turn", "role", "text")
    return digests(edits(damaged(table), table)).select("conv_id", "report.*", "repaired_sha256")
