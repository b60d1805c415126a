import hashlib
import random
import re
from functools import lru_cache
from zlib import crc32

import numpy as np
import pytest

from lakeloom.llm import repair, turns as turn_tables

SCHEMA = "conv_id long, turn long, role string, text string"


def is_legal(roles):
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def least(rows):
    """(cost, audit, repaired) by plain recursion over the rows' places and the roles so far, with whole strings."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    legal_next = {"": "us", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if inserted < 2:
            for letter, role in (("u", "user"), ("a", "assistant")):
                if letter in legal_next[last] and (tail := best(i, letter, inserted + 1)):
                    options.append((2 + tail[0], "I" + tail[1], ((role, ""),) + tail[2]))
        if i < len(rows):
            role, text = rows[i]
            late = int(faults[i] == "truncated")
            if tail := best(i + 1, last, 0):
                options.append((3 + tail[0], "D" + tail[1], tail[2]))
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in legal_next[last] and (tail := best(i + 1, role[0], 0)):
                    options.append((late + tail[0], "K" + tail[1], ((role, text),) + tail[2]))
                for letter, new in (("u", "user"), ("a", "assistant")):
                    if letter in legal_next[last] and (tail := best(i + 1, letter, 0)):
                        options.append((2 + late + tail[0], "R" + tail[1], ((new, text),) + tail[2]))
        return min(options) if options else None
    return best(0, "", 0), faults


def expected(table):
    """op11's rows by plain Python."""
    out, groups = {}, {}
    for conv, turn, role, text in table:
        groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] + "\0" + r[2]).encode()).hexdigest()))
        (cost, audit, left), faults = least([r[1:] for r in rows])
        numbers = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        assert is_legal("".join(r[:1] for r, _ in left))
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                     *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def conversations_of(rng, n, size):
    table = []
    for conv in range(n):
        for turn in range(rng.randint(1, size)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "u"])
            text = rng.choice(["Yes.", "No", "  ", "", None, "Why?\n", "fine! ", "x\x0b", " ", "a b."])
            table.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
    return table


def write(spark, tmp_path, table, name="sf", parts=3):
    folder = str(tmp_path / name)
    spark.createDataFrame(table, SCHEMA).repartition(parts).write.parquet(f"{folder}/conversations.parquet")
    return folder


def rows_of(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_equals_plain_python(spark, tmp_path):
    rng = random.Random(3)
    table = conversations_of(rng, 150, 9)
    table += table[:20] + [(None, None, None, None), (None, 3, "user", "hello."), (-7, None, "assistant", "x" * 1_000_000)]
    table += [(500, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(60)]
    folder = write(spark, tmp_path, table)
    got = repair.op11_repair(spark, folder)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = expected(table)
    assert got.count() == len(want) and rows_of(got) == want
    assert repair.op11_repair(spark, write(spark, tmp_path, [], "none")).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_pieces_of_conversations_give_the_same(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(turn_tables, "BLOCK_BITS", bits)
    table = conversations_of(random.Random(bits), 40, 30)
    assert rows_of(repair.op11_repair(spark, write(spark, tmp_path, table))) == expected(table)


def test_registered_table_equals_plain_python(spark):
    folder = "/root/testdata/sf0.01"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(repair.op11_repair(spark, folder)) == expected(table)


def test_edits_hold_texts_and_other_columns_are_ignored(spark):
    table = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Yes.")], SCHEMA)
    for name in ("kind", "digest", "report", "code", "_at", "block"):
        table = table.selectExpr("*", f"'x' AS {name}")
    edited = repair.edits(table).cache()
    assert [r.edit for r in edited.orderBy("step").collect()] == [None, "K", "I", "K", "K"]
    assert [(r.role, r.text) for r in repair.repaired(edited).orderBy("step").collect()] == [
        ("user", "Hi."), ("assistant", ""), ("user", "There."), ("assistant", "Yes.")]


def test_ranks_order_whole_audits():
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = 40
        label = rng.integers(0, 4, n)
        pointer = np.array([i if label[i] == 0 else rng.integers(i + 1, n) if i + 1 < n else i for i in range(n)])
        label[n - 1], pointer[n - 1] = 0, n - 1
        rank, pointers, length = repair.doubled(label, pointer)
        words = []
        for i in range(n):
            word, node = "", i
            while label[node]:
                word, node = word + str(label[node]), pointer[node]
            words.append(word)
            assert length[i] == len(word) and pointers[-1][i] == node
        order = {w: k for k, w in enumerate(sorted(set(words)))}
        assert [order[w] for w in words] == (np.unique(rank, return_inverse=True)[1]).tolist()
