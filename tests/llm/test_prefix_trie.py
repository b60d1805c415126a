import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from lakeloom.llm import prefix_trie, turns as turn_tables

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            convs[conv].append((turn, role or "", text or ""))
    for rows in convs.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] + "\0" + r[2]).encode()).hexdigest()))
    nodes = defaultdict(list)
    built = {}
    for c, rows in convs.items():
        h = crc32(str(c).encode()) % 6
        built[c] = [r[1:] for r in convs.get(c - c % 100, [])[:h] + rows[h:]]
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, own in nodes.items():
        gain = (len(own) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += gain
    return sorted((min(own), len(path), min(nodes[path[:-1]]) if path else -1, len(own), children[path], leaves[path], saved[path],
                   hashlib.sha256(",".join(str(c) for c in sorted(own) if len(built[c]) == len(path)).encode()).hexdigest())
                  for path, own in nodes.items())


def rows_of(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *tuple(r)[3:]) for r in df.collect())


def write(spark, tmp_path, table, name="sf", parts=3):
    folder = str(tmp_path / name)
    spark.createDataFrame(table, SCHEMA).repartition(parts).write.parquet(f"{folder}/conversations.parquet")
    return folder


def conversations_of(rng, n, size, words=3):
    return [(rng.choice([c, c, c + 100 * (c % 3)]), rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]),
             rng.choice(["a", "bb", "ñ😀", "", None][:words + 2])) for c in range(n) for t in range(rng.randint(1, size))]


def test_equals_plain_python(spark, tmp_path):
    rng = random.Random(2)
    table = conversations_of(rng, 260, 9)
    table += table[:10] + [(None, 1, "user", "x"), (700, None, None, None), (701, 5, "user", "y" * 1_000_000)]
    table += [(c, t, "user", f"same {t}") for c in range(800, 860) for t in range(7)]
    folder = write(spark, tmp_path, table)
    got = prefix_trie.op12_prefix_trie(spark, folder)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes[:-1]} == {"bigint"}
    assert rows_of(got) == expected(table)
    assert prefix_trie.op12_prefix_trie(spark, write(spark, tmp_path, [], "none")).count() == 0


@pytest.mark.parametrize("small,bits", [(1, 1), (5, 3), (40, 0)])
def test_rounds_by_joins_and_blocks_give_the_same(spark, tmp_path, monkeypatch, small, bits):
    monkeypatch.setattr(turn_tables, "BLOCK_BITS", bits)
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    table = conversations_of(random.Random(small), 40, 12) + [(900, t, "user", str(t % 7)) for t in range(60)]
    table += [(c, t, "user", "s") for c in range(910, 930) for t in range(5)]
    folder = write(spark, tmp_path, table)
    assert rows_of(prefix_trie.trie(spark.read.parquet(f"{folder}/conversations.parquet"), small=small)) == expected(table)


def test_registered_table_equals_plain_python(spark):
    folder = "/root/testdata/sf0.01"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(prefix_trie.op12_prefix_trie(spark, folder)) == expected(table)


def test_other_columns_are_ignored(spark):
    table = spark.createDataFrame([(1, 0, "user", "Hi."), (2, 0, "user", "Hi.")], SCHEMA)
    for name in ("node", "depth", "digest", "owner", "h", "points", "_at"):
        table = table.selectExpr("*", f"'x' AS {name}")
    assert prefix_trie.trie(table, head=1).count() == 2


def test_small_components_equal_plain_sums():
    rng = random.Random(6)
    for shape in ("random", "chain", "star"):
        for n in (1, 2, 3, 50, 400):
            parent = [-1] + [i - 1 if shape == "chain" else 0 if shape == "star" else rng.randrange(i) for i in range(1, n)]
            depth = [0] * n
            for i in range(1, n):
                depth[i] = depth[parent[i]] + 1
            order = sorted(range(n), key=lambda i: depth[i])
            nodes = [(i, depth[i], parent[i]) for i in order]
            values = [(rng.randint(0, 9), 1) for _ in nodes]
            want = {i: list(v) for (i, _, _), v in zip(nodes, values)}
            for i in reversed(order):
                if parent[i] >= 0:
                    want[parent[i]] = [a + b for a, b in zip(want[parent[i]], want[i])]
            assert prefix_trie.split_small(nodes, values) == [want[i] for i in order]
