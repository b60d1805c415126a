import random
from collections import Counter

import pytest

from lakeloom.llm import line_dedup
from corpora import corpus, prose


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_patience_is_an_alignment_and_whole_where_lines_are_unique():
    rng = random.Random(2)
    for _ in range(200):
        a = rng.sample(range(40), rng.randint(0, 25)) if rng.random() < .5 else [rng.randrange(6) for _ in range(rng.randint(0, 20))]
        b = [x for x in a if rng.random() < .8] + [rng.randrange(100, 110) for _ in range(3)]
        rng.random() < .3 and rng.shuffle(b)
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        if len(set(a)) == len(a) and len(set(b)) == len(b):
            assert len(pairs) == lcs(a, b)


def brute(rows, rare, least):
    """Lines left per (doc_id, text), pairing each document with the first holder of a key, in the table's order by id."""
    texts = [[x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")] for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    first = {}
    for i in order:
        if any(texts[i]):
            first.setdefault(tuple(texts[i]), i)
    lead = [i for i in order if first.get(tuple(texts[i])) == i]
    df = Counter(x for i in lead for x in set(texts[i]) if x)
    holder, gone = {}, {i: set() for i in order}
    for i in order:
        t = tuple(texts[i])
        if first.get(t, i) != i:
            gone[i] = set(range(len(t)))
            continue
        if i not in lead:
            continue
        keys = {(x,) if df[x] <= rare else (x, y) for x, y in zip(t, [*t[1:], None])
                if x and df[x] > 1 and (df[x] <= rare or y is not None)}
        for k in keys:
            j = holder.setdefault(k, i)
            if j != i:
                gone[i] |= set(line_dedup.common_blocks(list(t), texts[j], least))
    return {rows[i][0]: "\n".join(x for n, x in enumerate((rows[i][1] or "").split("\n")) if n not in gone[i]) for i in order}


@pytest.mark.parametrize("rare,least", [(50, 2), (2, 2), (1, 1)])
def test_equals_brute_force(spark, stored, clashing, rare, least):
    rng = random.Random(4)
    block, license = prose(rng, 60), "All rights reserved.\nDo not copy."
    rows = [(d, t) for d, t in dict(corpus(10, 30)).items() if d is not None]
    rows += [(500 + i, prose(rng, 40) + "\n" + block + "\n" + license + ("\n" + prose(rng, 30) if i % 2 else "")) for i in range(6)]
    rows += [(600 + i, prose(rng, 24) + "\n" + license) for i in range(8)]
    out = line_dedup.drop_lines(clashing(stored(rows)), rare_docs=rare, least=least).collect()
    assert {r.doc_id: r.text or "" for r in out} == brute(rows, rare, least)
    assert all(r.n_lines == len((dict(rows)[r.doc_id] or "").split("\n")) for r in out)


def test_repeated_and_null_rows(spark, stored):
    rows = [(None, "a\nb"), (3, "a\nb"), (3, "a\nb"), (5, None), (6, ""), (6, "")]
    out = line_dedup.op5_line_dedup(spark, stored(rows)).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in out) == [("3", 0), ("3", 2), ("5", 0), ("6", 0), ("6", 0), ("None", 2)]
    assert line_dedup.op5_line_dedup(spark, stored([], "none")).count() == 0


def test_single_rare_or_long_lines_go_and_common_short_ones_stay(spark, stored, monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(line_dedup, "RARE_DOCS", 5)
    long, rare, short = " ".join(prose(rng, 60).split()), "Rare one.", "Yes."
    own = lambda: prose(rng, 36)
    rows = [(i, "\n".join([own(), short, own(), long, own()])) for i in range(9)]
    rows += [(20, f"{own()}\n{rare}\n{own()}"), (21, f"{own()}\n\t\r\n{rare}\r\n{own()}\n \t\n{short}"),
             # Crossing: the earlier document has them in the other order.
             (30, f"{own()}\nFirst.\n{own()}\nSecond.\n"), (31, f"{own()}\nSecond.\n{own()}\nFirst.\n{own()}")]
    out = {r.doc_id: r.text.split("\n") for r in line_dedup.drop_lines(spark.read.parquet(stored(rows) + "/documents.parquet")).collect()}
    gone = {d: [x for x in t.split("\n") if x not in out[d]] for d, t in rows}
    assert gone == {0: [], **{i: [long] for i in range(1, 9)}, 20: [], 21: [rare + "\r"], 30: [], 31: ["Second.", "First."]}


def test_repeated_and_crossing_blocks_go():
    a, b = [1, 2, 9, 1, 2, 8, 5, 0, 6, 7, 3, 4], [3, 4, 11, 1, 2, 12, 5, 0, 6, 13, 1, 2]
    assert line_dedup.common_blocks(a, b) == [0, 1, 3, 4, 6, 7, 8, 10, 11]
    # Blank lines between count: 5, 6 without one is no block of the earlier document, nor are three lines of two blocks.
    assert line_dedup.common_blocks([5, 6, 20, 1, 3], b) == []
    assert line_dedup.common_blocks([0, 1, 2, 5, 0, 6], b, 3) == []
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 16))] for _ in range(2))
        gone = set(line_dedup.common_blocks(a, b))
        runs = {tuple(b[j:j + n]) for n in range(2, len(b) + 1) for j in range(len(b) - n + 1)}
        for i in range(len(a)):
            for n in range(2, len(a) - i + 1):
                if a[i] and a[i + n - 1] and tuple(a[i:i + n]) in runs:
                    assert gone >= set(range(i, i + n))
        assert all(a[i] in b for i in gone)


def test_deletions_come_from_the_alignment(monkeypatch):
    a, b = [1, 2, 9, 1, 2, 8, 5, 0, 6, 7, 3, 4], [3, 4, 11, 1, 2, 12, 5, 0, 6, 13, 1, 2]
    assert line_dedup.common_blocks(a, b, alone=[7, 5])
    monkeypatch.setattr(line_dedup, "patience", lambda a, b: [])
    assert line_dedup.common_blocks(a, b, alone=[7, 5]) == []


def test_long_documents_in_any_order():
    # Reversed blocks, one block many times, and blocks shuffled: each line of the later document goes.
    count = 20_000
    pairs = [[2 * i + 1, 2 * i + 2] for i in range(count)]
    b = [x for p in pairs for x in (*p, 0)]
    assert line_dedup.common_blocks([x for p in pairs[::-1] for x in p], b) == list(range(2 * count))
    assert line_dedup.common_blocks([1, 2] * count, b) == list(range(2 * count))
    assert line_dedup.common_blocks(b, [1, 2, 1, 2]) == [0, 1]
    random.Random(5).shuffle(pairs)
    assert line_dedup.common_blocks([x for p in pairs for x in p], b) == list(range(2 * count))
    assert line_dedup.common_blocks([x for p in pairs for x in (p[0], -1)], b, alone=range(0, 2 * count, 4)) == []
    assert len(line_dedup.common_blocks([x for p in pairs for x in (p[0], -1)], b, alone=range(1, 2 * count, 4))) == count // 2


@pytest.mark.parametrize("rare", [2, 8])
def test_blocks_of_all_earlier_documents_go(spark, stored, monkeypatch, rare):
    monkeypatch.setattr(line_dedup, "RARE_DOCS", rare)
    rng = random.Random(8)
    # The first holders of both lines have them apart; a blank line may stand between.
    rows = [(1, "Ah.\nbe"), (2, "Oh.\nbe"), (3, "Ah.\nOh.\nbo"), (4, "by\nAh.\nOh.")]
    rows += [(10 + i, "\n".join(rng.choice(["Ah.", "Oh.", "", "x", "y", "z", "u v", "w " * 40]) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    docs = spark.read.parquet(stored(rows) + "/documents.parquet")
    got = {r._row: r.places for r in line_dedup.repeated_lines(docs).collect()}
    rows_of = {r.doc_id: r._row for r in line_dedup.with_row(docs.select("doc_id"), "_row").collect()}
    texts = {d: [x.strip() for x in t.split("\n")] for d, t in rows if t.strip()}
    firsts = {tuple(t): d for d, t in sorted(texts.items(), reverse=True)}
    df = Counter(x for t in firsts for x in set(t) if x)
    lines, blocks = set(), set()
    for d, t in sorted(texts.items()):
        gone = set(got.get(rows_of[d], ()))
        if firsts[tuple(t)] == d:
            for i, x in enumerate(t):
                assert not x or x not in lines or i in gone or (df[x] > rare and len(x) < line_dedup.LONG_CHARS)
            for key, at in line_dedup.neighbours(t, 2):
                if key in blocks:
                    assert gone >= set(range(at[0], at[-1] + 1))
            assert all(not t[i] or t[i] in lines for i in gone)
        lines.update(t)
        blocks.update(key for key, _ in line_dedup.neighbours(t, 2))
