import random
import re

import numpy as np
import pytest

from lakeloom.llm import ngram_join
from lakeloom.llm.common import documents
from lakeloom.session import materialise
from corpora import corpus, prose


def word_sets(text, words):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    return frozenset(tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def brute(rows, words, percent):
    """(doc_id, size, component, links) by comparing all pairs."""
    sets = [word_sets(t, words) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(sets[i]), low.get(root(i)), links[i]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("words,percent,options", [
    (4, 85, {}), (5, 80, {}), (4, 60, dict(share=2, run_rows=7, range_keys=50, block_docs=3)), (2, 85, dict(share=100, block_docs=1))])
def test_equals_all_pairs(spark, stored, words, percent, options):
    rows = corpus(4)
    got = ngram_join.similar_groups(documents(spark, stored(rows)), words, percent, **options).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute(rows, words, percent)


def test_search_finds_every_pair():
    rng = np.random.default_rng(2)
    for percent in (50, 80, 85, 100):
        base = [rng.choice(400, rng.integers(1, 60), replace=False) for _ in range(12)]
        sets = []
        for b in base:
            for _ in range(6):
                keep = b[rng.random(len(b)) < 0.95]
                sets.append(np.unique(np.append(keep, rng.integers(400, 900, rng.integers(0, 3)))).astype(np.uint64))
        want = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j])
                if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)) and len(a)}
        assert {tuple(sorted(p)) for p in ngram_join.search(sets, percent)} == want
        side = [i % 2 for i in range(len(sets))]
        assert {tuple(sorted(p)) for p in ngram_join.search(sets, percent, side)} == {p for p in want if side[p[0]] != side[p[1]]}


def test_chains_equal_all_pairs_of_a_shingle(spark):
    rng = np.random.default_rng(5)
    for percent in (50, 85, 100):
        rows = []
        for i in range(400):
            n = int(rng.integers(1, 60))
            place = int(rng.integers(0, ngram_join.prefix_size(n, percent)))
            rows.append((int(rng.integers(0, 60)), i, n, place))
        got = ngram_join.chained(spark.createDataFrame(rows, "token long, row long, n int, place int"), percent).collect()
        want, seen = list(range(len(rows))), list(range(len(rows)))

        def root(parent, i):
            while parent[i] != i:
                i = parent[i]
            return i
        for t, i, m, p in rows:
            for u, j, n, q in rows[:i]:
                if t == u and (100 + percent) * min(m - p, n - q) >= percent * (m + n):
                    want[root(want, i)] = root(want, j)
        for r in got:
            seen[root(seen, r.row)] = root(seen, r.hub)
        chains = [{frozenset(i for i in range(len(rows)) if root(p, i) == k) for k in range(len(rows))} for p in (want, seen)]
        assert chains[0] == chains[1]


def test_passages_shared_by_chance_make_no_candidates(spark, stored, monkeypatch):
    rng = random.Random(3)
    passages = [prose(rng, 24) for _ in range(24)]
    rows = [(i, " ".join(passages[(i + k) % 24] for k in (0, 2, 5))) for i in range(24)]
    apart = prose(rng, 72)
    rows += [(100, apart + " more"), (101, apart + " again")]
    kept = []

    def keep(df, purpose):
        kept.append((purpose, materialise(df, purpose)))
        return kept[-1][1]
    monkeypatch.setattr(ngram_join, "materialise", keep)
    got = ngram_join.similar_groups(documents(spark, stored(rows)), share=1).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute(rows, 4, 85)
    # The two alike, and a few that share a shingle over the border of two passages.
    assert 2 <= [df for purpose, df in kept if purpose == "candidates"][-1].count() < 10


def test_one_of_each_group_stays(spark, stored, clashing):
    rows = corpus(6, 20)
    docs = clashing(stored(rows))
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    groups = brute(rows, 4, 85)
    empty = sum(size == 0 for _, size, _, _ in groups)
    assert left.count() == empty + len({(c, n) if c is None else c for _, n, c, _ in groups if n})
    assert ngram_join.similar_groups(documents(spark, stored([], "none"))).count() == 0
