import hashlib
import re
from collections import defaultdict

import pytest

from lakeloom.llm import exact_dedup
from lakeloom.llm.common import documents
from corpora import corpus


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d, t))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        out += [(d, keep[2], len(members), hashlib.sha256(norm.encode()).hexdigest()) for _, _, d, _ in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,bits", [(4096, 64), (5, 64), (7, 3)])
def test_equals_brute_force_also_when_hashes_collide(spark, stored, block, bits):
    rows = corpus()
    got = exact_dedup.exact_groups(documents(spark, stored(rows)), block, bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)
    kept = [(r.text_sha256, r.keep_id, r.doc_id) for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(k == d for _, k, d in kept)


def test_names_do_not_depend_on_partitions(spark, stored):
    rows = corpus(5, 30)
    names = []
    for parts in (1, 4):
        docs = documents(spark, stored(rows, f"p{parts}", parts))
        names.append(sorted((r.text_sha256, r.level, r.name) for r in exact_dedup.name_texts(docs, 9).collect()))
    assert names[0] == names[1]


def test_empty_table_and_clashing_columns(spark, stored, clashing):
    assert exact_dedup.exact_groups(documents(spark, stored([], "none"))).count() == 0
    rows = corpus(2, 20)
    docs = clashing(stored(rows))
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({re.sub(r"\s", "", t or "") for _, t in rows})
