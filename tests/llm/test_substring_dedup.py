import random

import numpy as np

from lakeloom.llm import substring_dedup as sub
from lakeloom.llm.common import documents
from corpora import WORDS, corpus


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def test_chunks_cover_the_text_and_resist_shifts():
    rng = random.Random(1)
    text = prose(rng, 3000).encode()
    (whole, _), (shifted, _), (empty, _), (same, _) = sub.Chunker()([text, b"inserted " + text, b"", b"a" * 20_000])
    assert whole[0] == 0 and whole[-1] == len(text) and np.all(np.diff(whole) > 0)
    assert len(empty) == 1 and same[-1] == 20_000 and np.diff(same).max() <= sub.MOST
    cuts = {text[a:b] for a, b in zip(whole, whole[1:])}
    moved = (b"inserted " + text)
    assert sum(moved[a:b] not in cuts for a, b in zip(shifted, shifted[1:])) <= 4
    one = sub.Chunker()([text])[0]
    assert np.array_equal(one[0], whole)


def brute(rows, same, any_source):
    """Spans by chunk contents, one document after the other."""
    first, spans = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], i))
    cut = sub.Chunker()([(t or "").encode() for _, t in rows])
    for i in order:
        data, edges = (rows[i][1] or "").encode(), cut[i][0]
        run, runs = [], []
        for n, (a, b) in enumerate(zip(edges, edges[1:])):
            j, m = first.setdefault(data[a:b], (i, n))
            if (j, m) == (i, n):
                runs, run = runs + [run], []
            else:
                run.append((n, int(a), int(b), j, n - m))
        for run in runs + [run]:
            pieces = []
            for n, a, b, j, shift in run:
                if pieces and pieces[-1][3:] == (j, shift) and pieces[-1][1] == a:
                    pieces[-1] = (pieces[-1][0], b, pieces[-1][2], j, shift)
                else:
                    pieces.append((a, b, n, j, shift))
            total = sum(b - a for a, b, *_ in pieces)
            spans += [(rows[i][0], a, b, rows[j][0]) for a, b, _, j, _ in pieces if b - a >= same or total >= any_source]
    return sorted(spans)


def test_equals_brute_force(spark, stored):
    rows = [(d, t) for d, t in dict(corpus(11, 40)).items() if d is not None]
    got = sub.repeated_spans(documents(spark, stored(rows, parts=1)), run_rows=9, range_keys=100).collect()
    assert sorted((r.doc_id, r.start_byte, r.end_byte, r.first_doc_id) for r in got) == brute(rows, sub.SAME_SOURCE, sub.ANY_SOURCE)


def test_planted_passages_are_caught_and_clean_texts_left_alone(spark, stored, clashing):
    rng = random.Random(3)
    rows, passages = [], [prose(rng, 51) for _ in range(60)]
    for i, p in enumerate(passages):
        rows += [(2 * i, prose(rng, 150) + " " + p + " " + prose(rng, 80)), (2 * i + 1, prose(rng, 70) + " " + p + " " + prose(rng, 90))]
    rows += [(1000 + i, prose(rng, 200)) for i in range(60)] + [(2000, None), (2001, ""), (1000, rows[0][1]), (2002, "ß" * 5000)]
    docs = clashing(stored(rows))
    found = {r.doc_id for r in sub.repeated_spans(docs).collect()}
    assert len(found & set(range(120))) >= 59 and not found & set(range(1001, 1060))
    left = sub.drop_repeats(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[2000] is None and texts[2001] == "" and texts[1001] == dict(rows)[1001]
    assert sum(len(texts[2 * i + 1]) < len(dict(rows)[2 * i + 1]) - 100 for i in range(60)) >= 59
    assert sub.repeated_spans(documents(spark, stored([], "none"))).count() == 0
