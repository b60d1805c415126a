import random
import re

import corpus_pipeline
from lakeloom.llm import bpe, toxicity
from lakeloom.llm.common import DOCUMENT_COLUMNS, documents
from corpora import corpus, prose
from test_decontaminate import brute as holds
from test_ngram_join import brute as groups


def test_rows_equal_brute_force(spark, stored):
    rng = random.Random(2)
    items = [(i, prose(rng, 20)) for i in range(4)]
    rows = [(d, t) for d, t in dict(corpus(12, 40)).items() if d is not None]
    rows += [(3000 + i, prose(rng, 60) + "\n" + t + "\n" + prose(rng, 60)) for i, t in items]
    marks = []
    for i in range(200):
        text = prose(rng, 60)
        rows.append((4000 + i, text + " scummy idiotic scummy" if i % 4 == 0 else text))
        marks.append((4000 + i, 1, int(i % 4 == 0)))
    folder = stored(rows, labels=marks, benchmark=items)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "decontaminate", "bpe"]
    kept = toxicity.stage(spark, documents(spark, folder), folder)
    assert kept.columns == DOCUMENT_COLUMNS
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert not {4000 + i for i in range(0, 200, 4)} & {d for d, _ in left}
    best = {}
    for d, t in sorted(left, key=lambda r: (-len(r[1] or ""), r[0])):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), (d, t))
    left = sorted(best.values())
    component = {d: c for d, _, c, _ in groups(left, 5, 80)}
    left = [(d, t) for d, t in left if component[d] == d]
    left = [(d, t) for d, t in left if not any(holds(t, x) for _, x in items)]
    out = corpus_pipeline.run(spark, folder).collect()
    model = bpe.Bpe(bpe.read_vocabulary())
    assert sorted((r.doc_id, r.text, r.token_ids) for r in out) == [(d, t, model.encode(t)) for d, t in left]
