import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import quality, toxicity
from corpora import prose

BAD = ["idiotic", "scummy", "moronic"]


def labelled(spoil, n=240, seed=3):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rng, rng.randint(20, 120))
        rows.append((i, spoil(rng, text) if bad else text))
        marks.append((i, int(not bad), int(bad)))
    return rows, marks


def insult(rng, text):
    words = text.split(" ")
    for _ in range(3):
        words.insert(rng.randrange(len(words)), rng.choice(BAD))
    return " ".join(words)


def shout(rng, text):
    return " ".join(w.upper() + "!!" for w in text.split(" "))


ODD = [(1000, None), (1001, ""), (1002, "x " * 200_000), (1003, "😀"), (0, "again"), (None, "none")]


@pytest.mark.parametrize("run,spoil,label,folds,fold,least", [
    (toxicity.op3_toxicity, insult, 2, 3, 1, 0.9), (quality.op7_quality, shout, 1, 5, 0, 0.9)])
def test_held_out_accuracy_and_odd_rows(spark, stored, run, spoil, label, folds, fold, least):
    from zlib import crc32
    rows, marks = labelled(spoil)
    folder = stored(rows + ODD, labels=marks + [(5, None, None), (None, 1, 1), (7, 1, 0)])
    out = run(spark, folder).collect()
    assert len(out) == len(rows) + len(ODD)
    truth = {m[0]: m[label] for m in marks}
    known = [r for r in out if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % folds == fold) for r in out if r.doc_id is not None)
    assert all(0 <= r.score <= 1 for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in known]) >= least


def test_without_labels_every_text_scores_alike(spark, stored):
    folder = stored([(1, "a b c"), (2, "d")])
    for run in (toxicity.op3_toxicity, quality.op7_quality):
        assert len({r.score for r in run(spark, folder).collect()}) == 1
        assert run(spark, stored([], "none" + run.__name__)).count() == 0


def test_scores_keep_other_columns(spark, stored, clashing):
    docs = clashing(stored([(1, "a b c"), (2, None)]))
    for scored in (toxicity.score(docs, np.zeros(2 ** 8 + 1, np.float32)), quality.score(docs, quality.Cnn().p)):
        assert dict(scored.dtypes)["score"] == "double" and scored.where(F.col("shard") == "x").count() == 2


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = quality.Cnn()
    texts = [bytes(rng.integers(97, 110, n).astype(np.uint8)) for n in (30, 700, 1, 1500)]
    label, weight = np.array([1, 0, 1, 0]), np.ones(4)
    g = net.gradients(texts, label, weight)

    def loss():
        z = net.logits(texts)
        return np.mean(np.log1p(np.exp(np.where(label == 1, -z, z))))
    for name, place in (("v", 3), ("c", 0), ("b", 5), ("w", (7, 2)), ("emb", (100, 1))):
        old, eps = net.p[name][place], 2e-3
        net.p[name][place] = old + eps
        up = loss()
        net.p[name][place] = old - eps
        down = loss()
        net.p[name][place] = old
        assert abs((up - down) / (2 * eps) - g[name][place]) < 2e-3


def test_long_text_in_segments_keeps_its_maxima(monkeypatch):
    net = quality.Cnn()
    text = bytes(np.random.default_rng(4).integers(97, 123, 6000).astype(np.uint8))
    whole = net.logits([text])[0]
    monkeypatch.setattr(quality, "SEGMENT", 1024)
    assert abs(net.logits([text])[0] - whole) < 0.5
