import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import piece
from lakeloom.llm.common import documents
from corpora import corpus

sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")
OURS = piece.Pieces(piece.read_model())
THEIRS = sentencepiece.SentencePieceProcessor(model_file=public.path(piece.MODEL))
ALPHABET = "abcdeinthsr ABC  éßñ▁\n\t.,'’!0123😀漢字\x1c\x00<s>/"


def check(texts):
    flat, begin = OURS.encode_run(texts)
    decoded = OURS.decode_run(flat, begin)
    for i, text in enumerate(texts):
        ids = THEIRS.encode(text or "", add_bos=True, add_eos=True)
        assert flat[begin[i]:begin[i + 1]].tolist() == ids, text
        assert decoded[i] == THEIRS.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=6))
def test_ids_and_decoding_equal_the_library(texts):
    check(texts + ["".join(texts), None, "", " ", "▁", " a  b   c    d " + texts[0]])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=4))
def test_any_characters(texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts])


def test_merges_that_make_better_pairs_and_runs(monkeypatch):
    rng = random.Random(4)
    check(["a" * n for n in range(1, 60)] + [" " * n + "x" for n in range(60)] + ["abab" * n for n in range(1, 20)])
    words = ["".join(rng.choice("abeinrst") for _ in range(rng.randint(5, 120))) for _ in range(400)]
    check(words)
    check(["".join(rng.choice("einrst=-_*") for _ in range(3000)), "=" * 5000, "-*" * 3000, "hello" * 2000])
    # The heap alone and the rounds alone give the same.
    for long in (1, 10 ** 9):
        monkeypatch.setattr(piece, "LONG", long)
        check(words[:100] + ["".join(rng.choice("einrst ") for _ in range(2000))])


def test_decoding_of_any_ids():
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.choice([1, 2, 28705, 264, rng.randrange(3, 32000), rng.randrange(1, 3)]) for _ in range(rng.randint(0, 8))]
        ids = [i for i in ids if not 3 <= i < 259]
        assert OURS.decode(ids) == THEIRS.decode(ids), ids


def test_documents(spark, stored, clashing):
    rows = corpus(3, 20) + [(7000, "word " * 40_000), (7001, "漢字" * 20_000)]
    folder = stored(rows)
    out = piece.encode_documents(clashing(folder), piece.read_model()).collect()
    assert len(out) == len(rows) and out[0].row == "x"
    for r in out:
        ids = THEIRS.encode(r.text or "", add_bos=True, add_eos=True)
        assert (r.n_tokens, r.token_ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(THEIRS.decode(ids).encode()).hexdigest()
    assert piece.op13_sentencepiece(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert piece.encode_documents(documents(spark, stored([], "none")), piece.read_model()).count() == 0


def test_refused_models():
    with pytest.raises(ValueError):
        piece.Pieces(b"")
