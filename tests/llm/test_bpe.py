import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import bpe
from lakeloom.llm.common import documents
from corpora import corpus

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
OURS = bpe.Bpe(bpe.read_vocabulary())
THEIRS = tokenizers.Tokenizer.from_file(public.path(bpe.VOCABULARY))

ALPHABET = "abcdefghij ABC  éßΣσñ\n\t.,'’!0123😀漢字\x1c <|>endoftext"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=6))
def test_ids_and_decoding_equal_the_library(texts):
    texts += ["".join(texts), "<|endoftext|>" + texts[0] + "<|startoftext|>", "aaaaaaa bbbb 'll I'VE"]
    flat, begin = OURS.encode_run(pa.array(texts, pa.string()))
    decoded = OURS.decode_run(flat, begin).to_pylist()
    for i, text in enumerate(texts):
        ids = THEIRS.encode(text, add_special_tokens=False).ids
        assert flat[begin[i]:begin[i + 1]].tolist() == ids == OURS.encode(text)
        assert decoded[i] == THEIRS.decode(ids, skip_special_tokens=False) == OURS.decode(ids)


def test_documents(spark, stored, clashing):
    rows = corpus(3, 20)
    folder = stored(rows)
    out = bpe.encode_documents(clashing(folder), bpe.read_vocabulary()).collect()
    assert len(out) == len(rows) and out[0].row == "x"
    for r in out:
        ids = THEIRS.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.token_ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(THEIRS.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.op1_bpe(spark, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bpe.encode_documents(documents(spark, stored([], "none")), bpe.read_vocabulary()).count() == 0


def test_runs_of_equal_symbols_and_a_refused_vocabulary():
    words = [b"a" * n for n in range(1, 40)]
    flat, begin = OURS.encode_words(words)
    for i, word in enumerate(words):
        assert flat[begin[i]:begin[i + 1]].tolist() == THEIRS.encode(word.decode(), add_special_tokens=False).ids
    import json
    data = json.loads(bpe.read_vocabulary())
    data["model"]["merges"] = data["model"]["merges"][::-1]
    with pytest.raises(ValueError):
        bpe.Bpe(json.dumps(data))


def test_every_code_point_equals_the_library():
    import sys
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(points), 50_000):
        texts = [f"a{c}b {c}{c}1" for c in points[first:first + 50_000]]
        flat, begin = OURS.encode_run(pa.array(texts, pa.string()))
        theirs = [e.ids for e in THEIRS.encode_batch(texts, add_special_tokens=False)]
        wrong = [hex(ord(points[first + i])) for i, ids in enumerate(theirs) if flat[begin[i]:begin[i + 1]].tolist() != ids]
        assert not wrong, wrong
