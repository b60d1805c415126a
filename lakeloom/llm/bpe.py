"""Byte-pair encoding with a pair occurrence index.

The distinct words of a run of documents are laid out in one array of symbols.
An index maps the rank of each adjacent pair to all its positions; the ranks
present are taken in ascending order, every occurrence of the pair is merged
at once, and the lists of the pairs left and right of it are updated. Taking
ranks in this order equals merging each word on its own, because a vocabulary
is refused in which a merge uses a symbol that a later merge makes.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.common import DOCUMENT_COLUMNS, documents, extended, small_batches

VOCABULARY = "word_bpe_49k.json"
#: Bytes of documents that a task lays out at once.
RUN_BYTES = 1_500_000
# Fixed values of the vocabulary's own description of words: what counts as one word.
# The vocabulary does not count the separators 1C to 1F as white space, as the library behind `regex` does.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|(?:[^\s\p{L}\p{N}]|[\x1c-\x1f])+"

# Letters and digits that Unicode 16.0 has beyond 15.1 (first, last), and lower-case forms (first, last, distance)
# that 16.0 and 17.0 add. The vocabulary's library cuts words by 16.0 and lowers by 17.0; Python 3.13 has 15.1, `regex` 17.0.
ADDED = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
         (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
         (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA),
         (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9),
         (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA)]
LOWERED = [(0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
           (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27)]
LOWER = {c: c + distance for first, last, distance in LOWERED for c in range(first, last + 1)}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next free one from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    """A vocabulary file of the word-end kind, read from its text.

    ``encode_words`` is the pair occurrence index; ``encode`` and ``decode``
    work on whole texts. A text is split at the special tokens it spells out;
    the rest is composed (NFC), lower-cased and cut into words.
    """

    def __init__(self, source: str):
        data = json.loads(source)
        model = data["model"]
        self.end = model["end_of_word_suffix"] or ""
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        by_id = {i: t for t, i in [*vocabulary.items(), *self.special.items()]}
        self.tokens = [by_id.get(i, "") for i in range(1 + max(by_id))]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.left, self.right = left, right
        made_at = {}
        for rank, symbol in enumerate(self.made.tolist()):
            if made_at.setdefault(symbol, rank) != rank:
                raise ValueError("two merges make one symbol")
        if any(made_at.get(s, -1) >= r for r, pair in enumerate(zip(left.tolist(), right.tolist())) for s in pair):
            raise ValueError("a merge uses a symbol that a later merge makes")
        key = left << 32 | right
        order = np.argsort(key)
        self._keys, self._ranks = key[order], order
        symbols = byte_symbols()
        self._inner = np.array([vocabulary[s] for s in symbols], np.int64)
        self._final = np.array([vocabulary[s + self.end] for s in symbols], np.int64)
        self._split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self._word = regex.compile(WORD + r"|\n")

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the vocabulary has no such merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of (non-empty) words, one after the other, and where each word's ids begin, the end included."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        size = len(flat)
        symbol = self._inner[flat]
        symbol[ends - 1] = self._final[flat[ends - 1]]
        word = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        # Neighbours inside the word; position `size` stands for none.
        after = np.arange(1, size + 1)
        after[ends - 1] = size
        before = np.arange(-1, size - 1)
        before[np.concatenate(([0], ends[:-1]))] = size
        symbol, after, before = np.append(symbol, -1), np.append(after, size), np.append(before, size)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(positions: np.ndarray) -> None:
            """File the pairs that start at these positions under their ranks."""
            positions = positions[after[positions] < size]
            rank = self._rank_of(symbol[positions], symbol[after[positions]])
            found = rank >= 0
            positions, rank = positions[found], rank[found]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            positions, rank = positions[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank, prepend=-1)).tolist() + [len(rank)]
            for first, last in zip(cuts, cuts[1:]):
                r, p = int(rank[first]), positions[first:last]
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(active, r)

        add(np.arange(size))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b = self.left[rank], self.right[rank]
            # Some occurrences have gone since they were filed.
            at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
            if a == b and len(at) > 1:
                # In a run of equal symbols every second pair counts, from the left.
                runs = np.flatnonzero(after[at[:-1]] != at[1:]) + 1
                starts = np.concatenate(([0], runs))
                inside = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
                at = at[inside % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbol[at], symbol[gone] = self.made[rank], -1
            after[at] = after[gone]
            before[after[at]] = at
            before[size] = size
            left = before[at]
            add(np.concatenate((at, left[left < size])))
        alive = np.flatnonzero(symbol[:size] >= 0)
        return symbol[alive].astype("<u4"), np.searchsorted(word[alive], np.arange(len(words) + 1))

    def words(self, text: str) -> list[str]:
        """Words of a text, special tokens among them, and a line feed for each line feed.

        Letters are lowered one by one, so that sigma keeps one form.
        """
        parts = self._split.split(text) if self._split.search(text) else [text]
        found = []
        for part in parts:
            found += [part] if part in self.special else self._cut(
                unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return found

    def _cut(self, text: str) -> list[str]:
        """Words of a lowered text.

        What Unicode 15.1 leaves unassigned is lowered by the table above and,
        unless 16.0 has it as a letter or digit, cut like a character that never will be assigned.
        """
        new = [c for c in set(text) if c > "\u0377" and unicodedata.category(c) == "Cn"]
        if not new:
            return self._word.findall(text)
        text = text.translate(LOWER)
        odd = [ord(c) for c in set(text) if unicodedata.category(c) == "Cn" and not any(a <= ord(c) <= b for a, b in ADDED)]
        cut = text.translate(dict.fromkeys(odd, "\uffff"))
        return [text[m.start():m.end()] for m in self._word.finditer(cut)]

    def encode_run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of texts (null: none) and where each text begins among them.

        Texts are cut at white space; distinct pieces are cut into words, and distinct words are encoded.
        """
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            lists = pa.array([re.split(r"[^\S\x1c-\x1f]+", t or "") for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        pieces = lists.flatten().dictionary_encode()
        words = self.words("\n".join(pieces.dictionary.to_pylist())) if len(pieces) else []
        named = pa.array(words, pa.string()).dictionary_encode()
        distinct = named.dictionary.to_pylist()
        plain = [w for w in distinct if w not in self.special and w != "\n"]
        flat, begin = self.encode_words([w.encode() for w in plain])
        # Special tokens and line feeds follow the plain words: one id each, and none.
        tail = [w for w in distinct if w in self.special]
        flat = np.concatenate((flat, np.array([self.special[w] for w in tail], np.uint32)))
        begin = np.concatenate((begin, begin[-1] + np.arange(1, len(tail) + 1), [begin[-1] + len(tail)]))
        place = {w: i for i, w in enumerate(plain + tail + ["\n"])}
        order = np.array([place[w] for w in distinct], np.int64)[named.indices.to_numpy(zero_copy_only=False)]
        breaks = np.flatnonzero(order == len(place) - 1)
        flat, begin = gather(flat, begin, order)
        begin = begin[np.concatenate(([0], breaks, [len(order)])).astype(np.int64)]
        flat, begin = gather(flat, begin, pieces.indices.to_numpy(zero_copy_only=False))
        return flat, begin[np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)]

    def encode(self, text: str) -> list[int]:
        return self.encode_run(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by blanks, special ones included: the vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def decode_run(self, flat: np.ndarray, begin: np.ndarray) -> pa.Array:
        """``decode`` of many texts, given as the result of ``encode_run``."""
        tokens = pa.array(self.tokens, pa.string()).take(pa.array(flat.astype(np.int64)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), tokens), " ")


def gather(flat: np.ndarray, begin: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists number ``rows`` of the lists that begin at ``begin`` in ``flat``, laid out in the same way."""
    sizes = (begin[1:] - begin[:-1])[rows]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(ends[-1]) + np.repeat(begin[:-1][rows] - ends[:-1], sizes)
    return flat[at], ends


def read_vocabulary(path: str | None = None) -> str:
    """Text of a vocabulary file; by default the public one installed beside the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", with_ids: bool = True,
                     passed: list[str] | None = None) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids (array<int>).

    Texts are encoded whole; null counts as empty and gives no tokens.
    Columns of these names in ``docs`` are replaced, all others pass through,
    or those in ``passed``. Repeated rows are encoded each, an empty table gives an empty table. A
    task holds one run of documents at a time.
    """
    from hashlib import sha256

    spark = docs.sparkSession
    small_batches(spark)
    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if with_ids else "")
    places, schema = extended(docs, added, passed)
    shared = spark.sparkContext.broadcast(vocabulary)
    place = docs.columns.index(text)

    def flush(bpe: Bpe, run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, begin = bpe.encode_run(pa.concat_arrays([b.column(place) for b in run]))
        decoded = bpe.decode_run(flat, begin)
        first = 0
        for batch in run:
            cuts = begin[first:first + batch.num_rows + 1]
            ids = [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            texts = decoded.slice(first, batch.num_rows).to_pylist()
            columns = [pa.array(np.diff(cuts), pa.int64()),
                       pa.array([sha256(i).hexdigest() for i in ids], pa.string()),
                       pa.array([sha256(t.encode()).hexdigest() for t in texts], pa.string())]
            if with_ids:
                values = pa.array(flat[cuts[0]:cuts[-1]].astype(np.int32), pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(cuts - cuts[0], pa.int32()), values))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), *columns], schema.names)
            first += batch.num_rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, run, size = Bpe(shared.value), [], 0
        for batch in batches:
            run.append(batch)
            size += batch.nbytes
            if size >= RUN_BYTES:
                yield from flush(bpe, run)
                run, size = [], 0
                pa.default_memory_pool().release_unused()
        if run:
            yield from flush(bpe, run)

    return docs.mapInArrow(task, schema)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return encode_documents(docs, read_vocabulary(), with_ids=False, passed=["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs.select(*DOCUMENT_COLUMNS), read_vocabulary())
