"""Sentence-piece BPE by vectorised merge rounds.

The distinct words of a run of documents are laid out as flat arrays of
symbols, cut into segments wherever no piece holds the two characters side by
side. A round finds the smallest pair rank of every segment, merges its
occurrences in all segments at once, leftmost first, and compacts the arrays;
segments without a pair leave. Pieces may be found by several pairs, so a merge
can make a pair that ranks before the one in hand: the occurrences right of
such a merge wait for the next round. That equals taking the best pair of the
whole text again and again. A segment of very many symbols, for which the
number of rounds has no good bound, takes its best pairs from a heap instead.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.bpe import gather
from lakeloom.llm.common import documents, extended, small_batches

MODEL = "piece_bpe_32k.model"
#: Bytes of documents that a task lays out at once, and symbols from which on a segment is merged with a heap.
RUN_BYTES, LONG = 1_500_000, 400
# Fixed values of the model file: the space mark, and the kinds of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.int64(1 << 40)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message: whole numbers, or bytes of everything else."""
    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size, at = number(at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class Pieces:
    """A model file of the BPE kind with byte fallback, read from its bytes.

    Refused are models with another normaliser than none, without byte
    fallback, or with pieces that go on after a space.
    """

    def __init__(self, source: bytes):
        pieces, trainer, rules = [], {}, {}
        for field, value in _fields(source):
            if field == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, bytes(4)))[0], own.get(3, NORMAL)))
            elif field in (2, 3):
                (trainer if field == 2 else rules).update(_fields(value))
        kinds = {kind for _, _, kind in pieces}
        # Fields: model type 2 is BPE, 35 byte fallback; the map of the normaliser, its dummy prefix, removal and escaping of spaces.
        if trainer.get(3) != 2 or not trainer.get(35) or rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only BPE models with byte fallback and the identity normaliser")
        if kinds & {USER, UNUSED}:
            raise ValueError("pieces of the user and unused pieces are not supported")
        texts = [t for t, _, kind in pieces if kind == NORMAL and len(t) > 1]
        if any(SPACE in t.lstrip(SPACE) or "\n" in t for t in texts):
            raise ValueError("a piece goes on after a space or a line feed")
        self.begin_id = next(i for i, (t, _, _) in enumerate(pieces) if t == "<s>")
        self.end_id = next(i for i, (t, _, _) in enumerate(pieces) if t == "</s>")
        normal = {t: i for i, (t, _, kind) in enumerate(pieces) if kind == NORMAL}
        # Characters that only longer pieces have are symbols too, without an id of their own.
        symbols = dict(normal)
        for char in sorted({c for t in texts for c in t}):
            symbols.setdefault(char, len(pieces) + len(symbols))
        self.size = len(pieces)
        self.byte = np.zeros(256, np.int64)
        for i, (t, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte[int(t[3:-1], 16)] = i
        single = sorted((ord(t), i) for t, i in symbols.items() if len(t) == 1)
        self._chars, self._char_symbols = np.array([c for c, _ in single]), np.array([i for _, i in single], np.int64)
        order = {s: r for r, s in enumerate(sorted({pieces[normal[t]][1] for t in texts}, reverse=True))}
        pairs = sorted((symbols[t[:k]] << 32 | symbols[t[k:]], order[pieces[normal[t]][1]], normal[t])
                       for t in texts for k in range(1, len(t)) if t[:k] in symbols and t[k:] in symbols)
        self._keys, self._ranks, self._made = (np.array(c, np.int64) for c in zip(*pairs))
        self._beside = np.array(sorted({ord(a) << 32 | ord(b) for t in texts for a, b in zip(t, t[1:])}), np.int64)
        self._word = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        # What ids stand for: bytes of the text; control pieces for nothing, the unknown piece for its mark.
        self._bytes = pa.array([bytes([int(t[3:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else
                                " ⁇ ".encode() if kind == UNKNOWN else t.replace(SPACE, " ").encode()
                                for t, _, kind in pieces], pa.binary())
        self._spaced = np.array([kind == NORMAL and t.startswith(SPACE) for t, _, kind in pieces])
        self._silent = np.array([kind == CONTROL for _, _, kind in pieces])

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NONE where no piece is made of it, and the piece."""
        key = np.where((a < 0) | (b < 0), -1, a << 32 | b)
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NONE), self._made[at]

    def merge(self, symbol: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Merge until no pair is left: the piece at the first symbol of each, -2 at the symbols it took in.

        ``segment`` numbers the symbols' segments in ascending order.
        """
        out = symbol.copy()
        at = np.arange(len(symbol))

        def ranked(places: np.ndarray) -> np.ndarray:
            """Rank of the pair that begins at each of these places."""
            after = np.minimum(places + 1, len(symbol) - 1)
            rank, _ = self._pair(symbol[places], symbol[after])
            return np.where((after > places) & (segment[after] == segment[places]), rank, NONE)

        rank = ranked(at) if len(at) else np.zeros(0, np.int64)
        while len(symbol):
            first = np.flatnonzero(np.diff(segment, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbol)))
            if (least == NONE).any():
                # Compaction: segments without a pair are done.
                stay = np.repeat(least < NONE, sizes)
                out[at[~stay]] = symbol[~stay]
                symbol, segment, at, rank = symbol[stay], segment[stay], at[stay], rank[stay]
                continue
            found = np.flatnonzero(rank == np.repeat(least, sizes))
            # Of overlapping occurrences every second one counts, from the left.
            starts = np.flatnonzero(np.diff(found, prepend=-9) != 1)
            inside = np.arange(len(found)) - np.repeat(starts, np.diff(np.append(starts, len(found))))
            found = found[inside % 2 == 0]
            own = segment[found]
            _, made = self._pair(symbol[found], symbol[found + 1])
            # Does the new piece make a pair that comes before the next occurrence? Its left neighbour may be new itself.
            before = np.maximum(found - 1, 0)
            left = symbol[before]
            new = np.flatnonzero(np.diff(found, prepend=-9) == 2)
            left[new] = made[new - 1]
            after = np.minimum(found + 2, len(symbol) - 1)
            limit = rank[found]
            ahead = (self._pair(left, made)[0] <= limit) & (found > 0) & (segment[before] == own)
            ahead |= (self._pair(made, symbol[after])[0] <= limit) & (found + 2 < len(symbol)) & (segment[after] == own)
            if ahead.any():
                seen = np.cumsum(ahead) - ahead
                base = np.flatnonzero(np.diff(own, prepend=-1))
                early = seen == np.repeat(seen[base], np.diff(np.append(base, len(own))))
                found, made = found[early], made[early]
            symbol[found] = made
            out[at[found + 1]] = -2
            stay = np.ones(len(symbol), bool)
            stay[found + 1] = False
            symbol, segment, at, rank = symbol[stay], segment[stay], at[stay], rank[stay]
            changed = found - np.arange(len(found))
            changed = np.concatenate((changed, changed[changed > 0] - 1))
            rank[changed] = ranked(changed)
        return out

    def merge_long(self, symbol: np.ndarray) -> np.ndarray:
        """``merge`` of one segment by a heap of its pairs (rank, place)."""
        size = len(symbol)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        table = symbol.tolist()
        pairs = self._pairs()
        heap = [(pairs[table[i] << 32 | table[i + 1]][0], i, table[i], table[i + 1]) for i in range(size - 1)
                if table[i] >= 0 and table[i + 1] >= 0 and (table[i] << 32 | table[i + 1]) in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            # Some pairs have gone since they were filed.
            if table[i] != a or j >= size or table[j] != b:
                continue
            table[i], table[j] = pairs[a << 32 | b][1], -2
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < size and table[x] >= 0 and table[y] >= 0 and (pair := pairs.get(table[x] << 32 | table[y])):
                    heapq.heappush(heap, (pair[0], x, table[x], table[y]))
        return np.array(table, np.int64)

    def _pairs(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_pair_table"):
            self._pair_table = dict(zip(self._keys.tolist(), zip(self._ranks.tolist(), self._made.tolist())))
        return self._pair_table

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of (non-empty) words, one after the other, and where each word's ids begin, the end included."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        where = np.minimum(np.searchsorted(self._chars, code), len(self._chars) - 1)
        symbol = np.where(self._chars[where] == code, self._char_symbols[where], -1)
        # A segment begins with a word, and where no piece has the two characters side by side.
        pair = code[:-1] << 32 | code[1:]
        place = np.minimum(np.searchsorted(self._beside, pair), len(self._beside) - 1)
        cut = np.concatenate(([True], self._beside[place] != pair))
        cut[ends[:-1]] = True
        segment = np.cumsum(cut) - 1
        sizes = np.bincount(segment)
        long = np.repeat(sizes > LONG, sizes)
        if not long.any():
            made = self.merge(symbol, segment)
        else:
            made = symbol.copy()
            made[~long] = self.merge(symbol[~long], segment[~long])
            starts = np.cumsum(sizes) - sizes
            for k in np.flatnonzero(sizes > LONG).tolist():
                span = slice(starts[k], starts[k] + sizes[k])
                made[span] = self.merge_long(symbol[span])
        # A character without a piece is spelled in bytes.
        spelled = (made == -1) | (made >= self.size)
        count = np.where(made == -2, 0, 1)
        chars, which = np.unique(code[spelled], return_inverse=True)
        coded = [np.frombuffer(chr(c).encode(), np.uint8) for c in chars.tolist()]
        if len(chars):
            count[spelled] = np.array([len(c) for c in coded])[which]
        total = np.concatenate(([0], np.cumsum(count)))
        flat = np.repeat(made, count)
        if len(chars):
            joined = self.byte[np.concatenate(coded)]
            begin = np.concatenate(([0], np.cumsum([len(c) for c in coded])))
            flat[np.repeat(spelled, count)] = gather(joined, begin, which)[0]
        return flat, total[np.concatenate(([0], ends))]

    def encode_run(self, texts: list[str | None], ends: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of texts (null: empty) and where each text begins among them; ``ends`` adds begin and end ids."""
        lists = [self._word.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        named = pa.array([w for ws in lists for w in ws], pa.string()).dictionary_encode()
        words = named.dictionary.to_pylist()
        flat, begin = self.encode_words(words)
        # Two more words: the begin and the end of a text.
        flat = np.concatenate((flat, [self.begin_id, self.end_id]))
        begin = np.concatenate((begin, begin[-1] + np.array([1, 2])))
        sizes = np.array([len(ws) for ws in lists], np.int64)
        order = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if ends:
            after = np.cumsum(sizes)
            order = np.insert(order, np.stack((after - sizes, after), 1).ravel(),
                              np.tile([len(words), len(words) + 1], len(lists)))
            sizes = sizes + 2
        flat, begin = gather(flat, begin, order)
        return flat, begin[np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)]

    def encode(self, text: str | None, ends: bool = True) -> list[int]:
        return self.encode_run([text], ends)[0].tolist()

    def decode_run(self, flat: np.ndarray, begin: np.ndarray) -> list[str]:
        """Texts of many lists of ids; the space before a text's first piece goes, bytes that are no character become U+FFFD."""
        tokens = self._bytes.take(pa.array(flat))
        # Control pieces stand for nothing, so the first piece is the first other one.
        sounds = np.concatenate((np.flatnonzero(~self._silent[flat]), [len(flat)]))
        first = sounds[np.searchsorted(sounds, begin[:-1])]
        spaced = np.zeros(len(begin) - 1, bool)
        inside = first < begin[1:]
        spaced[inside] = self._spaced[flat[first[inside]]]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), tokens), b"").to_pylist()
        return [t[s:].decode("utf-8", "replace") for t, s in zip(joined, spaced.tolist())]

    def decode(self, ids: Iterable[int]) -> str:
        flat = np.fromiter(ids, np.int64)
        return self.decode_run(flat, np.array([0, len(flat)]))[0]


def read_model(path: str | None = None) -> bytes:
    """Bytes of a model file; by default the public one installed beside the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, model: bytes, text: str = "text", with_ids: bool = True,
                     passed: list[str] | None = None) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids (array<int>).

    Texts are encoded whole, with begin and end ids; null counts as empty and
    has those two alone. Columns of these names in ``docs`` are replaced, all
    others pass through, or those in ``passed``. Repeated rows are encoded
    each, an empty table gives an empty table. A task holds one run of
    documents at a time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if with_ids else "")
    places, schema = extended(docs, added, passed)
    shared = spark.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def flush(model: Pieces, run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, begin = model.encode_run([t for b in run for t in b.column(place).to_pylist()])
        decoded = model.decode_run(flat, begin)
        packed = flat.astype("<u4")
        first = 0
        for batch in run:
            cuts = begin[first:first + batch.num_rows + 1]
            columns = [pa.array(np.diff(cuts), pa.int64()),
                       pa.array([sha256(packed[a:b].tobytes()).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string()),
                       pa.array([sha256(t.encode()).hexdigest() for t in decoded[first:first + batch.num_rows]], pa.string())]
            if with_ids:
                values = pa.array(flat[cuts[0]:cuts[-1]].astype(np.int32), pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(cuts - cuts[0], pa.int32()), values))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), *columns], schema.names)
            first += batch.num_rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, run, size = Pieces(shared.value), [], 0
        for batch in batches:
            run.append(batch)
            size += batch.nbytes
            if size >= RUN_BYTES:
                yield from flush(pieces, run)
                run, size = [], 0
                pa.default_memory_pool().release_unused()
        if run:
            yield from flush(pieces, run)

    return docs.mapInArrow(task, schema)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return encode_documents(docs, read_model(), with_ids=False, passed=["doc_id"])
