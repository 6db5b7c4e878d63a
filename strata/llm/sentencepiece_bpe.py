"""SentencePiece encoding and decoding (BPE model, identity normaliser, byte fallback).

Vocabulary and scores come from the model file; the merging is done here, by rounds over
flat numpy symbol arrays: the pair ranks' minimum per word, all its leftmost
non-overlapping occurrences merged at once, arrays compacted, until no pair remains.  A
word is a stretch of text that no piece can reach across: byte pairs found in no piece
are cut.  Distinct words are encoded once per worker.

Merging all occurrences of a pair at once equals the library's one-at-a-time order unless the
new piece could join a neighbour at a better rank; such pieces are known from the
vocabulary, and for them only the leftmost occurrence merges in a round.

Defined cases: a null text is empty and has no ids; repeated rows and doc_ids give
repeated results; an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._common import free_name, text_slices
from ._pieces import PieceTable

_SPACE = "▁"
_NEVER = np.int64(1) << 40
#: Occurrences of one pair in a word from which an order-dependent word is merged by a heap.
LONG = 64


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("strata_one_byte", _one_byte)


class Model:
    """Tables made from a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ident = {pieces[i]: i for i in normal}
        rank = {i: -sp.get_score(i) for i in normal}
        self.char = np.full(0x110000, -1, np.int32)
        self.byte = np.zeros(256, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte[int(pieces[i][3:5], 16)] = i
        pairs: dict[int, int] = {}
        joined = np.zeros((256, 256), bool)
        for i in normal:
            p = pieces[i]
            if len(p) == 1:
                self.char[ord(p)] = i
            raw = p.replace(_SPACE, " ").encode()
            joined[list(raw[:-1]), list(raw[1:])] = True
            for k in range(1, len(p)):
                if (a := ident.get(p[:k])) is not None and (b := ident.get(p[k:])) is not None:
                    pairs[a << 20 | b] = i
        self.joined = joined
        self.pair = np.array(sorted(pairs), np.int64)
        self.pair_made = pairs
        self.made = np.array([pairs[k] for k in self.pair.tolist()], np.int32)
        self.rank = np.full(n, _NEVER, np.int64)
        self.rank[normal] = [int(rank[i]) for i in normal]
        left, right, made = self.pair >> 20, self.pair & 0xFFFFF, self.made
        best = np.full(n, _NEVER, np.int64)  # best rank that a piece can join at
        np.minimum.at(best, left, self.rank[made])
        np.minimum.at(best, right, self.rank[made])
        self.jumps = best <= self.rank  # a tie goes to the left
        self.spaces = max([len(pieces[i]) for i in normal if not pieces[i].strip(_SPACE)], default=1)
        self.surface = [bytes([int(pieces[i][3:5], 16)]) if sp.is_byte(i) else pieces[i].replace(_SPACE, " ").encode() if i in rank else b"" for i in range(n)]
        self.decimal = [str(i) for i in range(n)]
        self.bare = np.array([sp.is_byte(i) or sp.is_unknown(i) or sp.is_control(i) for i in range(n)])  # never a dummy prefix
        self.control = {i for i in range(n) if sp.is_control(i)}
        for i in range(n):
            if sp.is_unknown(i):
                self.surface[i], self.unknown, self.unknown_text = sp.decode([i]).encode(), i, sp.decode([i])
        self.table = PieceTable(self._words, "<u4")
        for probe in ("", " a  b", "The  quick\tbrown\n\nfox's  日本語 \U0001f600 ▁x", "aaaaaaa bbbb",
                      *(" " * k + x for k in range(3 * self.spaces + 2) for x in ("", "x"))):
            if self.encode([probe])[0].tolist() != sp.encode(probe) or self.decode(sp.encode(probe)) != sp.decode(sp.encode(probe)):
                raise ValueError("not a BPE model with the identity normaliser, dummy prefix and byte fallback")

    # -- merging ------------------------------------------------------------------------

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair; _NEVER where it has none."""
        key = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        good = (self.pair[at] == key) & (a >= 0) & (b >= 0)
        piece = np.where(good, self.made[at], -1)
        return np.where(good, self.rank[piece], _NEVER), piece

    def _words(self, words: list[bytes]) -> list[np.ndarray]:
        out: list = []
        for i in range(0, len(words), 1 << 15):
            out += self._merge(words[i:i + (1 << 15)])
        return out

    def _merge(self, words: list[bytes]) -> list[np.ndarray]:
        texts = [w.decode().replace(" ", _SPACE) for w in words]
        length = np.array([len(t) for t in texts])
        code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sym = self.char[code]
        slow: dict[int, np.ndarray] = {}
        origin = np.arange(len(sym))  # where a symbol's characters begin
        word = np.repeat(np.arange(len(words)), length)
        done_sym, done_word, done_origin = [], [], []
        last = np.ones(len(sym), bool)
        last[:-1] = word[1:] != word[:-1]
        rank, made = np.full(len(sym), _NEVER, np.int64), np.full(len(sym), -1, np.int32)
        inner = np.flatnonzero(~last)
        rank[inner], made[inner] = self._lookup(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(sym)))
            low = np.minimum.reduceat(rank, first)
            open_ = low < _NEVER
            if not open_.all():
                stay = np.repeat(open_, size)
                done_sym.append(sym[~stay]), done_word.append(word[~stay]), done_origin.append(origin[~stay])
                sym, word, origin, rank, made = sym[stay], word[stay], origin[stay], rank[stay], made[stay]
                size, low = size[open_], low[open_]
                if not len(sym):
                    break
                first = np.cumsum(size) - size
            pick = rank == np.repeat(low, size)
            at = np.flatnonzero(pick)
            # runs of overlapping occurrences: every second one from the left
            begin = np.append(True, at[1:] != at[:-1] + 1)
            run = np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            # pieces that may jump ahead: only the leftmost occurrence of the word
            lead = np.append(True, word[at[1:]] != word[at[:-1]])
            lead_at = np.flatnonzero(lead)
            jumping = np.maximum.reduceat(self.jumps[made[at]], lead_at)
            several = np.diff(np.append(lead_at, len(at)))
            for w in word[at[lead_at[jumping & (several > LONG)]]].tolist():  # one merge a round would be quadratic
                slow[w] = self._by_heap(texts[w])
            at = at[lead | ~np.repeat(jumping, several)]
            if slow:
                alive = ~np.isin(word, list(slow))
                if not alive.all():
                    sym, word, origin, rank, made = sym[alive], word[alive], origin[alive], rank[alive], made[alive]
                    continue
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))  # places after compaction: one symbol gone per earlier merge
            sym, word, origin, rank, made = sym[keep], word[keep], origin[keep], rank[keep], made[keep]
            touch = np.unique(np.concatenate([new, np.maximum(new - 1, 0)]))
            ends = np.append(word[touch[:-1]] != word[touch[:-1] + 1], True) if touch[-1] + 1 >= len(sym) else word[touch] != word[touch + 1]
            rank[touch], made[touch] = _NEVER, -1
            touch = touch[~ends]
            rank[touch], made[touch] = self._lookup(sym[touch], sym[touch + 1])
        none = [np.zeros(0, np.int64)]
        sym, word, origin = np.concatenate(done_sym or none), np.concatenate(done_word or none), np.concatenate(done_origin or none)
        order = np.argsort(origin, kind="stable")
        sym, word, origin = sym[order], word[order], origin[order]
        bound = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        unknown = set(word[sym < 0].tolist())
        out = [sym[a:b] for a, b in zip(bound, bound[1:])]
        for w in unknown:
            ids: list[int] = []
            for s, o in zip(out[w].tolist(), origin[bound[w]:bound[w + 1]].tolist()):
                ids.extend([s] if s >= 0 else self.byte[list(chr(code[o]).encode())].tolist())
            out[w] = np.array(ids)
        for w, ids in slow.items():
            out[w] = ids
        return out

    def _by_heap(self, text: str) -> np.ndarray:
        """One word by single merges from a heap; for the rare long word whose merges depend on their order."""
        sym = self.char[np.frombuffer(text.encode("utf-32-le"), np.uint32)].tolist()
        n = len(sym)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        table = self.pair_made
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            if 0 <= i and j < n and (p := table.get(sym[i] << 20 | sym[j])) is not None and sym[i] >= 0 and sym[j] >= 0:
                heapq.heappush(heap, (int(self.rank[p]), i, sym[i], sym[j]))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = table[a << 20 | b], -2
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            push(left[i], i)
            push(i, right[i])
        ids: list[int] = []
        for s, c in zip(sym, text):
            if s != -2:
                ids.extend([s] if s >= 0 else self.byte[list(c.encode())].tolist())
        return np.array(ids)

    # -- texts --------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        raw = [(" " + t.replace(_SPACE, " ")).encode() if t else b"" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        begin = np.cumsum([0, *map(len, raw)])
        if not len(data):
            return [np.zeros(0, np.uint32) for _ in texts]
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.joined[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
        cut[begin[:-1][begin[:-1] < len(data)]] = True
        # Spaces gather from the left into the longest piece of spaces: a long run is cut behind each such piece.
        space = np.flatnonzero(data == 32)
        lead = np.append(True, np.diff(space) != 1) | cut[space]
        place = np.arange(len(space)) - np.maximum.accumulate(np.where(lead, np.arange(len(space)), 0))
        cut[space[place % self.spaces == 0]] = True
        start = np.flatnonzero(cut)
        ids, count = self.table.ids(data, start)
        at = np.append(0, np.cumsum(count))[np.searchsorted(start, begin)].tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def decode(self, ids) -> str:
        """The library's decode(ids): surfaces joined, the dummy prefix's space taken off."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        if not self.control.isdisjoint(ids):  # they give no text but end a run of bytes
            k = next(k for k, i in enumerate(ids) if i in self.control)
            rest = ids[k + 1:]
            return self.decode(ids[:k]) + (self.decode([self.unknown, *rest])[len(self.unknown_text):] if k else self.decode(rest))
        raw = b"".join(map(self.surface.__getitem__, ids))
        if ids and raw[:1] == b" " and not self.bare[ids[0]]:
            raw = raw[1:]
        return raw.decode("utf-8", "strata_one_byte")


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with columns ``ids`` (array of int, the ids of ``text``) and ``exact`` (whether decoding
    them gives ``text`` back: not so where the text has U+2581, the model's own sign for a space).
    Where ``docs`` has a column of such a name, the added one takes underscores in front until its name is free."""
    added = [free_name(c, docs.columns) for c in ("ids", "exact")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for a, b, _, _ in text_slices(texts):
                some = [t or "" for t in texts.slice(a, b - a).to_pylist()]
                ids = m.encode(some)
                at = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32)
                exact = [m.decode(x) == t for x, t in zip(ids, some)]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pa.array(exact)],
                                                 [*batch.schema.names, *added])
        m.table.clear()

    types = (T.ArrayType(T.IntegerType()), T.BooleanType())
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *map(T.StructField, added, types)]))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` (named as in ``encode``): the text of the ids in column ``ids`` (null: empty)."""
    added = free_name("decoded", encoded.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            coded = batch.column(batch.schema.get_field_index(ids))
            text = [m.decode(x.values.to_numpy(zero_copy_only=False) if x.is_valid else []) for x in coded]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], [*batch.schema.names, added])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(added, T.StringType())]))


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, digest of the decimal ids, digest of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            for a, b, _, _ in text_slices(batch.column(1)):
                ids = m.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([sha(",".join(map(m.decimal.__getitem__, x.tolist())).encode()) for x in ids]),
                     pa.array([sha(m.decode(x).encode()) for x in ids])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        m.table.clear()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
