"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The models (first-order, over the letters, digits and marks of tokens) are trained from
samples the corpus labels itself: values matched by the patterns are random strings, runs
of letters outside them ordinary identifiers.  Transition counts cover every document;
what reaches the driver is one row per class and character pair.  A run of token
characters, or what the pattern matches leave of it, is reported as ``markov`` when its
ratio is high in total and per character; what has no letter is a number or a rule, of
which the identifier model has no counts, and is not scored.

Defined cases: null and empty texts have no spans; spans are code points of the whole
text, end exclusive; repeated rows and doc_ids give repeated results; a corpus without any
pattern match takes random strings to be uniform; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import text_slices

# The patterns of the contract, in its order.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LETTER = re.compile("[A-Za-z]")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN, MIN_IDENTIFIER = 16, 8
#: A span needs this ratio per character pair and in total (natural logarithms).
PER_CHAR, IN_TOTAL = 0.5, 20.0

_N = len(ALPHABET)
_CODE = np.full(256, -1, np.int16)
_CODE[list(ALPHABET)] = np.arange(_N)
_IS_TOKEN = _CODE >= 0
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*range(48, 58), *range(97, 103)]] = True


def _runs(mask: np.ndarray, edge: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` of at least ``least`` places; a text's edge ends a run."""
    n = len(mask)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    start = np.flatnonzero(mask & (~before | edge[:n]))
    end = np.flatnonzero(mask & (~after | edge[1:])) + 1
    long = end - start >= least
    return start[long], end[long]


class Slice:
    """Pattern matches and token runs of a slice of texts; offsets are code points of the text."""

    def __init__(self, texts: list[str], data: np.ndarray, offsets: np.ndarray):
        self.data = data
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        self.points = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points before each byte
        self.origin = self.points[offsets]
        self.offsets = offsets
        self.base: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        self.values: list[str] = []
        for i, t in enumerate(texts):
            if ":" in t or "=" in t:
                for m in ASSIGN.finditer(t):
                    if len(m[2]) >= MIN_VALUE:
                        self.base[i].append((m.start(), 0, m.end()))
                        self.values.append(m[2])
            if "AKIA" in t:
                for m in ACCESS.finditer(t):
                    if m.end() - m.start() >= MIN_ACCESS:
                        self.base[i].append((m.start(), 1, m.end()))
                        self.values.append(m[0][4:])
        for i, a, b, raw in self._placed(*_runs(_IS_HEX[data], edge, MIN_HEX)):
            self.base[i].append((a, 2, b))
            self.values.append(raw)
        for spans in self.base:
            spans.sort()
        start, end = _runs(_IS_TOKEN[data], edge, MIN_IDENTIFIER)
        self.start, self.end = start, end
        if len(start):
            self.digits = np.append(0, np.cumsum(_IS_DIGIT[data]))
            self.letters = np.append(0, np.cumsum(_IS_LETTER[data]))

    def _placed(self, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int, str]]:
        doc = np.searchsorted(self.offsets, start, side="right") - 1
        for i, a, b in zip(doc.tolist(), start.tolist(), end.tolist()):
            o = self.origin[i]
            yield i, int(self.points[a] - o), int(self.points[b] - o), self.data[a:b].tobytes().decode()

    def _outside(self, i: int, a: int, b: int, raw: str) -> Iterator[tuple[int, int, int, str]]:
        """The parts of a run that no pattern match covers."""
        at = a
        for x, _, y in self.base[i]:
            if x >= b:
                break
            if x - at >= MIN_RUN:
                yield i, at, x, raw[at - a:x - a]
            at = max(at, y)
        if b - at >= MIN_RUN:
            yield i, at, b, raw[at - a:]

    def identifiers(self) -> tuple[np.ndarray, np.ndarray]:
        """Byte bounds of the runs of letters alone (marks allowed)."""
        if not len(self.start):
            return self.start, self.end
        plain = (self.digits[self.end] == self.digits[self.start]) & (self.letters[self.end] - self.letters[self.start] >= MIN_IDENTIFIER)
        return self.start[plain], self.end[plain]

    def candidates(self) -> list[tuple[int, int, int, str]]:
        if not len(self.start):
            return []
        some = self.end - self.start >= MIN_RUN
        return [x for found in self._placed(self.start[some], self.end[some]) for x in self._outside(*found) if LETTER.search(x[3])]


def _pairs(raw: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Counts of character pairs; ``inside[i]`` tells that raw[i] and raw[i + 1] belong together."""
    code = _CODE[raw].astype(np.int64)
    good = inside & (code[:-1] >= 0) & (code[1:] >= 0)
    return np.bincount((code[:-1] * _N + code[1:])[good], minlength=_N * _N)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Slice]]:
    texts = batch.column(1)
    for a, b, data, offsets in text_slices(texts):
        yield a, b, Slice([t or "" for t in texts.slice(a, b - a).to_pylist()], data, offsets)


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio (random over identifier) of each character pair, from all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, _N * _N), np.int64)
        for batch in batches:
            for _, _, s in _slices(batch):
                if s.values:
                    raw = np.frombuffer(" ".join(s.values).encode(), np.uint8)
                    total[0] += _pairs(raw, np.ones(len(raw) - 1, bool))
                start, end = s.identifiers()
                if len(start):
                    inside = np.zeros(len(s.data) + 1, np.int8)
                    inside[start] += 1
                    inside[end - 1] -= 1
                    total[1] += _pairs(s.data, np.cumsum(inside[:len(s.data) - 1]) > 0)
        kind, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(pair, pa.int32()), pa.array(total[kind, pair], pa.int64())],
                                         ["kind", "pair", "n"])

    rows = docs.select("doc_id", "text").mapInArrow(count, "kind int, pair int, n long").groupBy("kind", "pair").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, _N * _N))
    for r in rows.collect():  # at most 2 * len(ALPHABET) ** 2 rows
        counts[r["kind"], r["pair"]] = r["n"]
    c = counts.reshape(2, _N, _N) + 0.5
    p = np.log(c / c.sum(axis=2, keepdims=True))
    return p[0] - p[1]


def ratio(model: np.ndarray, token: str) -> float:
    code = _CODE[np.frombuffer(token.encode(), np.uint8)]
    return float(model[code[:-1], code[1:]].sum())


def is_secret(model: np.ndarray, token: str) -> bool:
    r = ratio(model, token)
    return r >= IN_TOTAL and r >= PER_CHAR * (len(token) - 1)


def scan(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """doc_id, spans: array of (kind, start, end), by start, then kind in the order of KINDS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for a, b, s in _slices(batch):
                spans = [list(x) for x in s.base]
                for i, x, y, token in s.candidates():
                    if is_secret(model, token):
                        spans[i].append((x, 3, y))
                out = [[{"kind": KINDS[k], "start": x, "end": y} for x, k, y in sorted(some)] for some in spans]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(out, pa.list_(kind))], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, end long>>")


def digests(spans: DataFrame) -> DataFrame:
    """Counts by kind and the joined spans of ``scan``'s rows."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return spans.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
