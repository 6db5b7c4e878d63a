"""Quality classifier: a generalised additive model with pairwise interactions.

Numeric features of the text alone are cut into quantile bins.  Shallow trees are
boosted on the logistic loss, one feature after the other round by round, each adding to
that feature's lookup table; then the pairs with the largest gain on the residuals get
tables of their own the same way.  A score is a sum of table entries.

The tables are fitted from at most ``max_train`` labelled rows (those with the smallest
hashes of doc_id among the rows not held out); every document is scored.

Defined cases: null and empty texts have all-zero features and get a score like any
other; labels that are null do not count and the smallest label of a doc_id holds; with
labels of one class only, or none, the score is constant (the class; 1 without labels);
an empty table gives no rows; other columns, labels, lang, source and doc_id are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Words, _mix, ngram_hash, text_slices

FEATURES = ("log_words", "bytes_per_word", "upper", "digits", "marks", "stops", "pipes", "odd_ends", "double_ends",
            "distinct", "adjacent", "repeated4", "non_ascii", "lines", "exclamations", "odd_end_kinds")
THRESHOLD = 0.7


def _lut(chars) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_UPPER, _LETTER = _lut(range(65, 91)), _lut([*range(65, 91), *range(97, 123)])
_DIGIT, _STOP = _lut(range(48, 58)), _lut(b".,;:?")
_MARK = _lut([b for b in range(33, 127) if not chr(b).isalnum()])
_ODD = _MARK & ~_lut(b".,;:?!'\"-)")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text."""
    w = Words(data, offsets, lower=False)
    texts = len(offsets) - 1
    n_words = np.diff(w.first)
    doc = np.repeat(np.arange(texts), n_words)

    def bytes_in(mask: np.ndarray) -> np.ndarray:
        c = np.append(0, np.cumsum(mask))
        return c[offsets[1:]] - c[offsets[:-1]]

    def words_in(mask: np.ndarray, at: np.ndarray = doc) -> np.ndarray:
        return np.bincount(at[:len(mask)][mask], minlength=texts) if len(mask) else np.zeros(texts, int)

    def distinct(h: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not len(h):
            return np.zeros(texts, int)
        with np.errstate(over="ignore"):
            _, first = np.unique(_mix(h + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        return np.bincount(at[first], minlength=texts)

    size = np.diff(offsets)
    words, length = np.maximum(n_words, 1), np.maximum(size, 1)
    last = data[w.end - 1]
    before = data[np.maximum(w.end - 2, 0)]
    odd = _ODD[last]
    same = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
    four, whole = ngram_hash(w.hash, 4), doc[3:] == doc[:-3]
    n4 = np.maximum(n_words - 3, 0)
    with np.errstate(over="ignore"):
        kinds = distinct(last[odd].astype(np.uint64) + np.uint64(1), doc[odd])
    return np.column_stack([
        np.log1p(n_words), size / words, bytes_in(_UPPER[data]) / np.maximum(bytes_in(_LETTER[data]), 1),
        bytes_in(_DIGIT[data]) / length, bytes_in(_MARK[data]) / words, bytes_in(_STOP[data]) / words,
        bytes_in(data == ord("|")) / words, words_in(odd) / words,
        words_in(odd & (before == last) & (w.end - w.start > 1)) / words,
        distinct(w.hash, doc) / words, words_in(same) / words,
        (n4 - distinct(four[whole], doc[:-3][whole])) / np.maximum(n4, 1),
        bytes_in(data >= 128) / length, bytes_in(data == 10) / words, bytes_in(data == ord("!")) / words, kinds]).astype(float)


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables by feature, and tables by pair of features (over coarser bins)."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float = 0.0
    single: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.single):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (i, j), table in self.pairs.items():
            total += table[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-total))


def _step_tree(g: np.ndarray, h: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """Best tree of up to ``leaves`` intervals over the ordered bins (greedy splits by gain)."""
    cg, ch = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))
    cuts = [0, len(g)]
    part = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + smooth)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = part(a, k) + part(k, b) - part(a, b)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), int(k[i]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + smooth)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """Best cut of a two-way table into four quadrants: (gain, values)."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    n, m = g.shape
    i, j = np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij")
    if not i.size:
        return 0.0, np.zeros_like(g)
    corner = lambda c: (c[i, j], c[i, m] - c[i, j], c[n, j] - c[i, j], c[n, m] - c[i, m] - c[n, j] + c[i, j])
    gain = sum(a * a / (b + smooth) for a, b in zip(corner(cg), corner(ch)))
    at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [a[at] / (b[at] + smooth) for a, b in zip(corner(cg), corner(ch))]
    r, c = int(i[at]), int(j[at])
    out = np.empty_like(g)
    out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:] = values
    return float(gain[at]) - float(cg[n, m] ** 2 / (ch[n, m] + smooth)), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, coarse_bins: int = 12, rounds: int = 120, pair_rounds: int = 60,
        n_pairs: int = 10, rate: float = 0.1, leaves: int = 3, smooth: float = 2.0) -> AdditiveModel:
    """Cyclic boosting of single features, then of the ``n_pairs`` pairs with the largest gain."""
    cut = lambda col, k: np.unique(np.quantile(col, np.arange(1, k) / k)) if len(col) else np.zeros(0)
    model = AdditiveModel([cut(c, bins) for c in x.T], [cut(c, coarse_bins) for c in x.T])
    share = float(y.mean()) if len(y) else 1.0
    if share in (0.0, 1.0):
        model.base = 50.0 if share else -50.0
        return model
    model.base = float(np.log(share / (1 - share)))
    fine = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
    rough = [np.searchsorted(e, c, side="right") for e, c in zip(model.coarse, x.T)]
    model.single = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, b in enumerate(fine):
            g, h = slopes()
            k = len(model.single[j])
            step = rate * _step_tree(np.bincount(b, g, k), np.bincount(b, h, k), leaves, smooth)
            model.single[j] += step
            total += step[b]

    def table(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, m = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        cell = rough[i] * m + rough[j]
        return np.bincount(cell, g, n * m).reshape(n, m), np.bincount(cell, h, n * m).reshape(n, m)

    g, h = slopes()
    gains = {(i, j): _quadrants(*table(i, j, g, h), smooth)[0] for i in range(len(fine)) for j in range(i)}
    for pair in sorted(gains, key=gains.get, reverse=True)[:n_pairs]:
        model.pairs[pair] = np.zeros((len(model.coarse[pair[0]]) + 1, len(model.coarse[pair[1]]) + 1))
    for _ in range(pair_rounds):
        for (i, j), t in model.pairs.items():
            g, h = slopes()
            step = rate * _quadrants(*table(i, j, g, h), smooth)[1]
            t += step
            total += step[rough[i], rough[j]]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> AdditiveModel:
    """Fit from at most ``max_train`` labelled documents that are not held out."""
    some = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(list(features(data, offsets)), pa.list_(pa.float64()))], ["label", "x"])

    # at most max_train rows of two integers: their size is bounded whatever the corpus
    sample = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("label", "text")
    got = sample.mapInArrow(rows, "label int, x array<double>").toPandas()
    x = np.array(got["x"].tolist()).reshape(len(got), len(FEATURES))
    order = np.lexsort([*x.T, got["label"].to_numpy()])  # the fit does not depend on row order
    return fit(x[order], got["label"].to_numpy(float)[order])


def score(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(model.score(features(data, offsets)))], ["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, in their own columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for a, b, data, offsets in text_slices(texts):
                keep = model.score(features(data, offsets)) >= threshold
                yield batch.slice(a, b - a).filter(pa.array(keep))

    return docs.mapInArrow(rows, docs.schema)
