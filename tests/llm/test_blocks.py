"""Groups above the block sizes against brute force, with the work they cause."""

from __future__ import annotations

import random
import re

import pytest

from strata.llm import ngram_join


def low_ids(sets: dict[int, set], percent: int) -> dict[int, int]:
    low = {i: i for i in sets}
    links = []
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in links:
            m = min(low[i], low[j])
            if low[i] != m or low[j] != m:
                low[i] = low[j] = m
                changed = True
    return low


@pytest.mark.parametrize("heads", [0, 1])
def test_ngram_join_of_a_group_above_the_block(spark, monkeypatch, heads):
    """Near copies that link only with some others: hypercube corners, a link is one changed word."""
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(500)]
    base = rng.choices(vocab, k=100)
    texts = []
    for mask in rng.sample(range(1 << 9), 90):
        texts.append(" ".join(f"{w}x" if p % 11 == 5 and mask >> (p // 11) & 1 else w for p, w in enumerate(base)))
    other = rng.choices(vocab, k=120)
    texts += [" ".join(other[:100 + i]) for i in range(0, 20, 3)] + texts[:5]
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"\S+", t)
        sets[i] = {tuple(w[j:j + 4]) for j in range(len(w) - 3)}
    want = low_ids(sets, 85)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "HEAD_ROUNDS", heads)
    monkeypatch.setattr(ngram_join, "SHINGLES", 1500)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs).collect()}
    assert got == want and 10 < len(set(want.values())) < 80


def test_candidates_and_links_are_fewer_than_members():
    """A block in which every pair is possible gives each member once, and a tree of links."""
    import numpy as np
    import pyarrow as pa
    sets = [np.unique(np.arange(200, dtype=np.uint64) * np.uint64(7919) + np.uint64(k // 40)) for k in range(120)]
    bits = [ngram_join._bitmap(s).tobytes() for s in sets]
    m = len(sets)
    same = lambda v, t: pa.array([v] * m, t)
    block = pa.RecordBatch.from_arrays(
        [same(1, pa.int64()), same(0, pa.int32()), same(0, pa.int32()), same(0, pa.int32()), pa.array([len(s) for s in sets], pa.int64()),
         pa.array(range(m), pa.int64()), pa.array(range(m), pa.int64()), pa.array(bits, pa.binary())],
        ["key", "i", "j", "part", "n", "doc", "comp", "bitmap"])
    found = pa.Table.from_batches(list(ngram_join._candidates(85)(iter([block.slice(0, 50), block.slice(50)]))))
    assert sorted(found.column("doc").to_pylist()) == list(range(m))
    held = found.append_column("shingles", pa.array([sets[d].tobytes() for d in found.column("doc").to_pylist()], pa.binary())).sort_by("gid")
    links = [tuple(r.values()) for b in ngram_join._joined(85)(iter(held.to_batches())) for r in b.to_pylist()]
    assert len(links) == m - 3 and all(a // 40 == b // 40 for a, b in links)


def test_line_dedup_of_long_texts_hot_lines_and_clashing_names(spark):
    """A text of 32,000 lines, a line that spans ranges, and inputs named like the helper columns."""
    import time
    from strata.llm import line_dedup
    hot = "a line that a third of all rows hold"
    long_text = "\n".join(f"line number {i} of a long text" for i in range(32_000))
    rows = [(i, long_text + f"\nown line {i} of the text", 1, 2, "x", 3, 4) for i in range(4)]
    rows += [(10 + i, f"{hot}\nshort\nonly in text {i} of them all\n{hot.upper()}  ", 1, 2, "x", 3, 4) for i in range(3000)]
    schema = "doc_id long, text string, n_lines int, n_dropped int, mark_doc string, _text_id int, words int"
    docs = spark.createDataFrame(rows, schema).repartition(4)
    t0 = time.time()
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert time.time() - t0 < 40  # seconds; quadratic work would take minutes
    assert [got[i].text.count("\n") for i in range(4)] == [0, 0, 0, 32_000] and got[0]._n_dropped == 32_000 and got[0]._n_lines == 32_001
    assert all(got[10 + i].text == f"short\nonly in text {i} of them all" and got[10 + i]._n_dropped == 2 for i in range(2999))
    assert got[3009].text.count(hot) == 1 and got[3009]._n_dropped == 0
    assert all((r.n_lines, r.n_dropped, r.mark_doc, r._text_id, r.words) == (1, 2, "x", 3, 4) for r in got.values())


def test_sentencepiece_keeps_columns_of_clashing_names(spark):
    from strata.llm import sentencepiece_bpe
    from strata.llm.queries import tokenizer_path
    path = tokenizer_path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "some words here", 7, "e", "d"), (2, None, 8, None, None)], "doc_id long, text string, ids int, Exact string, decoded string")
    coded = sentencepiece_bpe.encode(docs, path)
    assert coded.columns == [*docs.columns, "_ids", "_exact"]
    rows = {r.doc_id: r for r in sentencepiece_bpe.decode(coded, path, "_ids").collect()}
    assert (rows[1].ids, rows[1].Exact, rows[1].decoded, rows[1]._decoded, rows[1]._exact) == (7, "e", "d", "some words here", True)
    assert (rows[2].ids, rows[2]._decoded, rows[2]._ids) == (8, "", [])


def test_pipeline_mixing_of_clashing_names(spark):
    """A corpus whose columns are named like helper columns passes the mixing stage whole."""
    from strata.llm import mixing
    names = ["_runs", "_mix_doc", "row", "runs", "copy", "read", "pass"]
    docs = spark.createDataFrame([(i, f"some words {i} " * 40, "a", *range(7)) for i in range(20)],
                                 "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and all(tuple(r)[3:] == tuple(range(7)) for r in out.collect()) and out.count() >= 20
