"""Mixing: repeated rows, fractional caps, permutations and draws."""

from __future__ import annotations

import collections
import math
import random

from pyspark.sql import functions as F

from strata.llm import mixing


def rows(n: int, words: int, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    return [(i, " ".join(f"w{i}x{j}" for j in range(rng.randint(1, 2 * words))), rng.choice("abc")) for i in range(n)]


def test_repeated_rows_read_their_own_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 3)
    data = rows(30, 60)
    text = " ".join(f"same{j}" for j in range(500))
    data += [(90, text, "a")] * 2 + [(None, text, "a")] * 7 + [(91, text, "a"), (91, text, "b")] + [(92, None, None)] * 2
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(data)], "doc_id long, text string, source string, _runs int").repartition(4)
    got = mixing.words_taken(docs, block=16).collect()
    assert len(got) == len(data) and all(0 <= r.taken <= 2 * r.size for r in got)
    taken = collections.defaultdict(int)
    for r in got:
        taken[r.target] += r.taken
    assert all(abs(v - t) <= 16 + 1e-6 for t, v in taken.items())
    mixed = mixing.mixed_documents(docs, block=16)
    assert mixed.columns == docs.columns
    # every row number is read as often as its words are taken, by text and in order of its own
    by_id = collections.Counter()
    of_row = collections.Counter()
    for r in mixed.collect():
        by_id[r.doc_id] += len(r.text.split())
        of_row[r._runs] += len(r.text.split())
        source = iter(data[r._runs][1].split())
        assert all(w in source for w in r.text.split())
    want = collections.Counter()
    for r in got:
        want[r.doc_id] += r.taken
    assert +by_id == +want
    assert all(of_row[k] <= 2 * len((data[k][1] or "").split()) for k in range(len(data)))
    copies = sorted(of_row[k] for k, r in enumerate(data) if r[0] is None)
    assert copies == sorted(r.taken for r in got if r.doc_id is None)


def test_fractional_cap(spark):
    docs = spark.createDataFrame([(i, "w " * 300, "a") for i in range(100)] + [(200 + i, "w " * 300, "b") for i in range(100)],
                                 "doc_id long, text string, source string")
    got = mixing.words_taken(docs, weights=(1, 1), share=1.5, cap=1.5, block=64).collect()
    taken = collections.Counter()
    for r in got:
        taken[r.doc_id >= 200] += r.taken
    assert {r.target for r in got} == {45_000.0}
    assert all(abs(v - 45_000) <= 64 for v in taken.values())


def test_permutations_are_bijections_that_differ(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select(*(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(k).cast("long")).alias(f"p{k}") for k in range(3)))
        seen = list(zip(*df.collect()))
        assert all(sorted(p) == list(range(n)) for p in seen)
        if n == 1000:
            assert len(set(seen)) == 3
            for p in seen:
                fixed = sum(i == x for i, x in enumerate(p))
                steps = collections.Counter((b - a) % n for a, b in zip(p, p[1:]))
                assert fixed < 12 and max(steps.values()) < 12


def test_shard_counts_spread_like_draws(spark):
    sources = spark.createDataFrame([("a", 640_000, 640_000.0), ("b", 640_000, 320_000.0), (None, 0, 0.0)],
                                    "source string, source_size long, target double")
    reads = mixing.block_reads(sources, block=64, shard=100, cap=2.0, seed=17)
    n = collections.Counter()
    for r in reads.groupBy("k", "source").count().collect():
        n[r.k, r.source] = r["count"]
    shards = sorted({k for k, _ in n})
    assert shards == list(range(150)) and all(n[k, "a"] + n[k, "b"] == 100 for k in shards)
    mean = sum(n[k, "a"] for k in shards) / 150
    spread = sum((n[k, "a"] - mean) ** 2 for k in shards) / 149
    assert abs(mean - 100 * 2 / 3) < 1e-9
    assert 0.7 < spread / (100 * 2 / 9) < 1.4 and math.isfinite(spread)
    assert reads.groupBy("source", "block", "pass").count().filter("count > 1").isEmpty()
