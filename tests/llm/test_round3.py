"""Conversation repair, filter audit and permutation index against brute force on small fixtures."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from strata.llm import conversation_repair as CR
from strata.llm import filter_audit as FA
from strata.llm import permutation_index as PI

SPACES = " \t\n\x0b\f\r"


# --- op11 -----------------------------------------------------------------------------------

def least(symbols: list[int]) -> tuple[int, str]:
    """Cheapest cost and the ASCII-least edits, by whole strings."""
    go = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    named = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}
    for s in reversed(symbols):
        initial, cut = "sua-"[s >> 1] if s < 8 else "-", 5 * (s & 1)
        new = {}
        for q in range(4):
            options = [(2 + best[q][0], "D" + best[q][1])]
            if s < 8:
                options.append((1 + cut + best[named[q]][0], "R" + best[named[q]][1]))
                if initial in go[q]:
                    options.append((cut + best[go[q][initial]][0], "K" + best[go[q][initial]][1]))
            new[q] = min(options)
        for _ in range(4):
            new = {q: min(new[q], (5 + new[named[q]][0], "I" + new[named[q]][1])) for q in new}
        best = new
    return best[0]


def repaired_by_hand(rows: list[tuple]) -> dict:
    """The contract, conversation by conversation, in plain Python."""
    groups = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        mine = groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, symbols, n = set(), [], collections.Counter()
        for _, role, text in mine:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            n[fault] += 1
            symbols.append(8 if fault in ("blank", "duplicate") else 2 * ("sua".find(role[:1]) if role[:1] and role[0] in "sua" else 3) + (fault == "truncated"))
        cost, edits = least(symbols)
        state, i, kept = 0, 0, []
        for e in edits:
            if e in "RI":
                name = "assistant" if state == 2 else "user"
            else:
                name = mine[i][1] if e == "K" else None
            if e != "D":
                kept.append(name + ":" + ("" if e == "I" else mine[i][2]))
                state = {"s": 1, "u": 2, "a": 3}[name[0]]
            i += e != "I"
        turns = [t for t, _, _ in mine if t is not None]
        bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], bad, cost, edits, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string, n long, part int"


def conversations() -> list[tuple]:
    rng = random.Random(3)
    texts = ["Yes.", "No", "Why?", " \t", "", None, "Go on!  ", "wait\n", "é…", "A longer line. Not ended", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Sys"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), rng.choice(roles), rng.choice(texts), 1, 2))
    rows += [rows[3]] * 3 + [rows[40]] * 2
    rows += [(1000, t, ["user", "assistant"][t % 2 if t % 17 else rng.randint(0, 1)], rng.choice(texts[:4]) + f" {t}{rng.choice('.!,')}", 1, 2) for t in range(700)]
    rows += [(1001, None, "user", "same.", 1, 2)] * 50
    return rows


def test_block_tables():
    t, rng = CR.tables(), random.Random(1)
    assert len(t.vectors) < 64 and t.to.shape == (len(t.vectors), CR.SYMBOLS ** CR.BLOCK)
    for _ in range(2000):
        symbols = [rng.randrange(9) for _ in range(rng.randrange(15))]
        v, cost = t.left_of(np.array(symbols, np.int64), np.array([t.end]))
        edits, state = t.trace(np.array(symbols, np.int64), t.end, 0)
        assert (int(cost[0]) + t.vectors[int(v[0])][0], edits + t.close(state)[0]) == least(symbols)


@pytest.mark.parametrize("piece_rows", [CR.PIECE_ROWS, 7])
def test_conversation_repair(spark, piece_rows):
    rows = conversations()
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    pieces = CR.repair(CR.damage(df), piece_rows)
    got = {r.conv_id: tuple(r)[1:] for r in CR.report(pieces).collect()}
    assert got == repaired_by_hand([r[:4] for r in rows])
    assert pieces.filter("conv_id = 1000").count() > 1  # a long conversation is dealt over pieces
    assert all(any(x in v[6] for v in got.values()) for x in ("KK", "DD", "R"))  # an insert (5) never beats a delete (2)


def test_conversation_repair_of_lost_and_empty(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Hi.", 1, 1)], CONVERSATIONS)
    assert [tuple(r) for r in CR.report(CR.repair(CR.damage(df))).collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert CR.report(CR.repair(CR.damage(spark.createDataFrame([], CONVERSATIONS)))).count() == 0


# --- op12 -----------------------------------------------------------------------------------

DOCUMENTS = "doc_id long, text string, source string, part string, mask int, n long"
LABELS = "doc_id long, quality int, toxic int, n int"


def documents() -> list[tuple]:
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdeé漢A", k=rng.randint(1, 6))) for _ in range(120)] + ["a#b", "$", "x|y", "🙂"]
    texts = [None, "", " \t\n", "one", "WORD " * 60, "w" * 3000, "é" * 400_000, " ".join(f"w{i}" for i in range(70_000)), "a\x00b a\x00b"]
    texts += [" ".join(rng.choices(vocab[:rng.choice([20, 120, 124])], k=rng.randint(1, 120))) for _ in range(60)]
    texts += [texts[9], texts[10], texts[12]] * 4
    rows = [(i, t, [None, "", "b", "a"][i % 4], "p", 1, 2) for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, texts[9], "a", "p", 1, 2), (None, texts[20], None, "p", 1, 2), (-5, texts[13], "b", "p", 1, 2)]


def labels() -> list[tuple]:
    rng = random.Random(4)
    return [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1]), 1) for i in range(50)] + [(3, 1, 1, 1), (3, 1, 1, 1), (None, 1, 1, 1), (9999, 1, 1, 1)]


def audited(docs: list[tuple], marks: list[tuple]) -> dict:
    first = {}
    for i, text, *_ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good, toxic = ({r[0] for r in marks if r[0] is not None and r[k] == 1} for k in (1, 2))
    rows = []
    for i, text, source, *_ in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {c for c, f in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                                             bool(re.search("[#$%&*|]", text)), i is not None and first[text] < i)) if f}
        rows.append((source or "", fails, i in good, i in toxic))
    out, shapley = {}, collections.Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, c in enumerate(order, 1):
                gone, left = [r for r in left if c in r[1]], [r for r in left if c not in r[1]]
                fail = [r for r in mine if c in r[1]]
                out[part, order, step] = (len(left), len(gone), len(fail) - len(gone), sum(r[1] == {c} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[part, c] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    docs, marks = documents(), labels()
    got = FA.audit(spark.createDataFrame(docs, DOCUMENTS).repartition(4), spark.createDataFrame(marks, LABELS)).collect()
    want = audited(docs, marks)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want and len(got) == len(want)
    assert any(v[2] for v in want.values()) and any(v[4] for v in want.values()) and any(v[5] for v in want.values())
    none = spark.createDataFrame([], DOCUMENTS)
    assert FA.audit(none, spark.createDataFrame(marks, LABELS)).count() == 0
    assert FA.audit(spark.createDataFrame(docs[:5], DOCUMENTS), spark.createDataFrame([], LABELS)).count() == 600 * len({r[2] or "" for r in docs[:5]})


def test_filter_audit_oracle(spark):
    """The SQL that stands for the query says the same on rows with ids and no repeated id."""
    seen, docs = set(), []
    for r in documents():
        if r[0] is not None and r[0] not in seen and "\x00" not in (r[1] or ""):
            seen.add(r[0])
            docs.append(r)
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [r[:3] for r in docs])
    con.execute("create table labels(doc_id bigint, quality int, toxic int)")
    con.executemany("insert into labels values (?, ?, ?)", [r[:3] for r in labels()])
    assert {r[:3]: r[3:] for r in con.execute(FA.ORACLE).fetchall()} == audited(docs, labels())


def test_transducer_pieces():
    """Texts longer than a pass, words longer than a piece, and the verified table under colliding keys."""
    import pyarrow as pa
    texts = [r[1] for r in documents()] + ["a" * 700 + " b", " " * 900 + "x y x", "ab ba ab " * 200]
    for limit in (64, 1 << 18):
        m = FA.measure(pa.array(texts, pa.string()), limit)
        for i, t in enumerate(texts):
            w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            assert (m["words"][i], m["distinct"][i], m["chars"][i]) == (len(w), len(set(w)), len(t or "")), (limit, i)
    assert all(len(v) == 0 for v in FA.measure(pa.array([], pa.string())).values())


# --- op13 -----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, dim int, shard int, query_id int"


def vectors() -> list[tuple]:
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 24))
    x = np.concatenate([rng.standard_normal((500, 24)), centres[rng.integers(0, 6, 500)] + 0.05 * rng.standard_normal((500, 24))]).astype(np.float32)
    x[100:400] = x[100]  # a third nearly: one vector many times
    rows = [(int(i), v.tolist(), 1, 1, 1, 1) for i, v in enumerate(x)]
    rows += [(2000, None, 1, 1, 1, 1), (2020, [0.0] * 24, 1, 1, 1, 1), (2040, [float("nan")] + [1.0] * 23, 1, 1, 1, 1), (2060, [], 1, 1, 1, 1),
             (2080, [None] + [1.0] * 23, 1, 1, 1, 1), (None, x[0].tolist(), 1, 1, 1, 1), rows[20], rows[20], (40, [9.0] * 24, 1, 1, 1, 1)]
    return rows + [(3000 + 10 * i, [float(i + 1), 1.0], 1, 1, 1, 1) for i in range(5)]


def test_permutation_index(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            good[i] = min(good.get(i, v), v)
    table = PI.usable(df)
    pivots = PI.pivots_of(table, 128)
    index = PI.build(table, pivots)
    assert index.count() == len(good)  # every row is indexed
    queries = index.filter("vec_id % 20 = 0")
    share = PI.fit_share(table, pivots, 20, 0.95)
    hits = wanted = 0
    got = collections.defaultdict(list)
    for r in sorted(PI.search(index, queries, pivots, share, 20, shard_rows=128).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    for q in (i for i in good if i % 20 == 0):
        others = [(i, float(np.dot(np.array(v, float), np.array(good[q], float)))) for i, v in good.items() if i != q and len(v) == len(good[q])]
        score = dict(others)
        true = sorted(others, key=lambda x: (-round(x[1], 9), x[0]))[:20]
        mine = got.pop(q)
        assert [r for r, _, _ in mine] == list(range(1, len(true) + 1)) and len({i for _, i, _ in mine}) == len(mine)
        assert all(abs(score[i] - s) < 1e-9 for _, i, s in mine)
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in itertools.pairwise(mine))
        hits += len({i for i, _ in true} & {i for _, i, _ in mine})
        wanted += len(true)
        if 100 <= q < 400:  # equal vectors: ties go to the smaller ids
            assert [i for _, i, _ in mine] == [i for i, _ in true]
    assert not got and hits / wanted >= 0.9
    everything = PI.search(index, queries, pivots, 1.0, 20, shard_rows=128)
    assert everything.count() == wanted
    assert PI.nearest(spark.createDataFrame([], VECTORS), PI.F.col("vec_id") % 20 == 0).count() == 0


def test_footrule():
    rng = np.random.default_rng(8)
    pivots = PI.Pivots(rng.standard_normal((90, 12)))
    x = rng.standard_normal((40, 12))
    order = pivots.order(x)
    shard = PI.Shard(np.arange(40), x, order, 90)
    for i in range(40):
        at = [{p: j for j, p in enumerate(o.tolist())} for o in order]
        want = np.array([sum(abs(a.get(p, pivots.length) - j) for j, p in enumerate(order[i].tolist())) for a in at])
        d = shard.footrule(order[i])
        assert np.array_equal(d - d[0], want - want[0])


def test_piece_table_is_bounded_in_bytes():
    from strata.llm._pieces import PieceTable
    calls = []

    def encode(pieces):
        calls.extend(pieces)
        return [np.frombuffer(p, np.uint8).astype("<u4") for p in pieces]

    rng = random.Random(6)
    pieces = [bytes(rng.choices(b"abcdefgh", k=rng.randint(1, 9))) for _ in range(60_000)]
    for limit in (1 << 20, 1 << 28):
        t = PieceTable(encode, "<u4", limit)
        calls.clear()
        for a in range(0, len(pieces), 3000):
            some = pieces[a:a + 3000]
            start = np.cumsum([0, *map(len, some)])[:-1]
            ids, count = t.ids(np.frombuffer(b"".join(some), np.uint8), start)
            assert ids.tolist() == list(b"".join(some)) and count.tolist() == [len(p) for p in some]
            assert t.held() <= 3 * limit
        assert (len(calls) == len(set(pieces))) == (limit == 1 << 28)
    t.clear()
    assert t.n == 0 and t.held() < 2 << 20


def test_fingerprints_fill_bins_by_blocks(monkeypatch):
    """Empty bins are filled for a block of texts at once, with the values of the walks taken one by one."""
    import numpy as np
    import pyarrow as pa

    from strata.llm import fingerprints as fp
    from strata.llm._common import Words, _mix, text_slices

    def plain(text):
        (_, _, data, offsets), = text_slices(pa.array([text], pa.large_string()))
        h, _ = Words(data, offsets, lower=True).shingles(fp.SHINGLE)
        bins, mask = {}, (1 << fp.BITS) - 1
        for x in h.tolist():
            bins[x >> 55] = min(x, bins.get(x >> 55, x))
        if not bins:
            return []
        out = []
        for i in range(fp.BINS):
            step, at = 0, i
            while at not in bins and len(bins) > 1:
                step += 1
                with np.errstate(over="ignore"):
                    at = int(_mix(np.array([(i << 32) + step], np.uint64))[0] % np.uint64(fp.BINS))
            out.append((bins[at] if at in bins else next(iter(bins.values()))) & mask)
        return out

    texts = ["", " \n", "one", "a b c d e", "a b c d e f", "x " * 300, *(" ".join(f"w{i * k}" for k in range(i)) for i in (7, 9, 30, 200, 900))]
    got = fp._of(texts)
    assert [g.tolist() for g in got] == [plain(t) for t in texts]
    calls, densify = [], fp._densify
    monkeypatch.setattr(fp, "_densify", lambda *a: calls.append(1) or densify(*a))
    many = fp._of([texts[i % len(texts)] for i in range(len(texts) * 50)])
    assert all((many[i] == got[i % len(texts)]).all() for i in range(len(many)))
    assert len(calls) <= 4
