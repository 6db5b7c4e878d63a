"""Extension, CSV fidelity and stored history: cases that the bound tables do not show."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import dedup as WN
from strata.operators import extend as EX
from strata.operators import joins as JN
from strata.operators import snapshot as SN
from strata.sources import io as IO

DAY = [dt.datetime(2024, 1, d) for d in range(1, 8)]
VERSION = "id long, v string, updated_at timestamp_ntz"
NOW = "2025-09-01 00:00:00"


def _domain(spark, approved=True):
    a = spark.createDataFrame([(1, "AAAA", None, None, None)],
                              "id long, code string, origin string, redeemed_at timestamp_ntz, owner long")
    p = spark.createDataFrame([(i, None, "BR", approved, DAY[0], DAY[1], DAY[2] if approved else None) for i in (1, 2)],
                              "id long, affiliate_id long, country_code string, is_kyc_approved boolean, "
                              "created_at timestamp_ntz, updated_at timestamp_ntz, verified timestamp_ntz")
    t = spark.createDataFrame([(1, DAY[0], 1, "deposit", 5.0, "bet", 7, "USD", DAY[0])] if approved else [],
                              "id long, timestamp timestamp_ntz, player_id long, type string, amount double, "
                              "game_type string, stake_value int, currency string, seen timestamp_ntz")
    return a, p, t


def test_key_numbers_with_an_outlier(spark):
    df = spark.range(20_000).unionAll(spark.createDataFrame([(1 << 62,)], "id long"))
    numbered, n = EX.index_keys(df.withColumn("x", F.lit(1)), "id")
    assert n == 20_001
    assert numbered.where((F.col("id") < 20_000) & (F.col("id") != F.col("_gidx"))).count() == 0
    assert numbered.where(F.col("id") == 1 << 62).first()["_gidx"] == 20_000


def test_key_numbers_spread_by_quantiles(spark):
    """No range holds more than a few times its share, whatever the range of the keys."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).unionAll(spark.createDataFrame([(1 << 62,)], "id long"))
        sizes = (df.repartitionByRange("id").groupBy(F.spark_partition_id().alias("b")).count()
                 .agg(F.max("count").alias("most"), F.count("*").alias("parts")).first())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sizes["parts"] >= 4 and sizes["most"] < 3 * 20_001 / sizes["parts"]


def test_codes_are_a_bijection(spark):
    """Two characters: all 1,296 codes, each once; the inverse leads back."""
    x = F.col("id")
    rows = spark.range(-5, 36 ** 2 - 5).select("id", EX.random_code(7, "id", 2).alias("code"), EX.permuted(7, x, 2).alias("n"),
                                               EX.permuted(7, EX.permuted(7, x, 2), 2, back=True).alias("back"),
                                               EX.code_number(EX.random_code(7, "id", 2), 2).alias("read")).collect()
    assert len({r.code for r in rows}) == 36 ** 2 == len({r.n for r in rows})
    assert all(r.back == r.id % 36 ** 2 and r.read == r.n for r in rows)
    assert len({r.code for r in spark.range(20_000).select(EX.random_code(1, "id").alias("code")).collect()}) == 20_000
    big = spark.range(10 ** 12, 10 ** 12 + 500).select("id", EX.permuted(3, EX.permuted(3, x), back=True).alias("back")).collect()
    assert all(r.back == r.id for r in big)
    bad = spark.createDataFrame([("a1",), ("A",), ("A1B",), (None,), ("é1",)], "c string").select(EX.code_number(F.col("c"), 2).alias("n"))
    assert [r.n for r in bad.collect()] == [None] * 5


@pytest.mark.parametrize("window", [1, 64])
def test_codes_avoid_existing_ones(spark, window):
    everything = [r.code for r in spark.range(36 ** 2).select(EX.random_code(7, "id", 2).alias("code")).collect()]
    first = set(everything[1:41])                                     # what the new ids would get by themselves
    taken = sorted(first)[:30] + sorted(set(everything) - first)[:600] + [" aa ", None, "not a code"]
    have = spark.createDataFrame([(c,) for c in taken], "code string")
    got = {r.id: r.code for r in EX.unique_codes(spark.range(1, 41), "id", "code", have, 7, length=2, window=window).collect()}
    known = {(c or "").strip().upper() for c in taken}
    assert len(set(got.values())) == len(got) == 40 and not set(got.values()) & known
    assert all(got[i] == everything[i] for i in got if everything[i] not in known)     # others keep their code
    again = {r.id: r.code for r in EX.unique_codes(spark.range(1, 41).repartition(3), "id", "code", have.repartition(5), 7, length=2, window=window).collect()}
    assert again == got


def test_codes_that_do_not_fit(spark):
    none = spark.createDataFrame([], "code string")
    with pytest.raises(ValueError, match="do not fit"):
        EX.unique_codes(spark.range(2000), "id", "code", none, 7, length=2)
    everything = spark.range(36 ** 2).select(EX.random_code(7, "id", 2).alias("code"))
    with pytest.raises(Exception, match="leave an id no code"):
        EX.unique_codes(spark.range(5), "id", "code", everything, 7, length=2).collect()
    assert EX.unique_codes(spark.range(0), "id", "code", everything, 7, length=2).count() == 0


def test_no_transactions_without_approved_players(spark):
    a, p, t = _domain(spark, approved=False)
    p = p.limit(0)
    ext = EX.extend_domain(a, p, t, n=0, seed=1, now=NOW)
    assert ext.transactions.count() == 0
    assert dict(ext.transactions.dtypes)["player_id"] == "bigint"
    picked = EX.choose_from_table(spark.range(3), "id", 1, "x", p, "id", {"id": "pid"})
    assert dict(picked.dtypes)["pid"] == "bigint" and picked.where("pid IS NOT NULL").count() == 0


def test_extension_with_roles(spark):
    a, p, t = _domain(spark)
    ext = EX.extend_domain(a, p, t, n=60, seed=1, now=NOW, owner="owner", approved="verified")
    new = ext.transactions.where("id > 1")
    assert new.count() == 59
    assert new.where("game_type IS NULL OR game_type NOT IN ('deposit', 'withdrawal', 'bet', 'win')").count() == 0
    assert new.where("stake_value NOT BETWEEN 1 AND 4999 OR currency IS NULL OR seen IS NOT NULL").count() == 0
    assert new.agg(F.max("stake_value")).first()[0] > 999
    assert ext.affiliates.where("id > 1 AND owner IN (1, 2)").count() == 59
    assert ext.affiliates.where("id > 1").select("owner").distinct().count() == 2
    late = new.join(ext.players.withColumnRenamed("id", "pid"), F.expr("player_id = pid"))
    assert late.where("is_kyc_approved AND timestamp >= verified").count() == 59
    assert ext.players.where("is_kyc_approved != (verified IS NOT NULL)").count() == 0
    # the transaction planted before its player's approval is the one violation
    audit = EX.validate_extension(ext, 60, "verified").where("check_name = 'kyc_left_audit'").first()
    assert audit.violations == 1


def test_extended_tables_run_through_the_pipeline(spark, scratch):
    from strata.plans.pipeline import run_medallion
    a, p, t = _domain(spark)
    ext = EX.extend_domain(a.drop("owner"), p.drop("verified"), t.select("id", "timestamp", "player_id", "type", "amount"),
                           n=50, seed=1, now=NOW)
    src, out, db = (f"{scratch}/ext-src-{uuid.uuid4().hex[:6]}", f"{scratch}/ext-out-{uuid.uuid4().hex[:6]}",
                    f"strata_{uuid.uuid4().hex[:6]}")
    names = {}
    for name in ("affiliates", "players", "transactions"):
        names[name] = f"{name}_50"
        IO.write_csv(getattr(ext, name), f"{src}/{name}_50.csv")
    counts = {r.table_name: r.row_count for r in run_medallion(spark, src, out, sources=names, database=db).collect()}
    assert counts["br_affiliates"] == counts["br_players"] == counts["br_transactions"] == 50
    assert spark.table(f"{db}.br_players").count() == 50
    assert spark.table(f"{db}.br_transactions").count() == 50


def test_csv_round_trip(spark, scratch):
    rows = [("1", 'he said "hi", ok'), ("2", "back\\slash"), ("3", 'a\\"b'), ("4", ""), ("5", None), ("6", " x, y ")]
    df = spark.createDataFrame(rows, "id string, v string")
    path = IO.write_raw_csv(df, f"{scratch}/rt-{uuid.uuid4().hex[:6]}.csv")
    back = [(i, v or None) for i, v in rows]            # an empty field reads as NULL
    assert sorted(map(tuple, IO.read_raw_csv(spark, path).collect())) == back
    broken = spark.createDataFrame([("1", "two\nlines"), ("2", "cr\r\nlf")], "id string, v string")
    path = IO.write_raw_csv(broken, f"{scratch}/ml-{uuid.uuid4().hex[:6]}.csv", multi_line=True)
    assert sorted(map(tuple, IO.read_raw_csv(spark, path, multi_line=True).collect())) == [
        ("1", "two\nlines"), ("2", "cr\r\nlf")]
    with pytest.raises(Exception, match="line break in column v"):
        IO.write_raw_csv(broken, f"{scratch}/lb-{uuid.uuid4().hex[:6]}.csv")


def test_csv_header_order(spark, scratch):
    path = f"{scratch}/hdr-{uuid.uuid4().hex[:6]}.csv"
    with open(path, "w") as f:
        f.write('code,id\nAAA,1\n"he said ""x""",2\n')
    out = IO.read_raw_csv(spark, path, ["id", "code"], with_order=True)
    assert out.columns == ["id", "code", "_input_order"]
    assert sorted((r.id, r.code) for r in out.collect()) == [("1", "AAA"), ("2", 'he said "x"')]
    with pytest.raises(ValueError, match="name"):
        IO.read_raw_csv(spark, path, ["id", "name"])


def test_snapshot_null_key_and_columns(spark):
    h = SN.snapshot_merge(None, spark.createDataFrame([(1, "a", DAY[0]), (None, "n", DAY[0])], VERSION))
    cur = spark.createDataFrame([(1, "b", DAY[1], 9), (None, "n", DAY[0], 8), (None, "m", DAY[0], 7), (None, "m", DAY[0], 7)],
                                VERSION + ", extra int")
    out = SN.snapshot_merge(h, cur)
    rows = sorted((str(r.id), r.v, r.dbt_valid_to is None, r.extra) for r in out.collect())
    assert rows == [("1", "a", False, None), ("1", "b", True, 9), ("None", "m", True, 7), ("None", "n", True, None)]
    again = SN.snapshot_merge(out, cur)
    assert again.where("dbt_valid_to IS NULL AND id = 1").count() == 1
    # a column that is gone is NULL in new versions
    less = SN.snapshot_merge(out, spark.createDataFrame([(1, DAY[3])], "id long, updated_at timestamp_ntz"))
    assert less.where("id = 1 AND dbt_valid_to IS NULL AND v IS NULL").count() == 1
    with pytest.raises(ValueError, match="v string -> int"):
        SN.snapshot_merge(h, spark.createDataFrame([(1, 5, DAY[1])], "id long, v int, updated_at timestamp_ntz"))


def test_rows_without_key_are_spread(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("k"), F.col("id").alias("x"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = WN.count_over(df, "k", "x", "n")
        parts = out.where("k IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
        got = {r.k: r.n for r in out.select("k", "n").distinct().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == {None: 2000, 0: 400, 1: 400, 2: 400, 3: 400, 4: 400}
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 1000
    pairs = spark.createDataFrame([(None, None), (None, None), (None, 1), (1, None)], "a int, b int")
    assert sorted(str(tuple(r)) for r in WN.mark_duplicates(pairs, ["a", "b"]).collect()) == [
        "(1, None, False)", "(None, 1, False)", "(None, None, True)", "(None, None, True)"]


def test_null_orphans_counted_without_join(spark):
    child = spark.createDataFrame([(1,), (None,), (None,), (7,)], "fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert JN.orphan_count(child, parent, "fk", "id", null_is_orphan=True).first().orphans == 3
    assert JN.orphan_count(child, parent, "fk", "id").first().orphans == 1


def test_codes_in_generated_code(spark, capfd):
    """Codes and their places need no lambda (evaluated without generated code), whatever reads them, and code that is
    too large to compile is no way out."""
    have = spark.createDataFrame([("AB",), ("q9",)], "code string")
    df = EX.unique_codes(spark.range(1, 41), "id", "code", have, 7, length=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "lambda" not in EX.random_code(7, "id")._jc.toString()
    assert {r.id: r.code for r in df.collect()} == {r.id: r.code for r in spark.range(1, 41).select("id", EX.random_code(7, "id", 2).alias("code")).collect()}
    assert "Failed to compile" not in capfd.readouterr().err
    rows = spark.range(-5, 36 ** 2 - 5)
    for back in (False, True):
        got = EX.with_permuted(rows, 7, F.col("id"), "n", 2, back).withColumn("m", EX.permuted(7, F.col("id"), 2, back))
        assert got.where("n != m").count() == 0 and got.count() == 36 ** 2


def test_extension_with_shared_codes(spark):
    """Input affiliates that share a code after it is normalised: the largest id counts, and all get the first use."""
    a, p, t = _domain(spark)
    a = spark.createDataFrame([(1, "AAAA", None, None, None), (2, " aaaa", None, None, None), (3, None, "X", None, None),
                               (4, "BBBB", None, DAY[3], None)], a.schema)
    ext = EX.extend_domain(a.drop("owner"), p.drop("verified"), t, n=200, seed=1, now=NOW, keep_code=True)
    users = {}
    for r in ext.players.where("affiliate_code_redeemed IS NOT NULL").collect():
        users.setdefault(r.affiliate_code_redeemed, []).append(r)
    affiliates = {r.id: r for r in ext.affiliates.collect()}
    largest = {}
    for r in affiliates.values():
        largest[r.code] = max(r.id, largest.get(r.code, 0))
    assert largest["AAAA"] == 2 and affiliates[3].code is None and affiliates[3].redeemed_at is None
    assert affiliates[4].redeemed_at == DAY[3] and all(r.affiliate_id == largest[c] for c, rs in users.items() for r in rs)
    for r in affiliates.values():
        if r.id != 4 and r.code is not None:
            first = min((u.created_at for u in users.get(r.code, [])), default=None)
            assert (r.redeemed_at is None) == (first is None)
            assert first is None or dt.timedelta(0) <= r.redeemed_at - first < dt.timedelta(days=1)
    assert EX.validate_extension(ext, 200).where("check_name = 'code_consistent' AND violations > 0").count() == 0


def test_extension_work_is_done_once(spark, monkeypatch):
    """The checks read written transactions, and the players are written with their affiliate, not joined by code again."""
    written = []
    monkeypatch.setattr(EX, "materialize", lambda df, name: written.append(name) or IO.materialize(df, name))
    ext = EX.extend_domain(*_domain(spark), n=60, seed=1, now=NOW)
    assert written.count("ext-players") == 2                           # the input, the result
    EX.validate_extension(ext, 60)
    assert written[-1] == "ext-transactions"


def test_first_per_key_carries_order_columns_once(spark):
    rows = [(1, 2, "b", None), (1, 2, "a", 5), (1, 3, "a", 1), (None, 1, "x", 1), (None, None, "y", 2)]
    df = spark.createDataFrame(rows, "k long, pos long, v string, w long")
    want = {1: (2, "a", 5), None: (None, "y", 2)}
    for order in ("pos", ["pos", "v", "w"]):
        out = WN.first_per_key(df, "k", order, "d")
        assert out.columns == ["k", "pos", "v", "w", "d"]
        assert {r.k: (r.pos, r.v, r.w) for r in out.collect()} == want and out.agg(F.sum("d")).first()[0] == 3
        aggregate = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in x)
        assert aggregate.count("pos#") == 1


def test_parsed_timestamps_stay(spark):
    """Bronze transactions take a parsed time as it is: the same values as by way of its text, without that text."""
    from strata.functions import cleaning as fn
    from strata.plans import layers as L
    ts = ["2024-01-02 03:04:05.123456", "0000-01-01 00:00:00", "-0001-12-31 23:59:59", "9999-12-31 23:59:59.999999", "+10000-01-01 00:00:00", None]
    raw = spark.createDataFrame([(str(i), x, "1", "bet", "2") for i, x in enumerate(ts)], "id string, x string, player_id string, type string, amount string")
    raw = raw.withColumn("timestamp", F.col("x").cast("timestamp_ntz"))
    got = L.br_transactions(raw)
    assert got.join(raw.select(F.col("id").cast("long"), fn.parse_timestamp_safe("timestamp").alias("want")), "id").where("NOT timestamp <=> want").count() == 0
    assert got.where("timestamp IS NOT NULL").count() == 3
    assert "regexp_extract" not in got.select("timestamp")._jdf.queryExecution().optimizedPlan().toString()


def test_draws_and_codes_from_constant_parts(spark):
    """Draws and codes are those of their definitions, ids that are NULL included.  Codes join their constant parts beforehand:
    no text is joined by separator, and no code is translated character by character."""
    import hashlib
    rows = spark.createDataFrame([(0,), (-5,), (10 ** 12,), (None,)], "id long")
    for r in rows.select("id", EX.draw(7, "id", "kyc").alias("u")).collect():
        text = "|".join(["7", *([str(r.id)] if r.id is not None else []), "kyc"])
        assert r.u == int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    for length in (1, 2, 5, 8):
        top = len(EX.CODE_ALPHABET) ** length
        numbers = spark.createDataFrame([(n % top,) for n in (0, 1, 35, 36, 1295, 123_456_789, top - 1)] + [(None,)], "n long")
        for r in numbers.select("n", EX.code_text(F.col("n"), length).alias("code")).collect():
            digits = None if r.n is None else "".join(EX.CODE_ALPHABET[r.n // 36 ** k % 36] for k in reversed(range(length)))
            assert r.code == digits
    plan = spark.range(5).select(EX.random_code(7, "id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in plan and "translate(" not in plan and plan.count("conv(") == plan.count("md5(")


def test_first_per_key_compares_order_then_row(spark):
    """The order decides before the rest of the row, which is in the same flat struct."""
    df = spark.createDataFrame([(1, "z", 1, "b"), (1, "z", 1, "a"), (1, "a", 2, "a"), (2, None, None, "q")],
                               "k long, v string, pos long, w string")
    out = WN.first_per_key(df, "k", [F.col("pos") + 0], "d")
    assert sorted((r.k, r.v, r.pos, r.w, r.d) for r in out.collect()) == [(1, "z", 1, "a", 2), (2, None, None, "q", 0)]
    aggregate = next(x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in x)
    assert aggregate.count("struct(") == 1


def test_a_pick_is_drawn_once(spark):
    """Rows that must have a pick: the test of that does not draw it again, and every row has one."""
    keys, n = EX.index_keys(spark.range(100, 107), "id")
    picked = EX.choose_numbered(spark.range(50), "id", 1, "x", keys, n, {"id": "pid"}).where("pid IS NOT NULL")
    assert picked._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    want = {r.id: 100 + r.u % 7 for r in spark.range(50).select("id", EX.draw(1, "id", "x").alias("u")).collect()}
    assert {r.id: r.pid for r in picked.collect()} == want


def test_draws_of_whole_batches(spark):
    """Draws and rounds of codes are computed for whole batches, in one pass for all draws of a table; the values are those
    of the SQL expression: texts of several lengths, not ASCII, empty, NULL, and too long for one block of md5."""
    texts = ["", "1", "22", "é1", "x" * 40, "x" * 55, "y" * 200, None]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts * 3)] + [(str(i), i) for i in range(-2000, 12_000)], "id string, n long")
    tags = ["kyc", "a much longer tag", "x" * 60]
    df = rows.select("*", *[EX.draw(42, "id", t).alias(f"u{i}") for i, t in enumerate(tags)])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "conv(" not in plan
    for i, t in enumerate(tags):
        text = F.concat_ws("|", F.lit("42"), "id", F.lit(t))
        want = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
        assert df.where(~F.col(f"u{i}").eqNullSafe(want)).count() == 0
    for back in (False, True):
        numbers = rows.select(F.when(F.col("id").isNotNull(), F.col("n") * 7_919_000_003).alias("x"))
        got = EX.with_permuted(numbers, 42, F.col("x"), "y", back=back)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "conv(" not in plan
        assert got.where(~F.col("y").eqNullSafe(EX.permuted(42, F.col("x"), back=back))).count() == 0


def test_draws_of_a_row_are_made_at_once(spark, monkeypatch):
    """One pass for all draws of the players (input and new ones apart), before their join; the affiliates are written a
    second time without any."""
    written = []
    monkeypatch.setattr(EX, "materialize", lambda df, name: written.append(
        (name, df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython"))) or IO.materialize(df, name))
    a, p, t = _domain(spark)
    ext = EX.extend_domain(a.drop("owner"), p.drop("verified"), t, n=60, seed=1, now=NOW)
    assert [k for name, k in written if name == "ext-players"] == [0, 2]
    assert [k for name, k in written if name == "ext-affiliates"] == [0, 2, 0]      # codes are in the pass of new ones
    assert not [c for df in (ext.affiliates, ext.players_with_code) for c in df.columns if c.startswith("_")]
