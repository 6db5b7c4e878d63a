"""Deterministic table extension (EX-01..11): grow the three domain tables to a
target size with plausible rows, as set-based Spark plans.

Randomness is a pure function of (seed, row id, column tag)::

    u = conv(substr(md5("<seed>|<id>|<tag>"), 1, 15), 16, 10)   # 0 .. 2^60-1

so results do not depend on partitioning or task order and any SQL engine with
``md5`` reproduces them (``functions/draws.py`` computes them for whole batches).  Codes come from a keyed bijection of the id, so they are unique without any comparison.  "now" is an argument.

Scale notes
-----------
* New rows come from ``spark.range`` (distributed), never from driver lists.
* A uniform pick from an existing table (``choose_from_table``) numbers the
  candidate keys 0..N-1 in key order without a global single-partition window:
  keys are range-partitioned by the quantiles of the data (an outlier key widens
  no partition), numbered inside their sorted partition, and shifted by the
  partition's offset (one row per shuffle partition, broadcast under that
  bound); the draws are equi-joined on the global number.  Draws are uniform,
  so the join has no hot key.
* Tables that several branches read are written once as Parquet (``materialize``),
  so their readers prune columns and a lost executor recomputes one step.
* Only scalars (max id, row counts) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.cleaning import blank_to_null, first_non_null, normalize_code, offset
from strata.functions.draws import draw_bits, feistel
from strata.operators.joins import left_join
from strata.session import run_concurrently
from strata.sources.io import materialize

# Fixed values (must equal the reference behaviour).
CODE_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
CODE_LENGTH = 8
CODE_ROUNDS = 4
ORIGIN_POOL = ["web", "ios", "android", "partner", "campaign", "YouTube", "Discord", "X"]
COUNTRY_POOL = ["CO", "US", "MX", "BR", "AR", "CL", "PE", "ES", "GB", "DE", "FR", "CA", "IN", "PH", "AU"]
TXN_TYPE_POOL = ["deposit", "withdrawal", "bet", "win"]
CURRENCY_POOL = ["USD", "EUR", "COP", "BRL"]
KYC_TRUE_PERCENT = 75          # new players approved with p = 0.75
CODE_PERCENT = 60              # players given a redeemed code with p = 0.6
CREATED_MAX_DAYS, APPROVAL_MAX_DAYS, UPDATE_MAX_DAYS, TXN_MAX_DAYS = 120, 10, 30, 60
TXN_BASE_DAYS = 30             # transactions without an approval date start at now - 30 days
AMOUNT_MAX = 4999              # amounts 1 .. 4999
MINUTES_PER_DAY = 1440


@dataclass(frozen=True)
class Drawn:
    """In place of a seed: the draws that the rows carry in columns (``with_draws``)."""
    seed: int


def draw(seed: int | Drawn, id_col, tag: str) -> Column:
    """Uniform 60-bit draw for (seed, id, tag): 15 hex digits, far above any key count.  Drawn for whole batches of rows."""
    if isinstance(seed, Drawn):
        return F.col(f"_u_{tag}")
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return draw_bits(c, seed, tag)


def with_draws(df: DataFrame, seed: int, id_col: str, tags: Sequence[str]) -> DataFrame:
    """``df`` with its draws for ``tags`` as columns, in one pass over the rows; ``Drawn(seed)`` reads them."""
    return df.withColumns({f"_u_{t}": draw(seed, id_col, t) for t in tags})


def without_draws(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_u_")])


def _first_60_bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


# EX-03
def choose_from_pool(seed: int | Drawn, id_col, tag: str, pool: list[str]) -> Column:
    arr = F.array(*[F.lit(v) for v in pool])
    return F.element_at(arr, (draw(seed, id_col, tag) % len(pool) + 1).cast("int"))


# EX-04
def weighted_bool(seed: int | Drawn, id_col, tag: str, percent: int) -> Column:
    return draw(seed, id_col, tag) % 100 < percent


# EX-02
def _round(seed: int, r: int, half: Column, size: int) -> Column:
    return _first_60_bits(F.concat(F.lit(f"{seed}|{r}|"), half.cast("string"))) % size


def permuted(seed: int, x: Column, length: int = CODE_LENGTH, back: bool = False) -> Column:
    """A keyed bijection on 0 .. 36^length - 1 (``length`` even), or its inverse: rounds of md5 on two halves, where each
    round adds a keyed function of one half to the other, so different numbers never meet."""
    size = len(CODE_ALPHABET) ** (length // 2)
    x = F.pmod(x.cast("bigint"), F.lit(size * size))
    left, right = F.floor(x / size), x % size
    for r in range(CODE_ROUNDS, 0, -1) if back else range(1, CODE_ROUNDS + 1):
        if back:
            left, right = F.pmod(right - _round(seed, r, left, size), F.lit(size)), left
        else:
            left, right = right, (left + _round(seed, r, right, size)) % size
    return left * size + right


def with_permuted(df: DataFrame, seed: int, x: Column, out: str, length: int = CODE_LENGTH, back: bool = False) -> DataFrame:
    """``df`` with ``permuted`` of ``x`` as ``out``, all rounds in one pass over whole batches of rows."""
    size = len(CODE_ALPHABET) ** (length // 2)
    return df.withColumn(out, feistel(F.pmod(x.cast("bigint"), F.lit(size * size)), seed, CODE_ROUNDS, size, back))


def code_text(number: Column, length: int = CODE_LENGTH) -> Column:
    """``number`` (below 36^length) in the code alphabet, ``length`` digits: each two of them from a constant table."""
    base = len(CODE_ALPHABET)
    pairs = F.split(F.lit(",".join(a + b for a in CODE_ALPHABET for b in CODE_ALPHABET)), ",")

    def high(k: int) -> Column:
        return F.call_function("div", number, F.lit(base ** k).cast("bigint"))

    odd = [F.substring(F.lit(CODE_ALPHABET), (high(length - 1) + 1).cast("int"), F.lit(1))] if length % 2 else []
    return F.concat(*odd, *[F.get(pairs, (high(k) % base ** 2).cast("int")) for k in range(length // 2 * 2 - 2, -1, -2)])


def code_number(code: Column, length: int = CODE_LENGTH) -> Column:
    """The number behind a code; NULL for text that no ``code_text`` gives."""
    base = len(CODE_ALPHABET)
    value = sum(((F.instr(F.lit(CODE_ALPHABET), F.substring(code, k + 1, 1)) - 1).cast("bigint") * base ** (length - 1 - k) for k in range(length)), F.lit(0).cast("bigint"))
    return F.when(code.rlike(f"^[{CODE_ALPHABET}]{{{length}}}$"), value)


def random_code(seed: int, id_col, length: int = CODE_LENGTH) -> Column:
    """The code of an id: different ids (below 36^length) have different codes."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return code_text(permuted(seed, c, length), length)


def unique_codes(df: DataFrame, id_col: str, code_col: str, existing: DataFrame, seed: int, length: int = CODE_LENGTH,
                 window: int = 64) -> DataFrame:
    """Assign codes to ``df`` (unique ids) so that none collides with ``existing`` codes or with another new row.

    New codes cannot meet: they come from a bijection.  The inputs that would give an existing code are computed from
    the existing codes by its inverse, no new row is drawn and tested.  Row ``id`` uses the first input id, id + span,
    id + 2 span, ... that gives no existing code, span being the width of the new ids.  Of these attempts
    ``window`` are looked at in one pass (a second pass runs only for an id that has all of them taken).
    """
    size = len(CODE_ALPHABET) ** length
    lo, hi = df.agg(F.min(id_col), F.max(id_col)).first()
    if lo is None:
        return df.withColumn(code_col, F.lit(None).cast("string"))
    span = hi - lo + 1
    if span > size:
        raise ValueError(f"{span} ids do not fit {size} codes")
    number = code_number(normalize_code(code_col), length)
    at = with_permuted(existing.select(number.alias("_n")).where(F.col("_n").isNotNull()), seed, F.col("_n"), "_x", length, back=True)
    at = materialize(at.select(F.pmod(F.col("_x") - lo, F.lit(size)).alias("_d")), "code-places")
    out, start, pending = df.withColumn("_try", F.lit(0).cast("bigint")), 0, None
    while True:
        near = at.where((F.col("_d") >= start * span) & (F.col("_d") < (start + window) * span))
        used = near.groupBy((F.col("_d") % span + lo).alias("_id")).agg(F.sort_array(F.collect_set(F.floor(F.col("_d") / span).cast("bigint"))).alias("_js"))
        if pending is not None:
            used = used.join(pending, "_id", "left_semi")
        free = F.aggregate("_js", F.lit(start).cast("bigint"), lambda m, j: F.when(j == m, m + 1).otherwise(m))
        used = materialize(used.select("_id", free.alias("_free")), "code-attempts")
        out = out.join(used, (F.col(id_col) == F.col("_id")) & (F.col("_try") == start), "left").withColumn("_try", F.coalesce("_free", "_try")).drop("_id", "_free")
        start += window
        pending = used.where(F.col("_free") >= start).select("_id")
        if pending.isEmpty():
            break
        if start * span >= size:
            raise ValueError("the existing codes leave an id no code")
    spent = F.raise_error(F.lit("the existing codes leave an id no code")).cast("bigint")
    fits = F.col("_try") * span + F.col(id_col) - lo < size
    out = out.withColumn("_try", F.when(fits, F.col(id_col) + F.col("_try") * span).otherwise(spent))
    return with_permuted(out, seed, F.col("_try"), "_try", length).withColumn(code_col, code_text(F.col("_try"), length)).drop("_try")


# EX-05
def index_keys(df: DataFrame, key: str, out: str = "_gidx") -> tuple[DataFrame, int]:
    """Number the unique numeric keys of ``df`` 0..N-1 in key order; returns (df + out, N).

    NULL keys get no number and are left out.
    """
    # partition << 33 | place in the partition, fixed by writing it
    ranged = materialize(df.where(F.col(key).isNotNull()).repartitionByRange(key).sortWithinPartitions(key)
                         .withColumn("_at", F.monotonically_increasing_id()), "key-order")
    b = ranged.withColumn("_b", F.shiftright("_at", 33))
    sizes = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_sz"))          # one row per shuffle partition
    n = int(sizes.agg(F.sum("_sz")).first()[0] or 0)
    offsets = sizes.withColumn("_off", F.sum("_sz").over(Window.orderBy("_b").rowsBetween(
        Window.unboundedPreceding, -1))).select("_b", F.coalesce("_off", F.lit(0)).alias("_off"))
    numbered = b.join(F.broadcast(offsets), "_b").withColumn(
        out, F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    return numbered.drop("_b", "_at", "_off"), n


def choose_from_table(df: DataFrame, id_col: str, seed: int, tag: str, keys: DataFrame, key: str,
                      take: dict[str, str], where: Column | None = None) -> DataFrame:
    """For each row of ``df`` (where ``where`` holds) pick a uniformly random row of
    ``keys`` (unique numeric ``key``) and attach ``take`` = {source col: new name}."""
    numbered, n = index_keys(keys.select(key, *[c for c in take if c != key]), key)
    return choose_numbered(df, id_col, seed, tag, numbered, n, take, where)


def choose_numbered(df: DataFrame, id_col: str, seed: int | Drawn, tag: str, numbered: DataFrame, n: int,
                    take: dict[str, str], where: Column | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """``choose_from_table`` over ``n`` rows that have their numbers 0..n-1 in ``_gidx``.  The columns ``drop`` of ``df`` are
    used for the pick only."""
    if n == 0:
        return df.select("*", *[F.lit(None).cast(numbered.schema[c].dataType).alias(v) for c, v in take.items()]).drop(*drop)
    pick = draw(seed, id_col, tag) % n
    d = df.withColumn("_pick", F.coalesce(pick, F.lit(0).cast("bigint")) if where is None else F.when(where, pick)).drop(*drop)
    src = numbered.select(F.col("_gidx"), *[F.col(c).alias(v) for c, v in take.items()])
    if where is None:
        # a draw is never NULL: nothing to spread, and it is not drawn once more for a test of that before the join
        return d.join(src, F.col("_pick") == F.col("_gidx"), "left").drop("_pick", "_gidx")
    # rows outside ``where`` have a NULL pick: spread, not all in one partition
    return left_join(d, src, "_pick", "_gidx").drop("_pick", "_gidx")


# EX-01
def new_ids(spark: SparkSession, max_id: int, count: int, name: str = "id") -> DataFrame:
    """Rows ``max_id+1 .. max_id+count`` as a distributed range."""
    return spark.range(max_id + 1, max_id + 1 + max(0, count)).withColumnRenamed("id", name)


@dataclass
class Extended:
    affiliates: DataFrame
    players: DataFrame
    transactions: DataFrame
    players_with_code: DataFrame     # players incl. the temporary redeemed-code column
    new_counts: dict
    inputs: tuple[DataFrame, DataFrame, DataFrame]     # affiliates, players, transactions as written before


def _scalars(a: DataFrame, p: DataFrame, t: DataFrame) -> dict:
    """Max id and row count of each table: three one-row aggregates, one job."""
    def agg(df, name):
        return df.agg(F.lit(name).alias("t"), F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("mx"),
                      F.count(F.lit(1)).alias("rows"))
    out = {}
    for r in agg(a, "a").unionAll(agg(p, "p")).unionAll(agg(t, "t")).collect():
        out[f"{r['t']}_max"], out[f"{r['t']}_rows"] = int(r["mx"]), int(r["rows"])
    return out


# EX-06
def created_approved_dates(df: DataFrame, seed: int | Drawn, now, flag: str = "is_kyc_approved",
                           created: str = "created_at", approved: str | None = None) -> DataFrame:
    """created = now − (0..119 d, 0..1439 min); approved = created + 0..9 d when flagged."""
    now_c = F.lit(now).cast("timestamp_ntz")
    back = (draw(seed, "id", "created_d") % CREATED_MAX_DAYS) * MINUTES_PER_DAY + draw(seed, "id", "created_m") % MINUTES_PER_DAY
    out = df.withColumn(created, offset(now_c, 0, -back))
    if approved:
        out = out.withColumn(approved, F.when(F.col(flag) == F.lit(True),
                                              offset(F.col(created), draw(seed, "id", "approved_d") % APPROVAL_MAX_DAYS, 0)))
    return out


def fill_by_name(seed: int, id_col, name: str, dtype: T.DataType) -> Column:
    """Value of a further transaction column by its type and name: text named after a
    currency or a type from that pool, numbers named after an amount or a value 1 .. 4999,
    other numbers 0 .. 999, anything else NULL."""
    low = name.lower()
    if isinstance(dtype, T.StringType) and "currency" in low:
        return choose_from_pool(seed, id_col, name, CURRENCY_POOL)
    if isinstance(dtype, T.StringType) and "type" in low:
        return choose_from_pool(seed, id_col, name, TXN_TYPE_POOL)
    if isinstance(dtype, T.NumericType):
        u = draw(seed, id_col, name)
        return (u % AMOUNT_MAX + 1 if "amount" in low or "value" in low else u % 1000).cast(dtype)
    return F.lit(None).cast(dtype)


def extend_domain(a: DataFrame, p: DataFrame, t: DataFrame, n: int | None = None, seed: int = 42,
                  now: str = "2025-09-01 00:00:00", factor: float = 2.0,
                  keep_code: bool = False, owner: str | None = None, approved: str | None = None) -> Extended:
    """Grow affiliates, players and transactions to at least ``n`` rows each
    (default ``factor`` × the largest input table).

    Roles: ``owner`` names the affiliates' owner column (new affiliates get a random
    input player), ``approved`` the players' approval date (set for new approved players;
    new transactions start at it).  Without an approved player there are no new transactions.
    """
    spark = a.sparkSession
    # inputs are read several times (scalars, key numbering, unions): written once
    a, p, t = run_concurrently([lambda: materialize(a, "ext-affiliates"), lambda: materialize(p, "ext-players"),
                                lambda: materialize(t, "ext-transactions")])
    s = _scalars(a, p, t)
    if n is None:
        n = int(math.ceil(factor * max(s["a_rows"], s["p_rows"], s["t_rows"])))
    now_c = F.lit(now).cast("timestamp_ntz")
    ts_type = p.schema["created_at"].dataType

    # affiliates: new ids + codes that neither meet one another nor existing ones (EX-01, EX-02)
    a_new = new_ids(spark, s["a_max"], n - s["a_rows"])
    a_new = unique_codes(a_new, "id", "code", a, seed)
    if owner:
        a_new = choose_from_table(a_new, "id", seed, "owner", p, "id", {"id": owner})
        a_new = a_new.withColumn(owner, F.col(owner).cast(a.schema[owner].dataType))
    # the draws of a row are made at once, before the tables are joined and written
    drawn, a_tags = Drawn(seed), ["origin", "redeem_m"]
    p_tags = ["has_code", "code_pick", "upd_d", "upd_m", "country"]
    # players: new ids, created date, approval flag (EX-01, EX-04, EX-06)
    p_new = with_draws(new_ids(spark, s["p_max"], n - s["p_rows"]), seed, "id",
                       ["kyc", "created_d", "created_m", *(["approved_d"] if approved else []), *p_tags]) \
        .withColumn("is_kyc_approved", weighted_bool(drawn, "id", "kyc", KYC_TRUE_PERCENT))
    p_new = created_approved_dates(p_new, drawn, now, approved=approved).drop("_u_kyc", "_u_created_d", "_u_created_m", "_u_approved_d")
    for c in ["created_at", *([approved] if approved else [])]:
        p_new = p_new.withColumn(c, F.col(c).cast(p.schema[c].dataType))
    # new players have a created date: only input players need the draw for want of one
    p_ext = with_draws(p, seed, "id", [*p_tags, "upd_base"]).unionByName(p_new, allowMissingColumns=True)

    # normalise blanks and codes.  ``_aid`` is the largest id that has the code: new codes meet no other, and they
    # are normal, so only input codes are grouped
    a_old = blank_to_null(a, ["origin"]).withColumn("code", normalize_code("code"))
    by_code = a_old.where(F.col("code").isNotNull()).groupBy(F.col("code").alias("_c")).agg(F.max("id").alias("_aid"))
    a_old = left_join(a_old, by_code, "code", "_c").drop("_c")
    # affiliates.origin from the pool (EX-03)
    a_ext = with_draws(a_old.unionByName(a_new.withColumn("_aid", F.col("id")), allowMissingColumns=True), seed, "id", a_tags)
    a_ext = a_ext.withColumn("origin", F.coalesce("origin", choose_from_pool(drawn, "id", "origin", ORIGIN_POOL))) \
                 .withColumn("_jitter", draw(drawn, "id", "redeem_m") % MINUTES_PER_DAY)
    a_ext = materialize(without_draws(a_ext), "ext-affiliates")

    # affiliates with a code, numbered in id order: new ids follow one another above the input's, each with a code
    is_new = F.col("id") > s["a_max"]
    old_keys, n_old = index_keys(a_ext.where(F.col("code").isNotNull() & ~is_new).select("id", "code", "_aid"), "id")
    n_new = max(0, n - s["a_rows"])
    new_keys = a_ext.where(is_new).select("id", "code", "_aid", (F.col("id") - (s["a_max"] + 1) + n_old).alias("_gidx"))

    # country_code from the pool (EX-03), updated_at after created_at (EX-09).  The date of input players is kept only
    # where the filled column hides it
    upd_base = F.coalesce(F.col("created_at"),
                          offset(now_c, 0, -(draw(drawn, "id", "upd_base") % CREATED_MAX_DAYS) * MINUTES_PER_DAY))
    p_ext = (p_ext.withColumn("_before", F.when(F.col("created_at").isNull(), F.col("updated_at")))
                  .withColumn("country_code", F.coalesce("country_code",
                                                          choose_from_pool(drawn, "id", "country", COUNTRY_POOL)))
                  .withColumn("updated_at", F.coalesce("updated_at", offset(
                      upd_base, draw(drawn, "id", "upd_d") % UPDATE_MAX_DAYS,
                      draw(drawn, "id", "upd_m") % MINUTES_PER_DAY).cast(ts_type)))
                  .drop("_u_upd_base", "_u_upd_d", "_u_upd_m", "_u_country"))

    # temporary redeemed code: ~60 % of players get a random existing affiliate code (EX-04, EX-05)
    p_code = choose_numbered(p_ext, "id", drawn, "code_pick", old_keys.unionByName(new_keys), n_old + n_new,
                             {"code": "affiliate_code_redeemed", "_aid": "_aid"},
                             where=weighted_bool(drawn, "id", "has_code", CODE_PERCENT), drop=["_u_has_code", "_u_code_pick"])

    # players.affiliate_id ← affiliate of the redeemed code (EX-08); ``_aid`` stays where that hides it
    p_code = p_code.withColumns({"affiliate_id": F.coalesce("affiliate_id", "_aid"),
                                 "_aid": F.when(F.col("affiliate_id").isNotNull(), F.col("_aid"))})
    p_code = materialize(p_code, "ext-players")

    # affiliates.redeemed_at ← earliest best date of players using the code + jitter (EX-07)
    best = first_non_null("created_at", "_before")
    first_use = (p_code.where(F.col("affiliate_code_redeemed").isNotNull() & best.isNotNull())
                       .groupBy(F.coalesce("_aid", "affiliate_id").alias("_c")).agg(F.min(best).alias("_first")))
    a_ext = left_join(a_ext, first_use, "_aid", "_c")
    fill = F.col("redeemed_at").isNull() & F.col("_first").isNotNull()
    a_ext = a_ext.withColumn("redeemed_at", F.when(fill, offset(F.col("_first"), 0, F.col("_jitter")))
                             .otherwise(F.col("redeemed_at"))).drop("_c", "_first", "_aid", "_jitter")
    p_code = p_code.drop("_aid", "_before")

    # transactions of approved players only (EX-10)
    kyc = p_code.where(F.col("is_kyc_approved") == F.lit(True)).select("id", *([approved] if approved else []))
    t_new = new_ids(spark, s["t_max"], n - s["t_rows"])
    a_ext, (kyc, n_kyc) = run_concurrently([lambda: materialize(a_ext, "ext-affiliates"), lambda: index_keys(kyc, "id")])
    t_new = choose_numbered(t_new, "id", seed, "txn_player", kyc, n_kyc,
                            {"id": "player_id"} | ({approved: "_approved"} if approved else {}))
    t_new = t_new.where(F.col("player_id").isNotNull())
    base = offset(now_c, 0, -TXN_BASE_DAYS * MINUTES_PER_DAY)
    if approved:
        base = F.coalesce(F.col("_approved"), base)
    t_new = (t_new.withColumn("timestamp", offset(base, draw(seed, "id", "txn_d") % TXN_MAX_DAYS,
                                                  draw(seed, "id", "txn_m") % MINUTES_PER_DAY).cast(t.schema["timestamp"].dataType))
                  .withColumn("type", choose_from_pool(seed, "id", "txn_type", TXN_TYPE_POOL))
                  .withColumn("amount", (draw(seed, "id", "amount") % AMOUNT_MAX + 1).cast(t.schema["amount"].dataType)))
    extra = [c for c in t.columns if c not in ("id", "player_id", "timestamp", "type", "amount")]
    for c in extra:
        t_new = t_new.withColumn(c, fill_by_name(seed, "id", c, t.schema[c].dataType))
    t_ext = t.unionByName(t_new.select(*t.columns))

    players = p_code if keep_code else p_code.drop("affiliate_code_redeemed")
    return Extended(a_ext.select(*a.columns), players.select(*(p.columns + (["affiliate_code_redeemed"] if keep_code else []))),
                    t_ext, p_code, {"target": n}, (a, p, t))


def validate_extension(ext: Extended, n: int, approved: str | None = None) -> DataFrame:
    """Unique ids, code consistency, approval rule and target counts (EX-11).  The approval
    rule compares dates where ``approved`` names the players' approval date."""
    from strata.operators import quality as DQ

    players = ext.players_with_code
    # the transactions are a plan until here; three checks read them.  Their time is compared with an approval date only
    transactions = materialize(ext.transactions.select("id", "player_id", *(["timestamp"] if approved else [])), "ext-transactions")
    if not approved:
        transactions = transactions.withColumn("timestamp", F.lit(None).cast(ext.transactions.schema["timestamp"].dataType))
    parts = []
    for name, df in (("affiliates", ext.affiliates), ("players", players), ("transactions", transactions)):
        parts.append(DQ.unique(df, "id").agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("table_name"), F.lit("unique").alias("check_name"), "violations"))
        parts.append(DQ.min_rows(df, n).agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("table_name"), F.lit("min_rows").alias("check_name"), "violations"))
    parts.append(DQ.code_consistent(players, ext.affiliates).agg(F.count(F.lit(1)).alias("violations"))
                 .select(F.lit("players").alias("table_name"), F.lit("code_consistent").alias("check_name"), "violations"))
    gate_players = players.withColumn("kyc_approved_at", F.col(approved) if approved
                                      else F.lit(None).cast(players.schema["created_at"].dataType))
    parts.append(DQ.no_txn_before_kyc(transactions, gate_players, "timestamp", unknown_is_violation=True)
                 .agg(F.count(F.lit(1)).alias("violations"))
                 .select(F.lit("transactions").alias("table_name"), F.lit("kyc_left_audit").alias("check_name"),
                         "violations"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionAll(x)
    return out
