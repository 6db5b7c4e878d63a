"""End-to-end medallion run: CSV folder → landing Parquet → raw tables → bronze →
checks → snapshot → silver → checks → gold → checks (PL-01).

Every table is written once, to a folder of its run, and re-read by the next layer, which
cuts the lineage at layer boundaries (a lost executor recomputes at most
one layer).  Row counts and content hashes are taken by the writes themselves.  The finished run is released by one commit
(``sources.release``): readers see the previous tables until then, and a rerun after a failure goes on at the first
layer that is not recorded.  Checks never block: their report is written and failures are logged
as warnings.  Returns a DataFrame (layer, table_name, row_count, content_hash) over the
released tables.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as DQ
from strata.operators.aggregates import content_metrics
from strata.operators.dedup import deduplicate
from strata.plans import layers as L
from strata.session import configure, run_concurrently
from strata.sources import io
from strata.sources.history import History
from strata.sources.release import Release, Run, signature_of
from strata.sources.tables import source

log = logging.getLogger("strata.pipeline")

# day-partitioned outputs: table → timestamp column
PARTITIONED = {"br_transactions": "timestamp", "sl_transactions": "txn_timestamp"}


def _write_tables(spark: SparkSession, frames: dict[str, DataFrame], run: Run, layer: str) -> dict[str, dict]:
    """Write the (mutually independent) tables of one layer as concurrent jobs; path, columns, row count and content
    hash of each, the latter two observed by the write."""
    def write(name: str, df: DataFrame) -> Callable[[], dict]:
        def job() -> dict:
            path, seen = run.folder(f"{layer}/{name}"), Observation()
            day = {"partition_by_day": "txn_date", "day_col": "txn_date"} if name == "g_player_daily_balance" else {"partition_by_day": PARTITIONED.get(name)}
            io.write_table(df, path, mode="errorifexists", observe=(seen, content_metrics(df)), **day)
            got = seen.get
            return {"path": path, "columns": df.columns, "rows": int(got["row_count"]), "hash": got["content_hash"]}
        return job

    names = list(frames)
    return dict(zip(names, run_concurrently([write(n, frames[n]) for n in names])))


def _layer(spark: SparkSession, run: Run, step: str, layer: str, frames: Callable[[], dict[str, DataFrame]]) -> dict[str, dict]:
    """The written tables of a step: those of its entry, or else written now and entered."""
    done = run.done(step)
    return done if done is not None else run.record(step, _write_tables(spark, frames(), run, layer))


def _checks(spark: SparkSession, run: Run, tables: dict[str, DataFrame], layer: str, mode: str) -> dict[str, dict]:
    done = run.done(f"checks {layer}")
    if done is not None:
        return done
    rep = DQ.dq_report(tables, layers=[layer])
    path = run.folder(f"checks/{layer}")
    rep.write.parquet(path)
    if mode != "off":
        bad = spark.read.parquet(path).where(F.col("violations") > 0).collect()   # one row per check: bounded
        for r in bad:
            log.warning("check %s.%s(%s) on %s: %d violations", layer, r.check_name, r.columns, r.table_name,
                        r.violations)
        if bad and mode == "error":
            raise RuntimeError(f"{len(bad)} {layer} checks failed")
    return run.record(f"checks {layer}", {layer: {"path": path, "columns": rep.columns}})


def run_medallion(spark: SparkSession, src_dir: str, out_dir: str, checks: str = "warn",
                  amount_type: str = L.NUMERIC, player_keep: Sequence[str] = (),
                  tie_break: Sequence = (), sources: dict[str, str] | None = None,
                  database: str | None = None, resume: bool = True) -> DataFrame:
    """Run every layer.  ``sources`` maps the logical raw names (affiliates,
    players, transactions) to CSV stems in ``src_dir`` (default: same name).
    With ``database`` every released table is registered there by name.  With ``resume`` a run that did not finish is
    continued when its source files (names, sizes, times) and arguments are the same."""
    configure(spark)
    out = out_dir.rstrip("/")
    sources = sources or {"affiliates": "affiliates", "players": "players", "transactions": "transactions"}
    release = Release(spark, out)
    run = release.begin(signature_of(spark, src_dir, amount_type, sorted(player_keep), list(tie_break), sorted(sources.items())), resume)

    # ingest → land; the raw tables are named sources over the landed files
    landed = run.done("landing")
    if landed is None:
        landed = run.record("landing", io.ingest_dir(spark, src_dir, run.folder("landing/files")))
    raw = {name: io.as_view(source(spark, landed, stem), f"raw_{name}") for name, stem in sources.items()}
    opened = lambda tables: {n: release.open(t) for n, t in tables.items()}
    released: dict[str, dict[str, dict]] = {}

    # bronze
    released["bronze"] = _layer(spark, run, "bronze", "bronze", lambda: L.bronze(
        raw["affiliates"], raw["players"], raw["transactions"], amount_type, player_keep))
    br = opened(released["bronze"])
    reports = _checks(spark, run, br, "bronze", checks)

    # snapshot of players (latest version per id): a run appends its changes, and the release names the version
    history = History(spark, f"{out}/snapshots/players_snapshot")
    snap = run.done("snapshot")
    if snap is None:
        cur = deduplicate(br["br_players"], "id", [F.col("updated_at").desc_nulls_last(),
                                                   F.col("created_at").desc_nulls_last()], tie_break)
        at = history.apply(cur.drop(*player_keep))
        versions = history.read(at=at)
        totals = versions.agg(*content_metrics(versions)).first() if versions is not None else None
        snap = run.record("snapshot", {"version": at, "rows": totals.row_count if totals else 0, "hash": totals.content_hash if totals else "0"})

    # silver in two waves: the dimensions, then the tables built on their written form
    dims = _layer(spark, run, "silver dimensions", "silver", lambda: {
        "sl_affiliates": L.sl_affiliates(br["br_affiliates"]), "sl_players": L.sl_players(br["br_players"], tie_break)})
    sl = opened(dims)
    facts = _layer(spark, run, "silver", "silver", lambda: {
        "sl_affiliate_player_bridge": L.sl_affiliate_player_bridge(sl["sl_affiliates"], sl["sl_players"]),
        "sl_transactions": L.sl_transactions(br["br_transactions"], sl["sl_players"], measured=True)})
    released["silver"] = dims | facts
    sl.update(opened(facts))
    reports |= _checks(spark, run, sl, "silver", checks)

    # gold
    released["gold"] = _layer(spark, run, "gold", "gold", lambda: L.gold(sl))
    reports |= _checks(spark, run, opened(released["gold"]), "gold", checks)

    tables = {f"{layer}/{n}": t for layer, named in released.items() for n, t in named.items()}
    run.publish(tables | {f"checks/{layer}": t for layer, t in reports.items()}, snapshot=snap["version"])
    if database:
        for name, t in tables.items():
            io.register(spark, database, name.split("/")[1], t["path"])
    rows = [(*name.split("/"), t["rows"], t["hash"]) for name, t in tables.items()]
    return spark.createDataFrame([*rows, ("snapshot", "players_snapshot", snap["rows"], snap["hash"])],
                                 "layer string, table_name string, row_count bigint, content_hash string")
