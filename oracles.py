"""DuckDB oracle SQL for the registered queries.

Written from the model definitions in plain SQL (not generated from the Spark
plans).  Every statement starts from the driver's base tables through the same
binding views; ``WITH`` blocks unused by a statement are dropped by DuckDB.
Decimal results are cast to DOUBLE at the very end, integer results to BIGINT.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- binding + layers
BINDING = r"""
raw_affiliates AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS id,
         '  ' || s.s_name || '  ' AS code,
         CASE s.s_nationkey % 4 WHEN 0 THEN 'Discord' WHEN 1 THEN 'YouTube' WHEN 2 THEN 'X' END AS origin,
         CASE WHEN s.s_acctbal >= 0 THEN CAST(f.first_ship AS VARCHAR) END AS redeemed_at
  FROM supplier s
  LEFT JOIN (SELECT l_suppkey, MIN(l_shipdate) AS first_ship FROM lineitem GROUP BY l_suppkey) f
         ON f.l_suppkey = s.s_suppkey
),
raw_players AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS id,
         CASE WHEN c.c_custkey % 10 < (CASE (c.c_custkey // 10) % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 8 END)
              THEN CAST(c.c_custkey // 10 AS VARCHAR) END AS affiliate_id,
         CASE WHEN c.c_nationkey = 24 THEN 'BRA'
              ELSE ' ' || ['at', 'be', 'ch', 'cz', 'dk', 'ee', 'fi', 'gr', 'hr', 'hu', 'ie', 'it', 'lt', 'lv', 'nl',
                       'at', 'be', 'ch', 'cz', 'dk', 'ee', 'fi', 'gr', 'hr', 'hu'][c.c_nationkey + 1]
         END AS country_code,
         CASE o.o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN 'no' WHEN 'P' THEN '' END AS is_kyc_approved,
         CAST(MIN(o.o_orderdate) OVER (PARTITION BY o.o_custkey) AS VARCHAR) AS created_at,
         CAST(o.o_orderdate AS VARCHAR) AS updated_at,
         o.o_orderkey AS version_id
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
),
raw_transactions AS (
  SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) AS id,
         CAST(l.l_shipdate AS VARCHAR) AS "timestamp",
         CAST(o.o_custkey AS VARCHAR) AS player_id,
         CASE l.l_returnflag WHEN 'A' THEN ' Deposit' WHEN 'R' THEN 'Withdraw' WHEN 'N' THEN 'bet' END AS type,
         '$' || CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS amount
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
),
br_affiliates AS (
  SELECT TRY_CAST(TRY_CAST(id AS DECIMAL(38,0)) AS BIGINT) AS id,
         trim(regexp_replace(lower(code), '[ \t\n\f\r]+', ' ', 'g'), ' ') AS code,
         trim(regexp_replace(lower(origin), '[ \t\n\f\r]+', ' ', 'g'), ' ') AS origin,
         TRY_CAST(NULLIF(redeemed_at, '') AS TIMESTAMP) AS redeemed_at
  FROM raw_affiliates
),
br_players AS (
  SELECT TRY_CAST(TRY_CAST(id AS DECIMAL(38,0)) AS BIGINT) AS id,
         TRY_CAST(TRY_CAST(affiliate_id AS DECIMAL(38,0)) AS BIGINT) AS affiliate_id,
         CASE WHEN length(trim(country_code, ' ')) = 2 THEN upper(trim(country_code, ' ')) END AS country_code,
         CASE WHEN lower(is_kyc_approved) IN ('true', '1', 't', 'y', 'yes') THEN TRUE
              WHEN lower(is_kyc_approved) IN ('false', '0', 'f', 'n', 'no') THEN FALSE END AS is_kyc_approved,
         TRY_CAST(NULLIF(created_at, '') AS TIMESTAMP) AS created_at,
         TRY_CAST(NULLIF(updated_at, '') AS TIMESTAMP) AS updated_at,
         version_id
  FROM raw_players
),
br_transactions AS (
  SELECT TRY_CAST(TRY_CAST(id AS DECIMAL(38,0)) AS BIGINT) AS id,
         TRY_CAST(NULLIF("timestamp", '') AS TIMESTAMP) AS "timestamp",
         TRY_CAST(TRY_CAST(player_id AS DECIMAL(38,0)) AS BIGINT) AS player_id,
         trim(regexp_replace(lower(type), '[ \t\n\f\r]+', ' ', 'g'), ' ') AS type,
         TRY_CAST(regexp_replace(amount, '[^0-9.\-]+', '', 'g') AS DECIMAL(18,2)) AS amount
  FROM raw_transactions
),
sl_affiliates AS (
  SELECT id, code, origin, redeemed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY redeemed_at DESC NULLS LAST, code ASC NULLS FIRST) AS rn
    FROM br_affiliates) WHERE rn = 1
),
sl_players AS (
  SELECT id, affiliate_id, country_code, is_kyc_approved, created_at, updated_at,
         CASE WHEN is_kyc_approved THEN coalesce(updated_at, created_at) END AS kyc_approved_at
  FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST,
                                 created_at DESC NULLS LAST, version_id DESC) AS rn
    FROM br_players) WHERE rn = 1
),
sl_affiliate_player_bridge AS (
  SELECT *, CASE WHEN player_ref_count > 1 THEN 1 ELSE 0 END AS is_violation_affiliate_not_1to1
  FROM (
    SELECT a.id AS affiliate_id, a.code, a.origin, a.redeemed_at, p.id AS player_id,
           CASE WHEN a.redeemed_at IS NOT NULL AND p.id IS NULL THEN 1 ELSE 0 END AS is_violation_unlinked_redeemed,
           COUNT(p.id) OVER (PARTITION BY a.id) AS player_ref_count
    FROM sl_affiliates a LEFT JOIN sl_players p ON p.affiliate_id = a.id)
),
sl_transactions AS (
  SELECT t.id, t."timestamp" AS txn_timestamp, t.player_id, t.type, t.amount
  FROM br_transactions t JOIN sl_players p ON p.id = t.player_id
  WHERE p.is_kyc_approved = TRUE AND t."timestamp" >= p.kyc_approved_at
),
g_player_daily_balance AS (
  SELECT player_id, CAST(txn_timestamp AS DATE) AS txn_date,
         SUM(CASE WHEN lower(type) = 'deposit' THEN amount ELSE 0 END) AS deposits,
         SUM(CASE WHEN lower(type) = 'withdraw' THEN -amount ELSE 0 END) AS withdrawals
  FROM sl_transactions GROUP BY 1, 2
),
g_country_deposits_discord AS (
  SELECT p.country_code, COUNT(*) AS deposit_count, SUM(t.amount) AS deposit_sum
  FROM sl_players p
  LEFT JOIN sl_affiliates a ON a.id = p.affiliate_id
  JOIN sl_transactions t ON t.player_id = p.id
  WHERE p.is_kyc_approved = TRUE AND lower(a.origin) = 'discord' AND lower(t.type) = 'deposit'
  GROUP BY 1
),
g_top3_player_deposits AS (
  SELECT player_id, amount AS top_deposit_amount, rn AS rank_position FROM (
    SELECT player_id, amount, row_number() OVER (PARTITION BY player_id ORDER BY amount DESC) AS rn
    FROM sl_transactions WHERE lower(type) = 'deposit') WHERE rn <= 3
)
"""


def sql(body: str, extra_ctes: str = "") -> str:
    ctes = BINDING.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


def reg(name: str, body: str, extra_ctes: str = "") -> None:
    ORACLES[name] = sql(body, extra_ctes)


reg("br_affiliates", "SELECT * FROM br_affiliates")
reg("br_players", "SELECT id, affiliate_id, country_code, is_kyc_approved, created_at, updated_at FROM br_players")
reg("br_transactions", "SELECT id, \"timestamp\", player_id, type, CAST(amount AS DOUBLE) AS amount FROM br_transactions")
reg("sl_affiliates", "SELECT * FROM sl_affiliates")
reg("sl_players", "SELECT * FROM sl_players")
reg("sl_affiliate_player_bridge",
    "SELECT affiliate_id, code, origin, redeemed_at, player_id, "
    "CAST(is_violation_unlinked_redeemed AS BIGINT) AS is_violation_unlinked_redeemed, "
    "CAST(player_ref_count AS BIGINT) AS player_ref_count, "
    "CAST(is_violation_affiliate_not_1to1 AS BIGINT) AS is_violation_affiliate_not_1to1 "
    "FROM sl_affiliate_player_bridge")
reg("sl_transactions",
    "SELECT id, txn_timestamp, player_id, type, CAST(amount AS DOUBLE) AS amount FROM sl_transactions")
reg("g_player_daily_balance",
    "SELECT player_id, txn_date, CAST(deposits AS DOUBLE) AS deposits, "
    "CAST(withdrawals AS DOUBLE) AS withdrawals FROM g_player_daily_balance")
reg("g_country_deposits_discord",
    "SELECT country_code, CAST(deposit_count AS BIGINT) AS deposit_count, "
    "CAST(deposit_sum AS DOUBLE) AS deposit_sum FROM g_country_deposits_discord")
reg("g_top3_player_deposits",
    "SELECT player_id, CAST(top_deposit_amount AS DOUBLE) AS top_deposit_amount, "
    "CAST(rank_position AS BIGINT) AS rank_position FROM g_top3_player_deposits")

# ---------------------------------------------------------------- scalar functions
WS = r"'[ \t\n\f\r]+'"
reg("fn_clean_string_lower",
    f"SELECT doc_id, trim(regexp_replace(lower(text), {WS}, ' ', 'g'), ' ') AS text_clean FROM documents")
reg("fn_clean_string_keep",
    f"SELECT doc_id, trim(regexp_replace(text, {WS}, ' ', 'g'), ' ') AS text_clean FROM documents")
reg("fn_country_iso2",
    "SELECT version_id, CASE WHEN length(trim(country_code, ' ')) = 2 THEN upper(trim(country_code, ' ')) END "
    "AS country_code FROM raw_players")
reg("fn_parse_timestamp", "SELECT id, TRY_CAST(NULLIF(redeemed_at, '') AS TIMESTAMP) AS redeemed_at FROM raw_affiliates")
reg("fn_parse_bool", """
SELECT version_id,
       CASE WHEN lower(is_kyc_approved) IN ('true', '1', 't', 'y', 'yes') THEN TRUE
            WHEN lower(is_kyc_approved) IN ('false', '0', 'f', 'n', 'no') THEN FALSE END AS is_kyc_approved
FROM raw_players""")
reg("fn_parse_numeric", r"""
SELECT id, CAST(TRY_CAST(regexp_replace(amount, '[^0-9.\-]+', '', 'g') AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM raw_transactions""")
reg("fn_txn_sign", """
SELECT id, type, CAST(CASE WHEN lower(type) = 'deposit' THEN amount WHEN lower(type) = 'withdraw' THEN -amount END
                      AS DOUBLE) AS signed_amount
FROM br_transactions""")
reg("fn_kyc_filter", """
SELECT t.id, t.player_id, (p.is_kyc_approved = TRUE AND t."timestamp" >= p.kyc_approved_at) AS passes_gate
FROM br_transactions t JOIN sl_players p ON p.id = t.player_id""")
reg("fn_cast_int64", """
SELECT o_orderkey,
       CAST(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DECIMAL(38,0)) AS BIGINT) AS total_int
FROM orders""")
reg("fn_ts_to_date", "SELECT id, player_id, CAST(txn_timestamp AS DATE) AS txn_date FROM sl_transactions")
reg("fn_approved_at", """
SELECT version_id, CASE WHEN is_kyc_approved THEN coalesce(updated_at, created_at) END AS approved_at
FROM br_players""")
reg("fn_conditional_amounts", """
SELECT id, player_id,
       CAST(CASE WHEN lower(type) = 'deposit' THEN amount ELSE 0 END AS DOUBLE) AS deposit_amount,
       CAST(CASE WHEN lower(type) = 'withdraw' THEN -amount ELSE 0 END AS DOUBLE) AS withdrawal_amount
FROM sl_transactions""")
reg("fn_coerce_bool", """
SELECT version_id,
       CASE WHEN lower(trim(is_kyc_approved)) IN ('true', 'yes', 'y', '1') THEN TRUE
            WHEN lower(trim(is_kyc_approved)) IN ('false', 'no', 'n', '0') THEN FALSE END AS is_kyc_approved
FROM raw_players""")
reg("fn_parse_datetime_utc", """
SELECT version_id, TRY_CAST(NULLIF(trim(created_at), '') AS TIMESTAMP) AS created_at,
       TRY_CAST(NULLIF(trim(is_kyc_approved), '') AS TIMESTAMP) AS not_a_date
FROM raw_players""")
reg("fn_parse_datetime_formats", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS us,
       CASE WHEN o_orderkey % 7 <> 6 AND o_orderkey % 3 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS named,
       CASE WHEN o_orderkey % 11 <> 10 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '19 hours 5 minutes' END AS timed
FROM orders""")
reg("fn_blank_to_null", r"""
SELECT version_id,
       CASE WHEN NOT regexp_matches(affiliate_id, '^\s*$') THEN affiliate_id END AS affiliate_id,
       CASE WHEN NOT regexp_matches(is_kyc_approved, '^\s*$') THEN is_kyc_approved END AS is_kyc_approved
FROM raw_players""")
reg("fn_normalize_code", r"""
SELECT id, NULLIF(upper(regexp_replace(code, '^\s+|\s+$', '', 'g')), '') AS code,
       NULLIF(upper(regexp_replace(origin, '^\s+|\s+$', '', 'g')), '') AS origin
FROM raw_affiliates""")
reg("fn_to_int_or_null", """
SELECT TRY_CAST(TRY_CAST(player_id AS DECIMAL(38,0)) AS BIGINT) AS player_id,
       TRY_CAST(TRY_CAST(amount AS DECIMAL(38,0)) AS BIGINT) AS amount_raw_int,
       TRY_CAST(TRY_CAST(substr(amount, 2) AS DECIMAL(38,0)) AS BIGINT) AS amount_int
FROM raw_transactions""")
reg("fn_null_safe_neq", "SELECT id, is_kyc_approved IS DISTINCT FROM TRUE AS not_approved FROM sl_players")
reg("fn_first_non_null", "SELECT id, coalesce(kyc_approved_at, updated_at, created_at) AS best_date FROM sl_players")
reg("fn_timestamp_offset", """
SELECT id, player_id, txn_timestamp + to_minutes(CAST((player_id % 10) * 1440 + id % 1440 AS BIGINT)) AS shifted_ts
FROM sl_transactions""")

# ---------------------------------------------------------------- projections and filters
BRT = 'id, "timestamp", player_id, type, CAST(amount AS DOUBLE) AS amount'
reg("pf_typed_projection",
    'SELECT id, "timestamp" AS txn_ts, player_id, type AS txn_type, CAST(amount AS DOUBLE) AS amount FROM br_transactions')
reg("pf_star_except", "SELECT * EXCLUDE (version_id) FROM br_players")
reg("pf_filter_ci_eq", f"SELECT {BRT} FROM br_transactions WHERE lower(type) = 'deposit'")
reg("pf_bool_time_filter",
    "SELECT id, version_id, updated_at FROM br_players WHERE is_kyc_approved = TRUE AND updated_at > created_at")
reg("pf_not_in", f"SELECT {BRT} FROM br_transactions WHERE lower(type) NOT IN ('deposit', 'withdraw')")
reg("pf_null_filter", "SELECT id, country_code, is_kyc_approved FROM sl_players "
                      "WHERE country_code IS NOT NULL AND is_kyc_approved IS NOT NULL")
reg("pf_conditional_update",
    "SELECT id, code, CASE WHEN origin IS NULL THEN 'unknown' ELSE origin END AS origin, redeemed_at FROM br_affiliates")
reg("pf_add_missing_column", "SELECT *, CAST(NULL AS BIGINT) AS owner_player_id FROM br_affiliates")

# ---------------------------------------------------------------- joins
reg("jn_inner_gate", """
SELECT t.id, t.player_id, t."timestamp" FROM br_transactions t JOIN sl_players p ON p.id = t.player_id
WHERE p.is_kyc_approved = TRUE AND t."timestamp" >= p.kyc_approved_at""")
reg("jn_left_bridge", "SELECT affiliate_id, player_id FROM sl_affiliate_player_bridge")
reg("jn_three_way", """
SELECT p.id AS player_id, p.country_code, a.origin, CAST(t.amount AS DOUBLE) AS amount, t.type
FROM sl_players p LEFT JOIN sl_affiliates a ON a.id = p.affiliate_id JOIN sl_transactions t ON t.player_id = p.id
WHERE p.is_kyc_approved = TRUE AND lower(a.origin) = 'discord' AND lower(t.type) = 'deposit'""")
reg("jn_anti", """
SELECT p.id, p.affiliate_id FROM sl_players p
WHERE p.affiliate_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sl_affiliates a WHERE a.id = p.affiliate_id)""")
reg("jn_semi", """
SELECT p.id, p.affiliate_id FROM sl_players p
WHERE EXISTS (SELECT 1 FROM sl_affiliates a WHERE a.id = p.affiliate_id)""")
reg("jn_anti_count", """
SELECT 'players_unknown_affiliate' AS check_name, COUNT(*) AS orphans FROM sl_players p
WHERE p.affiliate_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sl_affiliates a WHERE a.id = p.affiliate_id)
UNION ALL
SELECT 'transactions_unapproved_player', COUNT(*) FROM br_transactions t
WHERE t.player_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM sl_players p WHERE p.id = t.player_id AND p.is_kyc_approved = TRUE)
UNION ALL
SELECT 'affiliates_without_player', COUNT(*) FROM br_affiliates a
WHERE NOT EXISTS (SELECT 1 FROM br_players p WHERE p.affiliate_id = a.id)""")
reg("jn_lookup_flag", """
SELECT t.id, t.player_id, coalesce(p.is_kyc_approved, FALSE) AS is_kyc_approved
FROM br_transactions t LEFT JOIN sl_players p ON p.id = t.player_id""")
reg("jn_lookup_fill", """
SELECT a.id, a.code, a.origin, coalesce(a.redeemed_at, f.first_player_at) AS redeemed_at
FROM sl_affiliates a LEFT JOIN (
  SELECT affiliate_id, MIN(created_at) AS first_player_at FROM sl_players
  WHERE affiliate_id IS NOT NULL AND created_at IS NOT NULL GROUP BY affiliate_id) f ON f.affiliate_id = a.id""")
reg("jn_left_audit", """
SELECT p.id, p.affiliate_id, a.id AS id__r, a.redeemed_at
FROM sl_players p LEFT JOIN sl_affiliates a ON a.id = p.affiliate_id
WHERE p.affiliate_id IS NOT NULL AND (a.id IS NULL OR a.redeemed_at IS NULL)""")
reg("jn_inner_violation", """
SELECT t.id, t.player_id, t."timestamp" FROM br_transactions t JOIN sl_players p ON p.id = t.player_id
WHERE p.is_kyc_approved IS DISTINCT FROM TRUE OR t."timestamp" < p.kyc_approved_at""")

# ---------------------------------------------------------------- aggregates
reg("ag_sum_by_keys", """
SELECT player_id, CAST("timestamp" AS DATE) AS txn_date, CAST(SUM(amount) AS DOUBLE) AS amount_sum,
       COUNT(*) AS txn_count
FROM br_transactions GROUP BY 1, 2""")
reg("ag_count_sum", """
SELECT p.country_code, COUNT(*) AS txn_count, CAST(SUM(t.amount) AS DOUBLE) AS amount_sum
FROM sl_players p JOIN sl_transactions t ON t.player_id = p.id GROUP BY 1""")
reg("ag_min_by_code", """
SELECT affiliate_id, MIN(created_at) AS first_created_at FROM br_players
WHERE affiliate_id IS NOT NULL AND created_at IS NOT NULL GROUP BY 1""")
reg("ag_having_count", "SELECT id, COUNT(*) AS cnt FROM br_transactions GROUP BY id HAVING COUNT(*) > 1")
reg("ag_having_distinct", """
SELECT id, COUNT(DISTINCT is_kyc_approved) AS combos FROM br_players GROUP BY id
HAVING COUNT(DISTINCT is_kyc_approved) > 1""")
reg("ag_nunique_vs_rows", """
SELECT 'br_affiliates' AS table_name, COUNT(DISTINCT id) AS distinct_keys, COUNT(*) AS row_count FROM br_affiliates
UNION ALL SELECT 'br_players', COUNT(DISTINCT id), COUNT(*) FROM br_players
UNION ALL SELECT 'br_transactions', COUNT(DISTINCT id), COUNT(*) FROM br_transactions""")
reg("ag_dup_stats", """
SELECT COUNT(*) AS duplicated_values, CAST(coalesce(SUM(n), 0) AS BIGINT) AS rows_with_duplicates
FROM (SELECT id, COUNT(*) AS n FROM br_transactions WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1)""")
_MX = "coalesce(MAX(TRY_CAST(TRY_CAST({c} AS DECIMAL(38,0)) AS BIGINT)), 0)"
reg("ag_max_id", f"""
SELECT 'raw_affiliates' AS table_name, {_MX.format(c='id')} AS max_id FROM raw_affiliates
UNION ALL SELECT 'raw_players', {_MX.format(c='id')} FROM raw_players
UNION ALL SELECT 'raw_transactions', {_MX.format(c='id')} FROM raw_transactions
UNION ALL SELECT 'no_numeric_ids', {_MX.format(c='is_kyc_approved')} FROM raw_players""")
reg("ag_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in [
        "raw_affiliates", "raw_players", "raw_transactions", "br_affiliates", "br_players", "br_transactions",
        "sl_affiliates", "sl_players", "sl_affiliate_player_bridge", "sl_transactions",
        "g_player_daily_balance", "g_country_deposits_discord", "g_top3_player_deposits"]))
reg("ag_distinct_values", r"""
SELECT DISTINCT code FROM (
  SELECT NULLIF(upper(regexp_replace(country_code, '^\s+|\s+$', '', 'g')), '') AS code FROM raw_players)
WHERE code IS NOT NULL""")

# ---------------------------------------------------------------- windows
reg("wn_dedup_latest", f"""
SELECT {BRT} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC NULLS LAST, amount DESC NULLS LAST,
                               player_id ASC NULLS FIRST, type ASC NULLS FIRST) AS rn
  FROM br_transactions) WHERE rn = 1""")
reg("wn_topn_per_group", """
SELECT player_id, CAST(amount AS DOUBLE) AS amount, CAST(rn AS BIGINT) AS rank_position FROM (
  SELECT player_id, amount, row_number() OVER (PARTITION BY player_id ORDER BY amount DESC NULLS LAST) AS rn
  FROM br_transactions) WHERE rn <= 5""")
reg("wn_count_partition", """
SELECT id, affiliate_id, COUNT(id) OVER (PARTITION BY affiliate_id) AS players_of_affiliate FROM sl_players""")
_KF = """
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY "timestamp" ASC NULLS FIRST, player_id ASC NULLS FIRST,
                               amount ASC NULLS FIRST, type ASC NULLS FIRST) AS rn
  FROM br_transactions"""
reg("wn_keep_first", f"SELECT {BRT} FROM ({_KF}) WHERE rn = 1")
reg("wn_keep_first_removed", f"SELECT id FROM ({_KF}) WHERE rn > 1")
reg("wn_mark_all_duplicates", """
SELECT id, player_id, CAST(amount AS DOUBLE) AS amount, COUNT(*) OVER (PARTITION BY id) > 1 AS is_duplicate
FROM br_transactions""")

# ---------------------------------------------------------------- sort / set
ORACLES["so_order_output"] = ORACLES["g_top3_player_deposits"] + "\nORDER BY player_id, rank_position"
reg("so_preview", "SELECT * FROM sl_players ORDER BY id ASC NULLS FIRST LIMIT 5")
reg("st_union_all", """
SELECT l FROM pairs GROUP BY l HAVING COUNT(DISTINCT r) > 1
UNION ALL
SELECT r FROM pairs GROUP BY r HAVING COUNT(DISTINCT l) > 1""", """
pairs AS (SELECT affiliate_id AS l, player_id AS r FROM sl_affiliate_player_bridge
          WHERE affiliate_id IS NOT NULL AND player_id IS NOT NULL)""")
reg("st_union_by_name", """
SELECT id, code, origin, redeemed_at FROM sl_affiliates
UNION ALL
SELECT DISTINCT p.affiliate_id AS id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP)
FROM sl_players p
WHERE p.affiliate_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sl_affiliates a WHERE a.id = p.affiliate_id)""")

# ---------------------------------------------------------------- data-quality checks
reg("dq_unique", "SELECT id, COUNT(*) AS n_records FROM br_players WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1")
reg("dq_not_null", "SELECT * FROM sl_players WHERE country_code IS NULL")
reg("dq_values_in_ci", f"SELECT {BRT} FROM br_transactions WHERE lower(CAST(type AS VARCHAR)) NOT IN ('deposit', 'withdraw')")
reg("dq_ref_integrity", """
SELECT c.affiliate_id AS fk FROM sl_players c LEFT JOIN sl_affiliates p ON c.affiliate_id = p.id
WHERE c.affiliate_id IS NOT NULL AND p.id IS NULL""")
reg("dq_ref_integrity_nullable", """
SELECT c.affiliate_id AS fk FROM br_players c LEFT JOIN (SELECT id FROM br_affiliates) p ON c.affiliate_id = p.id
WHERE c.affiliate_id IS NOT NULL AND p.id IS NULL""")
reg("dq_functional_dependency", """
SELECT id, COUNT(DISTINCT {'v': is_kyc_approved}) AS combos FROM br_players GROUP BY id
HAVING COUNT(DISTINCT {'v': is_kyc_approved}) > 1""")
reg("dq_functional_dependency_multi", """
SELECT id, COUNT(DISTINCT {'a': country_code, 'b': is_kyc_approved, 'c': created_at}) AS combos
FROM br_players GROUP BY id
HAVING COUNT(DISTINCT {'a': country_code, 'b': is_kyc_approved, 'c': created_at}) > 1""")
reg("dq_unique_by_key", "SELECT id, player_id, COUNT(*) AS cnt FROM br_transactions GROUP BY id, player_id HAVING COUNT(*) > 1")
reg("dq_txn_signs", f"""
SELECT {BRT} FROM br_transactions
WHERE (lower(type) = 'deposit' AND amount < 0) OR (lower(type) = 'withdraw' AND amount > 0)""")
reg("dq_one_to_one", """
SELECT l FROM pairs GROUP BY l HAVING COUNT(DISTINCT r) > 1
UNION ALL
SELECT r FROM pairs GROUP BY r HAVING COUNT(DISTINCT l) > 1""", """
pairs AS (SELECT affiliate_id AS l, player_id AS r FROM sl_affiliate_player_bridge
          WHERE affiliate_id IS NOT NULL AND player_id IS NOT NULL)""")
reg("dq_no_txn_before_kyc", """
SELECT t.id, t.txn_timestamp, t.player_id, t.type, CAST(t.amount AS DOUBLE) AS amount
FROM sl_transactions t JOIN sl_players p ON p.id = t.player_id
WHERE (p.is_kyc_approved IS DISTINCT FROM TRUE) OR (t.txn_timestamp < p.kyc_approved_at)""")
reg("dq_kyc_left_audit", """
SELECT t.id, t.player_id, t."timestamp" FROM br_transactions t LEFT JOIN sl_players p ON p.id = t.player_id
WHERE (p.is_kyc_approved IS DISTINCT FROM TRUE) OR (t."timestamp" < p.kyc_approved_at)""")
reg("dq_min_rows", """
SELECT row_count, CAST(1000 AS BIGINT) AS min_rows FROM (SELECT COUNT(*) AS row_count FROM sl_transactions) WHERE row_count < 1000
UNION ALL
SELECT row_count, CAST(2000 AS BIGINT) FROM (SELECT COUNT(*) AS row_count FROM sl_players) WHERE row_count < 2000""")


def _dq_row(layer, table, check, cols, count_sql):
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{check}' AS check_name, '{cols}' AS columns, "
            f"CAST(({count_sql}) AS BIGINT) AS violations")


def _uniq(t, c):
    return f"SELECT COUNT(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"


def _nn(t, c):
    return f"SELECT COUNT(*) FROM {t} WHERE {c} IS NULL"


def _ref(t, c, parent, pk):
    return (f"SELECT COUNT(*) FROM {t} c WHERE c.{c} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{c})")


def _ubk(t, cols):
    return f"SELECT COUNT(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING COUNT(*) > 1)"


_REPORT = [
    _dq_row("bronze", "br_affiliates", "unique", "id", _uniq("br_affiliates", "id")),
    _dq_row("bronze", "br_affiliates", "not_null", "id", _nn("br_affiliates", "id")),
    _dq_row("bronze", "br_players", "unique", "id", _uniq("br_players", "id")),
    _dq_row("bronze", "br_players", "not_null", "id", _nn("br_players", "id")),
    _dq_row("bronze", "br_players", "not_null", "country_code", _nn("br_players", "country_code")),
    _dq_row("bronze", "br_transactions", "unique", "id", _uniq("br_transactions", "id")),
    _dq_row("bronze", "br_transactions", "not_null", "id", _nn("br_transactions", "id")),
    _dq_row("bronze", "br_transactions", "values_in_ci", "type",
            "SELECT COUNT(*) FROM br_transactions WHERE lower(type) NOT IN ('deposit', 'withdraw')"),
    _dq_row("silver", "sl_affiliates", "unique", "id", _uniq("sl_affiliates", "id")),
    _dq_row("silver", "sl_affiliates", "not_null", "id", _nn("sl_affiliates", "id")),
    _dq_row("silver", "sl_affiliates", "functional_dependency", "id",
            "SELECT COUNT(*) FROM (SELECT id FROM sl_affiliates GROUP BY id "
            "HAVING COUNT(DISTINCT {'a': code, 'b': origin, 'c': redeemed_at}) > 1)"),
    _dq_row("silver", "sl_players", "ref_integrity_nullable", "affiliate_id",
            _ref("sl_players", "affiliate_id", "sl_affiliates", "id")),
    _dq_row("silver", "sl_players", "unique", "id", _uniq("sl_players", "id")),
    _dq_row("silver", "sl_players", "not_null", "id", _nn("sl_players", "id")),
    _dq_row("silver", "sl_players", "not_null", "country_code", _nn("sl_players", "country_code")),
    _dq_row("silver", "sl_affiliate_player_bridge", "one_to_one", "affiliate_id,player_id",
            "SELECT (SELECT COUNT(*) FROM (SELECT affiliate_id FROM sl_affiliate_player_bridge "
            "WHERE affiliate_id IS NOT NULL AND player_id IS NOT NULL GROUP BY affiliate_id "
            "HAVING COUNT(DISTINCT player_id) > 1)) + (SELECT COUNT(*) FROM (SELECT player_id "
            "FROM sl_affiliate_player_bridge WHERE affiliate_id IS NOT NULL AND player_id IS NOT NULL "
            "GROUP BY player_id HAVING COUNT(DISTINCT affiliate_id) > 1))"),
    _dq_row("silver", "sl_affiliate_player_bridge", "ref_integrity", "player_id",
            _ref("sl_affiliate_player_bridge", "player_id", "sl_players", "id")),
    _dq_row("silver", "sl_transactions", "no_txn_before_kyc", "txn_timestamp",
            "SELECT COUNT(*) FROM sl_transactions t JOIN sl_players p ON p.id = t.player_id "
            "WHERE p.is_kyc_approved IS DISTINCT FROM TRUE OR t.txn_timestamp < p.kyc_approved_at"),
    _dq_row("silver", "sl_transactions", "ref_integrity", "player_id",
            _ref("sl_transactions", "player_id", "sl_players", "id")),
    _dq_row("silver", "sl_transactions", "not_null", "amount", _nn("sl_transactions", "amount")),
    _dq_row("gold", "g_player_daily_balance", "unique_by_key", "player_id,txn_date",
            _ubk("g_player_daily_balance", "player_id, txn_date")),
    _dq_row("gold", "g_player_daily_balance", "not_null", "deposits", _nn("g_player_daily_balance", "deposits")),
    _dq_row("gold", "g_player_daily_balance", "not_null", "withdrawals", _nn("g_player_daily_balance", "withdrawals")),
    _dq_row("gold", "g_country_deposits_discord", "not_null", "country_code",
            _nn("g_country_deposits_discord", "country_code")),
    _dq_row("gold", "g_top3_player_deposits", "unique_by_key", "player_id,rank_position",
            _ubk("g_top3_player_deposits", "player_id, rank_position")),
    _dq_row("gold", "g_top3_player_deposits", "not_null", "top_deposit_amount",
            _nn("g_top3_player_deposits", "top_deposit_amount")),
]
reg("dq_report", "SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'warn' END AS status FROM (\n"
    + "\nUNION ALL\n".join(_REPORT) + "\n)")

# ---------------------------------------------------------------- cleaning job
CLEAN_CTES = """
c_players AS (
  SELECT id, affiliate_id, country_code,
         CASE WHEN lower(trim(is_kyc_approved)) IN ('true', 'yes', 'y', '1') THEN TRUE
              WHEN lower(trim(is_kyc_approved)) IN ('false', 'no', 'n', '0') THEN FALSE END AS is_kyc_approved,
         created_at, updated_at, version_id
  FROM raw_players
),
c_players_ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version_id) AS rn FROM c_players),
c_players_kept AS (SELECT * EXCLUDE (rn) FROM c_players_ranked WHERE rn = 1),
c_txn AS (
  SELECT id, TRY_CAST(NULLIF(trim("timestamp"), '') AS TIMESTAMP) AS "timestamp", player_id, type, amount
  FROM raw_transactions
),
c_txn_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY "timestamp", player_id, amount, type) AS rn FROM c_txn
),
c_txn_first AS (SELECT * EXCLUDE (rn) FROM c_txn_ranked WHERE rn = 1),
c_aff_ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id) AS rn FROM raw_affiliates),
c_aff_first AS (SELECT * EXCLUDE (rn) FROM c_aff_ranked WHERE rn = 1),
c_aff_code_ranked AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY id) AS rn FROM c_aff_first),
c_aff_kept AS (SELECT * EXCLUDE (rn) FROM c_aff_code_ranked WHERE rn = 1)
"""


def creg(name, body):
    reg(name, body, CLEAN_CTES)


creg("cl_coerce_types", "SELECT * FROM c_txn")
creg("cl_unique_ids", """
SELECT 'unique_ids' AS rule, 'affiliates' AS table_name, COUNT(*) AS rows_affected FROM c_aff_ranked WHERE rn > 1
UNION ALL SELECT 'unique_ids', 'players', COUNT(*) FROM c_players_ranked WHERE rn > 1
UNION ALL SELECT 'unique_ids', 'transactions', COUNT(*) FROM c_txn_ranked WHERE rn > 1""")
creg("cl_orphan_txn", """
SELECT * FROM c_txn_first t WHERE t.player_id IN (SELECT id FROM c_players_kept WHERE id IS NOT NULL)""")
creg("cl_unique_codes", "SELECT * FROM c_aff_kept")
creg("cl_null_unknown_codes", """
SELECT id, version_id,
       CASE WHEN affiliate_id IS NOT NULL AND affiliate_id NOT IN (SELECT id FROM c_aff_first WHERE id IS NOT NULL)
            THEN NULL ELSE affiliate_id END AS affiliate_id
FROM c_players_kept""")
creg("cl_drop_bad_owner", """
SELECT * FROM c_aff_kept WHERE id IN (SELECT id FROM c_players_kept WHERE id IS NOT NULL)""")
reg("cl_drop_not_approved", """
SELECT t.id, t.player_id FROM br_transactions t JOIN sl_players p ON p.id = t.player_id
WHERE coalesce(p.is_kyc_approved, FALSE)""")
reg("cl_drop_before_approval", """
SELECT t.id, t.player_id, t."timestamp" FROM br_transactions t JOIN sl_players p ON p.id = t.player_id
WHERE NOT coalesce(t."timestamp" < p.kyc_approved_at, FALSE)""")
creg("clean_domain", """
SELECT t.* FROM c_txn_first t JOIN c_players_kept p ON p.id = t.player_id
WHERE coalesce(p.is_kyc_approved, FALSE)""")
creg("clean_audit", """
SELECT 'unique_ids' AS rule, 'affiliates' AS table_name, COUNT(*) AS rows_affected FROM c_aff_ranked WHERE rn > 1
UNION ALL SELECT 'unique_codes', 'affiliates', COUNT(*) FROM c_aff_code_ranked WHERE rn > 1
UNION ALL SELECT 'unique_ids', 'players', COUNT(*) FROM c_players_ranked WHERE rn > 1
UNION ALL SELECT 'unique_ids', 'transactions', COUNT(*) FROM c_txn_ranked WHERE rn > 1
UNION ALL SELECT 'orphan_txn', 'transactions', COUNT(*) FROM c_txn_first t
          WHERE t.player_id IS NULL OR t.player_id NOT IN (SELECT id FROM c_players_kept WHERE id IS NOT NULL)
UNION ALL SELECT 'drop_not_approved', 'transactions', COUNT(*) FROM c_txn_first t JOIN c_players_kept p ON p.id = t.player_id
          WHERE NOT coalesce(p.is_kyc_approved, FALSE)""")

# ---------------------------------------------------------------- history snapshot
SNAP_CTES = """
s_ranked AS (
  SELECT * EXCLUDE (version_id), row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST,
         created_at DESC NULLS LAST, version_id DESC) AS rn FROM br_players
),
s_ranked_before AS (
  SELECT * EXCLUDE (version_id), row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST,
         created_at DESC NULLS LAST, version_id DESC) AS rn
  FROM br_players WHERE updated_at < TIMESTAMP '1998-01-01 00:00:00'
),
s_cur AS (SELECT * EXCLUDE (rn) FROM s_ranked WHERE rn = 1),
s_hist AS (
  SELECT * EXCLUDE (rn),
         md5(coalesce(CAST(id AS VARCHAR), '') || '|' || coalesce(CAST(updated_at AS VARCHAR), '')) AS dbt_scd_id,
         updated_at AS dbt_updated_at, updated_at AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
  FROM s_ranked_before WHERE rn = 1
)
"""
reg("players_snapshot_initial", """
SELECT *, md5(coalesce(CAST(id AS VARCHAR), '') || '|' || coalesce(CAST(updated_at AS VARCHAR), '')) AS dbt_scd_id,
       updated_at AS dbt_updated_at, updated_at AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
FROM s_cur""", SNAP_CTES)
reg("players_snapshot_merge", """
SELECT h.* EXCLUDE (dbt_valid_to),
       CASE WHEN c.updated_at > h.dbt_updated_at THEN c.updated_at END AS dbt_valid_to
FROM s_hist h LEFT JOIN s_cur c ON c.id = h.id
UNION ALL
SELECT c.*, md5(coalesce(CAST(c.id AS VARCHAR), '') || '|' || coalesce(CAST(c.updated_at AS VARCHAR), '')),
       c.updated_at, c.updated_at, CAST(NULL AS TIMESTAMP)
FROM s_cur c LEFT JOIN s_hist h ON h.id = c.id
WHERE h.id IS NULL OR c.updated_at > h.dbt_updated_at""", SNAP_CTES)

# ---------------------------------------------------------------- sources, sinks, pipeline
ORACLES["src_csv_scan"] = ORACLES["br_players"]
reg("src_csv_line_breaks", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, NULLIF(text, '') AS text, NULLIF(lang, '') AS lang, NULLIF(source, '') AS source FROM documents""")
reg("src_csv_dir", """
SELECT 'affiliates' AS table_name, COUNT(*) AS row_count FROM raw_affiliates
UNION ALL SELECT 'players', COUNT(*) FROM raw_players
UNION ALL SELECT 'transactions', COUNT(*) FROM raw_transactions""")
reg("src_drop_unnamed", "SELECT * FROM raw_affiliates")
reg("src_csv_to_parquet", "SELECT * FROM raw_transactions")
reg("src_load_truncate", "SELECT 'raw_transactions' AS table_name, COUNT(*) AS row_count FROM raw_transactions")
reg("src_load_append", "SELECT 'raw_transactions' AS table_name, 2 * COUNT(*) AS row_count FROM raw_transactions")
creg("snk_csv", """
SELECT t.id, strftime(t."timestamp", '%Y-%m-%d %H:%M:%S') || '+00:00' AS "timestamp", t.player_id, t.type, t.amount
FROM c_txn_first t JOIN c_players_kept p ON p.id = t.player_id
WHERE coalesce(p.is_kyc_approved, FALSE)""")
ORACLES["snk_table"] = ORACLES["sl_players"]
ORACLES["snk_view"] = ORACLES["g_player_daily_balance"]
reg("snk_partitioned", """
SELECT id, txn_timestamp, player_id, type, CAST(amount AS DOUBLE) AS amount,
       CAST(txn_timestamp AS DATE) AS txn_timestamp_date
FROM sl_transactions""")


def _content(layer: str, table: str, columns: str, source: str | None = None) -> str:
    """Row count and content hash of a table: ``name:kind`` columns, kind s (text, numbers, dates) or t (timestamps)."""
    parts = []
    for c in sorted(columns.split()):
        name, kind = c.split(":")
        text = f'epoch_us("{name}")' if kind == "t" else f'"{name}"'
        parts.append(f"coalesce('=' || CAST({text} AS VARCHAR), '~')")
    row = " || chr(31) || ".join(parts)
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, COUNT(*) AS row_count, "
            f"coalesce(SUM(('0x' || substr(md5({row}), 1, 15))::BIGINT), 0)::HUGEINT::VARCHAR AS content_hash FROM {source or table}")


_PLAYER = "id:s affiliate_id:s country_code:s is_kyc_approved:s created_at:t updated_at:t"
reg("run_medallion", " UNION ALL ".join([
    _content("bronze", "br_affiliates", "id:s code:s origin:s redeemed_at:t"),
    _content("bronze", "br_players", _PLAYER + " version_id:s"),
    _content("bronze", "br_transactions", "id:s timestamp:t player_id:s type:s amount:s"),
    _content("silver", "sl_affiliates", "id:s code:s origin:s redeemed_at:t"),
    _content("silver", "sl_players", _PLAYER + " kyc_approved_at:t"),
    _content("silver", "sl_affiliate_player_bridge", "affiliate_id:s code:s origin:s redeemed_at:t player_id:s "
             "is_violation_unlinked_redeemed:s player_ref_count:s is_violation_affiliate_not_1to1:s"),
    _content("silver", "sl_transactions", "id:s txn_timestamp:t player_id:s type:s amount:s"),
    _content("gold", "g_player_daily_balance", "player_id:s txn_date:s deposits:s withdrawals:s"),
    _content("gold", "g_country_deposits_discord", "country_code:s deposit_count:s deposit_sum:s"),
    _content("gold", "g_top3_player_deposits", "player_id:s top_deposit_amount:s rank_position:s"),
    _content("snapshot", "players_snapshot", _PLAYER + " dbt_scd_id:s dbt_updated_at:t dbt_valid_from:t dbt_valid_to:t", "s_initial"),
]), SNAP_CTES.rstrip() + """,
s_initial AS (
  SELECT *, md5(coalesce(CAST(id AS VARCHAR), '') || '|' || coalesce(CAST(updated_at AS VARCHAR), '')) AS dbt_scd_id,
         updated_at AS dbt_updated_at, updated_at AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
  FROM s_cur)
""")

# ---------------------------------------------------------------- table extension
_SEED = 42
_NOW = "TIMESTAMP '2025-09-01 00:00:00'"
_ALPHA = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_ORIGINS = "['web', 'ios', 'android', 'partner', 'campaign', 'YouTube', 'Discord', 'X']"
_COUNTRIES = "['CO', 'US', 'MX', 'BR', 'AR', 'CL', 'PE', 'ES', 'GB', 'DE', 'FR', 'CA', 'IN', 'PH', 'AU']"
_TYPES = "['deposit', 'withdrawal', 'bet', 'win']"


def U(tag: str, idx: str = "id") -> str:
    """md5 draw: first 15 hex digits of md5('<seed>|<id>|<tag>') as an integer."""
    return f"('0x' || substr(md5('{_SEED}|' || CAST({idx} AS VARCHAR) || '|{tag}'), 1, 15))::BIGINT"


def _code_number(x: str) -> str:
    """Four rounds on the halves of a number below 36^8: (l, r) -> (r, l + f(round, r))."""
    h = 36 ** 4
    left, right = f"({x} // {h})", f"({x} % {h})"
    for r in range(1, 5):
        left, right = right, f"(({left} + ('0x' || substr(md5('{_SEED}|{r}|' || CAST({right} AS VARCHAR)), 1, 15))::BIGINT % {h}) % {h})"
    return f"{left} * {h} + {right}"


_CODE = " || ".join(f"substr('{_ALPHA}', CAST(num // {36 ** (7 - k)} % 36 + 1 AS INTEGER), 1)" for k in range(8))

EXT_CTES = CLEAN_CTES.rstrip() + rf""",
e_a0 AS (
  SELECT TRY_CAST(TRY_CAST(id AS DECIMAL(38,0)) AS BIGINT) AS id,
         trim(regexp_replace(lower(code), '[ \t\n\f\r]+', ' ', 'g'), ' ') AS code,
         trim(regexp_replace(lower(origin), '[ \t\n\f\r]+', ' ', 'g'), ' ') AS origin,
         TRY_CAST(NULLIF(redeemed_at, '') AS TIMESTAMP) AS redeemed_at
  FROM c_aff_kept
),
e_p0 AS (
  SELECT TRY_CAST(TRY_CAST(id AS DECIMAL(38,0)) AS BIGINT) AS id,
         TRY_CAST(TRY_CAST(affiliate_id AS DECIMAL(38,0)) AS BIGINT) AS affiliate_id,
         CASE WHEN length(trim(country_code, ' ')) = 2 THEN upper(trim(country_code, ' ')) END AS country_code,
         CASE WHEN lower(CAST(is_kyc_approved AS VARCHAR)) IN ('true', '1', 't', 'y', 'yes') THEN TRUE
              WHEN lower(CAST(is_kyc_approved AS VARCHAR)) IN ('false', '0', 'f', 'n', 'no') THEN FALSE
         END AS is_kyc_approved,
         TRY_CAST(NULLIF(created_at, '') AS TIMESTAMP) AS created_at,
         TRY_CAST(NULLIF(updated_at, '') AS TIMESTAMP) AS updated_at
  FROM c_players_kept
),
e_t0 AS (
  SELECT TRY_CAST(TRY_CAST(t.id AS DECIMAL(38,0)) AS BIGINT) AS id,
         TRY_CAST(NULLIF(CAST(t."timestamp" AS VARCHAR), '') AS TIMESTAMP) AS "timestamp",
         TRY_CAST(TRY_CAST(t.player_id AS DECIMAL(38,0)) AS BIGINT) AS player_id,
         trim(regexp_replace(lower(t.type), '[ \t\n\f\r]+', ' ', 'g'), ' ') AS type,
         TRY_CAST(regexp_replace(t.amount, '[^0-9.\-]+', '', 'g') AS DECIMAL(18,2)) AS amount
  FROM c_txn_first t JOIN c_players_kept p ON p.id = t.player_id
  WHERE coalesce(p.is_kyc_approved, FALSE)
),
e_n AS (
  SELECT *, CAST(ceil(2.0 * greatest(a_rows, p_rows, t_rows)) AS BIGINT) AS n FROM (
    SELECT (SELECT coalesce(max(id), 0) FROM e_a0) AS a_max, (SELECT count(*) FROM e_a0) AS a_rows,
           (SELECT coalesce(max(id), 0) FROM e_p0) AS p_max, (SELECT count(*) FROM e_p0) AS p_rows,
           (SELECT coalesce(max(id), 0) FROM e_t0) AS t_max, (SELECT count(*) FROM e_t0) AS t_rows)
),
e_a_new AS (SELECT id, {_code_number(f'(id % {36 ** 8})')} AS num FROM (SELECT a_max + unnest(range(1, n - a_rows + 1)) AS id FROM e_n)),
e_a_ext1 AS (
  SELECT id, NULLIF(upper(regexp_replace(code, '^\s+|\s+$', '', 'g')), '') AS code,
         CASE WHEN NOT regexp_matches(origin, '^\s*$') THEN origin END AS origin, redeemed_at
  FROM (SELECT id, code, origin, redeemed_at FROM e_a0
        UNION ALL
        SELECT id, {_CODE}, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP) FROM e_a_new)
),
e_p_new AS (SELECT p_max + unnest(range(1, n - p_rows + 1)) AS id FROM e_n),
e_p_ext AS (
  SELECT id, affiliate_id, country_code, is_kyc_approved, created_at, updated_at FROM e_p0
  UNION ALL
  SELECT id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), {U('kyc')} % 100 < 75,
         {_NOW} + to_minutes(-(({U('created_d')} % 120) * 1440 + {U('created_m')} % 1440)), CAST(NULL AS TIMESTAMP)
  FROM e_p_new
),
e_a_idx AS (SELECT id, code, row_number() OVER (ORDER BY id) - 1 AS gidx FROM e_a_ext1
            WHERE code IS NOT NULL AND id IS NOT NULL),
e_a_cnt AS (SELECT count(*) AS n_codes FROM e_a_idx),
e_p_code AS (
  SELECT p.*, x.code AS affiliate_code_redeemed
  FROM e_p_ext p CROSS JOIN e_a_cnt c
  LEFT JOIN e_a_idx x ON x.gidx = CASE WHEN {U('has_code', 'p.id')} % 100 < 60 THEN {U('code_pick', 'p.id')} % c.n_codes END
),
e_a_ext2 AS (
  SELECT id, code, coalesce(origin, {_ORIGINS}[CAST({U('origin')} % 8 + 1 AS INTEGER)]) AS origin, redeemed_at
  FROM e_a_ext1
),
e_first_use AS (
  SELECT affiliate_code_redeemed AS c, min(coalesce(created_at, updated_at)) AS first_at FROM e_p_code
  WHERE affiliate_code_redeemed IS NOT NULL AND coalesce(created_at, updated_at) IS NOT NULL GROUP BY 1
),
e_a_ext3 AS (
  SELECT a.id, a.code, a.origin,
         CASE WHEN a.redeemed_at IS NULL AND f.first_at IS NOT NULL
              THEN f.first_at + to_minutes({U('redeem_m', 'a.id')} % 1440) ELSE a.redeemed_at END AS redeemed_at
  FROM e_a_ext2 a LEFT JOIN e_first_use f ON a.code = f.c
),
e_by_code AS (SELECT code AS c, max(id) AS aid FROM e_a_ext3 WHERE code IS NOT NULL GROUP BY 1),
e_p3 AS (
  SELECT p.id, coalesce(p.affiliate_id, b.aid) AS affiliate_id,
         coalesce(p.country_code, {_COUNTRIES}[CAST({U('country', 'p.id')} % 15 + 1 AS INTEGER)]) AS country_code,
         p.is_kyc_approved, p.created_at,
         coalesce(p.updated_at,
                  coalesce(p.created_at, {_NOW} + to_minutes(-({U('upd_base', 'p.id')} % 120) * 1440))
                  + to_minutes(({U('upd_d', 'p.id')} % 30) * 1440 + {U('upd_m', 'p.id')} % 1440)) AS updated_at,
         p.affiliate_code_redeemed
  FROM e_p_code p LEFT JOIN e_by_code b ON p.affiliate_code_redeemed = b.c
),
e_kyc AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS gidx FROM e_p3
          WHERE is_kyc_approved = TRUE AND id IS NOT NULL),
e_kyc_n AS (SELECT count(*) AS n_kyc FROM e_kyc),
e_t_new AS (SELECT t_max + unnest(range(1, n - t_rows + 1)) AS id FROM e_n),
e_t_ext AS (
  SELECT * FROM e_t0
  UNION ALL
  SELECT t.id,
         {_NOW} + to_minutes(-30 * 1440 + ({U('txn_d', 't.id')} % 60) * 1440 + {U('txn_m', 't.id')} % 1440),
         k.id, {_TYPES}[CAST({U('txn_type', 't.id')} % 4 + 1 AS INTEGER)],
         CAST({U('amount', 't.id')} % 4999 + 1 AS DECIMAL(18,2))
  FROM e_t_new t CROSS JOIN e_kyc_n c LEFT JOIN e_kyc k ON k.gidx = {U('txn_player', 't.id')} % c.n_kyc
),
e_codes AS (
  SELECT id AS aid, min(NULLIF(upper(regexp_replace(code, '^\s+|\s+$', '', 'g')), '')) AS acode
  FROM e_a_ext3 WHERE id IS NOT NULL AND code IS NOT NULL GROUP BY id
),
e_code_bad AS (
  SELECT p.* FROM e_p3 p LEFT JOIN e_codes c ON p.affiliate_id = c.aid
  WHERE p.affiliate_id IS NOT NULL AND p.affiliate_code_redeemed IS NOT NULL
    AND NULLIF(upper(regexp_replace(p.affiliate_code_redeemed, '^\s+|\s+$', '', 'g')), '') IS DISTINCT FROM c.acode
)"""


def ereg(name, body):
    reg(name, body, EXT_CTES)


ereg("ex_new_ids", "SELECT id FROM e_a_ext3")
ereg("ex_random_code", "SELECT id, code FROM e_a_ext3 WHERE id > (SELECT a_max FROM e_n)")
ereg("ex_choice_from_pool", "SELECT id, origin FROM e_a_ext3 UNION ALL SELECT id, country_code FROM e_p3")
ereg("ex_weighted_bool", "SELECT id, is_kyc_approved FROM e_p3 WHERE id > (SELECT p_max FROM e_n)")
ereg("ex_choice_from_table", "SELECT id, affiliate_code_redeemed FROM e_p3")
ereg("ex_created_approved_dates", f"""
SELECT id, is_kyc_approved, created_at,
       CASE WHEN is_kyc_approved = TRUE THEN created_at + to_minutes(({U('approved_d')} % 10) * 1440) END
         AS kyc_verified_at
FROM e_p3 WHERE id > (SELECT p_max FROM e_n)""")
ereg("ex_redeemed_at", "SELECT id, redeemed_at FROM e_a_ext3")
ereg("ex_affiliate_id_from_code", "SELECT id, affiliate_id FROM e_p3")
ereg("ex_updated_at", "SELECT id, created_at, updated_at FROM e_p3")
ereg("ex_transactions", 'SELECT id, "timestamp", player_id, type, CAST(amount AS DOUBLE) AS amount FROM e_t_ext')
ereg("extend_domain", """
SELECT 'affiliates' AS table_name, COUNT(*) AS row_count FROM e_a_ext3
UNION ALL SELECT 'players', COUNT(*) FROM e_p3
UNION ALL SELECT 'transactions', COUNT(*) FROM e_t_ext""")
_UQ = "SELECT COUNT(*) FROM (SELECT id FROM {t} WHERE id IS NOT NULL GROUP BY id HAVING COUNT(*) > 1)"
_MR = "SELECT CASE WHEN (SELECT COUNT(*) FROM {t}) < (SELECT n FROM e_n) THEN 1 ELSE 0 END"
ereg("ex_validation", " UNION ALL ".join(
    [f"SELECT '{name}' AS table_name, '{chk}' AS check_name, CAST(({q.format(t=t)}) AS BIGINT) AS violations"
     for name, t in (("affiliates", "e_a_ext3"), ("players", "e_p3"), ("transactions", "e_t_ext"))
     for chk, q in (("unique", _UQ), ("min_rows", _MR))]
    + ["SELECT 'players', 'code_consistent', CAST((SELECT COUNT(*) FROM e_code_bad) AS BIGINT)",
       "SELECT 'transactions', 'kyc_left_audit', CAST((SELECT COUNT(*) FROM e_t_ext t LEFT JOIN e_p3 p "
       "ON p.id = t.player_id WHERE p.is_kyc_approved IS DISTINCT FROM TRUE) AS BIGINT)"]))
ROLE_CTES = EXT_CTES + rf""",
er_p AS (
  SELECT p.*, CASE WHEN is_kyc_approved = TRUE THEN created_at + to_minutes(
           CASE WHEN id > (SELECT p_max FROM e_n) THEN ({U('approved_d')} % 10) * 1440 ELSE 3 * 1440 END) END AS kyc_verified_at
  FROM e_p3 p
),
er_t AS (
  SELECT id, "timestamp", player_id, type, amount FROM e_t0
  UNION ALL
  SELECT t.id, coalesce(p.kyc_verified_at, {_NOW} + to_minutes(-30 * 1440))
               + to_minutes(({U('txn_d', 't.id')} % 60) * 1440 + {U('txn_m', 't.id')} % 1440),
         t.player_id, t.type, t.amount
  FROM e_t_ext t JOIN er_p p ON p.id = t.player_id WHERE t.id > (SELECT t_max FROM e_n)
),
er_owner AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS gidx FROM e_p0 WHERE id IS NOT NULL),
er_a AS (
  SELECT a.id, CASE WHEN a.id > n.a_max THEN o.id END AS owner_player_id
  FROM e_a_ext3 a CROSS JOIN e_n n LEFT JOIN er_owner o
    ON o.gidx = {U('owner', 'a.id')} % (SELECT count(*) FROM er_owner)
)"""
reg("ex_owner", "SELECT id, owner_player_id FROM er_a", ROLE_CTES)
reg("ex_approval_dates", "SELECT id, kyc_verified_at FROM er_p", ROLE_CTES)
reg("ex_transactions_after_approval",
    'SELECT id, "timestamp", player_id, type, CAST(amount AS DOUBLE) AS amount FROM er_t', ROLE_CTES)
reg("ex_validation_dates", """
SELECT 'transactions' AS table_name, 'kyc_left_audit' AS check_name, COUNT(*) AS violations
FROM er_t t LEFT JOIN er_p p ON p.id = t.player_id
WHERE p.is_kyc_approved IS DISTINCT FROM TRUE OR t."timestamp" < p.kyc_verified_at""", ROLE_CTES)
ereg("dq_code_consistent", "SELECT id, affiliate_id, affiliate_code_redeemed FROM e_code_bad")
