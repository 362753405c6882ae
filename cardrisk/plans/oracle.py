"""Independent DuckDB SQL for every registered query.

The oracle is written from the documented semantics, not from the Spark
code: the fixture view, Silver and Gold are restated as CTEs and each
report is plain ANSI SQL over them.  Money is summed as DECIMAL(12,2)
(exact in both engines) and only the final column is cast to DOUBLE.
"""

from __future__ import annotations

from ..sources.fixtures import transactions_sql

from .params import (BASE_BEFORE, CORRECTIONS_FROM, DAY, ERASE_USERS, MOVED_MERCHANT, ODD_AMOUNTS,
                     UPSERT_FROM)

_TX = transactions_sql("VARCHAR")

_AFFIX = "substring(card, 1, 4) || '-XXXX-XXXX-' || right(card, 4)"
_REGEX = r"regexp_replace(card, '^(\d{4})\d{8}(\d{4})$', '\1-XXXX-XXXX-\2')"
_STRICT = (f"CASE WHEN card IS NULL THEN NULL WHEN regexp_full_match(card, '[0-9]{{16}}') "
           f"THEN {_AFFIX} ELSE 'XXXX-XXXX-XXXX-XXXX' END")

_SILVER_COLS = ("transaction_id, user_id, {mask} AS card_masked, amount, transaction_date, "
                "event_ts, merchant, merchant_category, currency, is_fraud_suspect")


def _silver(mask: str) -> str:
    return f"SELECT {_SILVER_COLS.format(mask=mask)} FROM transactions WHERE amount > 0"


BASE = f"""WITH transactions AS (
{_TX}
),
silver AS ({_silver(_AFFIX)}),
silver_regex AS ({_silver(_REGEX)}),
silver_strict AS ({_silver(_STRICT)}),
gold AS (
  SELECT user_id, transaction_date, COUNT(*) AS tx_count, SUM(amount) AS daily_total,
         COUNT(*) > 12 AS is_high_risk
  FROM silver GROUP BY user_id, transaction_date),
gold_p2 AS (
  SELECT user_id, transaction_date, SUM(amount) AS total_monto_diario,
         COUNT(transaction_id) AS cantidad_transacciones_diarias,
         MAX(is_fraud_suspect) AS contiene_sospecha_fraude,
         CASE WHEN COUNT(transaction_id) > 12 THEN 1 ELSE 0 END AS perfil_alto_riesgo
  FROM silver_regex GROUP BY user_id, transaction_date)
"""

_SILVER_OUT = ("SELECT transaction_id, user_id, card_masked, CAST(amount AS DOUBLE) AS amount, "
               "transaction_date, event_ts, merchant, merchant_category, currency, "
               "is_fraud_suspect FROM {src}")

_GOLD_OUT = ("user_id, transaction_date, tx_count, CAST(daily_total AS DOUBLE) AS daily_total, "
             "is_high_risk")


def _q(body: str) -> str:
    return BASE + body


ORACLE_SQL: dict[str, str] = {
    "silver_affix_mask": _q(_SILVER_OUT.format(src="silver")),
    "silver_regex_mask": _q(_SILVER_OUT.format(src="silver_regex")),
    "silver_strict_mask": _q(_SILVER_OUT.format(src="silver_strict")),
    "gold_risk_profile": _q(f"SELECT {_GOLD_OUT} FROM gold"),
    "gold_daily_features": _q(
        "SELECT user_id, transaction_date, CAST(total_monto_diario AS DOUBLE) AS total_monto_diario, "
        "cantidad_transacciones_diarias, contiene_sospecha_fraude, perfil_alto_riesgo FROM gold_p2"),
    "top_user_days": _q(
        f"SELECT {_GOLD_OUT} FROM gold ORDER BY tx_count DESC, user_id, transaction_date LIMIT 10"),
    "top5_user_days": _q(
        f"SELECT {_GOLD_OUT} FROM gold ORDER BY tx_count DESC, user_id, transaction_date LIMIT 5"),
    "high_risk_list": _q(
        "SELECT user_id, transaction_date, tx_count, CAST(daily_total AS DOUBLE) AS daily_total "
        "FROM gold WHERE is_high_risk = true ORDER BY tx_count DESC"),
    "daily_volume_7d": _q(
        "SELECT transaction_date, COUNT(*) AS total_transacciones, "
        "CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS monto_total FROM silver "
        "WHERE transaction_date >= (SELECT MAX(transaction_date) FROM silver) - INTERVAL 7 DAY "
        "GROUP BY transaction_date ORDER BY transaction_date DESC"),
    "risk_global": _q(
        "SELECT COUNT(DISTINCT user_id) AS total_usuarios, "
        "COUNT(DISTINCT CASE WHEN is_high_risk THEN user_id END) AS usuarios_high_risk, "
        "ROUND(CAST(COUNT(DISTINCT CASE WHEN is_high_risk THEN user_id END) AS DOUBLE) * 100.0 / "
        "CAST(COUNT(DISTINCT user_id) AS DOUBLE), 2) AS pct_high_risk FROM gold"),
    "currency_mix": _q(
        "SELECT currency, COUNT(*) AS cantidad, CAST(ROUND(AVG(amount), 2) AS DOUBLE) AS monto_promedio "
        "FROM silver GROUP BY currency ORDER BY cantidad DESC"),
    "layer_counts": _q(
        "SELECT 'Silver' AS capa, COUNT(*) AS filas FROM silver "
        "UNION ALL SELECT 'Gold', COUNT(*) FROM gold"),
    "category_day_count": _q(
        f"SELECT merchant_category, COUNT(*) AS count FROM silver "
        f"WHERE transaction_date = DATE '{DAY}' GROUP BY merchant_category"),
    "risk_day_histogram": _q(
        f"SELECT perfil_alto_riesgo, COUNT(*) AS count FROM gold_p2 "
        f"WHERE transaction_date = DATE '{DAY}' GROUP BY perfil_alto_riesgo"),
    "distinct_users": _q("SELECT DISTINCT user_id FROM gold"),
}


# -- generators: the md5 recipe restated in DuckDB ------------------------------

def _h(salt: str, expr: str = "event_id", k: int = 8) -> str:
    return f"CAST('0x' || substring(md5('{salt}:' || CAST({expr} AS VARCHAR)), 1, {k}) AS BIGINT)"


def _u(salt: str, expr: str) -> str:
    return f"(({_h(salt, expr)} + 0.5) / 4294967296.0)"


def _normal(salt: str, expr: str) -> str:
    return (f"(sqrt(-2.0 * ln({_u(salt + '/u1', expr)})) * "
            f"cos(6.283185307179586 * {_u(salt + '/u2', expr)}))")


def _uuid(salt: str, expr: str) -> str:
    d = f"md5('{salt}:' || CAST({expr} AS VARCHAR))"
    return (f"concat_ws('-', substring({d}, 1, 8), substring({d}, 9, 4), substring({d}, 13, 4), "
            f"substring({d}, 17, 4), substring({d}, 21, 12))")


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _lognormal(salt: str = "p3") -> str:
    k = f"({_h(salt + '/amount_idx')} % 10000)"
    return f"round(exp(3.0 + 1.2 * {_normal(salt + '/lognormal', k)}), 2)"


def _gauss(salt: str = "demo") -> str:
    return f"round(abs(150.0 + 300.0 * {_normal(salt + '/gauss', 'event_id')}) + 0.01, 2)"


_P2_CATS = ("Retail", "Banca", "Restaurantes", "Viajes", "E-Commerce")
_DEMO_MERCHANTS = ("Amazon", "Netflix", "Spotify", "Uber", "Rappi", "Falabella",
                   "MercadoLibre", "Disney+", "Apple", "Google")
_DEMO_CARDS = ("4532015112890367", "4916123456789012", "4556123456789013",
               "4929123456789014", "4539123456789015", "4485123456789016",
               "4716123456789017", "4024123456789018", "4532123456789019",
               "4913123456789020")

ORACLE_SQL["generate_p2"] = f"""SELECT event_id AS id,
  {_uuid('p2/txid', 'event_id')} AS transaction_id,
  CAST({_h('p2/user')} % 50000 AS INTEGER) AS user_id,
  '4152' || lpad(CAST({_h('p2/card', k=12)} % 1000000000000 AS VARCHAR), 12, '0') AS card_number,
  CAST(CAST((500 + {_h('p2/amount')} % 450000) / 100.0 AS DECIMAL(10,2)) AS DOUBLE) AS amount,
  {_list(_P2_CATS)}[{_h('p2/category')} % 5 + 1] AS merchant_category,
  DATE '2026-06-30' - CAST({_h('p2/date')} % 45 AS INTEGER) AS transaction_date,
  CASE WHEN {_h('p2/suspect')} % 100 >= 97 THEN 1 ELSE 0 END AS is_fraud_suspect
FROM events"""

_P3_AMOUNT = _lognormal("p3")
ORACLE_SQL["generate_p3"] = f"""SELECT 'tx-' || lpad(CAST(event_id AS VARCHAR), greatest(length(CAST(event_id AS VARCHAR)), 8)::INT, '0') AS transaction_id,
  {_uuid('p3/user_id', f"({_h('p3/user')} % 10000)")} AS user_id,
  '4' || lpad(CAST({_h('p3/card_no', f"({_h('p3/card')} % 2000)", 15)} % 1000000000000000 AS VARCHAR), 15, '0') AS card,
  CASE WHEN event_id % 50 = 0 THEN
         CASE WHEN {_h('p3/defect')} % 3 = 0 THEN -abs({_P3_AMOUNT}) ELSE 0.0 END
       ELSE {_P3_AMOUNT} END AS amount,
  DATE '2026-01-01' + CAST({_h('p3/date')} % 181 AS INTEGER) AS transaction_date,
  CAST(DATE '2026-01-01' + CAST({_h('p3/date')} % 181 AS INTEGER) AS TIMESTAMP) AS timestamp,
  'merchant_' || lpad(CAST({_h('p3/merchant')} % 500 AS VARCHAR), 3, '0') AS merchant,
  CASE WHEN {_h('p3/currency')} % 100 < 50 THEN 'USD' WHEN {_h('p3/currency')} % 100 < 70 THEN 'EUR'
       WHEN {_h('p3/currency')} % 100 < 85 THEN 'CLP' WHEN {_h('p3/currency')} % 100 < 95 THEN 'BRL'
       ELSE 'MXN' END AS currency
FROM events"""

_DEMO_AMOUNT = _gauss("demo")
_DEMO_TS = (f"(CAST(DATE '2026-01-01' + CAST({_h('demo/date')} % 181 AS INTEGER) AS TIMESTAMP) "
            f"+ to_hours(CAST({_h('demo/hour')} % 24 AS INTEGER)))")
ORACLE_SQL["generate_demo"] = f"""SELECT 'demo-' || lpad(CAST(event_id AS VARCHAR), greatest(length(CAST(event_id AS VARCHAR)), 6)::INT, '0') AS transaction_id,
  {_uuid('demo/user_id', f"({_h('demo/user')} % 500)")} AS user_id,
  {_list(_DEMO_CARDS)}[{_h('demo/card')} % 10 + 1] AS card,
  CASE WHEN event_id % 75 = 0 THEN
         CASE WHEN {_h('demo/defect')} % 2 = 0 THEN -abs({_DEMO_AMOUNT}) ELSE 0.0 END
       ELSE {_DEMO_AMOUNT} END AS amount,
  CAST({_DEMO_TS} AS DATE) AS transaction_date,
  {_DEMO_TS} AS timestamp,
  {_list(_DEMO_MERCHANTS)}[{_h('demo/merchant')} % 10 + 1] AS merchant,
  ['USD', 'EUR', 'CLP', 'BRL'][{_h('demo/currency')} % 4 + 1] AS currency
FROM events"""

ORACLE_SQL["generate_lognormal"] = f"SELECT event_id AS id, {_P3_AMOUNT} AS amount FROM events"
ORACLE_SQL["generate_gauss"] = f"SELECT event_id AS id, {_DEMO_AMOUNT} AS amount FROM events"


# -- quality ---------------------------------------------------------------------

_PCT = "ROUND(CAST({x} AS DOUBLE) * 100.0 / CAST({y} AS DOUBLE), 2)"

ORACLE_SQL["reconcile_layers"] = _q(
    "SELECT COUNT(*) AS bronze_rows, COUNT(*) FILTER (WHERE amount > 0) AS silver_rows, "
    "COUNT(*) FILTER (WHERE NOT coalesce(amount > 0, false)) AS rejected_rows, "
    + _PCT.format(x="COUNT(*) FILTER (WHERE amount > 0)", y="COUNT(*)")
    + " AS retention_pct FROM transactions")

ORACLE_SQL["run_summary"] = _q(
    "SELECT (SELECT COUNT(*) FROM transactions) AS bronze_rows, "
    "(SELECT COUNT(*) FROM silver) AS silver_rows, "
    + _PCT.format(x="(SELECT COUNT(*) FROM silver)", y="(SELECT COUNT(*) FROM transactions)")
    + " AS retention_pct, COUNT(*) AS gold_rows, COUNT(DISTINCT user_id) AS unique_users, "
    "COUNT(*) FILTER (WHERE is_high_risk) AS high_risk_user_days, "
    "COUNT(DISTINCT CASE WHEN is_high_risk THEN user_id END) AS high_risk_users FROM gold")

_STRING_COLS = ("transaction_id", "card_masked", "merchant", "merchant_category", "currency")
ORACLE_SQL["pii_leak_scan"] = _q(" UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE regexp_matches({c}, '[0-9]{{13,19}}')) AS violations FROM {src}"
    for layer, src in (("silver_affix", "silver"), ("silver_regex", "silver_regex"),
                       ("silver_strict", "silver_strict"))
    for c in _STRING_COLS))


def _luhn(d: str) -> str:
    """A card number: 13 to 19 digits, the first 2 to 6, digit sum with every second doubled."""
    return (f"regexp_full_match({d}, '[2-6][0-9]{{12,18}}') AND list_sum(list_transform(range(1, len({d}) + 1), "
            f"lambda k: CASE WHEN (len({d}) - k) % 2 = 0 THEN {d}[k]::INT "
            f"ELSE ({d}[k]::INT * 2) // 10 + ({d}[k]::INT * 2) % 10 END)) % 10 = 0")


# Whole groups of 13 to 19 digits in "4532 .... .... .... yyyy-MM-dd" (16 digits) and in
# "4532 .... .... ...yyyy-MM-dd" (15): first and last digit.
_GROUPS16 = ((1, 16), (5, 20), (5, 22), (9, 22), (9, 24))
_GROUPS15 = ((1, 19), (5, 19), (5, 21), (5, 23), (9, 21), (9, 23))


def _cut(places) -> str:
    return "[" + ", ".join(f"substring(card || strftime(event_ts, '%Y%m%d'), {a}, {b - a + 1})" for a, b in places) + "]"


ORACLE_SQL["card_number_scan"] = _q(f""",
forms AS (SELECT unnest(['card', 'number', 'whole', 'nested.notes']) AS column_name, [card] AS d FROM transactions
          UNION ALL SELECT 'spaced', CASE len(card) WHEN 16 THEN {_cut(_GROUPS16)} ELSE {_cut(_GROUPS15)} END FROM transactions
          UNION ALL SELECT 'millis', [CAST(epoch_ms(event_ts) AS VARCHAR)] FROM transactions
          UNION ALL SELECT 'micros', [CAST(epoch_ms(event_ts) * 1000 AS VARCHAR)] FROM transactions)
SELECT 'raw' AS layer, column_name,
       COUNT(*) FILTER (WHERE len(list_filter(d, lambda x: x IS NOT NULL AND {_luhn('x')})) > 0) AS violations
FROM forms GROUP BY column_name""")

# -- bronze ------------------------------------------------------------------------

_REASON = ("CASE WHEN merchant = 'merchant_11' THEN 'malformed' "
           "WHEN merchant = 'merchant_7' AND amount IS NOT NULL THEN 'malformed' "
           "WHEN amount IS NULL THEN 'null_amount' "
           "WHEN transaction_date IS NULL THEN 'null_date' END")

ORACLE_SQL["bronze_rejects"] = _q(
    f"SELECT reason, COUNT(*) AS row_count FROM (SELECT {_REASON} AS reason FROM transactions) r "
    "WHERE reason IS NOT NULL GROUP BY reason")

_TRUNC = "merchant = 'merchant_11'"
ORACLE_SQL["bronze_quarantine"] = _q(f"""
SELECT reason,
       CASE WHEN {_TRUNC} THEN NULL ELSE transaction_id END AS transaction_id,
       CASE WHEN {_TRUNC} THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN {_TRUNC} OR merchant = 'merchant_7' THEN NULL
            ELSE CAST(amount AS DOUBLE) END AS amount,
       CASE WHEN {_TRUNC} THEN NULL ELSE transaction_date END AS transaction_date,
       CASE WHEN {_TRUNC} THEN NULL ELSE merchant END AS merchant
FROM (SELECT *, {_REASON} AS reason FROM transactions) t
WHERE reason IS NOT NULL""")

ORACLE_SQL["bronze_stream_ingest"] = _q(
    "SELECT transaction_id, user_id, card, CAST(amount AS DOUBLE) AS amount, transaction_date, "
    "event_ts, merchant, merchant_category, currency, is_fraud_suspect FROM transactions "
    f"WHERE ({_REASON}) IS NULL")


# -- layout, joins, maintenance ------------------------------------------------------

ORACLE_SQL["partitioned_roundtrip"] = _q(
    f"SELECT {_GOLD_OUT} FROM gold WHERE transaction_date >= DATE '{DAY}'")

_JOIN = ("SELECT n_name, COUNT(*) AS customers, "
         "CAST(SUM(CAST(c_acctbal AS DECIMAL(15,2))) AS DOUBLE) AS total_acctbal "
         "FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
ORACLE_SQL["join_broadcast_dim"] = _JOIN
ORACLE_SQL["join_merge_dim"] = _JOIN

ORACLE_SQL["incremental_day"] = _q(_SILVER_OUT.format(src="silver"))
ORACLE_SQL["incremental_gold"] = _q(f"SELECT {_GOLD_OUT} FROM gold")

ORACLE_SQL["upsert_transactions"] = BASE + f""",
upd AS (
  SELECT transaction_id, user_id, card_masked, amount + 2 AS amount,
         CASE WHEN merchant = '{MOVED_MERCHANT}' THEN transaction_date - 1
              ELSE transaction_date END AS transaction_date,
         event_ts, merchant, merchant_category, currency, is_fraud_suspect
  FROM silver WHERE transaction_date >= DATE '{UPSERT_FROM}' AND transaction_id IS NOT NULL),
base AS (SELECT * FROM silver WHERE transaction_date < DATE '{BASE_BEFORE}'),
merged AS (
  SELECT * FROM base WHERE transaction_id IS NULL
     OR transaction_id NOT IN (SELECT transaction_id FROM upd)
  UNION ALL SELECT * FROM upd)
""" + _SILVER_OUT.format(src="merged")

ORACLE_SQL["erase_user"] = _q(
    _SILVER_OUT.format(src="silver") + " WHERE user_id NOT IN ("
    + ", ".join(str(u) for u in ERASE_USERS) + ")")

ORACLE_SQL["as_of_batch"] = _q(
    "SELECT transaction_id, user_id, card_masked, CAST(amount AS DOUBLE) AS amount, "
    "transaction_date, event_ts, merchant, merchant_category, currency, is_fraud_suspect, "
    "1 AS _batch_id FROM silver")
_CORRECTED = (f"transaction_date >= DATE '{CORRECTIONS_FROM}' AND transaction_id IS NOT NULL")
ORACLE_SQL["latest_as_of"] = _q(
    "SELECT transaction_id, user_id, card_masked, "
    f"CAST(CASE WHEN {_CORRECTED} THEN amount + 1 ELSE amount END AS DOUBLE) AS amount, "
    "transaction_date, event_ts, merchant, merchant_category, currency, is_fraud_suspect, "
    f"CASE WHEN {_CORRECTED} THEN 2 ELSE 1 END AS _batch_id FROM silver")

ORACLE_SQL["log_latest_as_of"] = ORACLE_SQL["latest_as_of"]
ORACLE_SQL["version_as_of_first"] = ORACLE_SQL["as_of_batch"]

ORACLE_SQL["published_gold"] = _q(f"SELECT {_GOLD_OUT} FROM gold")
ORACLE_SQL["cached_filter"] = ORACLE_SQL["category_day_count"]

ORACLE_SQL["incremental_batches"] = BASE + f""",
accepted AS (SELECT * FROM transactions WHERE ({_REASON}) IS NULL AND amount > 0)
SELECT user_id, transaction_date, COUNT(*) AS tx_count,
       CAST(SUM(amount) AS DOUBLE) AS daily_total, COUNT(*) > 12 AS is_high_risk
FROM accepted GROUP BY user_id, transaction_date"""
ORACLE_SQL["stream_file_drops"] = ORACLE_SQL["incremental_batches"]
ORACLE_SQL["full_then_incremental"] = BASE + f""",
accepted AS (SELECT * REPLACE (CASE WHEN transaction_date >= DATE '{DAY}' AND transaction_id IS NOT NULL
                                    THEN CAST(amount + 1 AS DECIMAL(12,2)) ELSE amount END AS amount)
             FROM transactions WHERE ({_REASON}) IS NULL AND amount > 0)
SELECT transaction_id, user_id, {_AFFIX} AS card_masked, CAST(amount AS DOUBLE) AS amount,
       transaction_date, event_ts, merchant, merchant_category, currency, is_fraud_suspect
FROM accepted"""

ORACLE_SQL["rebuild_keeps_increments"] = ORACLE_SQL["full_then_incremental"]

_ACCEPTED = BASE + f""",
accepted AS (SELECT * FROM transactions WHERE ({_REASON}) IS NULL AND amount > 0)
SELECT transaction_id, user_id, {_AFFIX} AS card_masked, CAST(amount AS DOUBLE) AS amount,
       transaction_date, event_ts, merchant, merchant_category, currency, is_fraud_suspect
FROM accepted"""
ORACLE_SQL["one_lake_any_order"] = _ACCEPTED
ORACLE_SQL["erase_then_rebuild"] = (
    _ACCEPTED + " WHERE user_id NOT IN (" + ", ".join(str(u) for u in ERASE_USERS) + ")")
ORACLE_SQL["batch_ledger"] = _q(
    "SELECT batch, CASE batch WHEN 'full' THEN 0 WHEN 'batch-1' THEN 1 ELSE 2 END AS seq, 'loaded' AS state, "
    f"COUNT(*) AS rows, COUNT(*) FILTER (WHERE ({_REASON}) IS NULL) AS accepted "
    "FROM (SELECT *, CASE WHEN day(transaction_date) <= 10 THEN 'full' WHEN day(transaction_date) <= 20 THEN 'batch-1' "
    "ELSE 'batch-2' END AS batch FROM transactions) GROUP BY batch")
ORACLE_SQL["phase2_layers"] = ORACLE_SQL["gold_daily_features"]
ORACLE_SQL["conformed_json"] = _q(
    "SELECT transaction_id, user_id, card, CAST(amount AS DOUBLE) AS amount, transaction_date, "
    "event_ts, merchant, merchant_category, currency, is_fraud_suspect FROM transactions")

_ODD = " ".join(f"WHEN merchant = '{m}' THEN CAST('{v}' AS DOUBLE)" for m, v in ODD_AMOUNTS.items())
ORACLE_SQL["quarantine_amounts"] = BASE + f""",
odd AS (SELECT merchant, CASE WHEN amount IS NULL THEN NULL {_ODD} ELSE CAST(amount AS DOUBLE) END AS a
        FROM transactions),
stored AS (SELECT merchant, a, TRY_CAST(a AS DECIMAL(12,2)) AS m FROM odd),
outcomes AS (SELECT merchant, m, CASE WHEN a IS NULL THEN 'null_amount' WHEN isnan(a) THEN NULL
                                      WHEN m IS NULL THEN 'amount_range'
                                      WHEN a > 0 AND m <= 0 THEN 'amount_rounds_to_zero'
                                      WHEN m > 0 THEN 'silver' END AS outcome FROM stored)
SELECT merchant, outcome, COUNT(*) AS row_count,
       CASE WHEN outcome = 'silver' THEN CAST(SUM(m) AS DOUBLE) ELSE 0.0::DOUBLE END AS total
FROM outcomes WHERE outcome IS NOT NULL GROUP BY merchant, outcome"""
ORACLE_SQL["join_fact_dim"] = (
    "SELECT s_nationkey, COUNT(*) AS lines, "
    "CAST(SUM(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS quantity, "
    "CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS revenue "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey")

# the SQL entry point runs the same six reports
for _name in ("top_user_days", "high_risk_list", "daily_volume_7d", "risk_global",
              "currency_mix", "layer_counts"):
    ORACLE_SQL[f"sql_{_name}"] = ORACLE_SQL[_name]


# Output normalisation, as on the Spark side (``catalog.oracle_types``): the
# only DATE column of any result, ``transaction_date``, leaves as a midnight
# TIMESTAMP.
DATE_OUTPUTS = (
    "silver_affix_mask", "silver_regex_mask", "silver_strict_mask", "gold_risk_profile",
    "gold_daily_features", "top_user_days", "top5_user_days", "high_risk_list",
    "daily_volume_7d", "generate_p2", "generate_p3", "generate_demo", "bronze_quarantine",
    "bronze_stream_ingest", "partitioned_roundtrip", "incremental_day", "incremental_gold",
    "upsert_transactions", "erase_user", "as_of_batch", "latest_as_of", "log_latest_as_of", "version_as_of_first", "published_gold",
    "incremental_batches", "full_then_incremental", "rebuild_keeps_increments", "one_lake_any_order", "erase_then_rebuild",
    "phase2_layers", "conformed_json", "stream_file_drops", "sql_top_user_days", "sql_high_risk_list",
    "sql_daily_volume_7d")
for _name in DATE_OUTPUTS:
    ORACLE_SQL[_name] = ("SELECT * REPLACE (CAST(transaction_date AS TIMESTAMP) AS transaction_date) "
                         f"FROM ({ORACLE_SQL[_name]}) AS result")
