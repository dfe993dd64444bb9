"""DuckDB oracle text for the keyed queries (correctness gate only).

Every oracle inlines the fixture views of `pitwise.sources.fixtures` as CTEs and
then states the query in plain SQL, independently of the Spark code path: window
features by self-joins, weekly stats by a generated calendar, the as-of join by a
lateral top-1.
"""

from __future__ import annotations

from pitwise.sources.fixtures import duckdb_with_clause


def sql(final: str, *ctes: str, views: list[str] | None = None) -> str:
    head = duckdb_with_clause(views)
    extra = "".join(",\n" + c.strip() for c in ctes)
    return f"{head}{extra}\n{final.strip()}"


def window_cte(name: str = "feat", src: str = "transactions", where: str = "", z_digits: int = 4,
               rate_digits: int = 4) -> str:
    """Window features by joins: each operation with its customer's older ones (by seconds, by position)."""
    return f"""
placed AS (
  SELECT *, CAST(amount AS DOUBLE) AS money, CAST(epoch(authorized_at) AS BIGINT) AS sec,
    row_number() OVER (PARTITION BY customer_id ORDER BY authorized_at, transaction_id) AS place
  FROM {src} {where}
),
recent AS (
  SELECT cur.transaction_id,
    count(*) FILTER (WHERE cur.sec - old.sec <= 3600) - 1 AS vel_1h,
    count(*) FILTER (WHERE cur.sec - old.sec <= 86400) - 1 AS vel_24h,
    count(*) - 1 AS vel_7d
  FROM placed cur JOIN placed old
    ON old.customer_id = cur.customer_id AND old.sec <= cur.sec AND old.sec >= cur.sec - 604800
  GROUP BY cur.transaction_id
),
history AS (
  SELECT cur.transaction_id, any_value(cur.sec) - max(old.sec) FILTER (WHERE old.place = cur.place - 1) AS secs_since_prev,
    round((any_value(cur.money) - avg(old.money)) / nullif(stddev_pop(old.money), 0), {z_digits}) AS amount_z,
    round(avg(CAST(CAST(old.auth_result = 'declined' AS INTEGER) AS DOUBLE)), {rate_digits}) AS decline_rate_20
  FROM placed cur JOIN placed old
    ON old.customer_id = cur.customer_id AND old.place < cur.place AND old.place >= cur.place - 20
  GROUP BY cur.transaction_id
),
{name} AS (
  SELECT placed.* EXCLUDE (money, sec, place), vel_1h, vel_24h, vel_7d, secs_since_prev, amount_z, decline_rate_20
  FROM placed JOIN recent USING (transaction_id) LEFT JOIN history USING (transaction_id)
)"""


# Snapshots by a generated calendar: a snapshot sees the operations of the 13 weeks before it, and the
# frauds among them that were reported before it.
WEEKLY_CTE = """
calendar AS (
  SELECT unnest(generate_series(date_trunc('week', min(authorized_at)) + INTERVAL 7 DAY,
                                date_trunc('week', max(authorized_at)) + INTERVAL 91 DAY, INTERVAL 7 DAY))::TIMESTAMP AS as_of_date
  FROM transactions
),
weekly AS (
  SELECT seen.merchant_id, calendar.as_of_date, count(*) AS n_tx,
    count(report.transaction_id) AS n_fraud_known,
    (count(report.transaction_id) + 2.0::DOUBLE) / (count(*) + 500.0::DOUBLE) AS fraud_rate_pit
  FROM calendar
  JOIN transactions seen ON seen.authorized_at < as_of_date AND seen.authorized_at >= as_of_date - INTERVAL 91 DAY
  LEFT JOIN fraud_labels report ON report.transaction_id = seen.transaction_id AND report.reported_at < as_of_date
  GROUP BY seen.merchant_id, calendar.as_of_date
)"""

BOUNDS_CTE = """
bounds AS (
  SELECT max(authorized_at) AS now_ts, max(authorized_at) - INTERVAL 90 DAY AS tx_cutoff FROM transactions
)"""

MATRIX_CTE = """
matrix AS (
  SELECT feat.transaction_id, customer_id, feat.authorized_at, amount, hour(feat.authorized_at)::INTEGER AS hour,
    channel, entry_mode, is_ecommerce::INTEGER AS is_ecommerce, is_recurring::INTEGER AS is_recurring,
    is_tokenized::INTEGER AS is_tokenized, country, coalesce((ip_country <> country)::INTEGER, 0) AS ip_mismatch,
    vel_1h, vel_24h, vel_7d, secs_since_prev, amount_z, decline_rate_20,
    (SELECT mcc FROM merchants WHERE merchants.merchant_id = feat.merchant_id) AS mcc,
    (SELECT risk_segment FROM merchants WHERE merchants.merchant_id = feat.merchant_id) AS risk_segment,
    latest.fraud_rate_pit AS merchant_fraud_rate_pit,
    EXISTS (SELECT 1 FROM fraud_labels report WHERE report.transaction_id = feat.transaction_id
            AND report.reported_at <= (SELECT now_ts FROM bounds))::INTEGER AS label
  FROM feat LEFT JOIN LATERAL (
    SELECT fraud_rate_pit FROM weekly
    WHERE weekly.merchant_id = feat.merchant_id AND weekly.as_of_date <= feat.authorized_at
    ORDER BY as_of_date DESC LIMIT 1) latest ON true
  WHERE feat.authorized_at <= (SELECT tx_cutoff FROM bounds)
)"""


def matrix_ctes() -> tuple[str, ...]:
    return (BOUNDS_CTE, window_cte(), WEEKLY_CTE, MATRIX_CTE)


# The merchant with the most frauds known in one snapshot, the smallest id of several.
WORST_MERCHANT_CTE = """
worst AS (
  SELECT min(merchant_id) AS merchant_id FROM weekly WHERE n_fraud_known = (SELECT max(n_fraud_known) FROM weekly)
)"""


def double_text(e: str) -> str:
    """All bits of a finite double as text: sign, 53-bit mantissa, p, binary exponent."""
    power = f"CAST(floor(log2(abs({e}))) AS INTEGER)"
    ratio = f"(abs({e}) / pow(2.0::DOUBLE, {power}))"
    power = f"({power} + CASE WHEN {ratio} >= 2 THEN 1 WHEN {ratio} < 1 THEN -1 ELSE 0 END)"
    return (f"CASE WHEN {e} = 0 THEN '0' WHEN {e} IS NOT NULL THEN CASE WHEN {e} < 0 THEN '-' ELSE '' END || "
            f"CAST(abs({e}) / pow(2.0::DOUBLE, {power}) * 4503599627370496.0 AS BIGINT) || 'p' || {power} END")


# Order-free fingerprint of the matrix.
FINGERPRINT_CTE = """
fingerprint AS (
  SELECT n_rows, sha256(concat_ws(':', CAST(n_rows AS VARCHAR), CAST(s0 AS VARCHAR), CAST(s1 AS VARCHAR),
                                  CAST(s2 AS VARCHAR), CAST(s3 AS VARCHAR))) AS sha256
  FROM (SELECT count(*) AS n_rows,
          CAST(coalesce(sum(('0x' || substr(h, 1, 8))::BIGINT), 0) AS HUGEINT) AS s0,
          CAST(coalesce(sum(('0x' || substr(h, 9, 8))::BIGINT), 0) AS HUGEINT) AS s1,
          CAST(coalesce(sum(('0x' || substr(h, 17, 8))::BIGINT), 0) AS HUGEINT) AS s2,
          CAST(coalesce(sum(('0x' || substr(h, 25, 8))::BIGINT), 0) AS HUGEINT) AS s3
        FROM (SELECT md5(concat_ws('|', """ + ", ".join(
    f"coalesce(length({e}) || ':' || {e}, '-')" for e in [
        "CAST(amount AS VARCHAR)", f"({double_text('amount_z')})", "strftime(authorized_at, '%Y-%m-%d %H:%M:%S.%f')",
        "channel", "country", "CAST(customer_id AS VARCHAR)", f"({double_text('decline_rate_20')})",
        "entry_mode", "CAST(hour AS VARCHAR)", "CAST(ip_mismatch AS VARCHAR)", "CAST(is_ecommerce AS VARCHAR)",
        "CAST(is_recurring AS VARCHAR)", "CAST(is_tokenized AS VARCHAR)", "CAST(label AS VARCHAR)", "mcc",
        f"({double_text('merchant_fraud_rate_pit')})", "risk_segment", "CAST(secs_since_prev AS VARCHAR)",
        "CAST(transaction_id AS VARCHAR)", "CAST(vel_1h AS VARCHAR)", "CAST(vel_24h AS VARCHAR)",
        "CAST(vel_7d AS VARCHAR)"]) + """)) AS h FROM matrix) r) s
)"""
