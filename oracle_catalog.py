"""Expected results as DuckDB SQL over the test tables: the oracle of the Spark queries.

`PARTS` are named building blocks. `statement` puts the ones a query mentions, directly or through
other parts, into a WITH list in definition order.
"""

from __future__ import annotations

import re

PARTS: dict[str, str] = {}

PARTS["line_rows"] = """
SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_orderpriority, p.p_type,
       l.l_orderkey * 8 + l.l_linenumber AS k
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
"""
PARTS["typed_rows"] = """
SELECT *, CASE WHEN l_returnflag = 'R' THEN 'refund'
               WHEN l_returnflag = 'N' AND l_suppkey % 10 = 0 THEN 'atm_withdrawal'
               WHEN l_returnflag = 'N' AND l_suppkey % 10 = 1 THEN 'fee' ELSE 'purchase' END AS txn_type,
       CAST(l_shipdate AS DATE) + CAST(CASE WHEN k % 167 = 0 THEN 3 + k % 18 ELSE k % 3 END AS INTEGER) AS posted_date
FROM line_rows
"""
PARTS["txn"] = """
SELECT 'TXN-' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || l_linenumber AS transaction_id,
       CASE WHEN k % 499 = 0 THEN 'CRD-ORPHAN' ELSE 'CRD-' || o_custkey END AS card_id,
       'ACC-' || o_custkey AS account_id,
       CASE WHEN txn_type IN ('atm_withdrawal', 'fee') OR (txn_type = 'purchase' AND k % 251 = 0) THEN NULL
            ELSE 'MER-' || l_partkey END AS merchant_id,
       l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS txn_timestamp,
       posted_date,
       CAST(round(l_extendedprice * 100) AS BIGINT)
         * CASE WHEN txn_type = 'refund' OR (txn_type = 'purchase' AND k % 997 = 0) THEN -1 ELSE 1 END
         * CASE WHEN k % 1999 = 0 THEN 100 ELSE 1 END AS amount_minor,
       CASE WHEN o_custkey % 100 < 70 THEN 'GBP' WHEN o_custkey % 100 < 82 THEN 'EUR'
            WHEN o_custkey % 100 < 92 THEN 'USD' WHEN o_custkey % 100 < 95 THEN 'SEK'
            WHEN o_custkey % 100 < 98 THEN 'AED' ELSE 'JPY' END AS currency,
       CAST(CASE WHEN k % 1249 = 0 THEN 99999 ELSE
            CASE p_type WHEN 'MEDIUM' THEN 5411 WHEN 'STANDARD' THEN 5812 WHEN 'LARGE' THEN 5732
                        WHEN 'PROMO' THEN 4816 WHEN 'SMALL' THEN 5912 WHEN 'ECONOMY' THEN 7011 END
            END AS INTEGER) AS mcc,
       CASE WHEN txn_type <> 'fee' THEN 'A' || lpad(CAST(k % 100000 AS VARCHAR), 5, '0') END AS auth_code,
       txn_type,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'chip_and_pin' WHEN '2-HIGH' THEN 'contactless'
            WHEN '3-MEDIUM' THEN 'ecommerce' WHEN '4-NOT SPECIFIED' THEN 'atm' WHEN '5-LOW' THEN 'mail_order'
            END AS channel,
       CASE o_orderstatus WHEN 'F' THEN 'settled'
            WHEN 'P' THEN CASE k % 4 WHEN 0 THEN 'declined' WHEN 1 THEN 'reversed' ELSE 'settled' END
            ELSE CASE WHEN l_linestatus = 'F' THEN 'settled' ELSE 'authorised' END END AS status,
       CASE WHEN posted_date >= DATE '1999-01-01' THEN
            CASE o_orderpriority WHEN '1-URGENT' THEN '05' WHEN '2-HIGH' THEN '07' WHEN '3-MEDIUM' THEN '81'
                 WHEN '4-NOT SPECIFIED' THEN '05' WHEN '5-LOW' THEN '01' END END AS pos_entry_mode,
       CASE WHEN posted_date >= DATE '1999-01-01'
            THEN k % 1249 <> 0 AND p_type = 'PROMO' AND k % 5 < 3 END AS is_recurring,
       CAST(CASE WHEN posted_date < DATE '1999-01-01' THEN 1 ELSE 2 END AS TINYINT) AS feed_version,
       k
FROM typed_rows
"""
PARTS["staged"] = """
SELECT *, CAST((txn_timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London' AS DATE) AS auth_date FROM txn
"""
PARTS["survivors"] = """
SELECT *, count(*) OVER (PARTITION BY transaction_id) > 1 AS was_duplicated
FROM staged
QUALIFY row_number() OVER (PARTITION BY transaction_id
    ORDER BY txn_timestamp DESC, feed_version DESC, amount_minor, merchant_id NULLS LAST, posted_date, mcc, txn_type) = 1
"""
PARTS["people_1"] = "SELECT * FROM customer WHERE c_custkey % 89 <> 1"
PARTS["people_2"] = "SELECT * FROM customer WHERE c_custkey % 97 <> 5"
PARTS["stg_people"] = """
SELECT 'CUS-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS customer_id,
       TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 300 AS INTEGER)) AS onboarded_at,
       DATE '1995-01-01' + CAST(c_custkey % 300 AS INTEGER) AS onboarded_on,
       CASE WHEN snap >= 2 AND c_custkey % 10 = 3 THEN 'premier' ELSE
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'affluent' WHEN 'AUTOMOBILE' THEN 'premier'
                           WHEN 'FURNITURE' THEN 'student' ELSE 'mass' END END AS segment,
       c_custkey % 2 = 0 AS marketing_consent,
       'Customer' AS first_name,
       lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS last_name,
       DATE '1960-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS date_of_birth,
       'customer' || c_custkey || '@example.com' AS email,
       CASE WHEN c_custkey % 4 <> 0 THEN '07' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS phone,
       c_custkey || ' High Street' AS address_line1,
       'City ' || c_nationkey AS city,
       CASE WHEN c_custkey % 111 = 3 THEN 'ab12cd' ELSE 'AB' || c_custkey % 10 || ' 2CD' END AS postcode,
       'GB' AS country,
       CASE WHEN c_custkey % 50 = 7 THEN 'pending' ELSE 'verified' END AS kyc_status,
       CASE WHEN c_custkey % 50 <> 7 AND c_custkey % 167 <> 9
            THEN TIMESTAMP '1995-01-02' + to_days(CAST(c_custkey % 300 AS INTEGER)) END AS kyc_verified_at,
       CASE WHEN c_custkey % 33 = 0 THEN 'high' ELSE 'low' END AS kyc_risk_band,
       snap
FROM (SELECT *, 1 AS snap FROM people_1 UNION ALL SELECT *, 2 FROM people_2
      UNION ALL SELECT *, 3 FROM customer)
"""
PARTS["people_now"] = """
SELECT * EXCLUDE (snap),
       '{"customer_id":"' || customer_id || '","created_at":"' || replace(CAST(onboarded_at AS VARCHAR), ' ', 'T')
       || 'Z","segment":"' || segment || '","marketing_consent":' || CAST(marketing_consent AS VARCHAR)
       || ',"profile":{"first_name":"' || first_name || '","last_name":"' || last_name
       || '","date_of_birth":"' || date_of_birth || '","email":"' || email || '","phone":'
       || coalesce('"' || phone || '"', 'null') || '},"address":{"line1":"' || address_line1 || '","city":"' || city
       || '","postcode":"' || postcode || '","country":"' || country || '"},"kyc":{"status":"' || kyc_status
       || '","verified_at":' || coalesce('"' || replace(CAST(kyc_verified_at AS VARCHAR), ' ', 'T') || 'Z"', 'null')
       || ',"risk_band":"' || kyc_risk_band || '"}}' AS document
FROM stg_people WHERE snap = 3
"""
PARTS["stg_acct"] = """
SELECT 'ACC-' || c_custkey AS account_id,
       'CUS-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS customer_id,
       CASE WHEN snap >= 2 AND c_custkey % 13 = 4 THEN 'PREMIER' WHEN c_custkey % 5 = 0 THEN 'SAVER'
            ELSE 'CURRENT' END AS product_code,
       CASE WHEN c_custkey % 23 = 9 THEN 'EUR' ELSE 'GBP' END AS currency,
       CASE WHEN snap = 3 AND c_custkey % 17 = 2 THEN 'closed' ELSE 'open' END AS status,
       DATE '1995-01-01' + CAST(c_custkey % 300 AS INTEGER) AS opened_on,
       CASE WHEN snap = 3 AND c_custkey % 17 = 2 THEN DATE '1995-01-01' + CAST(c_custkey % 300 AS INTEGER) + 1200
            WHEN c_custkey % 61 = 0 THEN DATE '1995-01-01' + CAST(c_custkey % 300 AS INTEGER) + 1000 END AS closed_on,
       c_custkey % 5 * 10000 AS overdraft_limit_minor,
       snap
FROM customer CROSS JOIN (VALUES (1), (2), (3)) AS s(snap)
WHERE snap <> 2 OR c_custkey % 101 <> 7
"""
PARTS["acct_now"] = "SELECT * EXCLUDE (snap) FROM stg_acct WHERE snap = 3"
PARTS["stg_card"] = """
SELECT 'CRD-' || c_custkey AS card_id, 'ACC-' || c_custkey AS account_id,
       CASE WHEN c_custkey % 7 = 0 THEN 'credit' ELSE 'debit' END AS card_type,
       CASE WHEN c_custkey % 2 = 0 THEN 'visa' ELSE 'mastercard' END AS network,
       DATE '1995-01-01' AS issued_on, DATE '2005-01-01' AS expires_on, 'active' AS status
FROM customer
"""
PARTS["stg_mer"] = """
SELECT 'MER-' || p_partkey AS merchant_id, p_name AS merchant_name,
       CAST(CASE p_type WHEN 'MEDIUM' THEN 5411 WHEN 'STANDARD' THEN 5812 WHEN 'LARGE' THEN 5732
            WHEN 'PROMO' THEN 4816 WHEN 'SMALL' THEN 5912 WHEN 'ECONOMY' THEN 7011 END AS INTEGER) AS mcc,
       CASE p_type WHEN 'MEDIUM' THEN 'groceries' WHEN 'STANDARD' THEN 'eating_out' WHEN 'LARGE' THEN 'electronics'
            WHEN 'PROMO' THEN 'digital_services' WHEN 'SMALL' THEN 'pharmacy' WHEN 'ECONOMY' THEN 'hotels'
            END AS category,
       CASE WHEN p_size % 8 = 0 THEN 'FR' ELSE 'GB' END AS country,
       p_partkey % 3 = 0 AS is_online, DATE '1994-01-01' AS first_seen_on
FROM part
"""
PARTS["rate_days"] = """
SELECT CAST(d AS DATE) AS rate_date, date_diff('day', lo, CAST(d AS DATE)) AS off
FROM (SELECT min(posted_date) AS lo, max(posted_date) AS hi FROM typed_rows),
     LATERAL (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d)
"""
PARTS["rates"] = """
SELECT rate_date, code AS currency,
       CASE WHEN code = 'GBP' THEN 1.0::DOUBLE
            ELSE ((base * (1000 + (off * 7) % 11 - 5) + 500) // 1000)::DOUBLE / 1e6::DOUBLE END AS rate_to_gbp,
       'treasury' AS source
FROM rate_days, (VALUES ('GBP', 1000000), ('EUR', 855000), ('USD', 790000), ('SEK', 73000), ('AED', 215000),
                        ('JPY', 5200)) AS c(code, base)
WHERE off = 0 OR off % 29 <> 0
"""
PARTS["dense_rates"] = """
SELECT g.rate_date, g.currency, r.rate_to_gbp IS NULL AS is_carried_forward,
       last_value(r.rate_to_gbp IGNORE NULLS) OVER (PARTITION BY g.currency ORDER BY g.rate_date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate_to_gbp
FROM (SELECT CAST(d AS DATE) AS rate_date, currency
      FROM (SELECT min(posted_date) AS lo, max(posted_date) AS hi FROM survivors),
           LATERAL (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d),
           (SELECT DISTINCT currency FROM rates)) g
LEFT JOIN rates r USING (rate_date, currency)
"""
PARTS["newest_rates"] = """
SELECT currency, arg_max(rate_to_gbp, rate_date) AS rate_to_gbp FROM dense_rates GROUP BY currency
"""
PARTS["typical"] = """
SELECT mcc, median(abs(amount_minor)) AS median_amount_minor FROM survivors
WHERE txn_type = 'purchase' AND mcc >= 1000 AND mcc <= 9999 GROUP BY mcc
"""
PARTS["flagged"] = """
SELECT s.*,
       s.txn_type = 'purchase' AND s.merchant_id IS NULL AS dq_missing_merchant,
       s.was_duplicated AS dq_duplicated,
       NOT EXISTS (SELECT 1 FROM stg_card c WHERE c.card_id = s.card_id) AS dq_orphan_card,
       s.txn_type = 'purchase' AND s.amount_minor < 0 AS dq_negative_purchase,
       s.mcc NOT BETWEEN 1000 AND 9999 AS dq_bad_mcc,
       (s.posted_date - s.auth_date) > 2 AS dq_late_posting,
       abs(s.amount_minor) > 40 * coalesce(t.median_amount_minor, 50000) AS dq_implausible_amount,
       CAST(s.posted_date - s.auth_date AS INTEGER) AS posting_lag_days
FROM survivors s LEFT JOIN typical t ON t.mcc = s.mcc
"""
PARTS["graded"] = """
SELECT *, CAST(greatest(0, 100 - (20 * (dq_missing_merchant::INT + dq_orphan_card::INT + dq_negative_purchase::INT
       + dq_implausible_amount::INT) + 5 * (dq_bad_mcc::INT + dq_late_posting::INT + dq_duplicated::INT)))
       AS INTEGER) AS dq_score
FROM flagged
"""
# A version begins where a key appears, returns or changes, and ends at the first snapshot that shows it otherwise.
PARTS["snap_times"] = """
SELECT * FROM (VALUES (1, TIMESTAMP '1995-06-01'), (2, TIMESTAMP '1998-07-01'), (3, TIMESTAMP '1998-12-01')) AS t(snap, taken_at)
"""
PARTS["people_history"] = """
SELECT p.* EXCLUDE (snap, starts, version, last_snap), s.taken_at AS valid_from, e.taken_at AS valid_to
FROM (SELECT *, max(snap) OVER (PARTITION BY customer_id, version) AS last_snap
      FROM (SELECT *, sum(starts) OVER (PARTITION BY customer_id ORDER BY snap) AS version
            FROM (SELECT *, CASE WHEN lag(snap) OVER w = snap - 1 AND lag(segment) OVER w = segment AND lag(kyc_status) OVER w = kyc_status AND lag(kyc_risk_band) OVER w = kyc_risk_band
                                 THEN 0 ELSE 1 END AS starts
                  FROM stg_people WINDOW w AS (PARTITION BY customer_id ORDER BY snap)))) p
JOIN snap_times s ON s.snap = p.snap
LEFT JOIN snap_times e ON e.snap = p.last_snap + 1
WHERE p.starts = 1
"""
PARTS["acct_history"] = """
SELECT p.* EXCLUDE (snap, starts, version, last_snap), s.taken_at AS valid_from, e.taken_at AS valid_to
FROM (SELECT *, max(snap) OVER (PARTITION BY account_id, version) AS last_snap
      FROM (SELECT *, sum(starts) OVER (PARTITION BY account_id ORDER BY snap) AS version
            FROM (SELECT *, CASE WHEN lag(snap) OVER w = snap - 1 AND lag(product_code) OVER w = product_code AND lag(status) OVER w = status
                                 THEN 0 ELSE 1 END AS starts
                  FROM stg_acct WINDOW w AS (PARTITION BY account_id ORDER BY snap)))) p
JOIN snap_times s ON s.snap = p.snap
LEFT JOIN snap_times e ON e.snap = p.last_snap + 1
WHERE p.starts = 1
"""
PARTS["d_customer"] = """
SELECT md5(customer_id || '|' || CAST(valid_from AS VARCHAR)) AS customer_key, customer_id, segment, kyc_status,
       kyc_risk_band, marketing_consent, onboarded_on, city, country, first_name, last_name, email,
       CASE WHEN n = 1 THEN least(onboarded_at, valid_from) ELSE valid_from END AS valid_from,
       coalesce(valid_to, TIMESTAMP '9999-12-31') AS valid_to, valid_to IS NULL AS is_current, n AS version_number
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS INTEGER) AS n
      FROM people_history)
UNION ALL
SELECT 'UNKNOWN', 'UNKNOWN', 'unknown', 'unknown', 'unknown', FALSE, DATE '1900-01-01', 'unknown', 'unknown',
       'unknown', 'unknown', 'unknown', TIMESTAMP '1900-01-01', TIMESTAMP '9999-12-31', TRUE, 1
"""
PARTS["d_account"] = """
SELECT md5(account_id || '|' || CAST(valid_from AS VARCHAR)) AS account_key, account_id, customer_id, product_code,
       currency, status, opened_on, closed_on, overdraft_limit_minor,
       status = 'open' AND closed_on IS NOT NULL AS dq_open_with_closed_date,
       CASE WHEN n = 1 THEN least(CAST(opened_on AS TIMESTAMP), valid_from) ELSE valid_from END AS valid_from,
       coalesce(valid_to, TIMESTAMP '9999-12-31') AS valid_to, valid_to IS NULL AS is_current, n AS version_number
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY account_id ORDER BY valid_from) AS INTEGER) AS n
      FROM acct_history)
UNION ALL
SELECT 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'unknown', 'unknown', 'unknown', DATE '1900-01-01', NULL, 0, FALSE,
       TIMESTAMP '1900-01-01', TIMESTAMP '9999-12-31', TRUE, 1
"""
PARTS["d_card"] = """
SELECT card_id AS card_key, * FROM stg_card
UNION ALL
SELECT 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'unknown', 'unknown', DATE '1900-01-01', DATE '9999-12-31', 'unknown'
"""
PARTS["d_merchant"] = """
SELECT merchant_id AS merchant_key, merchant_id AS vendor_merchant_id, CAST(NULL AS VARCHAR) AS acquirer_merchant_id,
       merchant_name, mcc, category, country, is_online, first_seen_on FROM stg_mer
UNION ALL
SELECT 'UNKNOWN', 'UNKNOWN', NULL, 'No merchant', 0, 'unknown', 'ZZ', FALSE, DATE '1900-01-01'
"""
PARTS["d_context"] = """
SELECT CAST(row_number() OVER (ORDER BY txn_type, channel, status) AS INTEGER) AS txn_context_key, *,
       status = 'settled' AS is_settled, channel IN ('ecommerce', 'mail_order') AS is_card_not_present,
       txn_type IN ('purchase', 'atm_withdrawal') AS counts_towards_spend
FROM (SELECT DISTINCT txn_type, channel, status FROM survivors)
"""
PARTS["d_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
       CAST(year(d) AS INTEGER) AS calendar_year, CAST(month(d) AS INTEGER) AS calendar_month,
       strftime(d, '%Y-%m') AS calendar_month_key, CAST(quarter(d) AS INTEGER) AS calendar_quarter,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_day_of_week,
       dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS iso_week, isodow(d) > 5 AS is_weekend,
       CAST(year(d - INTERVAL 3 MONTH - INTERVAL 5 DAY) AS INTEGER) AS uk_fiscal_year
FROM (SELECT CAST(unnest(generate_series(make_date(year(min(posted_date)), 1, 1),
                                         make_date(year(max(posted_date)) + 1, 1, 1), INTERVAL 1 DAY)) AS DATE) AS d
      FROM survivors)
"""
PARTS["f"] = """
SELECT g.transaction_id, CAST(strftime(g.posted_date, '%Y%m%d') AS INTEGER) AS posted_date_key,
       CAST(strftime(g.auth_date, '%Y%m%d') AS INTEGER) AS auth_date_key,
       g.posted_date, g.auth_date, g.txn_timestamp,
       coalesce(c.customer_key, 'UNKNOWN') AS customer_key, coalesce(a.account_key, 'UNKNOWN') AS account_key,
       coalesce(a.customer_id, 'UNKNOWN') AS customer_id,
       CASE WHEN g.dq_orphan_card THEN 'UNKNOWN' ELSE g.card_id END AS card_key,
       coalesce(g.merchant_id, 'UNKNOWN') AS merchant_key, x.txn_context_key, g.currency AS currency_key, g.mcc,
       g.amount_minor, CAST(round(g.amount_minor * r.rate_to_gbp) AS BIGINT) AS amount_gbp_minor,
       r.rate_to_gbp AS fx_rate_to_gbp, r.is_carried_forward AS fx_rate_carried_forward, g.posting_lag_days, g.dq_score,
       g.dq_missing_merchant, g.dq_duplicated, g.dq_orphan_card, g.dq_negative_purchase, g.dq_bad_mcc,
       g.dq_late_posting, g.dq_implausible_amount, g.feed_version
FROM graded g
LEFT JOIN dense_rates r ON r.currency = g.currency AND r.rate_date = g.posted_date
LEFT JOIN d_account a ON a.account_id = g.account_id AND a.valid_from <= g.txn_timestamp AND g.txn_timestamp < a.valid_to
LEFT JOIN d_customer c ON c.customer_id = a.customer_id AND c.valid_from <= g.txn_timestamp
                      AND g.txn_timestamp < c.valid_to
LEFT JOIN d_context x ON x.txn_type = g.txn_type AND x.channel = g.channel AND x.status = g.status
"""
# The fact with everything a report may group by.
PARTS["wide"] = """
SELECT f.*, x.txn_type, x.channel, x.status, x.is_settled, x.is_card_not_present, x.counts_towards_spend,
       x.is_settled AND x.counts_towards_spend AS is_spend,
       coalesce(m.category, 'unknown') AS category, m.merchant_name, strftime(f.posted_date, '%Y-%m') AS month_key
FROM f JOIN d_context x ON x.txn_context_key = f.txn_context_key LEFT JOIN d_merchant m ON m.merchant_key = f.merchant_key
"""
PARTS["now_customers"] = "SELECT * FROM d_customer WHERE is_current AND customer_id <> 'UNKNOWN'"
PARTS["monthly_agg"] = """
SELECT customer_id, month_key, category, count(*) AS txn_count,
       CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_gbp_minor,
       CAST(coalesce(sum(amount_gbp_minor) FILTER (counts_towards_spend), 0) AS BIGINT) AS net_spend_gbp_minor,
       CAST(coalesce(sum(amount_gbp_minor) FILTER (is_card_not_present), 0) AS BIGINT) AS online_spend_gbp_minor,
       avg(dq_score) AS avg_dq_score
FROM wide WHERE is_settled GROUP BY ALL
"""
PARTS["codes"] = """
SELECT * FROM (VALUES ('D01', 'completeness'), ('D02', 'uniqueness'), ('D03', 'consistency'), ('D04', 'validity'),
                      ('D05', 'validity'), ('D06', 'timeliness'), ('D07', 'accuracy')) AS v(defect_code, dimension)
"""
PARTS["rule_hits"] = """
SELECT f.*, c.defect_code, c.dimension,
       CASE c.defect_code WHEN 'D01' THEN dq_missing_merchant WHEN 'D02' THEN dq_duplicated
            WHEN 'D03' THEN dq_orphan_card WHEN 'D04' THEN dq_negative_purchase WHEN 'D05' THEN dq_bad_mcc
            WHEN 'D06' THEN dq_late_posting ELSE dq_implausible_amount END AS failed
FROM f, codes c
"""
PARTS["scorecard"] = """
SELECT posted_date, defect_code, dimension, count(*) AS rows_checked, count(*) FILTER (failed) AS rows_failed,
       1.0::DOUBLE - count(*) FILTER (failed) / count(*)::DOUBLE AS pass_rate
FROM rule_hits GROUP BY ALL
"""
PARTS["by_dimension"] = """
SELECT dimension, CAST(sum(rows_checked) AS BIGINT) AS rows_checked, CAST(sum(rows_failed) AS BIGINT) AS rows_failed,
       1.0::DOUBLE - sum(rows_failed)::DOUBLE / sum(rows_checked)::DOUBLE AS pass_rate
FROM scorecard GROUP BY dimension
"""
PARTS["planted"] = """
SELECT transaction_id, code AS defect_code FROM survivors,
     LATERAL (VALUES ('D01', txn_type = 'purchase' AND k % 251 = 0), ('D03', k % 499 = 0),
                     ('D04', txn_type = 'purchase' AND k % 997 = 0), ('D05', k % 1249 = 0), ('D06', k % 167 = 0),
                     ('D07', k % 1999 = 0)) AS v(code, hit)
WHERE hit
"""
PARTS["busy"] = """
SELECT customer_id, (SELECT max(posted_date) FROM f) - 365 AS from_date,
       strftime((SELECT max(posted_date) FROM f) - 365, '%Y-%m') AS from_month
FROM f WHERE customer_id <> 'UNKNOWN' GROUP BY customer_id ORDER BY count(*) DESC, customer_id LIMIT 1
"""
PARTS["per_segment"] = """
SELECT segment, count(DISTINCT w.customer_id) AS customers, count(*) AS n,
       CAST(sum(amount_gbp_minor) AS BIGINT) AS minor,
       CAST(sum(CASE WHEN is_card_not_present THEN amount_gbp_minor ELSE 0 END) AS BIGINT) AS online_minor
FROM wide w JOIN now_customers c ON c.customer_id = w.customer_id WHERE is_spend GROUP BY segment
"""
PARTS["fx_book"] = """
SELECT w.currency_key AS currency, count(*) AS txn_count, CAST(sum(amount_gbp_minor) AS BIGINT) AS booked_gbp_minor,
       sum(amount_minor)::DOUBLE * any_value(n.rate_to_gbp) AS revalued_gbp_minor
FROM wide w JOIN newest_rates n ON n.currency = w.currency_key
WHERE w.currency_key <> 'GBP' AND is_settled GROUP BY 1
"""
PARTS["hits"] = """
SELECT p.transaction_id, p.defect_code, r.failed AS found FROM planted p
LEFT JOIN rule_hits r ON r.transaction_id = p.transaction_id AND r.defect_code = p.defect_code
"""
PARTS["injected"] = """
SELECT transaction_id, code AS defect_code,
       (any_type OR txn_type = 'purchase')
       AND ('0x' || substr(md5(transaction_id || '|' || code || '|7'), 1, 8))::BIGINT % 1000000 < slots AS hit
FROM survivors, (VALUES ('D01', 4000, FALSE), ('D02', 1500, TRUE), ('D03', 2000, TRUE), ('D04', 1000, FALSE),
                        ('D05', 800, TRUE), ('D06', 6000, TRUE), ('D07', 500, TRUE)) AS v(code, slots, any_type)
"""
PARTS["day_counts"] = """
WITH d AS (SELECT posted_date, count(*) AS n FROM survivors GROUP BY 1),
     h AS (SELECT d.posted_date, count(*) AS days, sum(p.n)::DOUBLE AS s1, sum(p.n * p.n)::DOUBLE AS s2
           FROM d JOIN d p ON p.posted_date >= d.posted_date - 28 AND p.posted_date < d.posted_date GROUP BY 1),
     j AS (SELECT d.posted_date, n, coalesce(days, 0) AS days, s1 / days AS mean,
                  sqrt((days * s2 - s1 * s1) / nullif(days * (days - 1), 0)) AS sigma
           FROM d LEFT JOIN h USING (posted_date))
SELECT posted_date, n AS txn_count, days AS history_days, round(mean, 6) AS trailing_mean,
       round(sigma, 6) AS trailing_sigma, abs(n - mean) <= 3 * sigma AS within_limits FROM j
"""

QUERIES: dict[str, str] = {
    "stg_transactions": "SELECT * EXCLUDE (k) FROM staged",
    "stg_customers": "SELECT * FROM people_now",
    "stg_accounts": "SELECT * FROM acct_now",
    "stg_cards": "SELECT * FROM stg_card",
    "stg_merchants": "SELECT * FROM stg_mer",
    "stg_fx_rates": "SELECT * FROM rates",
    "dedupe_latest": "SELECT * EXCLUDE (k) FROM survivors",
    "fx_dense_asof": "SELECT rate_date, currency, rate_to_gbp, is_carried_forward FROM dense_rates",
    "fx_asof_join": """
        SELECT s.transaction_id, s.currency, s.posted_date, r.rate_to_gbp AS rate_at_posting
        FROM survivors s ASOF LEFT JOIN rates r ON r.currency = s.currency AND s.posted_date >= r.rate_date""",
    "mcc_median": "SELECT * FROM typical",
    "rules_flags": """
        SELECT transaction_id, dq_missing_merchant, dq_duplicated, dq_orphan_card, dq_negative_purchase, dq_bad_mcc,
               dq_late_posting, dq_implausible_amount FROM flagged""",
    "dq_score": "SELECT transaction_id, posting_lag_days, dq_score FROM graded",
    "dq_scorecard": "SELECT * FROM scorecard",
    "customer_feed_rules": """
        SELECT count(*) AS rows_checked,
               count(*) FILTER (NOT regexp_matches(postcode, '^[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}$')) AS "D08",
               count(*) FILTER (kyc_status = 'verified' AND kyc_verified_at IS NULL) AS "D09" FROM people_now""",
    "scd2_merge_customers": """
        SELECT customer_id, segment, kyc_status, kyc_risk_band, valid_from, valid_to FROM people_history""",
    "scd2_merge_accounts": """
        SELECT account_id, product_code, status, closed_on, valid_from, valid_to FROM acct_history""",
    "dim_customer": "SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to) FROM d_customer",
    "dim_account": "SELECT * REPLACE (CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to) FROM d_account",
    "dim_card": "SELECT * REPLACE (CAST(expires_on AS VARCHAR) AS expires_on) FROM d_card",
    "dim_merchant": "SELECT * FROM d_merchant",
    "dim_currency": """
        SELECT DISTINCT currency AS currency_key, currency AS currency_code, currency = 'GBP' AS is_reporting_currency
        FROM dense_rates""",
    "dim_date": "SELECT * FROM d_date",
    "dim_txn_context": "SELECT * FROM d_context",
    "customer_documents": "SELECT customer_id, document FROM people_now",
    "fact": "SELECT * FROM f",
    "agg_customer_category_month": "SELECT * FROM monthly_agg",
    "headline": """
        SELECT sum(amount_gbp_minor) / 100.0::DOUBLE AS spend_gbp, count(*) AS txn_count,
               count(DISTINCT customer_id) AS active_customers,
               sum(amount_gbp_minor)::DOUBLE / count(*) / 100.0::DOUBLE AS avg_basket_gbp, avg(dq_score) AS avg_dq_score,
               sum(amount_gbp_minor) FILTER (is_card_not_present)::DOUBLE / sum(amount_gbp_minor) AS online_share
        FROM wide WHERE is_spend""",
    "spend_by_month": """
        SELECT month_key, sum(amount_gbp_minor) / 100.0::DOUBLE AS spend_gbp, count(*) AS txn_count
        FROM wide WHERE is_spend GROUP BY month_key""",
    "spend_by_category": """
        SELECT category, sum(amount_gbp_minor) / 100.0::DOUBLE AS spend_gbp, count(*) AS txn_count,
               sum(amount_gbp_minor)::DOUBLE / count(*) / 100.0::DOUBLE AS avg_basket_gbp
        FROM wide WHERE is_spend GROUP BY category HAVING sum(amount_gbp_minor) > 0""",
    "category_top_n_other": """
        WITH c AS (SELECT category, sum(amount_gbp_minor) AS minor FROM wide WHERE is_spend GROUP BY 1 HAVING minor > 0),
             r AS (SELECT *, row_number() OVER (ORDER BY minor DESC, category) AS pos FROM c)
        SELECT CASE WHEN pos <= 4 THEN category ELSE 'Other' END AS category,
               round(sum(minor) / 100.0::DOUBLE, 2) AS spend_gbp FROM r GROUP BY 1""",
    "category_labels": """
        SELECT DISTINCT category, CASE category WHEN 'unknown' THEN 'ATM, fees and unmatched' ELSE
               upper(category[1]) || replace(category[2:], '_', ' ') END AS label FROM d_merchant""",
    "channel_mix_by_month": """
        SELECT month_key, coalesce(sum(amount_gbp_minor) FILTER (NOT is_card_not_present), 0) / 100.0::DOUBLE AS card_present_gbp,
               coalesce(sum(amount_gbp_minor) FILTER (is_card_not_present), 0) / 100.0::DOUBLE AS online_gbp
        FROM wide WHERE is_spend GROUP BY month_key""",
    "channel_online_share": """
        WITH m AS (SELECT month_key, coalesce(sum(amount_gbp_minor) FILTER (NOT is_card_not_present), 0) / 100.0::DOUBLE AS card_present_gbp,
               coalesce(sum(amount_gbp_minor) FILTER (is_card_not_present), 0) / 100.0::DOUBLE AS online_gbp
               FROM wide WHERE is_spend GROUP BY month_key)
        SELECT month_key, round(online_gbp / (card_present_gbp + online_gbp), 9) AS online_share FROM m""",
    "spend_by_segment": """
        SELECT segment, customers, minor / 100.0::DOUBLE AS spend_gbp, minor::DOUBLE / n / 100.0::DOUBLE AS avg_basket_gbp,
               minor::DOUBLE / customers / 100.0::DOUBLE AS spend_per_customer_gbp FROM per_segment""",
    "spend_by_segment_as_of": """
        SELECT segment, count(DISTINCT w.customer_id) AS customers, sum(amount_gbp_minor) / 100.0::DOUBLE AS spend_gbp,
               sum(amount_gbp_minor)::DOUBLE / count(*) / 100.0::DOUBLE AS avg_basket_gbp,
               sum(amount_gbp_minor)::DOUBLE / count(DISTINCT w.customer_id) / 100.0::DOUBLE AS spend_per_customer_gbp
        FROM wide w JOIN d_customer c ON c.customer_key = w.customer_key AND c.customer_key <> 'UNKNOWN'
        WHERE is_spend GROUP BY segment""",
    "dq_by_dimension": "SELECT * FROM by_dimension",
    "dq_by_defect": """
        SELECT defect_code, dimension, CAST(sum(rows_checked) AS BIGINT) AS rows_checked,
               CAST(sum(rows_failed) AS BIGINT) AS rows_failed,
               1.0::DOUBLE - sum(rows_failed)::DOUBLE / sum(rows_checked)::DOUBLE AS pass_rate
        FROM scorecard GROUP BY 1, 2""",
    "dq_status": """
        SELECT dimension, pass_rate, CASE WHEN pass_rate >= 0.99 THEN 'good' WHEN pass_rate >= 0.98 THEN 'warning'
               ELSE 'critical' END AS status FROM by_dimension""",
    "fx_exposure": """
        SELECT currency, txn_count, round(booked_gbp_minor / 100.0::DOUBLE, 2) AS booked_gbp,
               round(revalued_gbp_minor / 100.0::DOUBLE, 2) AS revalued_gbp,
               round((revalued_gbp_minor - booked_gbp_minor) / 100.0::DOUBLE, 2) AS unrealised_gbp FROM fx_book""",
    "posting_lag": """
        SELECT month_key, sum(posting_lag_days)::DOUBLE / count(*) AS avg_lag_days,
               quantile_cont(posting_lag_days, 0.95)::DOUBLE AS p95_lag_days,
               count(*) FILTER (posting_lag_days > 2) AS breaches, count(*) AS txn_count FROM wide GROUP BY month_key""",
    "posting_lag_breach_rate": """
        SELECT month_key, count(*) FILTER (posting_lag_days > 2)::DOUBLE / count(*) AS breach_rate
        FROM wide GROUP BY month_key""",
    "posting_lag_nearest_rank": """
        WITH r AS (SELECT month_key, posting_lag_days,
                          row_number() OVER (PARTITION BY month_key ORDER BY posting_lag_days) - 1 AS pos,
                          count(*) OVER (PARTITION BY month_key) AS n FROM wide)
        SELECT month_key, max(posting_lag_days)::DOUBLE AS p95_lag_days FROM r
        WHERE pos = CAST(round_even(0.95 * (n - 1), 0) AS BIGINT) GROUP BY month_key""",
    "run_metadata": """
        SELECT (SELECT count(DISTINCT posted_date) FROM f) AS daily_partitions, count(*) AS txn_count,
               avg(dq_score) AS avg_dq_score FROM wide WHERE is_spend""",
    "month_ranges": """
        SELECT DISTINCT 'fct_' || strftime(posted_date, '%Y_%m') AS name,
               make_date(year(posted_date), month(posted_date), 1) AS month_start,
               CAST(make_date(year(posted_date), month(posted_date), 1) + INTERVAL 1 MONTH AS DATE) AS month_end FROM f""",
    "customer_document": "SELECT customer_id, document FROM people_now WHERE customer_id = (SELECT customer_id FROM busy)",
    "customer_profile": """
        SELECT c.customer_id, c.segment, c.kyc_status, c.kyc_risk_band, c.onboarded_on, c.first_name, c.last_name,
               c.email, c.city, CAST(NULL AS VARCHAR) AS postcode,
               (SELECT count(*) FROM d_account a WHERE a.is_current AND a.customer_id = c.customer_id) AS account_count,
               (SELECT count(*) FROM d_card k JOIN d_account a ON a.account_id = k.account_id
                WHERE a.is_current AND a.customer_id = c.customer_id) AS card_count
        FROM now_customers c WHERE c.customer_id = (SELECT customer_id FROM busy)""",
    "customer_12m_from_fact": """
        SELECT month_key, category, count(*) AS txn_count, CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_minor
        FROM wide JOIN busy USING (customer_id) WHERE is_settled AND posted_date >= from_date GROUP BY 1, 2""",
    "customer_12m_clustered": """
        SELECT month_key, category, count(*) AS txn_count, CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_minor
        FROM wide JOIN busy USING (customer_id) WHERE is_settled AND posted_date >= from_date GROUP BY 1, 2""",
    "customer_12m_from_agg": """
        SELECT month_key, category, txn_count, net_spend_gbp_minor AS spend_minor
        FROM monthly_agg JOIN busy USING (customer_id) WHERE month_key >= from_month""",
    "aggregate_against_fact": """
        SELECT month_key, category, CAST(sum(amount_gbp_minor) AS BIGINT) AS fact_minor,
               CAST(sum(amount_gbp_minor) AS BIGINT) AS aggregate_minor, TRUE AS agrees
        FROM wide JOIN busy USING (customer_id) WHERE is_settled AND month_key >= from_month GROUP BY 1, 2""",
    "category_month_all": """
        SELECT month_key, category, count(*) AS txn_count, CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_minor
        FROM wide WHERE is_settled GROUP BY 1, 2""",
    "category_month_from_agg": """
        SELECT month_key, category, count(*) AS txn_count, CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_minor
        FROM wide WHERE is_settled GROUP BY 1, 2""",
    "top_merchants_per_segment": """
        SELECT segment, merchant_name, CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_minor, count(*) AS txn_count,
               CAST(row_number() OVER (PARTITION BY segment ORDER BY sum(amount_gbp_minor) DESC, merchant_name) AS INTEGER) AS rank
        FROM wide w JOIN now_customers c ON c.customer_id = w.customer_id
        WHERE is_spend AND merchant_key <> 'UNKNOWN' GROUP BY segment, merchant_name QUALIFY rank <= 20""",
    "fx_revaluation_asof": """
        WITH d AS (SELECT currency_key AS currency, posted_date, count(*) AS n, sum(amount_minor)::DOUBLE AS amount
                   FROM wide WHERE is_settled AND currency_key <> 'GBP' GROUP BY 1, 2)
        SELECT d.currency, CAST(sum(n) AS BIGINT) AS txn_count, round(sum(amount * r.rate_to_gbp), 2) AS booked_gbp_minor,
               round(sum(amount * l.rate_to_gbp), 2) AS revalued_gbp_minor,
               round(sum(amount * (l.rate_to_gbp - r.rate_to_gbp)), 2) AS unrealised_gbp_minor
        FROM d JOIN newest_rates l USING (currency)
        JOIN dense_rates r ON r.currency = d.currency AND r.rate_date = d.posted_date GROUP BY 1""",
    "fx_revaluation_stored": """
        SELECT currency, txn_count, booked_gbp_minor, round(revalued_gbp_minor, 2) AS revalued_gbp_minor,
               round(revalued_gbp_minor - booked_gbp_minor, 2) AS unrealised_gbp_minor FROM fx_book""",
    "busiest_customer": """
        SELECT b.*, (SELECT max(posted_date) FROM f) AS max_date, (SELECT count(*) FROM f) AS transactions,
               (SELECT count(*) FROM d_customer WHERE is_current) AS customers FROM busy b""",
    "full_scan": "SELECT count(*) AS txn_count, CAST(sum(amount_minor) AS BIGINT) AS amount_minor FROM f",
    "partition_month_scan": """
        SELECT count(*) AS txn_count, CAST(sum(amount_minor) AS BIGINT) AS amount_minor FROM f
        WHERE strftime(posted_date, '%Y-%m') = (SELECT strftime(max(posted_date), '%Y-%m') FROM f)""",
    "partition_months_opened": """
        SELECT 'full' AS scan, count(DISTINCT strftime(posted_date, '%Y-%m')) AS months FROM f
        UNION ALL SELECT 'newest month', 1""",
    "detection_recall_precision": """
        WITH t AS (SELECT defect_code, count(*) AS injected, count(*) FILTER (found) AS true_positives FROM hits GROUP BY 1),
             g AS (SELECT defect_code, count(*) FILTER (failed) AS flagged FROM rule_hits GROUP BY 1)
        SELECT defect_code, coalesce(injected, 0) AS injected, flagged, coalesce(true_positives, 0) AS true_positives,
               coalesce(true_positives::DOUBLE / nullif(injected, 0), 0) AS recall,
               coalesce(true_positives::DOUBLE / nullif(flagged, 0), 0) AS precision
        FROM g LEFT JOIN t USING (defect_code)""",
    "detection_flat_threshold": """
        WITH t AS (SELECT transaction_id FROM planted WHERE defect_code = 'D07'),
             r AS (SELECT (abs(amount_minor) > 5000000) AS flat, dq_implausible_amount AS relative,
                          transaction_id IN (SELECT transaction_id FROM t) AS truth FROM f),
             u AS (SELECT 'flat' AS rule, flat AS hit, truth FROM r UNION ALL SELECT 'relative', relative, truth FROM r)
        SELECT rule AS defect_code, count(*) FILTER (truth) AS injected, count(*) FILTER (hit) AS flagged,
               count(*) FILTER (hit AND truth) AS true_positives,
               count(*) FILTER (hit AND truth)::DOUBLE / count(*) FILTER (truth) AS recall,
               count(*) FILTER (hit AND truth)::DOUBLE / count(*) FILTER (hit) AS precision FROM u GROUP BY rule""",
    "undetected_value": """
        SELECT (SELECT count(*) FROM planted WHERE defect_code = 'D07') AS injected,
               count(*) FILTER (NOT dq_implausible_amount) AS missed_rows,
               coalesce(sum(amount_gbp_minor) FILTER (NOT dq_implausible_amount), 0) / 100.0::DOUBLE AS missed_value_gbp
        FROM f WHERE transaction_id IN (SELECT transaction_id FROM planted WHERE defect_code = 'D07')""",
    "inject_defects": "SELECT transaction_id, defect_code FROM injected WHERE hit",
    "inject_defects_feed": """
        WITH h AS (SELECT transaction_id, list(defect_code) FILTER (hit) AS codes FROM injected GROUP BY 1),
             d AS (SELECT s.txn_type, coalesce(list_contains(codes, 'D02'), FALSE) AS twice,
                          CASE WHEN list_contains(codes, 'D01') THEN NULL ELSE merchant_id END AS merchant_id,
                          CASE WHEN list_contains(codes, 'D04') THEN -abs(amount_minor) ELSE amount_minor END
                            * CASE WHEN list_contains(codes, 'D07') THEN 100 ELSE 1 END AS amount_minor,
                          CASE WHEN list_contains(codes, 'D05') THEN 99999 ELSE mcc END AS mcc
                   FROM survivors s LEFT JOIN h USING (transaction_id)),
             e AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE twice)
        SELECT txn_type, count(*) AS n, count(merchant_id) AS with_merchant,
               CAST(sum(amount_minor) AS BIGINT) AS amount_minor, count(*) FILTER (mcc = 99999) AS bad_mcc
        FROM e GROUP BY 1""",
    "scorecard_against_ledger": """
        WITH s AS (SELECT defect_code, CAST(sum(rows_failed) AS BIGINT) AS failed FROM scorecard GROUP BY 1),
             p AS (SELECT defect_code, count(*) AS planted FROM planted GROUP BY 1)
        SELECT defect_code, failed AS left_total, planted AS right_total, failed - coalesce(planted, 0) AS difference,
               failed IS NOT DISTINCT FROM planted AS agrees FROM s LEFT JOIN p USING (defect_code)""",
    "reconcile_lake_fact": """
        SELECT (SELECT count(DISTINCT transaction_id) FROM txn) AS lake_rows, (SELECT count(*) FROM f) AS fact_rows,
               0::BIGINT AS violations""",
    "aggregate_agrees": """
        SELECT (SELECT CAST(sum(spend_gbp_minor) AS BIGINT) FROM monthly_agg) AS aggregate_minor,
               (SELECT CAST(sum(amount_gbp_minor) AS BIGINT) FROM wide WHERE is_settled) AS fact_minor, 0::BIGINT AS violations""",
    "scd2_overlaps": """
        SELECT 'scd2 overlaps' AS "check", count(*) AS violations FROM (SELECT DISTINCT a.customer_id FROM d_customer a
        JOIN d_customer b ON a.customer_id = b.customer_id AND a.version_number < b.version_number AND b.valid_from < a.valid_to)""",
    "fact_checks": """
        SELECT 'fact without fx rate' AS "check", count(*) FILTER (fx_rate_to_gbp IS NULL) AS violations FROM f
        UNION ALL SELECT 'gbp not identical', count(*) FILTER (currency_key = 'GBP' AND amount_minor <> amount_gbp_minor) FROM f
        UNION ALL SELECT 'score out of range', count(*) FILTER (dq_score NOT BETWEEN 0 AND 100) FROM f
        UNION ALL SELECT 'null customer_key', count(*) - count(customer_key) FROM f
        UNION ALL SELECT 'null account_key', count(*) - count(account_key) FROM f
        UNION ALL SELECT 'null card_key', count(*) - count(card_key) FROM f
        UNION ALL SELECT 'null merchant_key', count(*) - count(merchant_key) FROM f
        UNION ALL SELECT 'null txn_context_key', count(*) - count(txn_context_key) FROM f
        UNION ALL SELECT 'null posted_date_key', count(*) - count(posted_date_key) FROM f""",
    "null_key_counts": """
        SELECT count(*) - count(customer_key) AS null_customer_key, count(*) - count(account_key) AS null_account_key,
               count(*) - count(card_key) AS null_card_key, count(*) - count(merchant_key) AS null_merchant_key,
               count(*) FILTER (customer_key = 'UNKNOWN') AS unknown_customer_key,
               count(*) FILTER (account_key = 'UNKNOWN') AS unknown_account_key,
               count(*) FILTER (card_key = 'UNKNOWN') AS unknown_card_key,
               count(*) FILTER (merchant_key = 'UNKNOWN') AS unknown_merchant_key FROM f""",
    "relationships_violations": """
        SELECT 'fact.customer_key' AS "check", count(*) AS violations FROM f WHERE customer_key NOT IN (SELECT customer_key FROM d_customer)
        UNION ALL SELECT 'fact.account_key', count(*) FROM f WHERE account_key NOT IN (SELECT account_key FROM d_account)
        UNION ALL SELECT 'fact.merchant_key', count(*) FROM f WHERE merchant_key NOT IN (SELECT merchant_key FROM d_merchant)
        UNION ALL SELECT 'fact.card_key', count(*) FROM f WHERE card_key NOT IN (SELECT card_key FROM d_card)
        UNION ALL SELECT 'fact.txn_context_key', count(*) FROM f WHERE txn_context_key NOT IN (SELECT txn_context_key FROM d_context)
        UNION ALL SELECT 'fact.posted_date_key', count(*) FROM f WHERE posted_date_key NOT IN (SELECT date_key FROM d_date)
        UNION ALL SELECT 'accounts.customer_id', count(*) FROM acct_now WHERE customer_id NOT IN (SELECT customer_id FROM people_now)
        UNION ALL SELECT 'cards.account_id', count(*) FROM stg_card WHERE account_id NOT IN (SELECT account_id FROM acct_now)""",
    "unique_violations": """
        SELECT 'deduped.transaction_id unique' AS "check", count(transaction_id) - count(DISTINCT transaction_id) AS violations FROM survivors
        UNION ALL SELECT 'fact.transaction_id unique' AS "check", count(transaction_id) - count(DISTINCT transaction_id) AS violations FROM f
        UNION ALL SELECT 'customers.customer_id unique' AS "check", count(customer_id) - count(DISTINCT customer_id) AS violations FROM people_now
        UNION ALL SELECT 'accounts.account_id unique' AS "check", count(account_id) - count(DISTINCT account_id) AS violations FROM acct_now
        UNION ALL SELECT 'cards.card_id unique' AS "check", count(card_id) - count(DISTINCT card_id) AS violations FROM stg_card
        UNION ALL SELECT 'merchants.merchant_id unique' AS "check", count(merchant_id) - count(DISTINCT merchant_id) AS violations FROM stg_mer
        UNION ALL SELECT 'dim_customer.customer_key unique' AS "check", count(customer_key) - count(DISTINCT customer_key) AS violations FROM d_customer
        UNION ALL SELECT 'dim_account.account_key unique' AS "check", count(account_key) - count(DISTINCT account_key) AS violations FROM d_account
        UNION ALL SELECT 'dim_date.date_key unique' AS "check", count(date_key) - count(DISTINCT date_key) AS violations FROM d_date
        UNION ALL SELECT 'dim_txn_context.txn_context_key unique' AS "check", count(txn_context_key) - count(DISTINCT txn_context_key) AS violations FROM d_context
        UNION ALL SELECT 'dim_merchant.merchant_key unique' AS "check", count(merchant_key) - count(DISTINCT merchant_key) AS violations FROM d_merchant
        UNION ALL SELECT 'dim_card.card_key unique' AS "check", count(card_key) - count(DISTINCT card_key) AS violations FROM d_card""",
    "not_null_violations": """
        SELECT 'transactions.transaction_id not null' AS "check", count(*) - count(transaction_id) AS violations FROM staged
        UNION ALL SELECT 'transactions.currency not null' AS "check", count(*) - count(currency) AS violations FROM staged
        UNION ALL SELECT 'customers.customer_id not null' AS "check", count(*) - count(customer_id) AS violations FROM people_now
        UNION ALL SELECT 'accounts.account_id not null' AS "check", count(*) - count(account_id) AS violations FROM acct_now
        UNION ALL SELECT 'cards.card_id not null' AS "check", count(*) - count(card_id) AS violations FROM stg_card
        UNION ALL SELECT 'merchants.merchant_id not null' AS "check", count(*) - count(merchant_id) AS violations FROM stg_mer
        UNION ALL SELECT 'fx_rates.rate_to_gbp not null' AS "check", count(*) - count(rate_to_gbp) AS violations FROM rates
        UNION ALL SELECT 'fx_daily.rate_to_gbp not null' AS "check", count(*) - count(rate_to_gbp) AS violations FROM dense_rates
        UNION ALL SELECT 'deduped.transaction_id not null' AS "check", count(*) - count(transaction_id) AS violations FROM survivors
        UNION ALL SELECT 'fact.transaction_id not null' AS "check", count(*) - count(transaction_id) AS violations FROM f
        UNION ALL SELECT 'fact.amount_gbp_minor not null' AS "check", count(*) - count(amount_gbp_minor) AS violations FROM f
        UNION ALL SELECT 'fact.txn_context_key not null' AS "check", count(*) - count(txn_context_key) AS violations FROM f
        UNION ALL SELECT 'fact.fx_rate_to_gbp not null' AS "check", count(*) - count(fx_rate_to_gbp) AS violations FROM f
        UNION ALL SELECT 'fact.dq_score not null' AS "check", count(*) - count(dq_score) AS violations FROM f
        UNION ALL SELECT 'dim_customer.customer_key not null' AS "check", count(*) - count(customer_key) AS violations FROM d_customer
        UNION ALL SELECT 'dim_customer.customer_id not null' AS "check", count(*) - count(customer_id) AS violations FROM d_customer
        UNION ALL SELECT 'dim_account.account_key not null' AS "check", count(*) - count(account_key) AS violations FROM d_account
        UNION ALL SELECT 'dim_account.customer_id not null' AS "check", count(*) - count(customer_id) AS violations FROM d_account
        UNION ALL SELECT 'dim_date.date_key not null' AS "check", count(*) - count(date_key) AS violations FROM d_date
        UNION ALL SELECT 'dim_date.calendar_date not null' AS "check", count(*) - count(calendar_date) AS violations FROM d_date
        UNION ALL SELECT 'dim_txn_context.txn_context_key not null' AS "check", count(*) - count(txn_context_key) AS violations FROM d_context
        UNION ALL SELECT 'dim_merchant.merchant_key not null' AS "check", count(*) - count(merchant_key) AS violations FROM d_merchant
        UNION ALL SELECT 'dim_card.card_key not null' AS "check", count(*) - count(card_key) AS violations FROM d_card
        UNION ALL SELECT 'agg_customer_category_month.spend_gbp_minor not null' AS "check", count(*) - count(spend_gbp_minor) AS violations FROM monthly_agg
        UNION ALL SELECT 'agg_dq_scorecard.pass_rate not null' AS "check", count(*) - count(pass_rate) AS violations FROM scorecard""",
    "accepted_values_violations": """
        SELECT 'transactions.feed_version accepted values' AS "check", count(*) FILTER (feed_version NOT IN (1, 2)) AS violations FROM txn
        UNION ALL SELECT 'dim_customer.segment accepted values',
               count(*) FILTER (segment NOT IN ('mass', 'student', 'affluent', 'premier', 'unknown')) FROM d_customer
        UNION ALL SELECT 'dim_customer.kyc_status accepted values',
               count(*) FILTER (kyc_status NOT IN ('verified', 'pending', 'referred', 'rejected', 'unknown')) FROM d_customer""",
    "feed_unique_violations": """
        SELECT 'transactions.transaction_id unique' AS "check", count(*) AS violations
        FROM (SELECT transaction_id FROM txn GROUP BY 1 HAVING count(*) > 1)""",
    "ledger_reconciliation": """
        WITH s AS (SELECT posted_date, sum(amount_minor) AS booked,
                          sum(CASE WHEN k % 1999 = 0 THEN amount_minor // 100 ELSE amount_minor END) AS ledger
                   FROM survivors WHERE status = 'settled' GROUP BY 1)
        SELECT posted_date, CAST(booked AS BIGINT) AS left_total, CAST(ledger AS BIGINT) AS right_total,
               CAST(booked - ledger AS BIGINT) AS difference, booked = ledger AS agrees FROM s""",
    "value_at_risk": """
        SELECT defect_code, count(*) FILTER (failed) AS rows_failed,
               CAST(coalesce(sum(abs(amount_gbp_minor)) FILTER (failed), 0) AS BIGINT) AS value_at_risk_minor
        FROM rule_hits GROUP BY 1""",
    "freshness_3sigma": "SELECT * FROM day_counts",
    "fresh_yesterday": """
        SELECT posted_date AS due_date, TRUE AS arrived, coalesce(within_limits, FALSE) AS fresh
        FROM day_counts WHERE posted_date = (SELECT max(posted_date) FROM survivors)""",
    "fx_coverage": """
        SELECT count(*) AS pairs_in_use, count(*) FILTER (rate_to_gbp IS NULL) AS pairs_without_rate
        FROM (SELECT DISTINCT posted_date AS rate_date, currency FROM survivors) LEFT JOIN dense_rates USING (rate_date, currency)""",
    "carried_forward_days": """
        WITH d AS (SELECT currency, count(*) FILTER (is_carried_forward) AS carried_days FROM dense_rates GROUP BY 1),
             t AS (SELECT currency_key AS currency, count(*) FILTER (fx_rate_carried_forward) AS carried_txns FROM f GROUP BY 1)
        SELECT * FROM d LEFT JOIN t USING (currency)""",
    "document_count": """
        SELECT (SELECT count(*) FROM people_now) AS documents, (SELECT count(*) FROM now_customers) AS current_customers,
               TRUE AS within_tolerance""",
    "quality_objectives": """
        SELECT d.dimension, v.objective::DOUBLE AS objective, pass_rate,
               CASE WHEN pass_rate >= v.objective THEN 'meets' ELSE 'below' END AS status
        FROM by_dimension d JOIN (VALUES ('completeness', 0.995::DOUBLE), ('consistency', 0.995), ('uniqueness', 0.999),
             ('validity', 0.999), ('accuracy', 0.999), ('timeliness', 0.99)) AS v(dimension, objective) USING (dimension)""",
    "feed_arrival": """
        WITH c AS (SELECT 'customers' AS feed, count(*) FILTER (snap = 3) AS row_count, count(*) FILTER (snap = 2) AS previous_count
                   FROM stg_people UNION ALL
                   SELECT 'accounts', count(*) FILTER (snap = 3), count(*) FILTER (snap = 2) FROM stg_acct)
        SELECT feed, row_count, previous_count, row_count - previous_count AS change, row_count > 0 AS arrived FROM c""",
    "publish_gate": "SELECT 12::BIGINT AS checks_run, 0::BIGINT AS violations, TRUE AS publishable",
    "active_customers_30d": """
        SELECT count(DISTINCT customer_id) AS active_customers FROM wide
        WHERE is_settled AND txn_type = 'purchase' AND posted_date > (SELECT max(posted_date) - 30 FROM f)""",
    "spend_net_gross": """
        SELECT month_key, CAST(coalesce(sum(amount_gbp_minor) FILTER (counts_towards_spend), 0) AS BIGINT) AS gross_spend_minor,
               CAST(coalesce(sum(amount_gbp_minor) FILTER (txn_type = 'refund'), 0) AS BIGINT) AS refund_minor,
               count(*) AS txn_count,
               CAST(coalesce(sum(amount_gbp_minor) FILTER (counts_towards_spend OR txn_type = 'refund'), 0) AS BIGINT) AS net_spend_minor
        FROM wide WHERE is_settled GROUP BY 1""",
    "approval_rate": """
        SELECT month_key, count(*) AS attempts, count(*) FILTER (status = 'declined') AS declined,
               1.0::DOUBLE - count(*) FILTER (status = 'declined')::DOUBLE / count(*) AS approval_rate FROM wide GROUP BY 1""",
    "average_basket": """
        SELECT count(*) AS purchases, sum(amount_gbp_minor)::DOUBLE / count(*) / 100.0::DOUBLE AS avg_basket_gbp
        FROM wide WHERE is_settled AND txn_type = 'purchase'""",
    "category_mix": """
        SELECT month_key, category, CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_minor,
               sum(amount_gbp_minor)::DOUBLE / nullif(sum(sum(amount_gbp_minor)) OVER (PARTITION BY month_key), 0)::DOUBLE AS share
        FROM wide WHERE is_spend GROUP BY 1, 2""",
    "spend_by_channel": """
        SELECT channel, is_card_not_present, CAST(sum(amount_gbp_minor) AS BIGINT) AS spend_minor, count(*) AS txn_count
        FROM wide WHERE is_spend GROUP BY 1, 2""",
    "onboarded_customers": "SELECT count(*) AS onboarded_customers FROM now_customers WHERE kyc_status = 'verified'",
    "date_basis_comparison": """
        WITH p AS (SELECT month_key, sum(amount_gbp_minor) AS posted FROM wide WHERE is_spend GROUP BY 1),
             a AS (SELECT strftime(auth_date, '%Y-%m') AS month_key, sum(amount_gbp_minor) AS auth FROM wide WHERE is_spend GROUP BY 1)
        SELECT month_key, CAST(coalesce(posted, 0) AS BIGINT) AS posted_basis_minor,
               CAST(coalesce(auth, 0) AS BIGINT) AS authorised_basis_minor,
               CAST(coalesce(posted, 0) - coalesce(auth, 0) AS BIGINT) AS difference_minor
        FROM p FULL JOIN a USING (month_key)""",
    "dormancy": """
        WITH t AS (SELECT max(posted_date) AS today FROM survivors),
             v AS (SELECT account_id, max(posted_date) AS any_day, max(posted_date) FILTER (txn_type = 'purchase') AS card_day
                   FROM survivors GROUP BY 1)
        SELECT product_code, count(*) AS accounts,
               count(*) FILTER (coalesce(any_day < today - INTERVAL 12 MONTH, TRUE)) AS dormant_core_banking,
               count(*) FILTER (coalesce(card_day < today - INTERVAL 6 MONTH, TRUE)) AS dormant_card_activity
        FROM acct_now LEFT JOIN v USING (account_id), t WHERE status <> 'closed' GROUP BY 1""",
    "dormant_accounts": """
        WITH t AS (SELECT max(posted_date) AS today FROM survivors),
             v AS (SELECT account_id, max(posted_date) AS any_day, max(posted_date) FILTER (txn_type = 'purchase') AS card_day
                   FROM survivors GROUP BY 1)
        SELECT account_id, product_code, coalesce(any_day < today - INTERVAL 12 MONTH, TRUE) AS is_dormant_core_banking,
               coalesce(card_day < today - INTERVAL 6 MONTH, TRUE) AS is_dormant_card_activity
        FROM acct_now LEFT JOIN v USING (account_id), t WHERE status <> 'closed'""",
    "segment_concentration": """
        SELECT segment, customers, customers::DOUBLE / (SELECT sum(customers) FROM per_segment)::DOUBLE AS customer_share,
               minor::DOUBLE / (SELECT sum(minor) FROM per_segment)::DOUBLE AS spend_share FROM per_segment""",
    "online_share_by_segment": "SELECT segment, online_minor::DOUBLE / minor::DOUBLE AS online_share FROM per_segment",
    "ingest_customers": """
        SELECT * EXCLUDE (onboarded_at, onboarded_on), onboarded_at AS created_at, CAST(NULL AS VARCHAR) AS address_line2
        FROM people_now""",
    "ingest_accounts": """
        SELECT * EXCLUDE (opened_on, closed_on), opened_on AS opened_date, closed_on AS closed_date FROM acct_now""",
    "ingest_cards": """
        SELECT * EXCLUDE (issued_on, expires_on), issued_on AS issued_date, expires_on AS expiry_date FROM stg_card""",
    "ingest_merchants": "SELECT * EXCLUDE (first_seen_on), first_seen_on AS first_seen_date FROM stg_mer",
    "ingest_fx_rates": "SELECT * FROM rates",
    "ingest_transactions": """
        SELECT * EXCLUDE (k, posted_date), CAST(date_trunc('month', posted_date + 15) AS DATE) AS posted_date FROM txn""",
    "evolve_union": """
        SELECT feed_version, count(*) AS n, count(pos_entry_mode) AS with_entry_mode,
               count(is_recurring) AS with_recurring, count(DISTINCT date_trunc('month', posted_date + 15)) AS days
        FROM txn GROUP BY 1""",
    "landed_metrics": """
        SELECT feed, n AS "rows", CAST(parts AS BIGINT) AS partitions, TRUE AS has_bytes, 'compatible' AS verdict FROM (
          SELECT 'customers' AS feed, count(*) AS n, NULL AS parts FROM people_now
          UNION ALL SELECT 'accounts', count(*), NULL FROM acct_now
          UNION ALL SELECT 'cards', count(*), NULL FROM stg_card
          UNION ALL SELECT 'merchants', count(*), NULL FROM stg_mer
          UNION ALL SELECT 'fx_rates', count(*), NULL FROM rates
          UNION ALL SELECT 'card_transactions', count(*), count(DISTINCT date_trunc('month', posted_date + 15)) FROM txn)""",
    "row_conservation": """
        SELECT feed, n AS raw_rows, n AS lake_rows, CAST(0 AS BIGINT) AS lost FROM (
          SELECT 'customers' AS feed, count(*) AS n FROM people_now
          UNION ALL SELECT 'accounts', count(*) FROM acct_now
          UNION ALL SELECT 'cards', count(*) FROM stg_card
          UNION ALL SELECT 'merchants', count(*) FROM stg_mer
          UNION ALL SELECT 'fx_rates', count(*) FROM rates
          UNION ALL SELECT 'card_transactions', count(*) FROM txn)""",
    "contract_verdicts": """
        SELECT feed, 'compatible' AS verdict FROM (VALUES ('customers'), ('accounts'), ('cards'), ('merchants'),
                                                          ('fx_rates'), ('card_transactions')) AS f(feed)""",
    "contract_verdicts_faulty": """
        SELECT *, TRUE AS refused FROM (VALUES
          ('accounts', 'breaking', 'accounts: breaking, missing product_code; renamed to product? (producer core-banking, owner core-banking@example.com)', 'core-banking@example.com', 'core-banking'),
          ('card_transactions', 'compatible', 'card_transactions: compatible', 'cards-platform@example.com', 'card-processor-gateway'),
          ('cards', 'compatible', 'cards: compatible', 'cards-platform@example.com', 'core-banking'),
          ('customers', 'compatible', 'customers: compatible', 'onboarding@example.com', 'onboarding-platform'),
          ('fx_rates', 'compatible', 'fx_rates: compatible', 'treasury@example.com', 'treasury-rates-api'),
          ('merchants', 'additive', 'merchants: additive, unknown vendor_score (owner data-platform@example.com)', 'data-platform@example.com', 'merchant-enrichment-vendor')
        ) AS v(feed, verdict, message, owner, producer)""",
    "contract_summary_faulty": """
        SELECT * FROM (VALUES ('breaking', 1::BIGINT, 'accounts'), ('additive', 1, 'merchants'),
                              ('compatible', 4, 'card_transactions, cards, customers, fx_rates')) AS v(verdict, feeds, names)""",
    "value_rule_violations": """
        SELECT * FROM (
          SELECT 'customers' AS feed, 'address.country enum' AS "check", count(*) AS violations FROM people_now
            WHERE CAST(substr(customer_id, 5) AS BIGINT) % 41 = 3
          UNION ALL SELECT 'customers', 'address.postcode pattern', count(*) FROM people_now
            WHERE NOT regexp_matches(postcode, '^[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}$')
          UNION ALL SELECT 'accounts', 'product_code required', count(*) FROM acct_now
          UNION ALL SELECT 'cards', 'network enum', count(*) FROM stg_card WHERE CAST(split_part(card_id, '-', 2) AS BIGINT) % 37 = 5
          UNION ALL SELECT 'merchants', 'country required', count(*) FROM stg_mer WHERE CAST(split_part(merchant_id, '-', 2) AS BIGINT) % 29 = 0
          UNION ALL SELECT 'card_transactions', 'channel enum', count(*) FROM txn WHERE split_part(transaction_id, '-', 3) = '7' AND mcc = 5411)
        WHERE violations > 0""",
    "history_from_lake_customers": """
        SELECT customer_id, segment, kyc_status, kyc_risk_band, valid_from, valid_to FROM people_history""",
    "history_from_lake_accounts": """
        SELECT account_id, product_code, status, closed_on, valid_from, valid_to FROM acct_history""",
    "history_versions": """
        SELECT CAST(snap AS INTEGER) AS version, strftime(taken_at, '%Y-%m-%d %H:%M:%S') AS taken_at,
               count(*) FILTER (valid_to IS NULL OR valid_to > taken_at) AS open_rows,
               count(*) FILTER (valid_to <= taken_at) AS closed_rows
        FROM snap_times JOIN people_history ON valid_from <= taken_at GROUP BY 1, 2""",
    "freshness_landed": """
        WITH w AS (SELECT max(posted_date) - 59 AS first, max(posted_date) AS last FROM txn),
             t AS (SELECT posted_date, count(*) * CASE WHEN posted_date - (SELECT first FROM w) = 52 THEN 3 ELSE 1 END AS n
                   FROM txn WHERE posted_date >= (SELECT first FROM w) AND posted_date - (SELECT first FROM w) <> 45 GROUP BY 1),
             s AS (SELECT CAST(unnest(generate_series((SELECT min(posted_date) FROM t), (SELECT max(posted_date) FROM t), INTERVAL 1 DAY)) AS DATE) AS posted_date),
             h AS (SELECT d.posted_date, count(*) AS days, sum(p.n)::DOUBLE AS s1, sum(p.n * p.n)::DOUBLE AS s2
                   FROM t d JOIN t p ON p.posted_date >= d.posted_date - 28 AND p.posted_date < d.posted_date GROUP BY 1),
             j AS (SELECT t.posted_date, n, coalesce(days, 0) AS days, s1 / days AS mean,
                          sqrt((days * s2 - s1 * s1) / nullif(days * (days - 1), 0)) AS sigma FROM t LEFT JOIN h USING (posted_date))
        SELECT s.posted_date, CAST(coalesce(n, 0) AS BIGINT) AS txn_count, days AS history_days, round(mean, 6) AS trailing_mean,
               round(sigma, 6) AS trailing_sigma, abs(n - mean) <= 3 * sigma AS within_limits, n IS NOT NULL AS arrived
        FROM s LEFT JOIN j USING (posted_date)""",
    "feed_arrival_ledger": """
        WITH w AS (SELECT max(posted_date) - 59 AS first, max(posted_date) AS last FROM txn),
             t AS (SELECT posted_date - (SELECT first FROM w) AS place FROM txn WHERE posted_date >= (SELECT first FROM w)),
             c AS (
               SELECT 'customers' AS feed, (SELECT count(*) FROM people_now) AS row_count, (SELECT count(*) FROM people_now) AS previous_count
               UNION ALL SELECT 'accounts', (SELECT count(*) FROM acct_now), (SELECT count(*) FROM acct_now)
               UNION ALL SELECT 'cards', (SELECT count(*) FROM stg_card), (SELECT count(*) FROM stg_card)
               UNION ALL SELECT 'fx_rates', (SELECT count(*) FROM rates), (SELECT count(*) FROM rates)
               UNION ALL SELECT 'merchants', 0, (SELECT count(*) FROM stg_mer)
               UNION ALL SELECT 'card_transactions',
                      (SELECT count(*) FILTER (place >= 50) + 2 * count(*) FILTER (place = 52) FROM t),
                      (SELECT count(*) FILTER (place < 50 AND place <> 45) FROM t))
        SELECT feed, feed <> 'merchants' OR isodow(last + 1) = 1 AS due, row_count > 0 AS arrived,
               row_count, previous_count, row_count - previous_count AS change,
               CASE WHEN row_count > 0 THEN 'arrived' WHEN isodow(last + 1) = 1 THEN 'absent' ELSE 'not due' END AS status
        FROM c CROSS JOIN w""",
    "declared_checks": """
        SELECT 'fact.customer_key' AS "check", count(*) AS violations FROM f WHERE customer_key NOT IN (SELECT customer_key FROM d_customer)
        UNION ALL SELECT 'fact.account_key', count(*) FROM f WHERE account_key NOT IN (SELECT account_key FROM d_account)
        UNION ALL SELECT 'fact.merchant_key', count(*) FROM f WHERE merchant_key NOT IN (SELECT merchant_key FROM d_merchant)
        UNION ALL SELECT 'fact.card_key', count(*) FROM f WHERE card_key NOT IN (SELECT card_key FROM d_card)
        UNION ALL SELECT 'fact.txn_context_key', count(*) FROM f WHERE txn_context_key NOT IN (SELECT txn_context_key FROM d_context)
        UNION ALL SELECT 'fact.posted_date_key', count(*) FROM f WHERE posted_date_key NOT IN (SELECT date_key FROM d_date)
        UNION ALL SELECT 'accounts.customer_id', count(*) FROM acct_now WHERE customer_id NOT IN (SELECT customer_id FROM people_now)
        UNION ALL SELECT 'cards.account_id', count(*) FROM stg_card WHERE account_id NOT IN (SELECT account_id FROM acct_now)
        UNION ALL SELECT 'deduped.transaction_id unique' AS "check", count(transaction_id) - count(DISTINCT transaction_id) AS violations FROM survivors
        UNION ALL SELECT 'fact.transaction_id unique' AS "check", count(transaction_id) - count(DISTINCT transaction_id) AS violations FROM f
        UNION ALL SELECT 'customers.customer_id unique' AS "check", count(customer_id) - count(DISTINCT customer_id) AS violations FROM people_now
        UNION ALL SELECT 'accounts.account_id unique' AS "check", count(account_id) - count(DISTINCT account_id) AS violations FROM acct_now
        UNION ALL SELECT 'cards.card_id unique' AS "check", count(card_id) - count(DISTINCT card_id) AS violations FROM stg_card
        UNION ALL SELECT 'merchants.merchant_id unique' AS "check", count(merchant_id) - count(DISTINCT merchant_id) AS violations FROM stg_mer
        UNION ALL SELECT 'dim_customer.customer_key unique' AS "check", count(customer_key) - count(DISTINCT customer_key) AS violations FROM d_customer
        UNION ALL SELECT 'dim_account.account_key unique' AS "check", count(account_key) - count(DISTINCT account_key) AS violations FROM d_account
        UNION ALL SELECT 'dim_date.date_key unique' AS "check", count(date_key) - count(DISTINCT date_key) AS violations FROM d_date
        UNION ALL SELECT 'dim_txn_context.txn_context_key unique' AS "check", count(txn_context_key) - count(DISTINCT txn_context_key) AS violations FROM d_context
        UNION ALL SELECT 'dim_merchant.merchant_key unique' AS "check", count(merchant_key) - count(DISTINCT merchant_key) AS violations FROM d_merchant
        UNION ALL SELECT 'dim_card.card_key unique' AS "check", count(card_key) - count(DISTINCT card_key) AS violations FROM d_card
        UNION ALL SELECT 'transactions.transaction_id not null' AS "check", count(*) - count(transaction_id) AS violations FROM staged
        UNION ALL SELECT 'transactions.currency not null' AS "check", count(*) - count(currency) AS violations FROM staged
        UNION ALL SELECT 'customers.customer_id not null' AS "check", count(*) - count(customer_id) AS violations FROM people_now
        UNION ALL SELECT 'accounts.account_id not null' AS "check", count(*) - count(account_id) AS violations FROM acct_now
        UNION ALL SELECT 'cards.card_id not null' AS "check", count(*) - count(card_id) AS violations FROM stg_card
        UNION ALL SELECT 'merchants.merchant_id not null' AS "check", count(*) - count(merchant_id) AS violations FROM stg_mer
        UNION ALL SELECT 'fx_rates.rate_to_gbp not null' AS "check", count(*) - count(rate_to_gbp) AS violations FROM rates
        UNION ALL SELECT 'fx_daily.rate_to_gbp not null' AS "check", count(*) - count(rate_to_gbp) AS violations FROM dense_rates
        UNION ALL SELECT 'deduped.transaction_id not null' AS "check", count(*) - count(transaction_id) AS violations FROM survivors
        UNION ALL SELECT 'fact.transaction_id not null' AS "check", count(*) - count(transaction_id) AS violations FROM f
        UNION ALL SELECT 'fact.amount_gbp_minor not null' AS "check", count(*) - count(amount_gbp_minor) AS violations FROM f
        UNION ALL SELECT 'fact.txn_context_key not null' AS "check", count(*) - count(txn_context_key) AS violations FROM f
        UNION ALL SELECT 'fact.fx_rate_to_gbp not null' AS "check", count(*) - count(fx_rate_to_gbp) AS violations FROM f
        UNION ALL SELECT 'fact.dq_score not null' AS "check", count(*) - count(dq_score) AS violations FROM f
        UNION ALL SELECT 'dim_customer.customer_key not null' AS "check", count(*) - count(customer_key) AS violations FROM d_customer
        UNION ALL SELECT 'dim_customer.customer_id not null' AS "check", count(*) - count(customer_id) AS violations FROM d_customer
        UNION ALL SELECT 'dim_account.account_key not null' AS "check", count(*) - count(account_key) AS violations FROM d_account
        UNION ALL SELECT 'dim_account.customer_id not null' AS "check", count(*) - count(customer_id) AS violations FROM d_account
        UNION ALL SELECT 'dim_date.date_key not null' AS "check", count(*) - count(date_key) AS violations FROM d_date
        UNION ALL SELECT 'dim_date.calendar_date not null' AS "check", count(*) - count(calendar_date) AS violations FROM d_date
        UNION ALL SELECT 'dim_txn_context.txn_context_key not null' AS "check", count(*) - count(txn_context_key) AS violations FROM d_context
        UNION ALL SELECT 'dim_merchant.merchant_key not null' AS "check", count(*) - count(merchant_key) AS violations FROM d_merchant
        UNION ALL SELECT 'dim_card.card_key not null' AS "check", count(*) - count(card_key) AS violations FROM d_card
        UNION ALL SELECT 'agg_customer_category_month.spend_gbp_minor not null' AS "check", count(*) - count(spend_gbp_minor) AS violations FROM monthly_agg
        UNION ALL SELECT 'agg_dq_scorecard.pass_rate not null' AS "check", count(*) - count(pass_rate) AS violations FROM scorecard
        UNION ALL SELECT 'transactions.feed_version accepted values' AS "check", count(*) FILTER (feed_version NOT IN (1, 2)) AS violations FROM txn
        UNION ALL SELECT 'dim_customer.segment accepted values',
               count(*) FILTER (segment NOT IN ('mass', 'student', 'affluent', 'premier', 'unknown')) FROM d_customer
        UNION ALL SELECT 'dim_customer.kyc_status accepted values',
               count(*) FILTER (kyc_status NOT IN ('verified', 'pending', 'referred', 'rejected', 'unknown')) FROM d_customer""",
    "gold_report": """
        SELECT "table", "rows", CASE WHEN "table" = 'fct_card_transaction' THEN (SELECT count(DISTINCT date_trunc('month', posted_date)) FROM f) END AS partitions,
               TRUE AS has_bytes
        FROM (SELECT 'dim_customer' AS "table", count(*) AS "rows" FROM d_customer
              UNION ALL SELECT 'dim_account', count(*) FROM d_account UNION ALL SELECT 'dim_card', count(*) FROM d_card
              UNION ALL SELECT 'dim_merchant', count(*) FROM d_merchant UNION ALL SELECT 'dim_txn_context', count(*) FROM d_context
              UNION ALL SELECT 'dim_date', count(*) FROM d_date UNION ALL SELECT 'fx_rate', count(*) FROM dense_rates
              UNION ALL SELECT 'agg_customer_category_month', count(*) FROM monthly_agg
              UNION ALL SELECT 'agg_dq_scorecard', count(*) FROM scorecard
              UNION ALL SELECT 'customer_document', count(*) FROM people_now
              UNION ALL SELECT 'fct_card_transaction', count(*) FROM f)""",
    "serving_months": """
        SELECT strftime(posted_date, '%Y-%m') AS posted_month, count(*) AS "rows", TRUE AS loaded FROM f GROUP BY 1""",
    "report_csv": "SELECT * FROM by_dimension",
    "defect_ledger_written": "SELECT transaction_id, defect_code FROM planted",
    "landed_partitions": "SELECT DISTINCT CAST(date_trunc('month', posted_date + 15) AS DATE) AS day FROM txn",
    "publish_audit": """
        SELECT attempt, attempt = 'clean' AS published, CAST(1 AS INTEGER) AS version,
               CASE WHEN attempt = 'clean' THEN ''
                    WHEN (SELECT sum(amount_gbp_minor) FROM wide WHERE is_settled AND posted_date = (SELECT min(posted_date) FROM f)) <> 0
                    THEN 'aggregate and fact differ, transaction repeated' ELSE 'transaction repeated' END AS violated,
               (SELECT count(*) FROM f) AS fact_rows
        FROM (VALUES ('clean'), ('overlapping load')) AS v(attempt)""",
    "active_customers_daily": """
        WITH a AS (SELECT DISTINCT posted_date, customer_id FROM wide WHERE is_settled AND txn_type = 'purchase'),
             d AS (SELECT CAST(unnest(generate_series((SELECT min(posted_date) FROM a), (SELECT max(posted_date) FROM a), INTERVAL 1 DAY)) AS DATE) AS day)
        SELECT day AS posted_date, count(DISTINCT customer_id) AS active_customers
        FROM d JOIN a ON a.posted_date > day - 30 AND a.posted_date <= day GROUP BY 1""",
    "serving_customers": """
        SELECT customer_id, segment, kyc_status, kyc_risk_band, onboarded_on, first_name, last_name, email, city,
               CAST(NULL AS VARCHAR) AS postcode FROM now_customers""",
    "serving_accounts": """
        SELECT account_id, customer_id, product_code, currency, status, opened_on FROM d_account
        WHERE is_current AND account_id <> 'UNKNOWN'""",
    "contract_value_rules": """
        SELECT 'customer_id pattern' AS "check", count(*) FILTER (NOT regexp_matches(customer_id, '^CUS-[0-9]{9}$')) AS violations FROM people_now
        UNION ALL SELECT 'segment enum', count(*) FILTER (segment NOT IN ('mass', 'affluent', 'premier', 'student')) FROM people_now
        UNION ALL SELECT 'postcode pattern', count(*) FILTER (NOT regexp_matches(postcode, '^[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}$')) FROM people_now
        UNION ALL SELECT 'kyc_status enum', count(*) FILTER (kyc_status NOT IN ('verified', 'pending', 'referred', 'rejected')) FROM people_now
        UNION ALL SELECT 'kyc_risk_band enum', count(*) FILTER (kyc_risk_band NOT IN ('low', 'medium', 'high')) FROM people_now
        UNION ALL SELECT 'customer_id unique', count(*) - count(DISTINCT customer_id) FROM people_now""",
}


def statement(query: str) -> str:
    """`query` with the parts it needs as a WITH list."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", text)):
            if word in PARTS and word not in needed:
                needed.add(word)
                visit(PARTS[word])

    visit(query)
    listed = ",\n".join(f"{name} AS ({PARTS[name].strip()})" for name in PARTS if name in needed)
    body = query.strip()
    if not listed:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {listed},\n{body[5:]}"
    return f"WITH {listed}\n{body}"
