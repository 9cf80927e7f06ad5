"""Plain SQL counterparts of the registered queries, written independently of the DataFrame code."""

from __future__ import annotations

import re

from conformance.mapping import COLUMNS, MOVED, TABLES, columns
from conformance.nights import AHEAD, CORRECTED, FIXED, LATE, RENAMED

# --- building blocks -------------------------------------------------------------------------


def _cols(source: str, changes: dict[str, str] | None = None) -> str:
    return ", ".join(columns(source, changes))


_FROM = {
    "branches": "nation JOIN region ON n_regionkey = r_regionkey",
    "customers": "customer",
    "accounts": "customer",
    "transactions": "(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 997 = 0) o",
    "payment_gateway_logs": "events",
    "credit_bureau_reports": "(SELECT c.*, 1 AS m FROM customer c UNION ALL SELECT c.*, 2 AS m FROM customer c) b",
    "job_runs": "events",
}

# (rule, kind, threshold, condition that holds for good rows; missing values only fail Completeness)
_RULES: dict[str, list[tuple[str, str, float, str]]] = {
    "branches": [
        ("Completeness(branch_code)", "Completeness", 1.0, "branch_code IS NOT NULL"),
        ("Uniqueness(branch_code)", "Uniqueness", 1.0, "branch_code IS NULL OR count(*) OVER (PARTITION BY branch_code) = 1"),
        ("Completeness(branch_name)", "Completeness", 1.0, "branch_name IS NOT NULL"),
        ("Completeness(city)", "Completeness", 1.0, "city IS NOT NULL"),
    ],
    "customers": [
        ("Completeness(customer_id)", "Completeness", 1.0, "customer_id IS NOT NULL"),
        ("Uniqueness(customer_id)", "Uniqueness", 1.0, "customer_id IS NULL OR count(*) OVER (PARTITION BY customer_id) = 1"),
        ("Completeness(kyc_status)", "Completeness", 0.95, "kyc_status IS NOT NULL"),
        ("InSet(kyc_status)", "InSet", 1.0, "kyc_status IN ('VERIFIED','PENDING','REJECTED')"),
        ("Length(phone_number)", "Length", 1.0, "length(phone_number) = 10"),
    ],
    "accounts": [
        ("Completeness(account_id)", "Completeness", 1.0, "account_id IS NOT NULL"),
        ("Uniqueness(account_id)", "Uniqueness", 1.0, "account_id IS NULL OR count(*) OVER (PARTITION BY account_id) = 1"),
        ("Completeness(customer_id)", "Completeness", 1.0, "customer_id IS NOT NULL"),
        ("InSet(account_type)", "InSet", 1.0, "account_type IN ('Savings','Current')"),
        ("InSet(status)", "InSet", 1.0, "status IN ('ACTIVE','CLOSED','FROZEN','DORMANT')"),
        ("Compare(balance >= 0)", "Compare", 1.0, "balance >= 0"),
        ("Compare(currency = INR)", "Compare", 1.0, "currency = 'INR'"),
    ],
    "transactions": [
        ("Completeness(txn_id)", "Completeness", 1.0, "txn_id IS NOT NULL"),
        ("Uniqueness(txn_id)", "Uniqueness", 1.0, "txn_id IS NULL OR count(*) OVER (PARTITION BY txn_id) = 1"),
        ("Completeness(account_id)", "Completeness", 1.0, "account_id IS NOT NULL"),
        ("InSet(txn_type)", "InSet", 1.0, "txn_type IN ('Debit','Credit')"),
        ("Compare(amount > 0)", "Compare", 1.0, "amount > 0"),
        ("InSet(status)", "InSet", 1.0, "status IN ('SUCCESS','FAILED','PENDING','REVERSED')"),
        ("Completeness(txn_timestamp)", "Completeness", 1.0, "txn_timestamp IS NOT NULL"),
    ],
    "payment_gateway_logs": [
        ("Completeness(txn_id)", "Completeness", 1.0, "txn_id IS NOT NULL"),
        ("Uniqueness(txn_id)", "Uniqueness", 1.0, "txn_id IS NULL OR count(*) OVER (PARTITION BY txn_id) = 1"),
        ("InSet(gateway_name)", "InSet", 1.0, "gateway_name IN ('Stripe','BillDesk','PayU','Razorpay')"),
        ("InSet(gateway_status)", "InSet", 1.0, "gateway_status IN ('SUCCESS','FAILED','PENDING','TIMEOUT')"),
        ("Length(response_code)", "Length", 1.0, "length(response_code) = 2"),
        ("Compare(processing_time_ms >= 0)", "Compare", 1.0, "processing_time_ms >= 0"),
        ("InSet(device_type)", "InSet", 1.0, "device_type IN ('Mobile','ATM','POS','Web')"),
    ],
    "credit_bureau_reports": [
        ("Completeness(customer_id)", "Completeness", 1.0, "customer_id IS NOT NULL"),
        ("Completeness(credit_score)", "Completeness", 1.0, "credit_score IS NOT NULL"),
        ("Compare(credit_score >= 300)", "Compare", 1.0, "credit_score >= 300"),
        ("Compare(credit_score <= 900)", "Compare", 1.0, "credit_score <= 900"),
        ("InSet(risk_grade)", "InSet", 1.0, "risk_grade IN ('LOW','MEDIUM','HIGH')"),
        ("Compare(external_active_loans >= 0)", "Compare", 1.0, "external_active_loans >= 0"),
        ("Compare(external_overdue_amount >= 0)", "Compare", 1.0, "external_overdue_amount >= 0"),
    ],
}


def _failed(rules: list[tuple[str, str, float, str]]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({ok}, true) THEN '{name}' END" for name, _, _, ok in rules) + ")"


def _outcomes(table: str, rules: list[tuple[str, str, float, str]], frm: str) -> str:
    """One row per rule."""
    flags = ", ".join(f"coalesce({ok}, true) AS ok{i}" for i, (_, _, _, ok) in enumerate(rules))
    parts = []
    for i, (name, kind, threshold, _) in enumerate(rules):
        parts.append(
            f"SELECT '{table}' AS table_name, {i + 1} AS rule_no, '{name}' AS rule, '{kind}' AS rule_kind, "
            f"cast({threshold} AS double) AS threshold, count(*) AS evaluated_rows, count(*) FILTER (WHERE NOT ok{i}) AS failing_rows, "
            f"round(cast(count(*) FILTER (WHERE ok{i}) AS double) / count(*), 6) AS ratio, "
            f"CASE WHEN cast(count(*) FILTER (WHERE ok{i}) AS double) / count(*) >= {threshold} THEN 'Passed' ELSE 'Failed' END AS outcome "
            f"FROM (SELECT {flags} FROM {frm})"
        )
    return " UNION ALL ".join(parts)


def _text(*cols: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} AS varchar), 'None')" for c in cols) + ")"


def _sk(*cols: str) -> str:
    return f"row_number() OVER (ORDER BY md5({_text(*cols)}))"


def _mean2(total: str, n: str) -> str:
    """Half-up mean to two places of non-negative amounts, in whole cents."""
    return f"cast((2 * sum(cast({total} * 100 AS bigint)) + ({n})) // (2 * ({n})) AS double) / 100"


def _pct(part: str, whole: str) -> str:
    """Half-up percentage to two places, in whole hundredths."""
    return f"cast((20000 * ({part}) + ({whole})) // (2 * ({whole})) AS double) / 100"


def _fmt(spec: str) -> str:
    """Output list: ``d:`` date, ``t:`` time, ``m:`` money, ``i:`` whole number, else as is."""
    makers = {
        "d": "strftime({c}, '%Y-%m-%d') AS {c}",
        "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}",
        "m": "cast({c} AS double) AS {c}",
        "i": "cast({c} AS bigint) AS {c}",
    }
    out = []
    for item in spec.split():
        kind, _, name = item.rpartition(":")
        out.append(makers[kind].format(c=name) if kind else name)
    return ", ".join(out)


_BAND = "CASE WHEN credit_score >= 750 THEN 'EXCELLENT' WHEN credit_score >= 650 THEN 'GOOD' WHEN credit_score >= 550 THEN 'FAIR' ELSE 'POOR' END"

_CTE: dict[str, str] = {f"src_{t}": f"SELECT {_cols(t)} FROM {_FROM[t]}" for t in _FROM}
_CTE |= {f"eval_{t}": f"SELECT *, {_failed(_RULES[t])} AS broken_rules FROM src_{t}" for t in TABLES}
_CTE["src_moved"] = f"SELECT {_cols('customers', MOVED)} FROM customer WHERE c_custkey % 10 = 0"

_MASK = """CASE WHEN pan_number IS NULL THEN 'UNKNOWN' ELSE concat(substr(pan_number,1,5), '*****') END AS pan_masked,
    regexp_replace(email, '^[^@]+', '***') AS email_masked,
    CASE WHEN phone_number IS NOT NULL THEN concat('XXXXXX', substr(phone_number,7,4)) END AS phone_masked"""

_SILVER = {
    "branches": "upper(trim(branch_code)) AS branch_code, trim(branch_name) AS branch_name, trim(city) AS city, trim(state) AS state, upper(trim(region)) AS region, created_at",
    "customers": f"customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name, date_of_birth, upper(trim(kyc_status)) AS kyc_status, trim(branch_code) AS branch_code, created_at, updated_at, {_MASK}",
    "accounts": "account_id, customer_id, trim(account_type) AS account_type, round(balance, 2) AS balance, upper(trim(currency)) AS currency, trim(branch_code) AS branch_code, upper(trim(status)) AS status, opened_date, created_at, updated_at",
    "transactions": "txn_id, account_id, trim(txn_type) AS txn_type, round(amount, 2) AS amount, txn_timestamp, upper(trim(channel)) AS channel, upper(trim(status)) AS status",
    "payment_gateway_logs": "txn_id, trim(gateway_name) AS gateway_name, upper(trim(gateway_status)) AS gateway_status, trim(response_code) AS response_code, processing_time_ms, trim(device_type) AS device_type, trim(geo_location) AS geo_location, processed_timestamp",
    "credit_bureau_reports": f"customer_id, credit_score, risk_grade, external_active_loans, external_overdue_amount, bureau_pull_date, {_BAND} AS risk_band",
}
_CTE |= {f"silver_{t}": f"SELECT {_SILVER[t]} FROM eval_{t} WHERE broken_rules = ''" for t in TABLES}

_CTE["calendar"] = """SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS date_sk, cast(d AS date) AS full_date, day(d) AS day_of_month,
    isodow(d) AS day_of_week, dayname(d) AS day_name, weekofyear(d) AS week_of_year, month(d) AS month_num, monthname(d) AS month_name,
    quarter(d) AS quarter, year(d) AS year, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN d = last_day(d) THEN 1 ELSE 0 END AS is_month_end, CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS is_month_start,
    year(d) + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS fiscal_year,
    CASE WHEN month(d) BETWEEN 4 AND 6 THEN 'Q1' WHEN month(d) BETWEEN 7 AND 9 THEN 'Q2' WHEN month(d) >= 10 THEN 'Q3' ELSE 'Q4' END AS fiscal_quarter
    FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM span)"""
_CTE["span"] = "SELECT timestamp '1995-01-01' AS lo, timestamp '2030-12-31' AS hi"
_CTE["dim_date"] = "SELECT * FROM calendar"

_CTE["dim_branch"] = f"""SELECT cast({_sk('branch_code', 'created_at')} AS int) AS branch_sk, branch_code, branch_name, city, state, region,
    created_at AS source_created_at, 1 AS is_current, created_at AS effective_from, cast(NULL AS timestamp) AS effective_to FROM silver_branches"""
_CTE["dim_customer"] = f"""SELECT cast({_sk('customer_id', 'updated_at')} AS int) AS customer_sk, customer_id, first_name, last_name,
    concat(first_name, ' ', last_name) AS full_name, date_of_birth, kyc_status, s.branch_code, coalesce(b.branch_sk, 0) AS branch_sk,
    pan_masked, email_masked, phone_masked, created_at AS source_created_at, updated_at AS source_updated_at, 1 AS is_current,
    updated_at AS effective_from, cast(NULL AS timestamp) AS effective_to
    FROM silver_customers s LEFT JOIN (SELECT branch_code, branch_sk FROM dim_branch) b ON s.branch_code = b.branch_code"""
_CTE["dim_account"] = f"""SELECT cast({_sk('account_id', 'updated_at')} AS int) AS account_sk, account_id, coalesce(c.customer_sk, 0) AS customer_sk,
    account_type, balance, currency, s.branch_code, coalesce(b.branch_sk, 0) AS branch_sk, status, opened_date, created_at AS source_created_at,
    1 AS is_current, updated_at AS effective_from, cast(NULL AS timestamp) AS effective_to
    FROM silver_accounts s LEFT JOIN (SELECT branch_code, branch_sk FROM dim_branch) b ON s.branch_code = b.branch_code
    LEFT JOIN (SELECT customer_id, customer_sk FROM dim_customer) c ON s.customer_id = c.customer_id"""
_CTE["fact_transactions"] = f"""SELECT {_sk('s.txn_id')} AS txn_sk, s.txn_id, coalesce(a.account_sk, 0) AS account_sk, coalesce(a.customer_sk, 0) AS customer_sk,
    coalesce(a.branch_sk, 0) AS branch_sk, coalesce(d.date_sk, 0) AS date_sk, s.txn_type, s.amount,
    CASE WHEN s.txn_type = 'Debit' THEN s.amount ELSE 0 END AS debit_amount, CASE WHEN s.txn_type = 'Credit' THEN s.amount ELSE 0 END AS credit_amount,
    s.txn_timestamp, cast(s.txn_timestamp AS date) AS txn_date, s.channel, s.status
    FROM silver_transactions s LEFT JOIN dim_account a ON s.account_id = a.account_id LEFT JOIN dim_date d ON cast(s.txn_timestamp AS date) = d.full_date"""
_CTE["fact_payments"] = f"""SELECT {_sk('s.txn_id')} AS payment_sk, s.txn_id, coalesce(d.date_sk, 0) AS date_sk, gateway_name, gateway_status, response_code,
    processing_time_ms, device_type, geo_location, processed_timestamp, cast(processed_timestamp AS date) AS txn_date,
    CASE WHEN gateway_status = 'SUCCESS' THEN 1 ELSE 0 END AS is_success
    FROM silver_payment_gateway_logs s LEFT JOIN dim_date d ON cast(s.processed_timestamp AS date) = d.full_date"""
_CTE["fact_credit_risk"] = f"""SELECT {_sk('s.customer_id', 's.bureau_pull_date')} AS credit_sk, coalesce(c.customer_sk, 0) AS customer_sk, s.customer_id,
    coalesce(d.date_sk, 0) AS date_sk, credit_score, risk_grade, risk_band, external_active_loans, external_overdue_amount, bureau_pull_date
    FROM silver_credit_bureau_reports s LEFT JOIN dim_customer c ON s.customer_id = c.customer_id LEFT JOIN dim_date d ON s.bureau_pull_date = d.full_date"""
_CTE["agg_daily_balances"] = f"""SELECT f.account_sk, max(a.account_id) AS account_id, txn_date, sum(credit_amount) AS total_credit, sum(debit_amount) AS total_debit,
    sum(credit_amount) - sum(debit_amount) AS net_balance_change, count(*) AS txn_count, {_mean2('amount', 'count(*)')} AS avg_txn_amount, 'DAILY_BALANCE' AS agg_type
    FROM fact_transactions f LEFT JOIN dim_account a ON f.account_sk = a.account_sk GROUP BY f.account_sk, txn_date"""
_CTE["agg_monthly_summary"] = f"""SELECT f.branch_sk, max(b.branch_code) AS branch_code, max(b.branch_name) AS branch_name, strftime(txn_date, '%Y-%m') AS year_month,
    sum(amount) AS total_txn_volume, count(*) AS total_txn_count, sum(credit_amount) AS total_credits, sum(debit_amount) AS total_debits,
    {_mean2('amount', 'count(*)')} AS avg_txn_amount, count(DISTINCT account_sk) AS active_accounts, 'MONTHLY_SUMMARY' AS agg_type
    FROM fact_transactions f LEFT JOIN dim_branch b ON f.branch_sk = b.branch_sk GROUP BY f.branch_sk, strftime(txn_date, '%Y-%m')"""
_CTE["agg_branch_performance"] = f"""SELECT f.branch_sk, max(b.branch_code) AS branch_code, max(b.branch_name) AS branch_name, max(b.city) AS city, max(b.region) AS region,
    sum(amount) AS total_txn_volume, count(*) AS total_txn_count, {_mean2('amount', 'count(*)')} AS avg_txn_amount, max(amount) AS max_single_txn,
    min(txn_date) AS first_txn_date, max(txn_date) AS last_txn_date, count(DISTINCT account_sk) AS unique_accounts, count(DISTINCT customer_sk) AS unique_customers,
    'BRANCH_PERFORMANCE' AS agg_type FROM fact_transactions f LEFT JOIN dim_branch b ON f.branch_sk = b.branch_sk GROUP BY f.branch_sk"""
_CTE["agg_customer_360"] = f"""SELECT customer_sk, sum(amount) AS lifetime_txn_volume, count(*) AS lifetime_txn_count, {_mean2('amount', 'count(*)')} AS avg_txn_amount,
    sum(credit_amount) AS total_credits_received, sum(debit_amount) AS total_debits_made, max(amount) AS largest_single_txn, min(txn_date) AS first_txn_date,
    max(txn_date) AS last_txn_date, count(DISTINCT txn_date) AS active_days, count(DISTINCT account_sk) AS num_accounts, 'CUSTOMER_360' AS agg_type
    FROM fact_transactions GROUP BY customer_sk"""

_CTE["vw_branch"] = f"""SELECT branch_code, branch_name, city, state, region, count(txn_id) AS total_transactions, sum(amount) AS total_volume_inr,
    {_mean2('amount', 'count(*)')} AS avg_txn_amount_inr, sum(credit_amount) AS total_credits_inr, sum(debit_amount) AS total_debits_inr,
    count(DISTINCT customer_sk) AS unique_customers, count(DISTINCT account_sk) AS unique_accounts, min(txn_date) AS first_txn_date, max(txn_date) AS last_txn_date,
    count(*) FILTER (WHERE status = 'SUCCESS') AS successful_txns, count(*) FILTER (WHERE status = 'FAILED') AS failed_txns
    FROM fact_transactions f JOIN dim_branch b USING (branch_sk) GROUP BY ALL"""
_CTE["vw_daily"] = f"""SELECT full_date, day_name, month_name, year, quarter, is_weekend, fiscal_quarter, branch_name, region, txn_type, channel,
    count(txn_id) AS txn_count, sum(amount) AS total_amount_inr, {_mean2('amount', 'count(*)')} AS avg_amount_inr, min(amount) AS min_amount_inr,
    max(amount) AS max_amount_inr, count(*) FILTER (WHERE status = 'SUCCESS') AS success_count, count(*) FILTER (WHERE status = 'FAILED') AS fail_count
    FROM fact_transactions JOIN dim_date USING (date_sk) JOIN dim_branch USING (branch_sk) GROUP BY ALL"""
_CTE["vw_payment"] = f"""SELECT full_date, month_name, year, gateway_name, device_type, geo_location, count(*) AS total_payments,
    sum(is_success) AS successful_payments, count(*) - sum(is_success) AS failed_payments, {_pct('sum(is_success)', 'count(*)')} AS success_rate_pct,
    {_mean2('processing_time_ms', 'count(*)')} AS avg_processing_ms, min(processing_time_ms) AS min_processing_ms, max(processing_time_ms) AS max_processing_ms
    FROM fact_payments JOIN dim_date USING (date_sk) GROUP BY ALL"""
_CTE["vw_risk"] = """SELECT c.customer_id, first_name, last_name, kyc_status, branch_name, city, credit_score, risk_grade, risk_band, external_active_loans,
    external_overdue_amount, bureau_pull_date, lifetime_txn_volume, lifetime_txn_count, num_accounts, last_txn_date,
    CASE WHEN credit_score >= 750 THEN 'LOW RISK' WHEN credit_score >= 650 THEN 'MEDIUM RISK' WHEN credit_score >= 550 THEN 'HIGH RISK' ELSE 'VERY HIGH RISK' END AS bank_risk_category
    FROM dim_customer c LEFT JOIN dim_branch b ON c.branch_sk = b.branch_sk LEFT JOIN fact_credit_risk r ON c.customer_sk = r.customer_sk
    LEFT JOIN agg_customer_360 a ON c.customer_sk = a.customer_sk"""

_CTE |= {f"rules_{t}": _outcomes(t, _RULES[t], f"src_{t}") for t in TABLES}
_CTE["rules_all"] = " UNION ALL ".join(f"SELECT * FROM rules_{t}" for t in TABLES)
_CTE["rows_all"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS evaluated_rows, count(*) FILTER (WHERE broken_rules <> '') AS failed_rows FROM eval_{t}" for t in TABLES
)

# Customer history: first load and moved customers; a version per change of the tracked columns.
_CTE["eval_moved"] = f"SELECT *, {_failed(_RULES['customers'])} AS broken_rules FROM src_moved"
_CTE["passed_history"] = "SELECT customer_id, branch_code, updated_at FROM eval_customers WHERE broken_rules = '' UNION ALL SELECT customer_id, branch_code, updated_at FROM eval_moved WHERE broken_rules = ''"
_CTE["history"] = "SELECT customer_id, branch_code, kyc_status, updated_at FROM src_customers UNION ALL SELECT customer_id, branch_code, kyc_status, updated_at FROM src_moved"
_CTE["changes"] = f"""SELECT * FROM (SELECT *, md5({_text('branch_code', 'kyc_status')}) AS attr_hash,
    lag(md5({_text('branch_code', 'kyc_status')})) OVER (PARTITION BY customer_id ORDER BY updated_at) AS before FROM history)
    WHERE before IS NULL OR before <> attr_hash"""
_CTE["versions"] = """SELECT customer_id, branch_code, kyc_status, attr_hash, updated_at AS effective_from,
    lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS effective_to FROM changes"""
_CTE["version_rows"] = "SELECT *, CASE WHEN effective_to IS NULL THEN 1 ELSE 0 END AS is_current FROM versions"

_CTE["daily_counts"] = """SELECT 'fact_transactions' AS table_name, txn_date AS day, count(*) AS value FROM fact_transactions GROUP BY ALL
    UNION ALL SELECT 'fact_payments', txn_date, count(*) FROM fact_payments GROUP BY ALL"""
_BAND14 = "OVER (PARTITION BY table_name ORDER BY day RANGE BETWEEN INTERVAL 14 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)"
_CTE["banded"] = f"""SELECT *, count(value) {_BAND14} AS baseline_days, avg(value) {_BAND14} AS baseline_mean,
    stddev_samp(value) {_BAND14} AS baseline_stddev, lag(value) OVER (PARTITION BY table_name ORDER BY day) AS previous_value FROM daily_counts"""
_CTE["bounded"] = "SELECT *, baseline_mean - 2 * baseline_stddev AS lower_bound, baseline_mean + 2 * baseline_stddev AS upper_bound FROM banded"
_CTE["anomalies"] = """SELECT *, CASE WHEN baseline_days >= 7 AND (value > upper_bound OR value < lower_bound) THEN 1 ELSE 0 END AS is_anomaly FROM bounded"""
_CTE["job_days"] = "SELECT step AS table_name, cast(run_ts AS date) AS day, cast(max(duration_s) AS double) AS value FROM src_job_runs GROUP BY ALL"
_CTE["job_banded"] = f"""SELECT *, count(value) {_BAND14} AS baseline_days, avg(value) {_BAND14} AS baseline_mean, stddev_samp(value) {_BAND14} AS baseline_stddev FROM job_days"""

_THRESHOLDS = """(VALUES ('PipelineFailures','>=',1.0,'critical'),('PipelineDurationSeconds','>',1800.0,'critical'),('FailedJobsPerHour','>=',2.0,'critical'),
    ('JobDurationSeconds','>',600.0,'warning'),('DQPassRate','<',95.0,'warning'),('QuarantinedRows','>',50.0,'warning'),('WarehouseLoadFailed','>=',1.0,'warning'),
    ('FailedSharePct','>',5.0,'alert')) t(metric, comparison, limit_value, severity)"""
_RUN_DAY = "date '2025-03-01'"
_CTE["metric_rows"] = f"""
    SELECT 'DQRulesPassed' AS metric, table_name, {_RUN_DAY} AS day, cast(count(*) FILTER (WHERE outcome = 'Passed') AS double) AS value FROM rules_all GROUP BY table_name
    UNION ALL SELECT 'DQRulesFailed', table_name, {_RUN_DAY}, cast(count(*) FILTER (WHERE outcome = 'Failed') AS double) FROM rules_all GROUP BY table_name
    UNION ALL SELECT 'RowsProcessed', table_name, {_RUN_DAY}, cast(evaluated_rows AS double) FROM rows_all
    UNION ALL SELECT 'QuarantinedRows', table_name, {_RUN_DAY}, cast(failed_rows AS double) FROM rows_all
    UNION ALL SELECT 'DQPassRate', table_name, {_RUN_DAY}, {_pct('evaluated_rows - failed_rows', 'evaluated_rows')} FROM rows_all
    UNION ALL SELECT 'FailedSharePct', table_name, {_RUN_DAY}, {_pct('failed_rows', 'evaluated_rows')} FROM rows_all
    UNION ALL SELECT 'JobDurationSeconds', table_name, day, value FROM job_days"""

_CTE["hourly"] = "SELECT *, strftime(run_ts, '%Y-%m-%d %H') AS batch FROM src_job_runs"
_CTE["run_spans"] = """SELECT cast(min(run_ts) AS date) AS day, round(max(epoch(run_ts) + duration_s) - min(epoch(run_ts)), 3) AS seconds,
    count(*) FILTER (WHERE status = 'FAILED') AS failed FROM hourly GROUP BY batch"""
_CTE["run_hours"] = """SELECT w, (SELECT count(*) FROM src_job_runs WHERE status = 'FAILED' AND run_ts >= w AND run_ts < w + INTERVAL 1 HOUR) AS failures
    FROM (SELECT DISTINCT unnest(generate_series(time_bucket(INTERVAL 5 MINUTES, run_ts) - INTERVAL 55 MINUTES, time_bucket(INTERVAL 5 MINUTES, run_ts), INTERVAL 5 MINUTES)) AS w FROM src_job_runs WHERE status = 'FAILED')"""
_CTE["run_metrics"] = """SELECT 'PipelineFailures' AS metric, day, cast(count(*) FILTER (WHERE failed > 0) AS double) AS value FROM run_spans GROUP BY day
    UNION ALL SELECT 'DailySuccess', day, cast(count(*) FILTER (WHERE failed = 0) AS double) FROM run_spans GROUP BY day
    UNION ALL SELECT 'PipelineDurationSeconds', day, max(seconds) FROM run_spans GROUP BY day
    UNION ALL SELECT 'FailedJobsPerHour', cast(w AS date), cast(max(failures) AS double) FROM run_hours GROUP BY cast(w AS date)
    UNION ALL SELECT 'WarehouseLoadFailed', cast(run_ts AS date), cast(count(*) FILTER (WHERE phase = 'warehouse' AND status = 'FAILED') AS double) FROM src_job_runs GROUP BY cast(run_ts AS date)
    UNION ALL SELECT 'SilverRows', cast(run_ts AS date), cast(coalesce(sum(rows) FILTER (WHERE phase = 'silver' AND status = 'SUCCESS'), 0) AS double) FROM src_job_runs GROUP BY cast(run_ts AS date)
    UNION ALL SELECT 'GoldRows', cast(run_ts AS date), cast(coalesce(sum(rows) FILTER (WHERE phase = 'gold' AND status = 'SUCCESS'), 0) AS double) FROM src_job_runs GROUP BY cast(run_ts AS date)"""

_CTE["payments_text"] = """SELECT concat(' ', cast(event_id + 1 AS string)) AS txn_id, concat(event_type, ' ') AS gateway_status,
    CASE WHEN event_id % 50 = 0 THEN 'abc' WHEN event_id % 51 = 0 THEN '' ELSE cast(cast(value * 20 AS decimal(18,2)) AS string) END AS processing_time_ms,
    CASE WHEN event_id % 77 = 0 THEN 'not a time' ELSE cast(ts AS string) END AS processed_timestamp FROM events"""
_LONG = "cast(trunc(try_cast(trim(processing_time_ms) AS decimal(38,6))) AS bigint)"

_MIN_ROWS = """(VALUES
        ('dim_date',3600),('dim_branch',5),('dim_customer',100),('dim_account',100),('fact_transactions',1000),('fact_payments',1000),('fact_credit_risk',100),('agg_daily_balances',10),
        ('agg_monthly_summary',5),('agg_branch_performance',5),('agg_customer_360',100)) m(table_name, min_rows)"""
_GOLD = (
    "dim_date", "dim_branch", "dim_customer", "dim_account", "fact_transactions", "fact_payments", "fact_credit_risk",
    "agg_daily_balances", "agg_monthly_summary", "agg_branch_performance", "agg_customer_360",
)
_CTE["gold_rows"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _GOLD)


def _needed(sql: str, found: dict[str, None]) -> None:
    for name, body in _CTE.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            found[name] = None


def sql(body: str, **replaced: str) -> str:
    """Prefix a query with the building blocks it uses, in dependency order."""
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    blocks = ", ".join(f"{n} AS ({replaced.get(n, _CTE[n])})" for n in found)
    return f"WITH {blocks} {body}"


# --- queries ----------------------------------------------------------------------------------

_SHAPES = {
    "branches": "branch_code branch_name city state region t:created_at",
    "customers": "customer_id first_name last_name d:date_of_birth kyc_status branch_code t:created_at t:updated_at pan_masked email_masked phone_masked",
    "accounts": "account_id customer_id account_type m:balance currency branch_code status d:opened_date t:created_at t:updated_at",
    "transactions": "txn_id account_id txn_type m:amount t:txn_timestamp channel status",
    "payment_gateway_logs": "txn_id gateway_name gateway_status response_code processing_time_ms device_type geo_location t:processed_timestamp",
    "credit_bureau_reports": "customer_id credit_score risk_grade external_active_loans m:external_overdue_amount d:bureau_pull_date",
}
_KEYS = {
    "branches": "branch_code", "customers": "customer_id", "accounts": "account_id", "transactions": "txn_id",
    "payment_gateway_logs": "txn_id", "credit_bureau_reports": "customer_id d:bureau_pull_date",
}
_GOLD_SHAPES = {
    "dim_branch": "branch_sk branch_code branch_name city state region t:source_created_at is_current t:effective_from t:effective_to",
    "dim_customer": "customer_sk customer_id first_name last_name full_name d:date_of_birth kyc_status branch_code branch_sk pan_masked email_masked phone_masked t:source_created_at t:source_updated_at is_current t:effective_from t:effective_to",
    "dim_account": "account_sk account_id customer_sk account_type m:balance currency branch_code branch_sk status d:opened_date t:source_created_at is_current t:effective_from t:effective_to",
    "fact_transactions": "txn_sk txn_id account_sk customer_sk branch_sk date_sk txn_type m:amount m:debit_amount m:credit_amount t:txn_timestamp d:txn_date channel status",
    "fact_payments": "payment_sk txn_id date_sk gateway_name gateway_status response_code processing_time_ms device_type geo_location t:processed_timestamp d:txn_date is_success",
    "fact_credit_risk": "credit_sk customer_sk customer_id date_sk credit_score risk_grade risk_band external_active_loans m:external_overdue_amount d:bureau_pull_date",
    "agg_daily_balances": "account_sk account_id d:txn_date m:total_credit m:total_debit m:net_balance_change i:txn_count avg_txn_amount agg_type",
    "agg_monthly_summary": "branch_sk branch_code branch_name year_month m:total_txn_volume i:total_txn_count m:total_credits m:total_debits avg_txn_amount i:active_accounts agg_type",
    "agg_branch_performance": "branch_sk branch_code branch_name city region m:total_txn_volume i:total_txn_count avg_txn_amount m:max_single_txn d:first_txn_date d:last_txn_date i:unique_accounts i:unique_customers agg_type",
    "agg_customer_360": "customer_sk m:lifetime_txn_volume i:lifetime_txn_count avg_txn_amount m:total_credits_received m:total_debits_made m:largest_single_txn d:first_txn_date d:last_txn_date i:active_days i:num_accounts agg_type",
}
_CALENDAR = "date_sk d:full_date day_of_month day_of_week day_name week_of_year month_num month_name quarter year is_weekend is_month_end is_month_start fiscal_year fiscal_quarter"
_VERSION = "customer_id branch_code kyc_status attr_hash t:effective_from t:effective_to is_current"
_SRC_COLS = {t: [n for n, _ in COLUMNS[t]] for t in COLUMNS}


def _select(spec: str, frm: str) -> str:
    return f"SELECT {_fmt(spec)} FROM {frm}"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    for t in TABLES:
        q[f"dq_rows_{t}"] = f"{_select(_KEYS[t] + ' broken_rules', f'eval_{t}')}"
        q[f"dq_rules_{t}"] = f"SELECT * FROM rules_{t}"
        extra = " risk_band" if t == "credit_bureau_reports" else ""
        q[f"silver_{t}"] = _select(_SHAPES[t] + extra, f"silver_{t}")
        masked = f"(SELECT * EXCLUDE (pan_number, email, phone_number), {_MASK} FROM eval_{t})" if t == "customers" else f"eval_{t}"
        q[f"quarantine_{t}"] = f"{_select(_SHAPES[t] + ' broken_rules', masked)} WHERE broken_rules <> ''"
        q[f"bronze_audit_{t}"] = f"SELECT {_fmt(_KEYS[t])}, md5({_text(*_SRC_COLS[t])}) AS row_hash, 1 AS is_active, 'bronze' AS pipeline_phase FROM src_{t}"
    for t, shape in _GOLD_SHAPES.items():
        q[t] = _select(shape, t)
    q["dim_date"] = _select(_CALENDAR, "calendar")
    q["scd2_customer"] = q["scd2_customer_batch"] = _select(_VERSION, "version_rows")
    known, fresh = "updated_at < timestamp '2024-04-01'", "updated_at >= timestamp '2024-04-01'"
    q["scd2_customer_stable_keys"] = f"""SELECT cast(coalesce(k.sk, n.sk) AS int) AS customer_sk, v.{_fmt(_VERSION)} FROM version_rows v
        LEFT JOIN (SELECT customer_id, updated_at, {_sk('customer_id', 'updated_at')} AS sk FROM history WHERE {known}) k ON v.customer_id = k.customer_id AND v.effective_from = k.updated_at
        LEFT JOIN (SELECT customer_id, updated_at, {_sk('customer_id', 'updated_at')} + (SELECT count(*) FROM history WHERE {known}) AS sk FROM history WHERE {fresh}) n
        ON v.customer_id = n.customer_id AND v.effective_from = n.updated_at"""
    q["current_customer_versions"] = _select(_VERSION, "version_rows") + " WHERE is_current = 1"
    q["changed_customer_versions"] = _select("customer_id branch_code kyc_status t:updated_at", "changes")
    q["asof_customer_version"] = """SELECT o_orderkey, o_custkey + 1 AS customer_id, v.branch_code AS branch_code, v.kyc_status AS kyc_status
        FROM orders LEFT JOIN versions v ON v.customer_id = o_custkey + 1 AND o_orderdate + INTERVAL '9000' DAY >= v.effective_from
        AND (v.effective_to IS NULL OR o_orderdate + INTERVAL '9000' DAY < v.effective_to)"""
    q["vw_branch_performance"] = _select(
        "branch_code branch_name city state region i:total_transactions m:total_volume_inr avg_txn_amount_inr m:total_credits_inr m:total_debits_inr i:unique_customers i:unique_accounts d:first_txn_date d:last_txn_date i:successful_txns i:failed_txns", "vw_branch"
    )
    q["vw_customer_risk_profile"] = _select(
        "customer_id first_name last_name kyc_status branch_name city credit_score risk_grade risk_band external_active_loans m:external_overdue_amount d:bureau_pull_date m:lifetime_txn_volume i:lifetime_txn_count i:num_accounts d:last_txn_date bank_risk_category", "vw_risk"
    )
    q["vw_daily_txn_summary"] = _select(
        "d:full_date day_name month_name year quarter is_weekend fiscal_quarter branch_name region txn_type channel i:txn_count m:total_amount_inr avg_amount_inr m:min_amount_inr m:max_amount_inr i:success_count i:fail_count", "vw_daily"
    )
    q["vw_payment_channel_analysis"] = _select(
        "d:full_date month_name year gateway_name device_type geo_location i:total_payments i:successful_payments i:failed_payments success_rate_pct avg_processing_ms min_processing_ms max_processing_ms", "vw_payment"
    )
    q["risk_profile_latest"] = """SELECT customer_id, strftime(bureau_pull_date, '%Y-%m-%d') AS bureau_pull_date, credit_score, bank_risk_category FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY bureau_pull_date DESC NULLS LAST) AS n FROM vw_risk) WHERE n = 1"""

    fact_date = "fact_transactions JOIN dim_date USING (date_sk)"
    fact_branch = "fact_transactions JOIN dim_branch USING (branch_sk)"
    q["q_quarterly"] = f"SELECT year, quarter, cast(sum(amount) AS double) AS total_amount FROM {fact_date} WHERE year = 1998 GROUP BY year, quarter"
    q["q_branch_volume"] = f"SELECT branch_name, city, count(*) AS txn_count, cast(sum(amount) AS double) AS total_volume FROM {fact_branch} GROUP BY branch_name, city"
    q["q_risk_band"] = f"SELECT risk_band, count(*) AS count, {_mean2('credit_score', 'count(*)')} AS avg_credit_score FROM fact_credit_risk GROUP BY risk_band"
    q["q_gateway_rate"] = f"SELECT gateway_name, count(*) AS total_payments, cast(sum(is_success) AS bigint) AS successful, {_pct('sum(is_success)', 'count(*)')} AS success_rate_pct FROM fact_payments GROUP BY gateway_name"
    q["q_top10_customers"] = """SELECT customer_id, full_name, cast(lifetime_txn_volume AS double) AS lifetime_txn_volume, lifetime_txn_count
        FROM agg_customer_360 JOIN dim_customer USING (customer_sk) ORDER BY agg_customer_360.lifetime_txn_volume DESC, customer_id LIMIT 10"""
    q["q_row_counts"] = "SELECT table_name, row_count FROM gold_rows"
    q["q_star_join_top5"] = """SELECT branch_name, count(*) AS txn_count, cast(sum(amount) AS double) AS total_volume
        FROM fact_transactions f JOIN dim_branch b ON f.branch_sk = b.branch_sk JOIN dim_date d ON f.date_sk = d.date_sk
        JOIN dim_customer c ON f.customer_sk = c.customer_sk GROUP BY branch_name ORDER BY sum(amount) DESC, branch_name LIMIT 5"""
    q["q_view_top3"] = "SELECT branch_name, cast(total_volume_inr AS double) AS total_volume_inr, total_transactions FROM vw_branch ORDER BY vw_branch.total_volume_inr DESC, branch_name LIMIT 3"
    q["q_kyc"] = "SELECT kyc_status, count(*) AS count FROM dim_customer WHERE is_current = 1 GROUP BY kyc_status"
    q["q_channel"] = "SELECT channel, count(*) AS txn_count, cast(sum(amount) AS double) AS total_amount FROM fact_transactions GROUP BY channel"
    q["q_customer_city"] = "SELECT customer_id, full_name, branch_name, city FROM dim_customer c JOIN (SELECT branch_sk, branch_name, city FROM dim_branch) b ON c.branch_sk = b.branch_sk ORDER BY customer_id LIMIT 5"
    q["q_customer360_risk"] = """SELECT c.customer_id, b.risk_band, cast(s.v AS double) AS total_transaction_value, s.n AS transaction_count
        FROM (SELECT customer_sk, sum(amount) AS v, count(*) AS n FROM fact_transactions GROUP BY customer_sk) s JOIN dim_customer c ON s.customer_sk = c.customer_sk
        LEFT JOIN (SELECT DISTINCT customer_sk, risk_band FROM fact_credit_risk) b ON s.customer_sk = b.customer_sk
        ORDER BY s.v DESC, c.customer_id, b.risk_band LIMIT 10"""
    q["q_daily_trend"] = "SELECT strftime(full_date, '%Y-%m-%d') AS full_date, cast(sum(total_amount_inr) AS double) AS total_amount FROM vw_daily GROUP BY vw_daily.full_date"
    q["q_branch_chart"] = "SELECT branch_name, cast(sum(total_volume_inr) AS double) AS total_volume FROM vw_branch GROUP BY branch_name"
    q["q_kpi"] = "SELECT count(*) AS total_transactions, cast(sum(amount) AS double) AS total_volume, cast(sum(debit_amount) AS double) AS total_debits, cast(sum(credit_amount) AS double) AS total_credits FROM fact_transactions"
    q["q_risk_band_counts"] = "SELECT risk_band, count(*) AS count FROM fact_credit_risk GROUP BY risk_band"
    q["q_gateway_table"] = f"""SELECT gateway_name, count(*) AS total_payments, cast(sum(is_success) AS bigint) AS successful_payments, cast(count(*) - sum(is_success) AS bigint) AS failed_payments,
        {_pct('sum(is_success)', 'count(*)')} AS success_rate_pct, max(processing_time_ms) AS max_processing_ms FROM fact_payments JOIN dim_date USING (date_sk) GROUP BY gateway_name"""
    q["q_weekend"] = f"SELECT is_weekend, count(*) AS txn_count, cast(sum(amount) AS double) AS total_amount FROM {fact_date} GROUP BY is_weekend"
    q["q_filtered_branch_year"] = q["vw_daily_txn_summary"] + " WHERE branch_name = 'NATION_3' AND year = 1998"
    q["q_excellent"] = "SELECT customer_id, strftime(bureau_pull_date, '%Y-%m-%d') AS bureau_pull_date, credit_score, risk_band FROM fact_credit_risk WHERE risk_band = 'EXCELLENT' ORDER BY customer_id, fact_credit_risk.bureau_pull_date LIMIT 5"
    q["q_branch_ranked"] = "SELECT branch_code, branch_name, cast(total_txn_volume AS double) AS total_txn_volume, total_txn_count FROM agg_branch_performance"

    # quality
    q["dq_foreign_keys"] = " UNION ALL ".join(
        f"SELECT '{c}' AS child, '{col}' AS fk_column, '{p}' AS parent, count(DISTINCT s.{col}) AS orphan_keys, count(*) AS orphan_rows FROM src_{c} s "
        f"WHERE s.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM silver_{p} p WHERE p.{pc} = s.{col})"
        for c, col, p, pc in (
            ("customers", "branch_code", "branches", "branch_code"), ("accounts", "customer_id", "customers", "customer_id"),
            ("accounts", "branch_code", "branches", "branch_code"), ("transactions", "account_id", "accounts", "account_id"),
        )
    )
    q["dq_fk_rows_transactions"] = """SELECT txn_id, account_id, CASE WHEN EXISTS (SELECT 1 FROM silver_accounts a WHERE a.account_id = s.account_id) THEN '' ELSE 'ForeignKey(account_id)' END AS broken_rules FROM src_transactions s"""
    q["orphan_transactions"] = _select(_SHAPES["transactions"], "src_transactions s") + " WHERE NOT EXISTS (SELECT 1 FROM silver_accounts a WHERE a.account_id = s.account_id)"
    formats = [
        ("Pattern(pan_number)", "", 0, "regexp_matches(pan_number, '^[A-Z]{5}[0-9]{4}[A-Z]$')"),
        ("Pattern(email)", "", 0, "regexp_matches(email, '^[^@ ]+@[^@ ]+[.][^@ ]+$')"),
        ("Pattern(phone_number)", "", 0, "regexp_matches(phone_number, '^[0-9]{10}$')"),
    ]
    strict = {
        "customers": [*_RULES["customers"], *formats, ("ForeignKey(branch_code)", "", 0, "branch_code IS NULL OR branch_code IN (SELECT branch_code FROM silver_branches)")],
        "accounts": [
            *_RULES["accounts"], ("ForeignKey(customer_id)", "", 0, "customer_id IS NULL OR customer_id IN (SELECT customer_id FROM strict_customers WHERE broken_rules = '')"),
            ("ForeignKey(branch_code)", "", 0, "branch_code IS NULL OR branch_code IN (SELECT branch_code FROM silver_branches)"),
        ],
        "transactions": [*_RULES["transactions"], ("ForeignKey(account_id)", "", 0, "account_id IS NULL OR account_id IN (SELECT account_id FROM strict_accounts WHERE broken_rules = '')")],
    }
    for t, rules in strict.items():
        _CTE[f"strict_{t}"] = f"SELECT *, {_failed(rules)} AS broken_rules FROM src_{t}"
        q[f"strict_rows_{t}"] = f"SELECT {COLUMNS[t][0][0]}, broken_rules FROM strict_{t}"
    q["dq_formats"] = f"SELECT customer_id, {_failed(formats)} AS broken_rules FROM src_customers"
    q["dq_duplicates"] = "SELECT txn_id, count(*) AS rows FROM src_transactions GROUP BY txn_id HAVING count(*) > 1"
    q["unique_flags_transactions"] = "SELECT txn_id, account_id, CASE WHEN count(*) OVER (PARTITION BY txn_id) = 1 THEN 1 ELSE 0 END AS is_unique FROM src_transactions"
    catalog_txn = [
        ("Completeness(txn_id)", "Completeness", 1.0, "txn_id IS NOT NULL"), ("Completeness(account_id)", "Completeness", 1.0, "account_id IS NOT NULL"),
        ("Completeness(txn_type)", "Completeness", 1.0, "txn_type IS NOT NULL"), ("Completeness(amount)", "Completeness", 1.0, "amount IS NOT NULL"),
        ("Completeness(txn_timestamp)", "Completeness", 1.0, "txn_timestamp IS NOT NULL"), ("Completeness(status)", "Completeness", 1.0, "status IS NOT NULL"),
        ("Uniqueness(txn_id)", "Uniqueness", 1.0, "txn_id IS NULL OR count(*) OVER (PARTITION BY txn_id) = 1"),
        ("InSet(txn_type)", "InSet", 1.0, "txn_type IN ('Debit','Credit')"), ("Compare(amount >= 0.01)", "Compare", 1.0, "amount >= 0.01"),
        ("Compare(amount <= 9999999)", "Compare", 1.0, "amount <= 9999999"), ("InSet(channel)", "InSet", 1.0, "channel IN ('UPI','ATM','NEFT','IMPS','RTGS','POS','Net Banking')"),
        ("InSet(status)", "InSet", 1.0, "status IN ('SUCCESS','FAILED','PENDING','REVERSED')"),
    ]
    q["dq_catalog_rules"] = f"SELECT * FROM ({_outcomes('transactions', catalog_txn, 'src_transactions')})"
    q["quarantine_stats"] = "SELECT table_name, cast(failed_rows AS bigint) AS quarantined_rows FROM rows_all UNION ALL SELECT 'ALL', cast(sum(failed_rows) AS bigint) FROM rows_all"
    q["dq_pass_rate"] = f"SELECT table_name, evaluated_rows, failed_rows, {_pct('evaluated_rows - failed_rows', 'evaluated_rows')} AS pass_rate_pct FROM rows_all"
    q["dq_rule_pass_rate"] = f"""SELECT table_name, count(*) FILTER (WHERE outcome = 'Passed') AS rules_passed, count(*) FILTER (WHERE outcome = 'Failed') AS rules_failed,
        {_pct("count(*) FILTER (WHERE outcome = 'Passed')", 'count(*)')} AS rule_pass_pct FROM rules_all GROUP BY table_name"""
    q["dq_gate"] = f"""SELECT r.table_name, evaluated_rows, failed_rows, {_pct('failed_rows', 'evaluated_rows')} AS failed_pct, critical_failures,
        CASE WHEN critical_failures > 0 THEN 'HALT' WHEN {_pct('failed_rows', 'evaluated_rows')} > 5 THEN 'ALERT' ELSE 'OK' END AS decision
        FROM rows_all r JOIN (SELECT table_name, count(*) FILTER (WHERE outcome = 'Failed' AND rule_kind IN ('Uniqueness','Completeness')) AS critical_failures FROM rules_all GROUP BY table_name) c ON r.table_name = c.table_name"""
    q["reconcile_layers"] = """SELECT table_name, '2025-03-01' AS load_date, evaluated_rows AS bronze_rows, evaluated_rows - failed_rows AS silver_rows, failed_rows AS quarantine_rows, 0 AS lost_rows, 'PASS' AS status FROM rows_all"""
    q["reprocess_accounts"] = _select(_SHAPES["accounts"], f"(SELECT {_SILVER['accounts']} FROM (SELECT * REPLACE (greatest(balance, 0) AS balance) FROM eval_accounts WHERE broken_rules <> ''))")
    q["top_failing_rules"] = """SELECT table_name, rule, failing_rows, evaluated_rows, rank FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY failing_rows DESC, rule) AS rank
        FROM rules_all WHERE failing_rows > 0) WHERE rank <= 3"""
    q["null_counts_customers"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS rows FROM src_customers" for c in _SRC_COLS["customers"]
    )
    q["value_range_transactions"] = "SELECT strftime(min(txn_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS min_value, strftime(max(txn_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS max_value FROM src_transactions"
    q["distinct_channels"] = "SELECT DISTINCT channel FROM src_transactions"
    q["fk_miss_rate"] = " UNION ALL ".join(
        f"SELECT '{k}' AS fk_column, count(*) FILTER (WHERE {k} = 0) AS missed_rows, count(*) AS rows, {_pct(f'count(*) FILTER (WHERE {k} = 0)', 'count(*)')} AS missed_pct FROM fact_transactions"
        for k in ("account_sk", "customer_sk", "branch_sk", "date_sk")
    )
    # masking, typing
    q["mask_customers"] = f"SELECT customer_id, {_MASK} FROM src_customers"
    q["mask_customers_alternative"] = """SELECT customer_id, CASE WHEN pan_number IS NULL THEN 'UNKNOWN' ELSE concat('MASKED_PAN_****', right(pan_number, 4)) END AS pan_masked,
        regexp_replace(email, '^[^@]+', 'cust_***') AS email_masked, CASE WHEN phone_number IS NOT NULL THEN concat('+91-XXXX-****', right(phone_number, 2)) END AS phone_masked FROM src_customers"""
    q["mask_by_catalog"] = """SELECT customer_id, concat(substr(trim(first_name),1,1), '***') AS first_name, concat(substr(trim(last_name),1,1), '***') AS last_name,
        strftime(date_trunc('year', date_of_birth), '%Y-%m-%d') AS date_of_birth, CASE WHEN pan_number IS NULL THEN 'UNKNOWN' ELSE concat(substr(pan_number,1,5), '*****') END AS pan_number,
        regexp_replace(email, '^[^@]+', '***') AS email, CASE WHEN phone_number IS NOT NULL THEN concat('XXXXXX', substr(phone_number,7,4)) END AS phone_number, kyc_status FROM src_customers"""
    q["pii_leak_check"] = "SELECT 0 AS raw_columns, count(*) FILTER (WHERE NOT contains(pan_masked, '*****') AND pan_masked <> 'UNKNOWN') AS unmasked_rows, count(*) AS rows, 1 AS clean FROM silver_customers"
    q["enforce_types_payments"] = f"""SELECT cast(trim(txn_id) AS bigint) AS txn_id, trim(gateway_status) AS gateway_status, {_LONG} AS processing_time_ms,
        strftime(try_cast(trim(processed_timestamp) AS timestamp), '%Y-%m-%d %H:%M:%S.%f') AS processed_timestamp FROM payments_text"""
    q["enforce_types_zero"] = f"SELECT cast(trim(txn_id) AS bigint) AS txn_id, coalesce({_LONG}, 0) AS processing_time_ms FROM payments_text"
    q["normalize_timestamps"] = """SELECT cast(trim(txn_id) AS bigint) AS txn_id, strftime(try_cast(trim(processed_timestamp) AS timestamp), '%Y-%m-%d %H:%M:%S.%f') AS processed_timestamp,
        CASE WHEN try_cast(trim(processed_timestamp) AS timestamp) IS NULL THEN processed_timestamp END AS processed_timestamp_raw FROM payments_text"""
    q["landing_csv_payments"] = q["stream_ingest"] = f"SELECT {_fmt(_SHAPES['payment_gateway_logs'])}, md5({_text(*_SRC_COLS['payment_gateway_logs'])}) AS row_hash FROM src_payment_gateway_logs"

    # incremental
    mark = "(SELECT max(txn_timestamp) FROM src_transactions WHERE txn_timestamp < timestamp '2000-01-01')"
    q["incremental_pull"] = _select(_SHAPES["transactions"], "src_transactions") + f" WHERE txn_timestamp >= {mark} OR txn_timestamp IS NULL"
    accounts = "account_id customer_id m:balance status t:updated_at"
    batch = "SELECT * REPLACE (cast(balance + 100 AS decimal(18,2)) AS balance, timestamp '2024-04-01' AS updated_at) FROM src_accounts WHERE account_id % 10 = 0 UNION ALL SELECT * REPLACE (account_id + 1000000000 AS account_id) FROM src_accounts WHERE account_id % 50 = 0"
    q["upsert_accounts"] = _select(accounts, f"(SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY updated_at DESC) AS n FROM (SELECT * FROM src_accounts UNION ALL {batch}))") + " WHERE n = 1"
    q["insert_only_transactions"] = f"SELECT DISTINCT {_fmt(_SHAPES['transactions'])} FROM src_transactions"
    q["union_loads_transactions"] = q["latest_transactions"] = q["insert_only_transactions"]
    q["extended_fact_transactions"] = f"""SELECT txn_sk, txn_id, account_sk, cast(amount AS double) AS amount, strftime(txn_date, '%Y-%m-%d') AS txn_date FROM (
        SELECT * REPLACE ({_sk('txn_id')} AS txn_sk) FROM fact_transactions WHERE txn_date < date '2000-01-01' UNION ALL
        SELECT * REPLACE ({_sk('txn_id')} + (SELECT count(*) FROM fact_transactions WHERE txn_date < date '2000-01-01') AS txn_sk) FROM fact_transactions WHERE txn_date >= date '2000-01-01')"""
    q["soft_delete_accounts"] = "SELECT account_id, CASE WHEN account_id % 13 = 0 THEN 0 ELSE 1 END AS is_active FROM src_accounts"
    q["extend_surrogate_keys"] = f"""SELECT * FROM (WITH known AS (SELECT customer_id, {_sk('customer_id')} AS sk FROM src_customers WHERE customer_id % 10 <> 0),
        fresh AS (SELECT customer_id, {_sk('customer_id')} + (SELECT max(sk) FROM known) AS sk FROM src_customers WHERE customer_id % 10 = 0)
        SELECT * FROM known UNION ALL SELECT * FROM fresh)"""
    q["incremental_merge_customers"] = "SELECT customer_id, branch_code, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS n FROM passed_history) WHERE n = 1"
    q["watermark_report"] = f"""SELECT 'customers' AS source, 'SUCCESS' AS status, 'INCREMENTAL_MERGE' AS load_type, 'updated_at' AS watermark_column, '2024-04-01 00:00:00.000000' AS high_water, count(*) AS rows_last_loaded FROM src_moved"""

    # observability
    q["anomaly_daily_counts"] = """SELECT table_name, strftime(day, '%Y-%m-%d') AS day, value, baseline_days, round(baseline_mean, 4) AS baseline_mean, round(baseline_stddev, 4) AS baseline_stddev,
        round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound, is_anomaly FROM anomalies"""
    q["anomaly_alerts"] = "SELECT table_name, strftime(day, '%Y-%m-%d') AS day, value, concat(cast(cast(round(lower_bound, 0) AS bigint) AS varchar), '-', cast(cast(round(upper_bound, 0) AS bigint) AS varchar)) AS expected_range FROM anomalies WHERE is_anomaly = 1"
    q["duration_anomalies"] = """SELECT table_name, strftime(day, '%Y-%m-%d') AS day, value, round(baseline_mean, 4) AS baseline_mean,
        CASE WHEN baseline_days >= 7 AND value > baseline_mean + 2 * baseline_stddev THEN 1 ELSE 0 END AS is_anomaly FROM job_banded"""
    q["dod_change"] = "SELECT table_name, strftime(day, '%Y-%m-%d') AS day, value, previous_value, round((value - previous_value) * 100.0 / previous_value, 4) AS change_pct FROM banded"
    q["deviation_rules"] = """SELECT table_name, strftime(day, '%Y-%m-%d') AS day, value, CASE WHEN (value - previous_value) * 100.0 / previous_value <= -20 THEN 1 ELSE 0 END AS dropped,
        CASE WHEN abs(value - baseline_mean) * 100.0 / baseline_mean > 10 THEN 1 ELSE 0 END AS off_baseline FROM banded"""
    q["metrics_table"] = "SELECT metric, table_name, strftime(day, '%Y-%m-%d') AS day, value FROM metric_rows"
    q["alerts_thresholds"] = f"""SELECT metric, table_name, strftime(day, '%Y-%m-%d') AS day, value, comparison, cast(limit_value AS double) AS limit_value, severity FROM metric_rows JOIN {_THRESHOLDS} USING (metric)
        WHERE (comparison = '>' AND value > limit_value) OR (comparison = '>=' AND value >= limit_value) OR (comparison = '<' AND value < limit_value)"""
    q["failure_burst"] = """SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end, count(*) AS failures FROM (
        SELECT time_bucket(INTERVAL 5 MINUTES, run_ts) - unnest(range(12)) * INTERVAL 5 MINUTES AS w FROM src_job_runs WHERE status = 'FAILED') GROUP BY w HAVING count(*) >= 2"""
    q["stream_failure_burst"] = q["failure_burst"]
    q["daily_runs_sla"] = f"""SELECT strftime(cast(run_ts AS date), '%Y-%m-%d') AS day, count(*) AS runs, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, count(*) FILTER (WHERE status <> 'SUCCESS') AS failed,
        {_pct('count(*) FILTER (WHERE duration_s < 1500)', 'count(*)')} AS within_sla_pct FROM src_job_runs GROUP BY cast(run_ts AS date)"""
    q["run_trend_30d"] = q["daily_runs_sla"].replace(
        "FROM src_job_runs GROUP BY", "FROM src_job_runs WHERE cast(run_ts AS date) > (SELECT max(cast(run_ts AS date)) FROM src_job_runs) - 30 GROUP BY"
    )
    q["last_7_runs"] = "SELECT batch_id, strftime(run_ts, '%Y-%m-%d %H:%M:%S.%f') AS run_ts, status, duration_s FROM src_job_runs ORDER BY src_job_runs.run_ts DESC, batch_id LIMIT 7"
    q["run_status"] = """SELECT step AS batch_id, strftime(min(run_ts), '%Y-%m-%d %H:%M:%S.%f') AS run_ts, CASE WHEN count(*) FILTER (WHERE status = 'SUCCESS') = count(*) THEN 'SUCCESS'
        WHEN count(*) FILTER (WHERE status = 'SUCCESS') = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status, count(*) AS steps, cast(sum(rows) AS bigint) AS total_rows, sum(duration_s) AS duration_s FROM src_job_runs GROUP BY step"""
    q["rows_by_zone"] = "SELECT phase AS zone, cast(sum(rows) AS bigint) AS rows FROM src_job_runs GROUP BY phase"
    # checks
    q["extract_customers"] = "SELECT c_custkey, c_name, c_nationkey FROM customer"
    q["verified_write"] = _select(_SHAPES["transactions"], "src_transactions")
    q["nightly_run_log"] = f"""SELECT 'bronze' AS phase, table_name AS step, 'SUCCESS' AS status, cast(evaluated_rows AS bigint) AS rows FROM rows_all
        UNION ALL SELECT 'silver', table_name, 'SUCCESS', cast(evaluated_rows - failed_rows AS bigint) FROM rows_all
        UNION ALL SELECT 'gold', table_name, 'SUCCESS', cast(row_count AS bigint) FROM gold_rows
        UNION ALL SELECT 'warehouse', 'load', 'SUCCESS', cast(sum(row_count) AS bigint) FROM gold_rows
        UNION ALL SELECT 'warehouse', table_name, CASE WHEN row_count >= min_rows THEN 'SUCCESS' ELSE 'LOW' END, cast(row_count AS bigint) FROM gold_rows JOIN {_MIN_ROWS} USING (table_name)"""
    q["warehouse_load"] = f"""SELECT table_name, CASE WHEN row_count >= min_rows THEN 'LOADED' WHEN row_count > 0 THEN 'LOW' ELSE 'FAIL' END AS status, row_count AS rows, min_rows, 0 AS too_long FROM gold_rows JOIN {_MIN_ROWS} USING (table_name)"""
    q["catalog_registration"] = q["q_row_counts"]
    q["check_fact_keys"] = " UNION ALL ".join(
        f"SELECT 'fact_transactions' AS table_name, '{n}' AS check_name, {c} AS failures, count(*) AS rows, CASE WHEN {c} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM fact_transactions"
        for n, c in [("min_rows", "CASE WHEN count(*) < 1000 THEN 1 ELSE 0 END"), ("key:txn_sk", "count(*) FILTER (WHERE coalesce(txn_sk, 0) = 0)")]
        + [(f"lookup:{k}", f"count(*) FILTER (WHERE {k} = 0)") for k in ("account_sk", "customer_sk", "branch_sk", "date_sk")]
    )
    q["profile_gold"] = """SELECT 'dim_date' AS profile, 'first' AS item, cast(min(full_date) AS varchar) AS value FROM dim_date UNION ALL SELECT 'dim_date', 'last', cast(max(full_date) AS varchar) FROM dim_date
        UNION ALL SELECT 'fact_transactions', 'debit', cast(sum(debit_amount) AS varchar) FROM fact_transactions UNION ALL SELECT 'fact_transactions', 'credit', cast(sum(credit_amount) AS varchar) FROM fact_transactions
        UNION ALL SELECT 'risk_band', risk_band, cast(count(*) AS varchar) FROM fact_credit_risk GROUP BY risk_band"""
    q["stream_dq"] = f"SELECT DISTINCT {_fmt(_SHAPES['payment_gateway_logs'])} FROM silver_payment_gateway_logs"

    q["reprocess_written_back"] = f"""SELECT account_id, cast(balance AS double) AS balance, 'PASSED' AS dq_status, 'silver' AS zone FROM silver_accounts
        UNION ALL SELECT account_id, 0, 'PASSED', 'silver' FROM eval_accounts WHERE broken_rules = 'Compare(balance >= 0)'
        UNION ALL SELECT account_id, cast(balance AS double), CASE WHEN broken_rules = 'Compare(balance >= 0)' THEN 'REPROCESSED' ELSE 'FAILED' END, 'quarantine' FROM eval_accounts WHERE broken_rules <> ''"""
    written = {"branches": "eval_branches"} | {t: f"strict_{t}" for t in ("customers", "accounts", "transactions")}
    q["reconcile_written"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '2025-03-01' AS load_date, (SELECT count(*) FROM src_{t}) AS bronze_rows, count(*) FILTER (WHERE broken_rules = '') AS silver_rows, "
        f"count(*) FILTER (WHERE broken_rules <> '') AS quarantine_rows, (SELECT count(*) FROM src_{t}) - count(*) AS lost_rows, "
        f"CASE WHEN (SELECT count(*) FROM src_{t}) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM {frm}" for t, frm in written.items()
    )

    def checked(table: str, name: str, failures: str, frm: str) -> str:
        return f"SELECT '{table}' AS table_name, '{name}' AS check_name, cast({failures} AS bigint) AS failures, count(*) AS rows, CASE WHEN {failures} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {frm}"

    few = "CASE WHEN count(*) < 5 THEN 1 ELSE 0 END"
    q["check_bronze"] = " UNION ALL ".join(checked(t, n, few if n == "min_rows" else "0", f"src_{t}") for t in TABLES for n in ("min_rows", "row_hash", "is_active", "audit_not_null"))
    unmasked = "count(*) FILTER (WHERE pan_masked NOT LIKE '%*****' AND pan_masked <> 'UNKNOWN')"
    q["check_silver"] = " UNION ALL ".join(
        [checked(t, n, few if n == "min_rows" else "0", f"silver_{t}") for t in TABLES for n in ("min_rows", "dq_status", "columns_removed")] + [checked("customers", "pan_masked", unmasked, "silver_customers")]
    )
    q["check_source_branches"] = " UNION ALL ".join([checked("branches", "min_rows", few, "src_branches"), checked("branches", "has:BR001", "CASE WHEN count(*) FILTER (WHERE branch_code = 'BR001') = 0 THEN 1 ELSE 0 END", "src_branches")])

    # landing files
    line = "concat_ws(',', cast(event_id + 1 AS varchar), event_type, cast(cast(floor(value * 20) AS bigint) AS varchar), cast(user_id AS varchar))"
    batch = "CASE WHEN event_id % 3 <> 0 THEN 'b1' ELSE 'b2' END AS batch_id"
    bad = "(event_id % 40 = 0 OR event_id % 41 = 0)"
    q["landing_csv_corrupt"] = f"SELECT CASE WHEN event_id % 40 = 0 THEN concat({line}, ',surplus') ELSE concat_ws(',', cast(event_id + 1 AS varchar), event_type) END AS line, 'MALFORMED_LINE' AS quarantine_reason, {batch} FROM events WHERE {bad}"
    q["landing_files_rows"] = f"SELECT cast(event_id + 1 AS bigint) AS txn_id, event_type AS kind, cast(floor(value * 20) AS bigint) AS processing_time_ms, cast(user_id AS bigint) AS payer, {batch}, 'gateway_csv' AS src_system FROM events WHERE NOT {bad}"
    q["batch_manifest"] = f"SELECT 'gateway' AS source, {batch}, 2 AS files_processed, count(*) FILTER (WHERE NOT {bad}) AS rows, count(*) FILTER (WHERE {bad}) AS corrupt_rows, 'PARTIAL' AS status FROM events GROUP BY ALL"

    # days without rows, whole runs
    dense = {"daily_counts": """SELECT table_name, day, coalesce(value, 0) AS value FROM (
        SELECT table_name, cast(unnest(generate_series(min(day), greatest(max(day), date '2024-02-15'), INTERVAL 1 DAY)) AS date) AS day FROM found GROUP BY table_name) LEFT JOIN found USING (table_name, day)"""}
    q["anomaly_dense_days"] = q["anomaly_daily_counts"]
    q["deviation_dense_days"] = """SELECT table_name, strftime(day, '%Y-%m-%d') AS day, value, CASE WHEN previous_value > 0 AND value <= 0.8 * previous_value THEN 1 ELSE 0 END AS dropped,
        CASE WHEN baseline_mean = 0 THEN cast(value <> 0 AS int) WHEN abs(value - baseline_mean) * 100.0 / baseline_mean > 10 THEN 1 ELSE 0 END AS off_baseline FROM banded"""
    spans = "(SELECT run_ts AS s, run_ts + to_microseconds(cast(duration_s * 60000000 AS bigint)) AS e FROM src_job_runs WHERE duration_s > 0)"
    q["concurrent_runs"] = f"""SELECT strftime(moment, '%Y-%m-%d') AS day, max(active) AS peak_runs, strftime(arg_min(moment, (-active, moment)), '%Y-%m-%d %H:%M:%S.%f') AS peak_at
        FROM (SELECT moment, count(r.s) AS active FROM (SELECT s AS moment FROM {spans} UNION SELECT e FROM {spans}) m LEFT JOIN {spans} r ON r.s <= moment AND moment < r.e GROUP BY moment)
        WHERE cast(moment AS date) IN (SELECT cast(s AS date) FROM {spans}) GROUP BY strftime(moment, '%Y-%m-%d')"""
    q["whole_run_metrics"] = "SELECT metric, 'pipeline' AS table_name, strftime(day, '%Y-%m-%d') AS day, value FROM run_metrics"
    q["rows_by_zone_day"] = "SELECT phase AS zone, strftime(run_ts, '%Y-%m-%d') AS day, cast(sum(rows) AS bigint) AS rows, count(*) FILTER (WHERE status = 'FAILED') AS failed_steps FROM src_job_runs GROUP BY phase, strftime(run_ts, '%Y-%m-%d')"
    failing = "count(*) FILTER (WHERE status = 'FAILED')"
    q["job_trend_30d"] = f"""SELECT step, strftime(run_ts, '%Y-%m-%d') AS day, count(*) AS runs, {_pct(failing, 'count(*)')} AS failure_rate_pct, max(duration_s) AS max_duration_s FROM src_job_runs
        WHERE cast(run_ts AS date) > (SELECT max(cast(run_ts AS date)) - 30 FROM src_job_runs) GROUP BY step, strftime(run_ts, '%Y-%m-%d')"""
    single = " AND ".join(f"coalesce({ok}, true)" for _, kind, _, ok in _RULES["transactions"] if kind != "Uniqueness")
    broken = f"count(*) FILTER (WHERE NOT ({single}))"
    q["quality_trend_30d"] = f"""SELECT 'transactions' AS table_name, strftime(txn_timestamp, '%Y-%m-%d') AS day, count(*) AS evaluated_rows, {broken} AS quarantined_rows, {_pct(f'count(*) - {broken}', 'count(*)')} AS pass_rate_pct
        FROM src_transactions WHERE cast(txn_timestamp AS date) > (SELECT max(cast(txn_timestamp AS date)) - 30 FROM src_transactions) GROUP BY strftime(txn_timestamp, '%Y-%m-%d')"""
    q["alerts_whole_runs"] = f"""SELECT metric, 'pipeline' AS table_name, strftime(day, '%Y-%m-%d') AS day, value, comparison, limit_value, severity FROM run_metrics JOIN {_THRESHOLDS} USING (metric)
        WHERE (comparison = '>' AND value > limit_value) OR (comparison = '>=' AND value >= limit_value) OR (comparison = '<' AND value < limit_value)"""

    # nights: the same building blocks over the state of the sources in the second night
    again = {
        "src_transactions": f"SELECT {_cols('transactions', CORRECTED)} FROM orders",
        "src_customers": f"SELECT {_cols('customers')} FROM customer WHERE c_custkey % 10 <> 0 UNION ALL SELECT {_cols('customers', MOVED)} FROM customer WHERE c_custkey % 10 = 0",
        "src_branches": f"SELECT {_cols('branches', RENAMED)} FROM {_FROM['branches']}",
    }
    second = {
        "nightly_second_run": "SELECT txn_id, a.account_id, c.customer_id, b.branch_code, date_sk, cast(amount AS double) AS amount, cast(debit_amount AS double) AS debit_amount, "
        "cast(credit_amount AS double) AS credit_amount, strftime(txn_date, '%Y-%m-%d') AS txn_date, f.status FROM fact_transactions f LEFT JOIN dim_account a ON f.account_sk = a.account_sk "
        "LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk LEFT JOIN dim_branch b ON f.branch_sk = b.branch_sk",
        "second_night_customer_360": _select(_GOLD_SHAPES["agg_customer_360"].replace("customer_sk ", "customer_id home_branch "), "(SELECT a.*, customer_id, branch_code AS home_branch FROM agg_customer_360 a LEFT JOIN dim_customer c ON a.customer_sk = c.customer_sk)"),
        # Months of late rows, and the months that corrected rows left and went to.
        "second_night_parts": f"""SELECT strftime(txn_date, '%Y-%m') AS part, count(*) AS rows, max(CASE WHEN strftime(txn_date, '%Y-%m') IN (
            SELECT strftime(cast(o_orderdate AS date), '%Y-%m') FROM orders JOIN fact_transactions ON txn_id = o_orderkey + 1 WHERE ({LATE}) OR ({FIXED})
            UNION ALL SELECT strftime(cast(o_orderdate AS date) + 65, '%Y-%m') FROM orders JOIN fact_transactions ON txn_id = o_orderkey + 1 WHERE {FIXED} AND o_orderkey % 2 = 0) THEN 1 ELSE 0 END) AS written
            FROM fact_transactions GROUP BY ALL""",
    }
    for t, sk in (("agg_daily_balances", "account_sk "), ("agg_monthly_summary", "branch_sk "), ("agg_branch_performance", "branch_sk ")):
        second[f"second_night_{t.removeprefix('agg_')}"] = _select(_GOLD_SHAPES[t].replace(sk, "", 1), t)
    ahead = {"src_transactions": f"SELECT {_cols('transactions', AHEAD)} FROM orders"}
    q["incremental_future_row"] = "SELECT txn_id, cast(amount AS double) AS amount, strftime(txn_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS txn_timestamp FROM silver_transactions"
    q["rerun_same_date"] = """SELECT 'bronze' AS zone, count(*) AS rows, 'attempt-1' AS batch_id FROM src_accounts UNION ALL SELECT 'silver', count(*), 'attempt-1' FROM silver_accounts
        UNION ALL SELECT 'quarantine', count(*), max('attempt-1') FROM eval_accounts WHERE broken_rules <> ''"""
    # Planted gaps, filled with zeros.
    counted = """(SELECT * FROM (SELECT 'fact_transactions' AS table_name, txn_date AS day, count(*) AS value FROM fact_transactions GROUP BY ALL
        UNION ALL SELECT 'fact_payments', txn_date, count(*) FROM fact_payments GROUP BY ALL) WHERE day(day) <> 13) found"""
    dense = {name: body.replace("found GROUP BY", f"{counted} GROUP BY").replace("LEFT JOIN found", f"LEFT JOIN {counted}") for name, body in dense.items()}
    swaps = {name: again for name in second} | {name: dense for name in ("anomaly_dense_days", "deviation_dense_days")} | {"incremental_future_row": ahead}
    q |= second

    own_span = {"dim_date": "SELECT cast(min(o_orderdate) AS timestamp) AS lo, cast(max(o_orderdate) AS timestamp) AS hi FROM orders"}
    return {name: sql(body, **({"span": own_span[name]} if name in own_span else {}), **swaps.get(name, {})) for name, body in q.items()}
