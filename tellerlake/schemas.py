"""Source contracts and warehouse table definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type: str
    nullable: bool = True
    pk: bool = False
    pii: bool = False
    classification: str | None = None
    valid_values: tuple[str, ...] | None = None
    valid_range: tuple[float, float] | None = None


def _c(name: str, type: str, **kw) -> ColumnContract:
    return ColumnContract(name, type, **kw)


_KEY = {"nullable": False, "pk": True}
_REQUIRED = {"nullable": False}
_INTERNAL = {"pii": True, "classification": "PII-INTERNAL"}
_CONFIDENTIAL = {"pii": True, "classification": "PII-CONFIDENTIAL"}

# Columns, types, domains and personal-data classes of the source tables.
CATALOG: dict[str, list[ColumnContract]] = {
    "branches": [
        _c("branch_code", "string", **_KEY),
        _c("branch_name", "string", **_REQUIRED),
        _c("city", "string", **_REQUIRED),
        _c("state", "string", **_REQUIRED),
        _c("region", "string"),
        _c("created_at", "timestamp", **_REQUIRED),
    ],
    "customers": [
        _c("customer_id", "int", **_KEY),
        _c("first_name", "string", **_REQUIRED, **_INTERNAL),
        _c("last_name", "string", **_REQUIRED, **_INTERNAL),
        _c("date_of_birth", "date", **_REQUIRED, **_CONFIDENTIAL),
        _c("pan_number", "string", **_CONFIDENTIAL),
        _c("email", "string", **_CONFIDENTIAL),
        _c("phone_number", "string", **_CONFIDENTIAL),
        _c("kyc_status", "string", **_REQUIRED, valid_values=("VERIFIED", "PENDING", "REJECTED")),
        _c("branch_code", "string", **_REQUIRED),
        _c("created_at", "timestamp", **_REQUIRED),
        _c("updated_at", "timestamp", **_REQUIRED),
    ],
    "accounts": [
        _c("account_id", "bigint", **_KEY),
        _c("customer_id", "int", **_REQUIRED),
        _c("account_type", "string", **_REQUIRED, valid_values=("Savings", "Current")),
        _c("balance", "decimal(18,2)", **_REQUIRED, valid_range=(0, 99999999)),
        _c("currency", "string", **_REQUIRED, valid_values=("INR",)),
        _c("branch_code", "string", **_REQUIRED),
        _c("status", "string", **_REQUIRED, valid_values=("ACTIVE", "CLOSED", "FROZEN", "DORMANT")),
        _c("opened_date", "date", **_REQUIRED),
        _c("created_at", "timestamp"),
        _c("updated_at", "timestamp", **_REQUIRED),
    ],
    "transactions": [
        _c("txn_id", "bigint", **_KEY),
        _c("account_id", "bigint", **_REQUIRED),
        _c("txn_type", "string", **_REQUIRED, valid_values=("Debit", "Credit")),
        _c("amount", "decimal(18,2)", **_REQUIRED, valid_range=(0.01, 9999999)),
        _c("txn_timestamp", "timestamp", **_REQUIRED),
        _c("channel", "string", valid_values=("UPI", "ATM", "NEFT", "IMPS", "RTGS", "POS", "Net Banking")),
        _c("status", "string", **_REQUIRED, valid_values=("SUCCESS", "FAILED", "PENDING", "REVERSED")),
        _c("created_at", "timestamp"),
    ],
    "payment_gateway_logs": [
        _c("txn_id", "bigint", **_KEY),
        _c("gateway_name", "string", **_REQUIRED, valid_values=("Stripe", "BillDesk", "PayU", "Razorpay")),
        _c("gateway_status", "string", **_REQUIRED, valid_values=("SUCCESS", "FAILED", "PENDING", "TIMEOUT")),
        _c("response_code", "string", **_REQUIRED),
        _c("processing_time_ms", "bigint", **_REQUIRED, valid_range=(0, 10000)),
        _c("device_type", "string", **_REQUIRED, valid_values=("Mobile", "ATM", "POS", "Web")),
        _c("geo_location", "string"),
        _c("processed_timestamp", "timestamp", **_REQUIRED),
    ],
    "credit_bureau_reports": [
        _c("customer_id", "bigint", **_KEY),
        _c("credit_score", "bigint", **_REQUIRED, valid_range=(300, 900)),
        _c("risk_grade", "string", **_REQUIRED, valid_values=("LOW", "MEDIUM", "HIGH")),
        _c("external_active_loans", "bigint", **_REQUIRED, valid_range=(0, 20)),
        _c("external_overdue_amount", "decimal(18,2)", **_REQUIRED, valid_range=(0, 500000)),
        _c("bureau_pull_date", "date", **_KEY),
    ],
}

_CATALOG_SCHEMA = """table_name string, position int, column_name string, data_type string, nullable int,
    is_pk int, is_pii int, classification string, valid_values string, valid_range string"""


def catalog_df(spark: SparkSession) -> DataFrame:
    """The contracts as a table."""
    rows = [
        (
            table,
            i,
            c.name,
            c.type,
            int(c.nullable),
            int(c.pk),
            int(c.pii),
            c.classification,
            "|".join(c.valid_values) if c.valid_values else None,
            f"{c.valid_range[0]}..{c.valid_range[1]}" if c.valid_range else None,
        )
        for table, contracts in CATALOG.items()
        for i, c in enumerate(contracts, 1)
    ]
    return spark.createDataFrame(rows, _CATALOG_SCHEMA)


def landing_types(table: str) -> dict[str, str]:
    """Target types of a landing table for :func:`enforce_types`."""
    short = {"int": "bigint", "decimal(18,2)": "decimal"}
    return {c.name: short.get(c.type, c.type) for c in CATALOG[table]}


def source_ddl(table: str) -> str:
    return ", ".join(f"{c.name} {c.type}" for c in CATALOG[table])


# Columns and types of the warehouse tables. Dates and times are typed here.
WAREHOUSE: dict[str, str] = {
    "dim_date": """date_sk bigint, full_date date, day_of_month bigint, day_of_week bigint,
        day_name varchar(20), week_of_year int, month_num int, month_name varchar(20), quarter int,
        year int, is_weekend int, is_month_end int, is_month_start int, fiscal_year int,
        fiscal_quarter varchar(5)""",
    "dim_branch": """branch_sk int, branch_code varchar(10), branch_name varchar(100),
        city varchar(100), state varchar(100), region varchar(100), source_created_at timestamp,
        gold_load_ts timestamp, gold_layer varchar(20), is_current int, effective_from timestamp,
        effective_to timestamp""",
    "dim_customer": """customer_sk int, customer_id int, first_name varchar(100),
        last_name varchar(100), full_name varchar(200), date_of_birth date, kyc_status varchar(50),
        branch_code varchar(10), branch_sk int, pan_masked varchar(20), email_masked varchar(150),
        phone_masked varchar(20), source_created_at timestamp, source_updated_at timestamp,
        gold_load_ts timestamp, gold_layer varchar(20), is_current int, effective_from timestamp,
        effective_to timestamp""",
    "dim_account": """account_sk int, account_id bigint, customer_sk int, account_type varchar(50),
        balance decimal(18,2), currency varchar(10), branch_code varchar(10), branch_sk int,
        status varchar(50), opened_date date, source_created_at timestamp, gold_load_ts timestamp,
        gold_layer varchar(20), is_current int, effective_from timestamp, effective_to timestamp""",
    "fact_transactions": """txn_sk bigint, txn_id bigint, account_sk int, customer_sk int,
        branch_sk int, date_sk bigint, txn_type varchar(20), amount decimal(18,2),
        debit_amount decimal(18,2), credit_amount decimal(18,2), txn_timestamp timestamp,
        txn_date date, channel varchar(50), status varchar(50), gold_load_ts timestamp,
        gold_layer varchar(20)""",
    "fact_payments": """payment_sk bigint, txn_id bigint, date_sk bigint, gateway_name varchar(50),
        gateway_status varchar(50), response_code varchar(10), processing_time_ms bigint,
        device_type varchar(50), geo_location varchar(100), processed_timestamp timestamp,
        txn_date date, is_success int, gold_load_ts timestamp, gold_layer varchar(20)""",
    "fact_credit_risk": """credit_sk bigint, customer_sk int, customer_id int, date_sk bigint,
        credit_score int, risk_grade varchar(20), risk_band varchar(20), external_active_loans int,
        external_overdue_amount decimal(18,2), bureau_pull_date date, gold_load_ts timestamp,
        gold_layer varchar(20)""",
    "agg_daily_balances": """account_sk int, account_id bigint, txn_date date,
        total_credit decimal(18,2), total_debit decimal(18,2), net_balance_change decimal(18,2),
        txn_count bigint, avg_txn_amount decimal(18,2), gold_load_ts timestamp, agg_type varchar(50)""",
    "agg_monthly_summary": """branch_sk int, branch_code varchar(10), branch_name varchar(100),
        year_month varchar(7), total_txn_volume decimal(18,2), total_txn_count bigint,
        total_credits decimal(18,2), total_debits decimal(18,2), avg_txn_amount decimal(18,2),
        active_accounts bigint, gold_load_ts timestamp, agg_type varchar(50)""",
    "agg_branch_performance": """branch_sk int, branch_code varchar(10), branch_name varchar(100),
        city varchar(100), region varchar(100), total_txn_volume decimal(18,2),
        total_txn_count bigint, avg_txn_amount decimal(18,2), max_single_txn decimal(18,2),
        first_txn_date date, last_txn_date date, unique_accounts bigint, unique_customers bigint,
        gold_load_ts timestamp, agg_type varchar(50)""",
    "agg_customer_360": """customer_sk int, lifetime_txn_volume decimal(18,2),
        lifetime_txn_count bigint, avg_txn_amount decimal(18,2),
        total_credits_received decimal(18,2), total_debits_made decimal(18,2),
        largest_single_txn decimal(18,2), first_txn_date date, last_txn_date date,
        active_days bigint, num_accounts bigint, gold_load_ts timestamp, agg_type varchar(50)""",
}

# Fewest rows a loaded warehouse table should have.
MIN_ROWS = {
    "dim_date": 3600,
    "dim_branch": 5,
    "dim_customer": 100,
    "dim_account": 100,
    "fact_transactions": 1000,
    "fact_payments": 1000,
    "fact_credit_risk": 100,
    "agg_daily_balances": 10,
    "agg_monthly_summary": 5,
    "agg_branch_performance": 5,
    "agg_customer_360": 100,
}


def warehouse_columns(table: str) -> list[tuple[str, str]]:
    """Column names and types of a warehouse table, in order."""
    parts = " ".join(WAREHOUSE[table].split()).replace(", ", "\n").split("\n")
    return [(p.split(" ", 1)[0], p.split(" ", 1)[1]) for p in parts]
