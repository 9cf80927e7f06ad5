"""How the given tables stand in for the bank's source tables.

The expressions mean the same in Spark SQL and DuckDB, so the reports and their SQL counterparts
start from equal rows. They plant defects (missing and malformed values, repeated and dangling
keys) so that no rule stays idle. Keys are moved up by one because 0 means "unknown".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BRANCH = "concat('BR', lpad(cast({k}+1 as string),3,'0'))"
_EPOCH = "cast(date '2020-01-01' as timestamp)"

COLUMNS: dict[str, list[tuple[str, str]]] = {
    "branches": [
        ("branch_code", _BRANCH.format(k="n_nationkey")),
        ("branch_name", "case when n_nationkey%5=0 then concat(' ',n_name) else n_name end"),
        ("city", "n_name"),
        ("state", "n_name"),
        ("region", "lower(r_name)"),
        ("created_at", _EPOCH),
    ],
    "customers": [
        ("customer_id", "cast(c_custkey+1 as int)"),
        ("first_name", "concat(split_part(c_name,'#',1),' ')"),
        ("last_name", "split_part(c_name,'#',2)"),
        ("date_of_birth", "date '1960-01-01' + cast((c_custkey*37)%15000 as int)"),
        ("pan_number", "case when c_custkey%29=0 then null else concat('ABCDE',lpad(cast(c_custkey%10000 as string),4,'0'),'F') end"),
        ("email", "case when c_custkey%23=0 then null else concat('user',cast(c_custkey as string),'@bank.example') end"),
        ("phone_number", "case when c_custkey%31=0 then '12345' when c_custkey%17=0 then null else concat('9',lpad(cast(c_custkey as string),9,'0')) end"),
        ("kyc_status", "case when c_custkey%41=0 then null when c_mktsegment='FURNITURE' then 'PENDING' when c_mktsegment='MACHINERY' then 'REJECTED' when c_custkey%43=0 then 'verified' else 'VERIFIED' end"),
        ("branch_code", _BRANCH.format(k="c_nationkey")),
        ("created_at", _EPOCH),
        ("updated_at", "cast(date '2024-01-01' + cast(c_custkey%60 as int) as timestamp)"),
    ],
    "accounts": [
        ("account_id", "cast(100001+c_custkey as bigint)"),
        ("customer_id", "cast(c_custkey+1 as int)"),
        ("account_type", "case when c_custkey%3=0 then 'Current' else 'Savings' end"),
        ("balance", "cast(c_acctbal as decimal(18,2))"),
        ("currency", "'INR'"),
        ("branch_code", _BRANCH.format(k="c_nationkey")),
        ("status", "case when c_custkey%11=0 then 'DORMANT' when c_custkey%7=0 then 'FROZEN' else 'ACTIVE' end"),
        ("opened_date", "date '2015-01-01' + cast(c_custkey%3000 as int)"),
        ("created_at", _EPOCH),
        ("updated_at", "cast(date '2024-01-01' + cast(c_custkey%60 as int) as timestamp)"),
    ],
    "transactions": [
        ("txn_id", "cast(o_orderkey+1 as bigint)"),
        ("account_id", "cast(100001+o_custkey as bigint)"),
        ("txn_type", "case when o_orderkey%503=0 then 'Transfer' when o_orderkey%3=0 then 'Credit' else 'Debit' end"),
        ("amount", "cast(o_totalprice as decimal(18,2))"),
        ("txn_timestamp", "cast(o_orderdate as timestamp)"),
        ("channel", "case o_orderpriority when '1-URGENT' then 'UPI' when '2-HIGH' then 'ATM' when '3-MEDIUM' then 'NEFT' when '5-LOW' then 'IMPS' else null end"),
        ("status", "case when o_orderkey%19=0 then 'REVERSED' when o_orderstatus='F' then 'SUCCESS' when o_orderstatus='O' then 'FAILED' else 'PENDING' end"),
    ],
    "payment_gateway_logs": [
        ("txn_id", "cast(event_id+1 as bigint)"),
        ("gateway_name", "case user_id%5 when 0 then 'Stripe' when 1 then 'BillDesk' when 2 then 'PayU' else 'Razorpay' end"),
        ("gateway_status", "case event_type when 'error' then 'FAILED' when 'signup' then 'PENDING' when 'view' then 'TIMEOUT' else 'SUCCESS' end"),
        ("response_code", "case when event_id%101=0 then '0' when event_type='error' then '05' else '00' end"),
        ("processing_time_ms", "cast(floor(value*20) as bigint)"),
        ("device_type", "case event_id%4 when 0 then 'Mobile' when 1 then 'ATM' when 2 then 'POS' else 'Web' end"),
        ("geo_location", "case user_id%4 when 0 then 'Mumbai' when 1 then 'Delhi' when 2 then 'Bangalore' else 'Ahmedabad' end"),
        ("processed_timestamp", "cast(ts as timestamp)"),
    ],
    "credit_bureau_reports": [
        ("customer_id", "cast(c_custkey+1 as int)"),
        ("credit_score", "cast(280+(c_custkey*53+m*17)%640 as int)"),
        ("risk_grade", "case when (c_custkey*53+m*17)%640>=420 then 'LOW' when (c_custkey*53+m*17)%640>=270 then 'MEDIUM' else 'HIGH' end"),
        ("external_active_loans", "cast(c_custkey%6 as int)"),
        ("external_overdue_amount", "cast((c_custkey*131)%500000 as decimal(18,2))"),
        ("bureau_pull_date", "case when m=1 then date '2025-01-31' else date '2025-02-28' end"),
    ],
    # Log of job runs: every event is a run of one of eight jobs, an error a failed one.
    "job_runs": [
        ("batch_id", "concat('run', cast(event_id as string))"),
        ("run_ts", "cast(ts as timestamp)"),
        ("phase", "case user_id%4 when 0 then 'bronze' when 1 then 'silver' when 2 then 'gold' else 'warehouse' end"),
        ("step", "concat('job', cast(user_id%8 as string))"),
        ("status", "case when event_type='error' then 'FAILED' else 'SUCCESS' end"),
        ("rows", "cast(floor(value*100) as bigint)"),
        ("duration_s", "cast(floor(value*10) as double)"),
    ],
}

# Second customer load: every tenth customer moved to the next branch.
MOVED = {
    "branch_code": "concat('BR', lpad(cast((c_nationkey+1)%25+1 as string),3,'0'))",
    "updated_at": "cast(date '2024-04-01' as timestamp)",
}


def columns(source: str, changes: dict[str, str] | None = None) -> list[str]:
    changed = changes or {}
    return [f"{changed.get(name, text)} AS {name}" for name, text in COLUMNS[source]]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table as a plan over the given tables."""
    if name == "branches":
        region = read(spark, sf_dir, "region")
        base = read(spark, sf_dir, "nation").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    elif name in ("customers", "accounts"):
        base = read(spark, sf_dir, "customer")
    elif name == "transactions":
        # Every 997th order comes twice.
        times = F.when(F.col("o_orderkey") % 997 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        base = read(spark, sf_dir, "orders").withColumn("_copy", F.explode(times))
    elif name in ("payment_gateway_logs", "job_runs"):
        base = read(spark, sf_dir, "events")
    elif name == "credit_bureau_reports":
        # Two pulls per customer.
        base = read(spark, sf_dir, "customer").withColumn("m", F.explode(F.array(F.lit(1), F.lit(2))))
    else:
        raise ValueError(f"unknown source {name!r}")
    out = base.selectExpr(*columns(name))
    return out.withColumns({f.name: F.col(f.name).cast("timestamp") for f in out.schema if f.dataType.typeName() == "timestamp_ntz"})


def moved_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").filter("c_custkey % 10 = 0").selectExpr(*columns("customers", MOVED))


TABLES = ("branches", "customers", "accounts", "transactions", "payment_gateway_logs", "credit_bureau_reports")
