"""Bronze to silver: check raw values, split, then mask and standardise what passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.banding import risk_band
from tellerlake.functions.masking import mask_pii
from tellerlake.operators.skew import broadcastable
from tellerlake.quality.engine import drop_helpers, evaluate_rows, failing_keys, reason_text, rule_outcomes, split
from tellerlake.quality.rules import FOREIGN_KEYS, FORMAT_RULES, RULES, Rule, foreign_key_rules
from tellerlake.session import settle


def _trim(c: str) -> Column:
    return F.trim(F.col(c))


def _upper(c: str) -> Column:
    return F.upper(F.trim(F.col(c)))


def _money(c: str) -> Column:
    return F.round(F.col(c), 2)


@dataclass(frozen=True)
class TableSpec:
    name: str
    trim: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    money: tuple[str, ...] = ()
    masked: bool = False
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ("load_date",)
    extra_transform: Callable[[DataFrame], DataFrame] | None = None

    @property
    def rules(self) -> Sequence[Rule]:
        return RULES[self.name]


# What is trimmed, upper-cased and rounded in every table, and how it is partitioned.
SPEC: dict[str, TableSpec] = {
    "branches": TableSpec(
        "branches", trim=("branch_name", "city", "state"), upper=("branch_code", "region")
    ),
    "customers": TableSpec(
        "customers", trim=("first_name", "last_name", "branch_code"), upper=("kyc_status",), masked=True
    ),
    "accounts": TableSpec(
        "accounts", trim=("account_type", "branch_code"), upper=("status", "currency"), money=("balance",)
    ),
    "transactions": TableSpec(
        "transactions", trim=("txn_type",), upper=("status", "channel"), money=("amount",)
    ),
    "payment_gateway_logs": TableSpec(
        "payment_gateway_logs",
        trim=("gateway_name", "device_type", "geo_location", "response_code"),
        upper=("gateway_status",),
    ),
    "credit_bureau_reports": TableSpec(
        "credit_bureau_reports",
        derived={"risk_band": lambda: risk_band(F.col("credit_score"))},
        partition_by=("load_date", "bureau_pull_date"),
    ),
}


# Parents before children, as the foreign keys say.
LEVELS = (("branches",), ("customers",), ("accounts",), ("transactions", "payment_gateway_logs", "credit_bureau_reports"))


def strict_rules(table: str) -> list[Rule]:
    """The rules of a table with formats of personal identifiers and foreign keys among them."""
    return [*RULES[table], *(FORMAT_RULES if SPEC[table].masked else ()), *foreign_key_rules(table)]


def parents_of(table: str) -> list[str]:
    return sorted({parent for child, _, parent, _ in FOREIGN_KEYS if child == table})


@dataclass(frozen=True)
class SilverResult:
    """The three outputs of a table; all of them are lazy plans over the same evaluated rows."""

    evaluated: DataFrame
    silver: DataFrame
    quarantine: DataFrame
    outcomes: DataFrame


def standardise(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Clean-up of rows that passed, as one projection."""
    clean = {c: _trim(c) for c in spec.trim}
    clean |= {c: _upper(c) for c in spec.upper}
    clean |= {c: _money(c) for c in spec.money}
    clean |= {name: make() for name, make in spec.derived.items()}
    out = mask_pii(df) if spec.masked else df
    out = out.withColumns(clean) if clean else out
    return spec.extra_transform(out) if spec.extra_transform else out


def build_silver(
    bronze: DataFrame,
    spec: TableSpec,
    run_ts: datetime,
    keep_raw: bool = False,
    rules: Sequence[Rule] | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    once: bool = False,
) -> SilverResult:
    """Evaluate the rules on raw values and derive silver, quarantine and rule outcomes.

    Quarantined rows of every table are kept with the rules they broke; personal data in them is
    masked unless ``keep_raw`` is set. ``once`` writes the evaluated rows first where keys that break a rule are too many for a
    broadcast, so that the three outputs do not each shuffle all rows. Where they are few, an output is one pass over ``bronze``.
    """
    checked = list(rules if rules is not None else spec.rules)
    failing = failing_keys(bronze, checked, parents)
    evaluated = evaluate_rows(bronze, checked, failing=failing)
    if once and not all(broadcastable(keys) for keys in failing.values()):
        evaluated = settle(evaluated, f"evaluated-{spec.name}")
    passed, failed = split(evaluated)
    ts = F.lit(run_ts).cast("timestamp")
    silver = standardise(drop_helpers(passed), spec).withColumns(
        {"silver_load_ts": ts, "silver_layer": F.lit("silver"), "dq_status": F.lit("PASSED")}
    )
    reasons = failed.withColumns(
        {
            "quarantine_ts": ts,
            "dq_status": F.lit("FAILED"),
            "quarantine_reason": F.lit("DQ_RULE_FAILED"),
            "broken_rules": reason_text(checked),
        }
    )
    quarantine = drop_helpers(reasons if keep_raw or not spec.masked else mask_pii(reasons))
    outcomes = rule_outcomes(evaluated, checked, spec.name, run_ts.date().isoformat())
    return SilverResult(evaluated, silver, quarantine, outcomes)


def quarantine_stats(quarantines: Mapping[str, DataFrame]) -> DataFrame:
    """Quarantined rows per table and in total (table ALL)."""
    counts = reduce(
        DataFrame.unionAll,
        [
            df.agg(F.count(F.lit(1)).alias("quarantined_rows")).select(F.lit(t).alias("table_name"), "quarantined_rows")
            for t, df in quarantines.items()
        ],
    )
    total = counts.agg(F.sum("quarantined_rows").alias("quarantined_rows"))
    return counts.unionAll(total.select(F.lit("ALL").alias("table_name"), "quarantined_rows"))


AUDIT_ONLY = ["quarantine_ts", "dq_status", "quarantine_reason", "broken_rules"]


def reprocess(quarantine: DataFrame, spec: TableSpec, fix: Callable[[DataFrame], DataFrame], run_ts: datetime) -> SilverResult:
    """Run quarantined rows (kept raw) through the rules again after ``fix`` was applied to them."""
    return build_silver(fix(quarantine.drop(*AUDIT_ONLY)), spec, run_ts)
