"""Data-quality rules as plain values."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.joins import orphan_keys
from tellerlake.operators.windows import duplicate_keys


@dataclass(frozen=True)
class ColumnRule:
    """A rule that looks at one row. Missing values pass unless ``null_fails`` says otherwise."""

    column: str

    threshold = 1.0

    @property
    def kind(self) -> str:
        return type(self).__name__

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})"

    def holds(self) -> Column:
        raise NotImplementedError

    def row_ok(self) -> Column:
        return F.coalesce(self.holds(), F.lit(not getattr(self, "null_fails", False)))


@dataclass(frozen=True)
class Completeness(ColumnRule):
    threshold: float = 1.0

    def holds(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class InSet(ColumnRule):
    values: tuple = ()
    null_fails: bool = False

    def holds(self) -> Column:
        return F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class Compare(ColumnRule):
    op: str = ">="
    value: object = 0
    null_fails: bool = False

    @property
    def name(self) -> str:
        return f"Compare({self.column} {self.op} {self.value})"

    def holds(self) -> Column:
        c, v = F.col(self.column), F.lit(self.value)
        return {"=": c == v, ">": c > v, ">=": c >= v, "<": c < v, "<=": c <= v}[self.op]


@dataclass(frozen=True)
class Length(ColumnRule):
    length: int = 0
    null_fails: bool = False

    def holds(self) -> Column:
        return F.length(self.column) == self.length


@dataclass(frozen=True)
class Pattern(ColumnRule):
    regex: str = ""
    null_fails: bool = False

    def holds(self) -> Column:
        return F.col(self.column).rlike(self.regex)


@dataclass(frozen=True)
class KeyRule:
    """A rule whose failing rows are those of a set of key values."""

    columns: tuple[str, ...]
    threshold: float = 1.0

    @property
    def kind(self) -> str:
        return type(self).__name__

    @property
    def name(self) -> str:
        return f"{self.kind}({','.join(self.columns)})"

    def bad_keys(self, df: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
        raise NotImplementedError


@dataclass(frozen=True)
class Uniqueness(KeyRule):
    def bad_keys(self, df: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
        return duplicate_keys(df, list(self.columns))


@dataclass(frozen=True)
class NoDuplicates(Uniqueness):
    """Uniqueness of a business key."""


@dataclass(frozen=True)
class ForeignKey(KeyRule):
    parent: str = ""
    parent_column: str = ""

    def bad_keys(self, df: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
        return orphan_keys(df, self.columns[0], parents[self.parent], self.parent_column)


Rule = ColumnRule | KeyRule

# The rules of every source table, in order.
RULES: dict[str, tuple[Rule, ...]] = {
    "branches": (
        Completeness("branch_code"),
        Uniqueness(("branch_code",)),
        Completeness("branch_name"),
        Completeness("city"),
    ),
    "customers": (
        Completeness("customer_id"),
        Uniqueness(("customer_id",)),
        Completeness("kyc_status", 0.95),
        InSet("kyc_status", ("VERIFIED", "PENDING", "REJECTED")),
        Length("phone_number", 10),
    ),
    "accounts": (
        Completeness("account_id"),
        Uniqueness(("account_id",)),
        Completeness("customer_id"),
        InSet("account_type", ("Savings", "Current")),
        InSet("status", ("ACTIVE", "CLOSED", "FROZEN", "DORMANT")),
        Compare("balance", ">=", 0),
        Compare("currency", "=", "INR"),
    ),
    "transactions": (
        Completeness("txn_id"),
        Uniqueness(("txn_id",)),
        Completeness("account_id"),
        InSet("txn_type", ("Debit", "Credit")),
        Compare("amount", ">", 0),
        InSet("status", ("SUCCESS", "FAILED", "PENDING", "REVERSED")),
        Completeness("txn_timestamp"),
    ),
    "payment_gateway_logs": (
        Completeness("txn_id"),
        Uniqueness(("txn_id",)),
        InSet("gateway_name", ("Stripe", "BillDesk", "PayU", "Razorpay")),
        InSet("gateway_status", ("SUCCESS", "FAILED", "PENDING", "TIMEOUT")),
        Length("response_code", 2),
        Compare("processing_time_ms", ">=", 0),
        InSet("device_type", ("Mobile", "ATM", "POS", "Web")),
    ),
    "credit_bureau_reports": (
        Completeness("customer_id"),
        Completeness("credit_score"),
        Compare("credit_score", ">=", 300),
        Compare("credit_score", "<=", 900),
        InSet("risk_grade", ("LOW", "MEDIUM", "HIGH")),
        Compare("external_active_loans", ">=", 0),
        Compare("external_overdue_amount", ">=", 0),
    ),
}

# Formats of personal identifiers.
FORMAT_RULES: tuple[Rule, ...] = (
    Pattern("pan_number", "^[A-Z]{5}[0-9]{4}[A-Z]$"),
    Pattern("email", "^[^@ ]+@[^@ ]+[.][^@ ]+$"),
    Pattern("phone_number", "^[0-9]{10}$"),
)

# Foreign keys of the source tables as (child, column, parent, column).
FOREIGN_KEYS = (
    ("customers", "branch_code", "branches", "branch_code"),
    ("accounts", "customer_id", "customers", "customer_id"),
    ("accounts", "branch_code", "branches", "branch_code"),
    ("transactions", "account_id", "accounts", "account_id"),
)


def foreign_key_rules(table: str) -> list[Rule]:
    return [ForeignKey((col,), parent=p, parent_column=pc) for child, col, p, pc in FOREIGN_KEYS if child == table]


def rules_from_catalog(contracts: list) -> list[Rule]:
    """Rules that follow from column contracts: nullability, key, allowed values, range."""
    rules: list[Rule] = [Completeness(c.name) for c in contracts if not c.nullable]
    key = tuple(c.name for c in contracts if c.pk)
    if key:
        rules.append(Uniqueness(key))
    for c in contracts:
        if c.valid_values:
            rules.append(InSet(c.name, c.valid_values))
        if c.valid_range:
            low, high = c.valid_range
            rules += [Compare(c.name, ">=", low), Compare(c.name, "<=", high)]
    return rules
