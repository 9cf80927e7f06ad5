"""Evaluation of rules over rows and over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.measures import pct
from tellerlake.operators.skew import keyed_join
from tellerlake.quality.rules import KeyRule, Rule
from tellerlake.session import settle_keys

MASK = "broken_mask"
_WORD = 62
PASSED = "dq_passed"
HELPERS = (MASK, PASSED)

OUTCOME_SCHEMA = """table_name string, run_date date, rule_no int, rule string, rule_kind string, threshold double,
    failing_rows bigint, evaluated_rows bigint, ratio double, outcome string, failed_rows bigint"""


def failing_keys(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None) -> dict[int, DataFrame]:
    """The key values that break a key rule, by the place of the rule, worked out once."""
    return {i: settle_keys(r.bad_keys(df, parents or {}).select(*r.columns)) for i, r in enumerate(rules) if isinstance(r, KeyRule)}


def evaluate_rows(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None, failing: Mapping[int, DataFrame] | None = None
) -> DataFrame:
    """Add a bit mask of the rules each row breaks, and whether it breaks none.

    Rule i is bit i % 62 of word i // 62 of the mask.

    Column rules are one projection. A key rule first finds its failing key values from the key
    column alone; the (usually few) values are then joined to the rows. The mask keeps the work per
    row to integer arithmetic in generated code; names are spelled out by :func:`failed_rules`.
    ``failing`` has these values if the caller has found them already.
    """
    failing = failing_keys(df, rules, parents) if failing is None else failing
    marked, checks = df, []
    for i, rule in enumerate(rules):
        if isinstance(rule, KeyRule):
            flag, keys = f"_bad_{i}", list(rule.columns)
            marked = keyed_join(marked, failing[i].withColumn(flag, F.lit(True)), keys)
            checks.append(F.col(flag).isNull())
        else:
            checks.append(rule.row_ok())
    bits = [F.when(ok, F.lit(0)).otherwise(F.lit(1 << i % _WORD)).cast("bigint") for i, ok in enumerate(checks)]
    words = [reduce(Column.__add__, bits[k : k + _WORD]) for k in range(0, len(bits), _WORD)] or [F.lit(0).cast("bigint")]
    mask = F.struct(*[w.alias(f"w{k}") for k, w in enumerate(words)])
    none = reduce(Column.__and__, [F.col(f"{MASK}.w{k}") == 0 for k in range(len(words))])
    return marked.select(*df.columns, mask.alias(MASK)).withColumn(PASSED, none)


def breaks(i: int) -> Column:
    """Whether the row breaks rule ``i`` of its rule set."""
    return F.col(f"{MASK}.w{i // _WORD}").bitwiseAND(F.lit(1 << i % _WORD)) != 0


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules as an array."""
    return F.array_compact(F.array(*[F.when(breaks(i), F.lit(r.name)) for i, r in enumerate(rules)]))


def reason_text(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, joined by commas."""
    return F.concat_ws(",", *[F.when(breaks(i), F.lit(r.name)) for i, r in enumerate(rules)])


def rule_outcomes(evaluated: DataFrame, rules: Sequence[Rule], table: str, run_date: str) -> DataFrame:
    """One row per rule with the share of rows that keep it, from a single aggregate.

    ``failed_rows``, the same for all rules, counts the rows that break any of them.
    """
    wide = evaluated.agg(
        F.count(F.lit(1)).alias("evaluated_rows"),
        F.count_if(~F.col(PASSED)).alias("failed_rows"),
        *[F.count_if(breaks(i)).alias(f"f{i}") for i in range(len(rules))],
    )
    long = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("rule_no"),
                F.lit(r.name).alias("rule"),
                F.lit(r.kind).alias("rule_kind"),
                F.lit(float(r.threshold)).alias("threshold"),
                F.col(f"f{i}").alias("failing_rows"),
            )
            for i, r in enumerate(rules)
        ]
    )
    totals = ["evaluated_rows", "failed_rows"]
    rows = wide.select(*totals, F.explode(long).alias("r")).select("r.*", *totals)
    kept = (F.col("evaluated_rows") - F.col("failing_rows")).cast("decimal(18,0)")
    exact = F.coalesce(kept / F.nullif("evaluated_rows", F.lit(0)).cast("decimal(18,0)"), F.lit(1).cast("decimal(18,6)"))
    return rows.select(
        F.lit(table).alias("table_name"),
        F.lit(run_date).cast("date").alias("run_date"),
        "rule_no",
        "rule",
        "rule_kind",
        "threshold",
        "evaluated_rows",
        "failing_rows",
        F.round(exact, 6).cast("double").alias("ratio"),
        F.when(exact >= F.col("threshold").cast("decimal(18,6)"), "Passed").otherwise("Failed").alias("outcome"),
        "failed_rows",
    )


def evaluate_rules(
    df: DataFrame, rules: Sequence[Rule], table: str, run_date: str, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    return rule_outcomes(evaluate_rows(df, rules, parents), rules, table, run_date)


def split(evaluated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules and rows that break some; every row is in exactly one of them."""
    return evaluated.filter(PASSED), evaluated.filter(~F.col(PASSED))


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)


@dataclass(frozen=True)
class GatePolicy:
    """Alert above 5 % failed rows, stop if a complete-key rule fails."""

    failed_pct: float = 5.0
    critical_kinds: tuple[str, ...] = ("Uniqueness", "Completeness")


def dq_gate(row_counts: DataFrame, outcomes: DataFrame, policy: GatePolicy = GatePolicy()) -> DataFrame:
    """Decision per table: HALT, ALERT or OK.

    ``row_counts`` has table_name, evaluated_rows and failed_rows. A failed rule of a critical kind
    halts the table, a share of failed rows above the limit only alerts.
    """
    critical = outcomes.filter(F.col("rule_kind").isin(*policy.critical_kinds)).groupBy("table_name").agg(
        F.count_if(F.col("outcome") == "Failed").alias("critical_failures")
    )
    share = pct(F.col("failed_rows"), F.col("evaluated_rows"))
    joined = row_counts.join(critical, "table_name", "left").withColumns(
        {"failed_pct": share, "critical_failures": F.coalesce("critical_failures", F.lit(0))}
    )
    decision = (
        F.when(F.col("critical_failures") > 0, "HALT")
        .when(F.col("failed_pct") > policy.failed_pct, "ALERT")
        .otherwise("OK")
    )
    return joined.withColumn("decision", decision)


class QualityHalt(RuntimeError):
    """A table failed a critical rule."""


def enforce_gate(decisions: DataFrame) -> None:
    """Raise if any table is to be halted."""
    halted = [r.table_name for r in decisions.filter("decision = 'HALT'").select("table_name").collect()]
    if halted:
        raise QualityHalt(f"critical rules failed for: {', '.join(sorted(halted))}")


def dq_pass_rate(row_counts: DataFrame) -> DataFrame:
    """Share of processed rows that were not quarantined, per table."""
    passed = F.col("evaluated_rows") - F.col("failed_rows")
    return row_counts.withColumn("pass_rate_pct", pct(passed, F.col("evaluated_rows")))


def rule_pass_rate(outcomes: DataFrame) -> DataFrame:
    """Rules passed and failed per table, and the share passed."""
    counts = outcomes.groupBy("table_name").agg(
        F.count_if(F.col("outcome") == "Passed").alias("rules_passed"),
        F.count_if(F.col("outcome") == "Failed").alias("rules_failed"),
    )
    total = F.col("rules_passed") + F.col("rules_failed")
    return counts.withColumn("rule_pass_pct", pct(F.col("rules_passed"), total))


def row_results(outcomes: DataFrame) -> DataFrame:
    """Evaluated and failed rows per table, out of the rule outcomes of a run."""
    return outcomes.groupBy("table_name").agg(
        F.max("evaluated_rows").alias("evaluated_rows"), F.max("failed_rows").alias("failed_rows")
    )
