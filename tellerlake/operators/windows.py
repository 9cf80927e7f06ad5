"""Ordered operators per key, split along time so that no key has to fit into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tellerlake.operators.skew import COPIES, HotKeys, hot_keys, keyed_join


def latest(df: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order`` and, among equals, by its other columns.

    An aggregate and no window: every map task reduces its rows first, so a hot key stays small.
    """
    rest = [c for c in df.columns if c not in order]
    best = df.groupBy(*pk).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows; NULL is no key value."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def flag_unique(df: DataFrame, keys: list[str], flag: str = "is_unique") -> DataFrame:
    """Mark each row by whether its key occurs once; only key values are shuffled to find out."""
    repeated = duplicate_keys(df, keys).select(*keys, F.lit(True).alias("_repeated"))
    return keyed_join(df, repeated, keys).withColumn(flag, F.col("_repeated").isNull()).drop("_repeated")


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    out: str,
    segment: Column,
    inclusive: bool = False,
    backward: bool = False,
    hot: HotKeys | list[int] | None = None,
) -> DataFrame:
    """Last non-null ``value`` before each row (or next one after it, with ``backward``) per key.

    Keys with few rows are one window each. Hot keys (looked up here unless given) are cut along
    time: rows are sorted within (key, segment) only, the last value of every segment forms a small
    table with one row per key and segment, and a segment takes from there what came before it.
    ``segment`` must not decrease along ``order``.
    """
    hot = hot_keys(df, keys) if hot is None else HotKeys.of(df.sparkSession, hot) if isinstance(hot, list) else hot
    sort = [F.desc(c) if backward else F.asc(c) for c in order]
    to = 0 if inclusive else -1

    def last_in(window: WindowSpec) -> Column:
        frame = window.orderBy(*sort).rowsBetween(Window.unboundedPreceding, to)
        return F.last(value, ignorenulls=True).over(frame)

    if not hot:
        return df.withColumn(out, last_in(Window.partitionBy(*keys)))
    marked = hot.mark(df, keys)
    plain = marked.filter(F.col(COPIES).isNull()).select(*df.columns).withColumn(out, last_in(Window.partitionBy(*keys)))

    seg, carried = "_segment", "_carried"
    cut = marked.filter(F.col(COPIES).isNotNull()).select(*df.columns).withColumn(seg, segment)
    pick = F.min_by if backward else F.max_by
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    edges = cut.groupBy(*keys, seg).agg(pick(F.col(value), rank).alias(carried))
    across = Window.partitionBy(*keys).orderBy(F.desc(seg) if backward else F.asc(seg))
    across = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn(carried, F.last(carried, ignorenulls=True).over(across))
    local = cut.withColumn(out, last_in(Window.partitionBy(*keys, seg)))
    # Null-safe, as the window over a key is: a missing key is one key here.
    names = [*keys, seg]
    other = edges.select(carried, *[F.col(n).alias(f"_edge_{n}") for n in names])
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_edge_{n}")) for n in names])
    joined = local.join(other, same, "left").withColumn(out, F.coalesce(out, carried))
    return plain.unionByName(joined.select(*df.columns, out))


def changed(
    df: DataFrame, pk: list[str], ts: str, hash_col: str, segment: str = "hour", hot: HotKeys | None = None
) -> DataFrame:
    """Versions that differ from the one before them, first versions included."""
    seen = carry_forward(df, pk, [ts], hash_col, "_before", F.date_trunc(segment, F.col(ts)), hot=hot)
    return seen.filter(F.col("_before").isNull() | (F.col("_before") != F.col(hash_col))).drop("_before")


def validity(df: DataFrame, pk: list[str], ts: str, segment: str = "hour", hot: HotKeys | None = None) -> DataFrame:
    """Add effective_from, effective_to (NULL while open) and is_current to the versions of a key."""
    cut = F.date_trunc(segment, F.col(ts))
    ended = carry_forward(df, pk, [ts], ts, "effective_to", cut, backward=True, hot=hot)
    return ended.withColumn("effective_from", F.col(ts)).withColumn(
        "is_current", F.col("effective_to").isNull().cast("int")
    )


def rolling_band(
    daily: DataFrame, part: list[str], day: str, metric: str, days: int = 14, sigmas: float = 2.0
) -> DataFrame:
    """Mean, deviation and band of the metric over the ``days`` calendar days before each day.

    The input holds one row per part and day, so a window group is never longer than the calendar.
    """
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    past = Window.partitionBy(*part).orderBy(number).rangeBetween(-days, -1)
    return (
        daily.withColumn("baseline_days", F.count(metric).over(past))
        .withColumn("baseline_mean", F.avg(metric).over(past))
        .withColumn("baseline_stddev", F.stddev_samp(metric).over(past))
        .withColumn("lower_bound", F.col("baseline_mean") - sigmas * F.col("baseline_stddev"))
        .withColumn("upper_bound", F.col("baseline_mean") + sigmas * F.col("baseline_stddev"))
    )


def dod_change(daily: DataFrame, part: list[str], day: str, metric: str) -> DataFrame:
    """Value of the preceding recorded day and the change against it in percent."""
    w = Window.partitionBy(*part).orderBy(day)
    before = F.lag(metric).over(w)
    return daily.withColumn("previous_value", before).withColumn(
        "change_pct", (F.col(metric) - F.col("previous_value")) * 100.0 / F.nullif(F.col("previous_value"), F.lit(0))
    )


def top_n_per(df: DataFrame, part: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each part; Spark keeps only ``n`` per part and task before the shuffle."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
