from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tellerlake.operators import aggregates as agg
from tellerlake.operators.joins import asof_dim, current, join_dim, lookup_sk, orphan_keys, orphans, star_join
from tellerlake.operators.keys import assign_sk, extend_sk
from tellerlake.operators.merge import dedupe, insert_only, new_rows, soft_delete, union_loads, upsert
from tellerlake.operators.scd2 import scd2, scd2_apply
from tellerlake.operators.skew import fanout_join, frame_bytes, hot_keys, keyed_join, split_by_keys
from tellerlake.operators.windows import carry_forward, dod_change, duplicate_keys, flag_unique, latest, rolling_band, top_n_per

DAY = datetime(2024, 1, 1)


def skewed(seed: int = 3) -> list[tuple]:
    """A third of the rows share one key, some have none."""
    r = random.Random(seed)
    return [(1 if i % 3 == 0 else None if i % 17 == 0 else r.randrange(2, 30), i) for i in range(300)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keyed_join_spreads_hot_keys_without_changing_rows(tight, how):
    facts = skewed()
    dim = {k: k * 10 for k in range(0, 25)}
    many = tight.createDataFrame(facts, "k int, i int").repartition(5)
    one = tight.createDataFrame(list(dim.items()), "k long, v long")
    assert len(hot_keys(many, ["k"])) > 5
    joined = keyed_join(many, one, ["k"], how)
    assert "_salt" in joined._jdf.queryExecution().toString()
    expected = [(k, i, dim.get(k)) for k, i in facts if how == "left" or k in dim]
    assert rows(joined, "k", "i", "v") == rows(tight.createDataFrame(expected, "k int, i int, v long"))


def test_keyed_join_broadcasts_only_below_the_limit(spark, tight):
    many, one = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).selectExpr("id AS k", "id AS v")

    def plan() -> str:
        return keyed_join(many, one, ["k"])._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" not in plan()
    spark.conf.set("tellerlake.broadcast.maxBytes", "1000")
    assert "BroadcastHashJoin" in plan()


def test_keyed_join_with_nothing_to_join(spark):
    empty = spark.createDataFrame([], "k long, v string")
    assert rows(keyed_join(spark.range(2).withColumnRenamed("id", "k"), empty, ["k"])) == [(0, None), (1, None)]


def test_frame_bytes_counts_text(spark):
    assert frame_bytes(spark.createDataFrame([("abc", 1), (None, 2)], "s string, n long")) == (2, 2 * 8 + 3)


def test_split_by_keys_keeps_every_row(tight):
    many = tight.createDataFrame(skewed(), "k int, i int")
    inside, outside = split_by_keys(many, tight.createDataFrame([(1,), (2,), (99,)], "k int"), ["k"])
    assert inside.count() + outside.count() == 300
    assert {r.k for r in inside.select("k").distinct().collect()} == {1, 2}
    assert inside.columns == many.columns


def test_fanout_join_equals_left_join(tight):
    parent = tight.createDataFrame([(k, f"p{k}") for k in range(40)], "k int, p string")
    child = tight.createDataFrame([t for t in skewed() if t[0] is not None], "k int, i int")
    assert rows(fanout_join(parent, child, ["k"])) == rows(parent.join(child, ["k"], "left"))


def test_surrogate_keys_are_dense_and_do_not_depend_on_buckets(spark):
    df = spark.createDataFrame([(i, f"c{i}") for i in range(500)], "id int, code string").repartition(7)
    one, three = assign_sk(df, ["code"], "sk", digits=1), assign_sk(df, ["code"], "sk", digits=3)
    assert rows(one) == rows(three)
    assert sorted(r.sk for r in one.collect()) == list(range(1, 501))
    assert one.columns == ["sk", "id", "code"]


def test_known_surrogate_keys_stay(spark):
    known = assign_sk(spark.range(50).withColumnRenamed("id", "k"), ["k"], "sk", as_type="int")
    more = extend_sk(known, spark.range(80).withColumnRenamed("id", "k"), ["k"], "sk")
    before, after = {r.k: r.sk for r in known.collect()}, {r.k: r.sk for r in more.collect()}
    assert len(after) == 80 and sorted(after.values()) == list(range(1, 81))
    assert all(after[k] == sk for k, sk in before.items())


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_carry_forward_equals_brute_force(tight, backward, inclusive):
    r = random.Random(5)
    data = []
    for i in range(240):
        key = "hot" if i % 3 == 0 else f"k{r.randrange(100)}"
        data.append((key, DAY + timedelta(days=r.randrange(200), seconds=i), r.choice([None, None, f"v{i}"])))
    df = tight.createDataFrame(data, "k string, t timestamp, v string")
    got = carry_forward(df, ["k"], ["t"], "v", "out", F.date_trunc("month", "t"), inclusive, backward)
    expected = []
    for k, t, v in data:
        seen = [
            (t2, v2) for k2, t2, v2 in data
            if k2 == k and v2 is not None and ((t2 > t if backward else t2 < t) or (inclusive and t2 == t))
        ]
        best = (min(seen) if backward else max(seen))[1] if seen else None
        expected.append((k, t, v, best))
    assert rows(got) == rows(tight.createDataFrame(expected, "k string, t timestamp, v string, out string"))


def test_latest_and_dedupe(tight):
    df = tight.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, 1, None), (3, 1, "x"), (3, 1, "x")], "k int, t int, v string")
    assert rows(latest(df, ["k"], ["t"])) == [(1, 7, "c"), (2, 1, None), (3, 1, "x")]
    assert rows(dedupe(df, ["k"], ["t"])) == [(1, 7, "c"), (2, 1, None), (3, 1, "x")]


def test_uniqueness_flags(tight):
    df = tight.createDataFrame([(1,), (2,), (2,), (3,), (3,), (3,), (None,), (None,)], "k int")
    assert rows(flag_unique(df, ["k"])) == [(None, True), (None, True), (1, True), (2, False), (2, False), (3, False), (3, False), (3, False)]
    assert rows(duplicate_keys(df, ["k"])) == [(2, 2), (3, 3)]


# --- history ---------------------------------------------------------------------------------

STATE = "id int, city string, note string, ts timestamp"


def at(day: int) -> datetime:
    return DAY + timedelta(days=day)


def versions(df):
    return [
        (r.id, r.city, r.effective_from, r.effective_to, r.is_current)
        for r in df.orderBy("id", "effective_from").collect()
    ]


@pytest.mark.parametrize("mode", ["plain", "hot"])
def test_scd2_versions(spark, request, mode):
    if mode == "hot":
        request.getfixturevalue("tight")
    history = spark.createDataFrame(
        [
            (1, "A", "x", at(0)), (1, "A", "touched", at(40)), (1, "B", "y", at(80)), (1, "A", "z", at(120)), (1, "A", "z", at(120)),
            (2, "C", "x", at(3)),
        ],
        STATE,
    )
    got = versions(scd2(history, ["id"], ["city"], "ts"))
    assert got == [
        (1, "A", at(0), at(80), 0), (1, "B", at(80), at(120), 0), (1, "A", at(120), None, 1), (2, "C", at(3), None, 1),
    ]


def test_scd2_batches_equal_full_history(tight):
    first = tight.createDataFrame([(1, "A", "x", at(0)), (2, "C", "x", at(0)), (1, "B", "y", at(90))], STATE)
    batch = tight.createDataFrame([(1, "D", "late", at(40)), (3, "N", "new", at(95)), (1, "B", "same", at(100))], STATE)
    dim = scd2(first, ["id"], ["city"], "ts")
    assert versions(scd2_apply(dim, batch, ["id"], ["city"], "ts")) == versions(scd2(first.union(batch), ["id"], ["city"], "ts"))
    again = scd2_apply(dim, first, ["id"], ["city"], "ts")
    assert versions(again) == versions(dim)


def test_intervals_do_not_overlap_and_one_version_is_current(tight):
    r = random.Random(1)
    history = tight.createDataFrame([(r.randrange(6), r.choice("ABC"), "n", at(r.randrange(400))) for _ in range(200)], STATE)
    by_key: dict = {}
    for row in versions(scd2(history, ["id"], ["city"], "ts")):
        by_key.setdefault(row[0], []).append(row)
    for spans in by_key.values():
        assert [s[4] for s in spans] == [0] * (len(spans) - 1) + [1]
        for a, b in zip(spans, spans[1:]):
            assert a[3] == b[2] and a[1] != b[1]


@pytest.mark.parametrize("mode", ["plain", "hot"])
def test_asof_join(spark, request, mode):
    if mode == "hot":
        request.getfixturevalue("tight")
    dim = spark.createDataFrame(
        [(1, "A", at(10), at(50)), (1, "B", at(50), None), (2, "C", at(0), at(20))], "id int, city string, effective_from timestamp, effective_to timestamp"
    )
    fact = spark.createDataFrame([(1, 1, at(9)), (2, 1, at(10)), (3, 1, at(49)), (4, 1, at(50)), (5, 1, at(300)), (6, 2, at(20)), (7, 9, at(1)), (8, 2, at(19))], "n int, id int, t timestamp")
    got = rows(asof_dim(fact, dim, ["id"], "t", ["city"]), "n", "city")
    assert got == [(1, None), (2, "A"), (3, "A"), (4, "B"), (5, "B"), (6, None), (7, None), (8, "C")]


# --- joins and merges ------------------------------------------------------------------------


def test_lookup_misses_become_zero(spark):
    dim = spark.createDataFrame([(10, 1, 5, 1), (11, 2, 6, 1)], "account_id long, account_sk int, branch_sk int, is_current int")
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "n int, account_id long")
    assert rows(lookup_sk(fact, current(dim), ["account_id"], ["account_sk", "branch_sk"]), "n", "account_sk", "branch_sk") == [(1, 1, 5), (2, 0, 0), (3, 0, 0)]


def test_star_join_drops_unknown_members(spark):
    fact = spark.createDataFrame([(1, 1, 7), (0, 1, 8), (1, 0, 9)], "a_sk int, b_sk int, v int")
    a, b = spark.createDataFrame([(1, "A")], "a_sk int, a string"), spark.createDataFrame([(1, "B")], "b_sk int, b string")
    assert rows(star_join(fact, {"a_sk": a, "b_sk": b}), "v", "a", "b") == [(7, "A", "B")]
    assert rows(join_dim(fact, a, "a_sk"), "v") == [(7,), (9,)]


def test_orphans(tight):
    child = tight.createDataFrame([(1, 1), (2, 7), (3, 7), (4, None), (5, 8)], "n int, fk int")
    parent = tight.createDataFrame([(1,), (2,)], "id int")
    assert rows(orphan_keys(child, "fk", parent, "id")) == [(7, 2), (8, 1)]
    assert rows(orphans(child, "fk", parent, "id"), "n") == [(2,), (3,), (5,)]


@pytest.mark.parametrize("mode", ["plain", "tight"])
def test_upsert(spark, request, mode):
    if mode == "tight":
        request.getfixturevalue("tight")
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 9)], "k int, v string, t int")
    batch = spark.createDataFrame([(2, "B", 2), (4, "n", 1), (4, "m", 2), (3, "old", 5)], "k int, v string, t int")
    once = upsert(target, batch, ["k"], ["t"])
    expected = [(1, "a", 1), (2, "B", 2), (3, "c", 9), (4, "m", 2)]
    assert rows(once) == expected
    assert rows(upsert(once, batch, ["k"], ["t"])) == expected


def test_rows_without_a_key_are_not_merged(spark):
    shape = "k int, t int, v string"
    target = spark.createDataFrame([(1, 1, "a"), (None, 1, "x"), (None, 2, "y")], shape)
    batch = spark.createDataFrame([(1, 2, "b"), (None, 2, "y"), (None, 3, "z"), (None, 4, "w")], shape)
    expected = [(None, 1, "x"), (None, 2, "y"), (None, 3, "z"), (None, 4, "w"), (1, 2, "b")]
    once = upsert(target, batch, ["k"], ["t"])
    assert rows(once) == expected
    assert rows(upsert(once, batch, ["k"], ["t"])) == expected
    fresh = new_rows(target, batch, ["k"], ["t"])
    assert rows(fresh) == [(None, 3, "z"), (None, 4, "w")]
    assert new_rows(target.union(fresh), batch, ["k"], ["t"]).count() == 0


def test_a_missing_key_carries_the_same_when_hot(spark, request):
    df = spark.createDataFrame([(None, datetime(2024, 1, 1, h), v) for h, v in [(1, "a"), (3, None), (7, None)]] + [(1, datetime(2024, 1, 1, 2), "b"), (1, datetime(2024, 1, 1, 9), None)], "k int, ts timestamp, v string")
    carried = lambda hot: rows(carry_forward(df, ["k"], ["ts"], "v", "out", F.date_trunc("hour", "ts"), hot=hot), "k", "ts", "out")
    every = [r.h for r in df.select(F.xxhash64("k").alias("h")).distinct().collect()]
    assert carried([]) == carried(every)


def test_insert_only_and_rerun(tight):
    target = tight.createDataFrame([(1, 1), (2, 1)], "k int, t int")
    batch = tight.createDataFrame([(2, 9), (3, 2), (3, 1)], "k int, t int")
    merged = insert_only(target, batch, ["k"], ["t"])
    assert rows(merged) == [(1, 1), (2, 1), (3, 2)]
    assert new_rows(merged, batch, ["k"], ["t"]).count() == 0


def test_soft_delete(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "k int, is_active int")
    assert rows(soft_delete(df, df.filter("k = 1"), ["k"])) == [(1, 1), (2, 0)]


def test_union_of_loads_with_new_column(spark):
    old = spark.createDataFrame([(1, 1), (2, 1)], "k int, t int")
    new = spark.createDataFrame([(2, 5, "x")], "k int, t int, extra string")
    assert rows(union_loads([old, new], ["k"], ["t"])) == [(1, 1, None), (2, 5, "x")]
    assert union_loads([old, new]).count() == 3


# --- aggregates and daily windows ------------------------------------------------------------


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("A", 3, Decimal("1.25"), 0), ("A", 4, None, 7), (None, 5, Decimal("2.00"), 7)], "g string, s int, m decimal(18,2), x_sk int"
    )
    assert rows(agg.distribution(df, "g")) == [(None, 1), ("A", 2)]
    assert rows(agg.distribution_avg(df, "g", "s")) == [(None, 1, Decimal("5.00")), ("A", 2, Decimal("3.50"))]
    assert rows(agg.null_counts(df, ["g", "m", "s"])) == [("g", 1, 3), ("m", 1, 3), ("s", 0, 3)]
    assert rows(agg.value_range(df, "s")) == [(3, 5)]
    assert rows(agg.distinct_values(df, "g")) == [(None,), ("A",)]
    assert rows(agg.fk_miss(df, "pk")) == [("x_sk", 1, 3, 33.33)]
    assert rows(agg.kpi(df, {"n": F.count("m"), "top": F.max("s")})) == [(2, 5)]
    assert [r.s for r in agg.top_k(df, "s", 2, ["g"]).collect()] == [5, 4]
    assert rows(agg.row_counts({"a": df, "b": df.limit(1)})) == [("a", 3), ("b", 1)]


def test_daily_windows(spark):
    values = [10, 20, 30, 15]
    df = spark.createDataFrame([("t", (DAY + timedelta(days=i)).date(), v) for i, v in enumerate(values)], "n string, day date, v long")
    change = [(r.previous_value, r.change_pct) for r in dod_change(df, ["n"], "day", "v").orderBy("day").collect()]
    assert change == [(None, None), (10, 100.0), (20, 50.0), (30, -50.0)]
    band = rolling_band(df, ["n"], "day", "v", days=2).orderBy("day").collect()
    assert [(b.baseline_days, b.baseline_mean) for b in band] == [(0, None), (1, 10.0), (2, 15.0), (2, 25.0)]


def test_top_n_per_part(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 9)], "p string, v int")
    assert rows(top_n_per(df, ["p"], [F.desc("v")], 2)) == [("a", 2, 2), ("a", 3, 1), ("b", 9, 1)]
