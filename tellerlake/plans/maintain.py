"""Gold kept from night to night: only parts that changed are read and written.

Every table notes the version of the table it was made from. To bring it up to date, the two versions are
compared by their lists of folders; parts whose folders differ have changed, all others are not opened.
So a run that stops anywhere is made good by the next one, and a night repeated changes nothing.

Facts lie in parts by day (or month). Rows of a load that are known with the same content are dropped by a
ledger of keys (key, number, part, fingerprint in hash buckets). Corrected rows keep their number and leave the part they
lay in; late rows go to the part of their day. The parts touched are written again, and with them, from the facts of those
parts alone, a cube of sums per branch, customer, account and day, the daily balances and the monthly summary.
Totals per account and days per customer change by the difference between the old and the new cube rows of
the changed parts. Only where a correction may have taken away the largest amount or the first or last day
of an account, the cube of that account is looked through.

Facts point to the open version of a dimension row, whose number stays for good (:func:`number_versions`), so a new
version changes no fact. What does change facts are accounts that move to another customer or branch, and parents that
arrive after the rows that name them: the parts that hold such rows are found by the cube and by a table of
unresolved rows, and looked up again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.hashing import row_hash
from tellerlake.operators.joins import current
from tellerlake.operators.keys import assign_sk
from tellerlake.operators.merge import one_each, without_key
from tellerlake.operators.scd2 import number_versions, scd2, scd2_apply
from tellerlake.operators.skew import broadcastable, keyed_join, with_keys, without_keys
from tellerlake.plans import aggregates, dims, facts
from tellerlake.plans.aggregates import SPANS, SUMS, roll, transaction_measures
from tellerlake.schemas import CATALOG
from tellerlake.session import in_parallel, settle, settle_keys
from tellerlake.sources.lake import Lake
from tellerlake.sources.parts import NO_PART, Entry, PartTable, bucket, plenty
from tellerlake.sources.state import LOAD_POLICY

Gold = dict[str, DataFrame]

# Formats of the parts of facts.
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
ACCOUNT = ["branch_sk", "customer_sk", "account_sk"]
_OF = "of"
# So many rows of a part go to one task where rows are dealt for a grouping within parts.
DEALT_ROWS = 100_000


@dataclass(frozen=True)
class Keeper:
    """Where and how gold is kept: grain of the facts' parts, hash buckets of keyed tables."""

    lake: Lake
    run_ts: datetime
    grain: str = "day"
    buckets: int = 64

    def table(self, name: str) -> PartTable:
        return self.lake.parts("gold", name)

    def home(self, column: str) -> Column:
        return F.coalesce(F.date_format(column, GRAINS[self.grain]), F.lit(NO_PART))


def changed_parts(table: PartTable, since: int) -> tuple[Entry, Entry, set[str]]:
    """The version noted, the newest one, and the parts whose folders differ. A version no longer kept counts as none."""
    new = table.entry()
    old = table.entry(since) if since in table.published() else Entry()
    differ = set(old.folders) ^ set(new.folders)
    return old, new, {part for part, _, _ in differ}


def names(df: DataFrame, part: Column) -> set[str]:
    """Parts of the rows; as many as there are days or buckets."""
    return {r[0] for r in df.select(part.alias("part")).distinct().collect()}


# --- dimensions -------------------------------------------------------------------------------


@dataclass(frozen=True)
class History:
    """Versions of a dimension: where its states come from, their key, and the time of a state."""

    source: str
    key: str
    sk: str
    ts: str
    keeps: tuple[str, ...]


HISTORIES = {
    "dim_branch": History("branches", "branch_code", "branch_sk", "state_ts", ("created_at", "load_timestamp")),
    "dim_customer": History("customers", "customer_id", "customer_sk", "updated_at", ("created_at", "load_timestamp")),
    "dim_account": History("accounts", "account_id", "account_sk", "updated_at", ("created_at", "load_timestamp")),
}


def new_states(k: Keeper, name: str) -> tuple[DataFrame | None, int]:
    """Silver rows of the loads that the versions of a dimension do not hold yet, and the version of silver they bring it to."""
    spec = HISTORIES[name]
    silver = k.lake.parts("silver", spec.source)
    _, entry, loads = changed_parts(silver, k.table(f"{name}_versions").entry().notes.get(_OF, 0))
    return (silver.read(loads, entry) if loads else None), entry.version


def branch_states(states: DataFrame, known: DataFrame | None) -> DataFrame:
    """Branch rows with the time from which they hold: the first load of a branch counts from its creation, later ones from themselves."""
    firsts = states.select("branch_code", "load_timestamp")
    if known is not None:
        firsts = firsts.unionByName(known.select("branch_code", "load_timestamp"))
    first = firsts.groupBy("branch_code").agg(F.min("load_timestamp").alias("_first"))
    later = F.when(F.col("load_timestamp") > F.col("_first"), F.greatest("load_timestamp", "created_at")).otherwise(F.col("created_at"))
    return keyed_join(states, first, ["branch_code"]).withColumn("state_ts", later).drop("_first")


def keep_versions(k: Keeper, name: str) -> DataFrame:
    """Versions of a dimension after the new loads; only buckets with a key of them are worked out again."""
    spec, tracked = HISTORIES[name], dims.TRACKED[name]
    table = k.table(f"{name}_versions")
    entry = table.entry()
    states, version = new_states(k, name)
    if states is None:
        return table.read(entry=entry)
    buckets = entry.notes.get("buckets", k.buckets)
    part = bucket([spec.key], buckets)
    touched = names(states, part)
    known = table.read(touched, entry) if entry.version else None
    if name == "dim_branch":
        states = branch_states(states, known)
    batch = settle(states.select(*dict.fromkeys([spec.key, *tracked, spec.ts, *spec.keeps])), "states")
    top = entry.notes.get("top", 0)
    versions = scd2(batch, [spec.key], tracked, spec.ts) if known is None else scd2_apply(known.drop(spec.sk), batch, [spec.key], tracked, spec.ts)
    numbered = settle(number_versions(settle(versions, "versions"), known, [spec.key], spec.sk, top), "numbered")
    highest = numbered.agg(F.max(spec.sk)).first()[0] or 0
    table.replace(numbered, part, touched, {_OF: version, "top": max(top, highest), "buckets": buckets})
    return table.read()


def keep_dimensions(k: Keeper, days: tuple[date, date]) -> dict[str, DataFrame]:
    """All dimensions from their versions; they are small beside the facts and published whole."""
    versions = in_parallel({n: lambda n=n: keep_versions(k, n) for n in HISTORIES})
    put = {}

    def publish(name: str, df: DataFrame) -> None:
        put[name] = k.lake.replace(df, "gold", name)[0]

    publish("dim_date", dims.build_dim_date(k.lake.spark, *days))
    publish("dim_branch", dims.branch_rows(versions["dim_branch"], k.run_ts))
    publish("dim_customer", dims.customer_rows(versions["dim_customer"], put["dim_branch"], k.run_ts))
    publish("dim_account", dims.account_rows(versions["dim_account"], put["dim_customer"], put["dim_branch"], k.run_ts))
    return put


# --- facts ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fact:
    """Where a fact comes from, its number and day, and the dimension row that it names: natural key, number, and what it brings."""

    source: str
    sk: str
    day: str
    rows: Callable[[DataFrame, Gold, datetime, list[str]], DataFrame]
    parent: str | None = None
    names_by: str | None = None
    parent_sk: str | None = None
    brings: tuple[str, ...] = ()

    @property
    def key(self) -> list[str]:
        return list(LOAD_POLICY[self.source][2])


FACTS = {
    "fact_transactions": Fact(
        "transactions", "txn_sk", "txn_date", lambda r, g, ts, more: facts.transaction_rows(r, g["dim_account"], g["dim_date"], ts, more),
        "dim_account", "account_id", "account_sk", ("customer_sk", "branch_sk"),
    ),
    "fact_payments": Fact("payment_gateway_logs", "payment_sk", "txn_date", lambda r, g, ts, more: facts.payment_rows(r, g["dim_date"], ts, more)),
    "fact_credit_risk": Fact(
        "credit_bureau_reports", "credit_sk", "bureau_pull_date", lambda r, g, ts, more: facts.credit_rows(r, g["dim_customer"], g["dim_date"], ts, more),
        "dim_customer", "customer_id", "customer_sk",
    ),
}


def contents(spec: Fact, columns: list[str], known: Entry) -> Column:
    """Fingerprint of a row's content, as bytes; a ledger that has it as text goes on so."""
    digest = row_hash(*[c.name for c in CATALOG[spec.source] if c.name in columns])
    return digest if known.version and known.schema["digest"].dataType.typeName() == "string" else F.unhex(digest)


def arrivals(k: Keeper, spec: Fact, ledger: PartTable, known: Entry, loads: DataFrame) -> DataFrame:
    """Rows of new loads that are new or differ from what the ledger knows of them, with what it knows (_known).

    ``loads`` are written rows. Only keys and fingerprints of rows that the ledger may know are shuffled.
    """
    batch = one_each(loads, spec.key, ["load_timestamp"])
    batch = batch.withColumn("_content", contents(spec, batch.columns, known))
    unknown = F.lit(None).cast(f"struct<seq:bigint,{spec.sk}:bigint,home:string,digest:{batch.schema['_content'].dataType.simpleString()}>")
    if not known.version:
        return batch.withColumn("_known", unknown)
    known_as = F.struct("seq", spec.sk, "home", "digest")
    mine = ledger.read(names(batch, bucket(spec.key, known.notes.get("buckets", k.buckets))), known)
    # The first load of a ledger has every key once.
    newest = mine.select(*spec.key, known_as.alias("_known")) if known.version == 1 else mine.groupBy(*spec.key).agg(F.max(known_as).alias("_known"))
    keyed, keyless = batch.filter(~without_key(spec.key)), batch.filter(without_key(spec.key)).withColumn("_known", unknown)
    # Keys and fingerprints are compared; what else the ledger knows is looked up for the few rows that differ.
    compared = keyed.select(*spec.key, "_content").join(newest.select(*spec.key, F.col("_known.digest").alias("_digest")), spec.key, "left")
    unlike = settle_keys(compared.filter(F.col("_digest").isNull() | (F.col("_digest") != F.col("_content"))).select(*spec.key))
    differ = settle(unlike.join(settle(with_keys(newest, unlike, spec.key), "differ"), spec.key, "left"), "differ-known")
    return settle(keyed_join(keyed, differ, spec.key, "inner", spread=False).unionByName(keyless), "changed")


def known_rows(spec: Fact, ledger: PartTable, entry: Entry, rows: DataFrame, buckets: int) -> DataFrame:
    """What the ledger last wrote about the keys of some rows; only their buckets are read."""
    part = bucket(spec.key, entry.notes.get("buckets", buckets))
    mine = with_keys(ledger.read(names(rows, part), entry), rows.select(*spec.key), spec.key)
    return mine.groupBy(*spec.key).agg(F.max(F.struct("seq", spec.sk, "home", "digest")).alias("known"))


def resolved(k: Keeper, name: str, ledger: PartTable, entry: Entry, gold: Gold) -> DataFrame | None:
    """Rows of the fact whose parent was missing and has arrived: their key, part and the parent's number."""
    spec, waiting = FACTS[name], k.table(f"{name}_unresolved")
    if not waiting.entry().version:
        return None
    parents = current(gold[spec.parent]).select(spec.names_by, spec.parent_sk)
    open_rows = waiting.read()
    found = settle(keyed_join(open_rows, parents, [spec.names_by], "inner"), "resolved")
    if found.isEmpty():
        return None
    # A row that was corrected since names another parent by now.
    newest = settle_keys(known_rows(spec, ledger, entry, found, k.buckets))
    return keyed_join(found, newest, spec.key, "inner", spread=False).filter("digest = known.digest").select(*spec.key, "home", F.col(spec.parent_sk).alias("_found"))


def moved_parts(k: Keeper, spec: Fact, gold: Gold) -> set[str]:
    """Parts of the facts whose accounts belong to another customer or branch than when they were written."""
    owners = k.table("fact_owners")
    if not spec.brings or not owners.entry().version:
        return set()
    now = current(gold[spec.parent]).select(spec.parent_sk, F.struct(*spec.brings).alias("_now"))
    joined = keyed_join(owners.read(), now, [spec.parent_sk], "inner", spread=False)
    moved = settle_keys(joined.filter(F.struct(*spec.brings) != F.col("_now")).select(spec.parent_sk))
    if moved.isEmpty():
        return set()
    return names(with_keys(k.table("daily_cube").read().select(spec.parent_sk, spec.day), moved, [spec.parent_sk]), k.home(spec.day))


def looked_up_again(rows: DataFrame, spec: Fact, gold: Gold, found: DataFrame | None) -> DataFrame:
    """Fact rows that are written again, with the parents they have now."""
    out = rows
    if found is not None:
        known = keyed_join(out, found.select(*spec.key, "_found"), spec.key, spread=False)
        out = known.withColumn(spec.parent_sk, F.coalesce("_found", spec.parent_sk)).drop("_found")
    if spec.brings:
        parents = current(gold[spec.parent]).select(spec.parent_sk, *[F.col(c).alias(f"_{c}") for c in spec.brings])
        out = keyed_join(out, parents, [spec.parent_sk])
        out = out.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in spec.brings})
    return out.select(*rows.columns)


def keep_fact(k: Keeper, name: str, gold: Gold) -> None:
    """Bring a fact up to date with silver and with its dimensions."""
    spec = FACTS[name]
    fact, ledger, silver = k.table(name), k.table(f"{name}_keys"), k.lake.parts("silver", spec.source)
    held, known = fact.entry(), ledger.entry()
    # The ledger is written last, so its note says how far the fact is complete.
    _, arrived, loads = changed_parts(silver, known.notes.get(_OF, 0))
    found = resolved(k, name, ledger, known, gold) if spec.parent and known.version else None
    touched = moved_parts(k, spec, gold) | (names(found, F.col("home")) if found is not None else set())
    if not loads and not touched:
        return
    buckets = known.notes.get("buckets", k.buckets)
    changed = arrivals(k, spec, ledger, known, silver.read(loads, arrived))
    top = max(held.notes.get("top", 0), known.notes.get("top", 0))
    fresh = assign_sk(changed.filter("_known IS NULL"), spec.key, spec.sk, start=top)
    corrected = changed.filter("_known IS NOT NULL").withColumn(spec.sk, F.col(f"_known.{spec.sk}"))
    # Fingerprints of new rows are worked out again behind the shuffle of the numbering rather than sent through it.
    digest = contents(spec, changed.columns, known)
    numbered = fresh.drop("_content").unionByName(corrected.drop("_content")).withColumn("_content", digest).withColumn("_was", F.col("_known.home")).drop("_known")
    if spec.parent:
        numbered = numbered.withColumn("_names", F.col(spec.names_by))
        if not broadcastable(current(gold[spec.parent]).select(spec.names_by, spec.parent_sk, *spec.brings)):
            numbered = settle(numbered, "numbered")  # it is read more than once
    more = ["_content", "_was", *(["_names"] if spec.parent else [])]
    kept = settle(spec.rows(numbered, gold, k.run_ts, more), "fact-rows")
    rows = kept.drop(*more)
    touched |= names(rows, k.home(spec.day)) | names(kept.filter("_was IS NOT NULL"), F.col("_was"))
    if touched:
        stay = without_keys(fact.read(touched, held), rows.select(*spec.key), spec.key) if held.version else rows.limit(0)
        top = max(top, rows.agg(F.max(spec.sk)).first()[0] or 0)
        again = looked_up_again(stay, spec, gold, found)
        fact.replace(again.unionByName(rows).sortWithinPartitions(spec.day), k.home(spec.day), touched, {"top": top})
    keyed = ~without_key(spec.key)  # a row without a key is never found again
    parent = [F.when(keyed, F.col(spec.parent_sk)).alias(spec.parent_sk)] if spec.parent else []
    named = [F.col("_names").alias(spec.names_by)] if spec.parent and spec.names_by not in spec.key else []
    written = kept.select(*spec.key, spec.sk, "_content", F.when(keyed, k.home(spec.day)).alias("home"), *parent, *named)
    if spec.parent:
        keep_unresolved(k, name, written, found, buckets)
        owners = current(gold[spec.parent]).select(spec.parent_sk, *spec.brings)
        if spec.brings:
            k.table("fact_owners").replace(owners, "all", {"all"})
    entry = written.select(*spec.key, spec.sk, "home", F.col("_content").alias("digest"), F.lit(known.version + 1).cast("bigint").alias("seq"))
    ledger.append(entry, bucket(spec.key, buckets), {_OF: arrived.version, "top": top, "buckets": buckets}, plenty(k.lake.spark, kept.count(), buckets))


def keep_unresolved(k: Keeper, name: str, written: DataFrame, found: DataFrame | None, buckets: int) -> None:
    """Rows that name a parent which is not there: those of this load join, those found leave."""
    spec, table = FACTS[name], k.table(f"{name}_unresolved")
    entry = table.entry()
    part = bucket([spec.names_by], buckets)
    columns = list(dict.fromkeys([*spec.key, spec.names_by]))
    new = written.filter(F.col(spec.parent_sk) == 0).select(*columns, "home", F.col("_content").alias("digest"))
    if not entry.version:
        table.replace(new, part)
        return
    gone = written.select(*spec.key)
    if found is not None:
        gone = gone.unionByName(found.select(*spec.key))
    touched = names(new, part) | names(with_keys(table.read(entry=entry), gone, spec.key), part)
    if touched:
        table.replace(without_keys(table.read(touched, entry), gone, spec.key).unionByName(new), part, touched)


# --- aggregates -------------------------------------------------------------------------------


def rolled_in_parts(rows: DataFrame, slices: int, part: Column, keys: list[str], sums: list[str], maxima: list[str] = []) -> DataFrame:
    """:func:`roll` by keys that a part follows from: rows go once, as they are, to the task that groups them and writes their part.

    Each part is dealt over ``slices`` tasks by all keys, so that an account with very many rows is spread by its days.
    """
    deal = F.pmod(F.xxhash64(*keys), F.lit(slices))
    dealt = rows.withColumns({"_home": part, "_slice": deal}).repartition("_home", "_slice")
    return roll(dealt, ["_home", "_slice", *keys], sums, maxima).drop("_home", "_slice")


def follow(k: Keeper, name: str, upstream: PartTable, make: Callable[[DataFrame, int], DataFrame], part: Column, placed: bool = True) -> None:
    """A table whose parts are made from the same parts of another one.

    ``make`` also gets the number of tasks over which the largest of these parts is to be dealt; with ``placed`` it leaves rows there.
    """
    table = k.table(name)
    _, new, touched = changed_parts(upstream, table.entry().notes.get(_OF, 0))
    if touched or not table.entry().version:
        sizes = [sum(n for p, _, n in new.folders if p == one) for one in touched]
        slices = -(-max(sizes, default=1) // DEALT_ROWS) or 1
        table.replace(make(upstream.read(touched, new), slices), part, touched, {_OF: new.version}, placed)


def keep_monthly(k: Keeper, cube: PartTable, dim_branch: DataFrame) -> None:
    """Monthly rows of the months that changed, from the cube of those months.

    The rows carry code and name of their branch, so months of a branch that has other ones now change too. The table has
    a row per branch and month and is looked through for them.
    """
    table = k.table("agg_monthly_summary")
    held = table.entry()
    _, new, touched = changed_parts(cube, held.notes.get(_OF, 0))
    months = {part[:7] for part in touched}
    if held.version:
        now = dim_branch.select("branch_sk", F.struct("branch_code", "branch_name").alias("_now"))
        stale = keyed_join(table.read(entry=held), now, ["branch_sk"], "inner", spread=False).filter(~F.struct("branch_code", "branch_name").eqNullSafe(F.col("_now")))
        months |= names(stale, F.coalesce("year_month", F.lit(NO_PART)))
        if not months:
            return
    rows = cube.read(lambda p: p[:7] in months, new).withColumn("year_month", F.date_format("txn_date", "yyyy-MM"))
    table.replace(aggregates.monthly_cells(rows, dim_branch, k.run_ts), F.coalesce("year_month", F.lit(NO_PART)), months, {_OF: new.version})


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per account: what its sums gain, and its extremes in the changed parts before (was_) and after (now_).

    Accounts whose rows in the changed parts are the same as before drop out.
    """
    extremes = [*SPANS["maxima"], *SPANS["minima"]]

    def side(df: DataFrame, sign: int, mine: str, other: str) -> DataFrame:
        sums = [(F.col(c) * sign).alias(c) for c in (*SUMS, "rows")]
        return df.select(*ACCOUNT, *sums, *[F.col(c).alias(f"{mine}{c}") for c in extremes], *[F.lit(None).cast(df.schema[c].dataType).alias(f"{other}{c}") for c in extremes])

    both = side(before, -1, "was_", "now_").unionByName(side(after, 1, "now_", "was_"))
    picks = [(F.max if c in SPANS["maxima"] else F.min)(f"{when}{c}").alias(f"{when}{c}") for c in extremes for when in ("was_", "now_")]
    found = both.groupBy(*ACCOUNT).agg(*[F.sum(c).alias(c) for c in (*SUMS, "rows")], *picks)
    same = [F.coalesce(F.col(c), F.lit(0)) == 0 for c in (*SUMS, "rows")] + [F.col(f"was_{c}").eqNullSafe(F.col(f"now_{c}")) for c in extremes]
    return found.filter(~all_of(same))


def all_of(conditions: Iterable[Column]) -> Column:
    found = F.lit(True)
    for c in conditions:
        found = found & c
    return found


def keep_totals(k: Keeper, cube: PartTable) -> None:
    """Lifetime sums and extremes per account, changed by the difference of the changed parts."""
    table = k.table("account_totals")
    held = table.entry()
    old, new, touched = changed_parts(cube, held.notes.get(_OF, 0))
    if not touched and held.version:
        return
    buckets = held.notes.get("buckets", k.buckets)
    part = bucket(["customer_sk"], buckets)
    notes = {_OF: new.version, "buckets": buckets}
    after = roll(cube.read(touched, new), ACCOUNT, [*SUMS, "rows"], **SPANS)
    if not old.version:  # the first build, or the version noted is gone: from the whole cube
        table.replace(roll(cube.read(entry=new), ACCOUNT, [*SUMS, "rows"], **SPANS), part, lambda _: True, notes)
        return
    before = roll(cube.read(touched, old), ACCOUNT, [*SUMS, "rows"], **SPANS)
    delta = settle(difference(before, after), "delta")
    gained = delta.select(*ACCOUNT, *[F.col(c).alias(f"_{c}") for c in (*SUMS, "rows")], *[c for c in delta.columns if c.startswith(("was_", "now_"))])
    changed = names(delta, part)
    joined = table.read(changed, held).join(gained, ACCOUNT, "full")
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(after.schema[c].dataType)) + F.coalesce(F.col(f"_{c}"), F.lit(0).cast(after.schema[c].dataType)) for c in (*SUMS, "rows")}
    lost = F.lit(False)
    best = {}
    for c in SPANS["maxima"] + SPANS["minima"]:
        # It was the account's extreme and is not reached any more in the changed parts: another part may hold the next one.
        lost = lost | (F.col(c).eqNullSafe(F.col(f"was_{c}")) & F.col(f"was_{c}").isNotNull() & ~F.col(f"now_{c}").eqNullSafe(F.col(f"was_{c}")))
        best[c] = (F.greatest if c in SPANS["maxima"] else F.least)(F.col(c), F.col(f"now_{c}"))
    summed = joined.select(*ACCOUNT, *[v.cast(after.schema[c].dataType).alias(c) for c, v in zero.items()], *[v.alias(c) for c, v in best.items()], F.coalesce(lost, F.lit(False)).alias("_lost"))
    result = settle(summed.filter(F.col("rows") > 0), "totals")
    again = settle_keys(result.filter("_lost").select(*ACCOUNT))
    if not again.isEmpty():
        extremes = roll(with_keys(cube.read(entry=new), again, ACCOUNT), ACCOUNT, [], **SPANS)
        whole = result.filter("_lost").drop(*best).join(extremes, ACCOUNT).select(*result.columns)
        result = result.filter("NOT _lost").unionByName(whole)
    table.replace(result.drop("_lost"), part, changed, notes)


def keep_days(k: Keeper, cube: PartTable) -> None:
    """Days with transactions per customer, changed by days that came or went in the changed parts."""
    table = k.table("customer_days")
    held = table.entry()
    old, new, touched = changed_parts(cube, held.notes.get(_OF, 0))
    if not touched and held.version:
        return
    buckets = held.notes.get("buckets", k.buckets)
    part = bucket(["customer_sk"], buckets)
    whole = not old.version

    def days(entry: Entry, sign: int) -> DataFrame:
        rows = cube.read(None if whole else touched, entry).select("customer_sk", "txn_date").distinct()
        return rows.withColumn("days", F.when(F.col("txn_date").isNotNull(), F.lit(sign).cast("bigint")).otherwise(0))

    if whole:
        moved = days(new, 1)
    else:
        both = days(old, -1).unionByName(days(new, 1))
        moved = both.groupBy("customer_sk", "txn_date").agg(F.sum("days").alias("days")).filter("days <> 0")
    gained = settle(moved.groupBy("customer_sk").agg(F.sum("days").alias("days")), "days")
    changed = names(gained, part)
    result = gained if whole else roll(table.read(changed, held).unionByName(gained), ["customer_sk"], ["days"])
    table.replace(result, part, (lambda _: True) if whole else changed, {_OF: new.version, "buckets": buckets})


def keep_customers(k: Keeper) -> None:
    """Customer rows of the buckets whose totals or days changed."""
    table, totals, days = k.table("agg_customer_360"), k.table("account_totals"), k.table("customer_days")
    notes = table.entry().notes
    _, t, by_totals = changed_parts(totals, notes.get("totals", 0))
    _, d, by_days = changed_parts(days, notes.get("days", 0))
    touched = by_totals | by_days
    if not touched and table.entry().version:
        return
    accounts = roll(totals.read(touched, t), ["customer_sk", "account_sk"], SUMS, **SPANS)
    rows = aggregates.customer_rows(accounts, days.read(touched, d), k.run_ts)
    table.replace(rows, bucket(["customer_sk"], t.notes["buckets"]), touched, {"totals": t.version, "days": d.version})


def keep_aggregates(k: Keeper, gold: Gold) -> None:
    """All aggregates of the transaction fact."""
    fact, cube = k.table("fact_transactions"), k.table("daily_cube")

    def measured(rows: DataFrame, slices: int) -> DataFrame:
        counted = transaction_measures(rows).withColumn("rows", F.lit(1).cast("bigint"))
        cells = rolled_in_parts(counted, slices, k.home("txn_date"), [*ACCOUNT, "txn_date"], [*SUMS, "rows"], ["largest"])
        return cells.withColumns({"first_date": F.col("txn_date"), "last_date": F.col("txn_date")})

    named = broadcastable(gold["dim_account"].select("account_sk", "account_id"))

    def daily(rows: DataFrame, slices: int) -> DataFrame:
        days = rolled_in_parts(rows, slices, k.home("txn_date"), ["account_sk", "txn_date"], SUMS)
        return aggregates.daily_rows(days, gold["dim_account"], k.run_ts)

    follow(k, "daily_cube", fact, measured, k.home("txn_date"))
    in_parallel({
        "days": lambda: follow(k, "agg_daily_balances", cube, daily, k.home("txn_date"), named),
        "months": lambda: keep_monthly(k, cube, gold["dim_branch"]),
        "totals": lambda: keep_totals(k, cube),
        "customer_days": lambda: keep_days(k, cube),
    })
    keep_customers(k)
    branches = aggregates.branch_rows(k.table("account_totals").read(), gold["dim_branch"], k.run_ts)
    k.lake.replace(branches, "gold", "agg_branch_performance")


def keep_gold(k: Keeper, days: tuple[date, date]) -> dict[str, DataFrame]:
    """Every gold table brought up to date with silver."""
    gold = keep_dimensions(k, days)
    in_parallel({f: lambda f=f: keep_fact(k, f, gold) for f in FACTS})
    keep_aggregates(k, gold)
    kept = [*FACTS, "agg_daily_balances", "agg_monthly_summary", "agg_branch_performance", "agg_customer_360"]
    return gold | {t: k.lake.current("gold", t) for t in kept}
