"""Tables that Spark derives from the given ones, written once per application and read by queries."""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import mapping
from tellerlake.plans.nightly import SORTED_BY, STAGES, gold_plan
from tellerlake.plans.silver import SPEC, SilverResult, build_silver
from tellerlake.schemas import WAREHOUSE
from tellerlake.session import in_parallel, scratch_path, settle
from tellerlake.sources.lake import Lake

RUN_TS = datetime(2025, 3, 1)
# Covers every date of the given tables.
CALENDAR = (date(1995, 1, 1), date(2030, 12, 31))


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._gold: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}
        self._results: dict[str, SilverResult] = {}

    @cached_property
    def lake(self) -> Lake:
        """Lake with silver and gold tables published."""
        lake = Lake(self.spark, scratch_path(self.spark, "lake"))
        gold = self.all_gold()
        in_parallel({t: lambda t=t: lake.append(self.silver(t), "silver", t) for t in mapping.TABLES})
        in_parallel({t: lambda t=t, df=df: lake.replace(df, "gold", t) for t, df in gold.items()})
        return lake

    def source(self, name: str) -> DataFrame:
        return mapping.source(self.spark, self.sf_dir, name)

    def bronze(self, name: str) -> DataFrame:
        return self.source(name).withColumn("load_date", F.lit(RUN_TS.date()))

    def checked(self, name: str) -> SilverResult:
        """Lazy silver, quarantine and outcomes of a source."""
        if name not in self._results:
            self._results[name] = build_silver(self.bronze(name), SPEC[name], RUN_TS)
        return self._results[name]

    def silver(self, name: str) -> DataFrame:
        """Written silver table."""
        if name not in self._silver:
            self._silver[name] = settle(self.checked(name).silver, f"silver-{name}")
        return self._silver[name]

    def plan(self, name: str) -> DataFrame:
        """Lazy plan of a gold table over written ones."""
        return gold_plan(name, self.silver, self.gold, self.spark, RUN_TS, CALENDAR)

    def gold(self, name: str) -> DataFrame:
        """Written gold table, built with what it needs on first use."""
        if name not in self._gold:
            plan = self.plan(name)
            day = SORTED_BY.get(name)
            self._gold[name] = settle(plan.sortWithinPartitions(day) if day else plan, f"gold-{name}")
        return self._gold[name]

    def all_silver(self) -> dict[str, DataFrame]:
        return in_parallel({t: lambda t=t: self.silver(t) for t in mapping.TABLES})

    def all_gold(self) -> dict[str, DataFrame]:
        self.all_silver()
        for stage in STAGES:
            in_parallel({t: lambda t=t: self.gold(t) for t in stage})
        return {t: self.gold(t) for t in WAREHOUSE}


class Gold(dict):
    """Gold tables by name, built when first asked for."""

    def __init__(self, workspace: Workspace):
        super().__init__()
        self._workspace = workspace

    def __missing__(self, name: str) -> DataFrame:
        return self._workspace.gold(name)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Workspace(spark, sf_dir)
    return _open[key]
