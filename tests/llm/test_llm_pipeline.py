"""The corpus pipeline: every stage on what the one before kept, its decisions in effect."""

from __future__ import annotations

import importlib
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tellerlake.llm import packing, pii, queries, quality, simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1][1], SF).write.parquet(path)
        out.append((name, spark.read.parquet(path)))
    return dict(out)


def test_order_and_columns(stages):
    assert list(stages) == ["documents", "quality", "near_duplicates", "personal_data", "mixing", "packing"]
    assert all(stages[s].columns == COLUMNS for s in list(stages)[:-1])


def test_quality_rejects(stages, spark):
    scores = quality.classify(stages["documents"], spark.read.parquet(f"{SF}/labels.parquet"))
    wanted = {r.doc_id for r in scores.filter("predicted = 1").collect()}
    assert {r.doc_id for r in stages["quality"].collect()} == wanted and 0 < len(wanted) < stages["documents"].count()


def test_one_of_each_group_stays(stages):
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(stages["quality"]).collect()}
    kept = [groups[r.doc_id] for r in stages["near_duplicates"].collect()]
    assert sorted(kept) == sorted(set(groups.values()))


def test_personal_data_goes(stages):
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    after = stages["personal_data"].collect()
    assert len(after) == len(before) and all(r.n_chars == len(r.text) for r in after)
    assert not any(pii.base_spans(r.text) for r in after)
    assert all(r.text == before[r.doc_id].text for r in after if not pii.base_spans(before[r.doc_id].text))


def test_mix_repeats_and_drops(stages):
    before = {r.doc_id: r for r in stages["personal_data"].collect()}
    copies = Counter(r.doc_id for r in stages["mixing"].collect())
    assert set(copies) < set(before) and max(copies.values()) <= 3


def test_packs_every_copy(stages):
    pieces = Counter(r.doc_id for r in stages["packing"].filter("piece = 0").collect())
    assert pieces == Counter(r.doc_id for r in stages["mixing"].collect())
    assert stages["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").isEmpty()


def test_run_gives_the_last_stage(stages, spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == stages["packing"].columns and found.count() == stages["packing"].count()


def test_awkward_documents(spark, awkward, no_docs):
    docs = awkward.select(*COLUMNS)
    for start in (docs, no_docs.select(*COLUMNS)):
        now = start
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
        now.collect()


def test_columns_of_any_name_come_through(spark, awkward):
    """Every stage but the last returns the columns it got, those with the operators' own names unchanged."""
    names = ["quality_score", "Quality_Score_", "copy", "own_0", "source_size", "n", "members_"]
    now = awkward.withColumns({c: F.lit("clash") for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == now.columns, name
        clashing = [c for c in out.columns if c not in COLUMNS]
        assert {tuple(r) for r in out.select(*clashing).distinct().collect()} <= {("clash",) * len(clashing)}, name
    corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()


def test_sql_counterparts(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df, result = queries.queries()[name](spark, SF), con.sql(sql)
        rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
        order = [list(result.columns).index(c) for c in sorted(df.columns)]
        assert sorted(rows, key=str) == sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=str), name


def test_registered_queries():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} and "pipeline" in names
    assert packing.__name__.startswith("tellerlake.llm")


def test_nothing_else_imports_the_package():
    root = Path(__file__).resolve().parents[2]
    for p in [*root.glob("tellerlake/**/*.py"), *root.glob("conformance/*.py"), root / "bench.py"]:
        if "llm" not in p.parts:
            assert "llm" not in p.read_text(), p
    code = "import sys; sys.modules['tellerlake.llm'] = None; import __spark_entry__ as e; assert not any(n.startswith('op1') for n in e.queries()) and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
