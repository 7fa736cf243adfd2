"""The registered queries without checking SQL, and the contract of the entry module."""

from __future__ import annotations

import importlib.util
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from shoplens.registry import oracle_sql, queries

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def folder(testdata):
    return f"{testdata}/sf0.01"


def test_entry_module(spark):
    spec = importlib.util.spec_from_file_location("entry_module", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_entry_module_without_the_corpus_operators(tmp_path, pipeline_stays):
    """On a copy without the subpackage, with and without the pipeline that is built on it."""
    shutil.copytree(ROOT / "shoplens", tmp_path / "shoplens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline_stays else [])]:
        shutil.copy(ROOT / name, tmp_path / name)
    told = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert found == [str(len(queries())), "False", str(len(oracle_sql()))]


def test_every_query_has_checking_sql():
    assert set(queries()) == set(oracle_sql())


def test_split_keeps_every_row(spark, folder):
    parts = {r["part"]: r["count"] for r in queries()["train_test_split"](spark, folder).groupBy("part").count().collect()}
    assert sum(parts.values()) == 15_000 and set(parts) == {"train", "test"}


def test_sample_budget(spark, folder, testdata):
    sample = queries()["sample_to_budget"]
    assert sample(spark, folder).count() == 9_912  # labelled rows, all of them
    assert abs(sample(spark, f"{testdata}/sf0.1").count() - 50_000) < 1_000


def test_invariants(spark, folder):
    q = queries()
    assert sum(r.pct for r in q["status_share"](spark, folder).collect()) == pytest.approx(100, abs=0.2)
    assert sum(r["count"] for r in q["order_value_histogram"](spark, folder).collect()) == 15_000
    f = q["clickstream_funnel"](spark, folder).collect()[0]
    assert max(f.sessions_with_view, f.sessions_with_cart, f.sessions_with_checkout) <= f.total_sessions
    trend = q["monthly_revenue_trend"](spark, folder).collect()
    assert trend[-1].cumulative_revenue == pytest.approx(sum(r.monthly_revenue for r in trend))
