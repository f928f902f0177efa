"""Registered queries against their SQL. LENDGRID_ALL=1 runs every one of them."""

import os
import re
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from sql_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "fe6_bureau_balance", "fe15_feature_table", "p1_null_profile", "p6_target_correlations", "m2_stratified_holdout",
    "m11_metrics_by_group", "m15_threshold", "a9_fairness_report", "c5_assign_clusters", "x4_reason_codes",
    "r5_keyword_search", "r11_retrieve", "q5_review_batch", "d1_feature_drift", "d4_streamed_log",
    "io1_checked_scan", "io6_exactly_once_log", "fe11_history_store", "fe14_category_dictionary", "d1_category_drift", "r14_reply_store",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def names():
    return sorted(entry_points.oracle_sql()) if os.environ.get("LENDGRID_ALL") else SAMPLE


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, name):
    outcome = compare(spark, connect(FOLDER), FOLDER, name, entry_points.queries()[name], entry_points.oracle_sql()[name])
    assert outcome.startswith("ok") or (outcome.startswith("EMPTY") and name.startswith("d2")), outcome


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    """A copy without the llm folders, with and without their pipeline, imports and keeps all other queries."""
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    others = sorted(n for n in entry_points.queries() if n != "pipeline" and not re.match(r"op\d+_", n))
    for name, gone in (("without", ("llm",)), ("bare", ("llm", "corpus_pipeline.py"))):
        copy = shutil.copytree(root, tmp_path / name, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.md", "*.json", *gone))
        out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"],
                             cwd=copy, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr
        assert out.stdout.split() == others


def test_entry(spark):
    assert entry_points.entry(spark).count() == 150
