"""Every registered query against its SQL, on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import TABLES, rows_of
from slotledger.plans import queries as query_plans

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are missing")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(queries()) & set(oracle_sql())))
def test_query_matches_its_sql(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    ours = rows_of(frame.columns, frame.collect())
    result = duck.sql(oracle_sql()[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert ours == rows_of(result.columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).columns == ["depositor_name", "moment_month", "slots_used_month"]


def test_loads_without_the_training_data_operators(tmp_path):
    """With the subpackage, its pipeline and its tokenizers taken out, the rest still runs."""
    root = Path(__file__).parent.parent
    shutil.copytree(root / "slotledger", tmp_path / "slotledger", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = (
        "import sys; sys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e\n"
        "from slotledger.session import build_session\n"
        "assert set(e.queries()) >= set(e.oracle_sql()) and not any(n.startswith('op') for n in e.queries())\n"
        "spark = build_session('bare', 'local[2]', {'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2'})\n"
        "assert e.entry(spark).count() >= 0\n"
    )
    for with_pipeline in (False, True):
        if with_pipeline:  # a pipeline left behind does no harm
            shutil.copy(root / "corpus_pipeline.py", tmp_path)
            code = code.rsplit("from slotledger.session", 1)[0]
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=300)


def test_reconciliations_store_no_tiles(spark, monkeypatch):
    stored, cut = [], query_plans.cut
    monkeypatch.setattr(query_plans, "cut", lambda df, label: stored.append(label) or cut(df, label))
    query_plans.QUERIES["dq_reconcile_layers"](spark, FOLDER)
    assert stored == ["ledger", "operations"]


@pytest.mark.parametrize("name", ["mart_balance_daily", "spine_enriched"])
def test_all_days_are_given_by_item_and_month(spark, name):
    """Days that share their totals are neighbours, so that they compress where they are stored."""
    days = query_plans.QUERIES[name](spark, FOLDER)
    shown = days.select(F.spark_partition_id(), "item_name", F.trunc("moment_day", "MM")).collect()
    met = [tuple(row) for row in shown]
    assert len(met) > 1000 and met == sorted(met)
