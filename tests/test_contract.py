"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from workload import queries as library
from check import connect, difference
from conftest import SF_DIR

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(library.registered()))
def test_query_matches_sql(spark, duck, name):
    assert difference(contract.queries()[name](spark, SF_DIR), duck, SQL[name]) is None


@pytest.mark.parametrize("name", ["chain_rejects", "validated_join_outer", "store_name_fix", "numeric_profile", "panel_store_queue"])
def test_plans_have_no_cross_join_and_no_python(spark, plan_of, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert "BroadcastHashJoin" in plan
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Exchange SinglePartition"):
        assert node not in plan


def test_every_query_has_sql():
    assert set(library.registered()) <= set(SQL) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    """Their folders and the pipeline may be deleted, a library of theirs may be missing."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("gondola", "workload", "__spark_entry__.py"):
        source = os.path.join(root, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), set(s) == set(q), any(n.startswith('op') for n in q))"
    alone = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""}, check=True)
    assert alone.stdout.split() == [str(len(library.registered())), "True", "False"]
    blocked = "import sys; sys.modules['public_tokenizers'] = None; " + code
    partly = subprocess.run([sys.executable, "-c", blocked], cwd=root, capture_output=True, text=True, check=True)
    assert partly.stdout.split()[0] == str(len(library.registered()))
