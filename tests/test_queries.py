"""Every query against its SQL, at the smallest scale."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def con(tmp_path_factory):
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, sf_dir, name):
    ok, note = compare(spark, con, sf_dir, contract.queries()[name], contract.oracle_sql().get(name))
    assert ok, note


def test_flagship(spark):
    assert contract.entry(spark).count() == 300


def test_no_python_in_the_plans_and_columns_pruned(spark, sf_dir):
    from workload import queries

    plan = queries.composite_exact_part(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_type:string>" in re.sub(r"\s+", " ", plan)
    assert "Python" not in plan
