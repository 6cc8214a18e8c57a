"""Operators that SQL can express equal their DuckDB SQL on whole tables."""

import os
import sys

import pytest

from eventide.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    from compare import compare

    assert compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name][0] == "OK"


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op3_rendezvous_sharding", "op8_pfair_mixing"])
def test_native_operators_run_no_python(spark, name):
    from eventide.plans.inspect import physical_plan

    plan = physical_plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan
