"""Every registered query against its SQL, and what no plan may contain."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as registered
from tests.compare import connect, differences

FOLDER = os.environ.get("STOREFRONT_SF_DIR", "/root/testdata/sf0.01")


# Queries of the text operators have tests of their own in tests/llm.
NAMES = sorted(n for n, f in registered.queries().items() if f.__module__.startswith("storefront.plans"))


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(NAMES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_and_stays_native(name, spark, con):
    df = registered.queries()[name](spark, FOLDER)
    assert differences(df, con, registered.oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert operator not in plan, f"{operator} in {name}"


def test_entry(spark):
    statuses = registered.entry(spark).collect()
    totals = [r.total for r in statuses]
    assert totals == sorted(totals, reverse=True) and len(totals) == 3


@pytest.mark.parametrize("absent", ["storefront.llm", "public_tokenizers", "corpus_pipeline"])
def test_entry_without_text_operators(absent):
    """In a process of its own, with a module that cannot be imported."""
    code = f"""
import sys
sys.modules[{absent!r}] = None
import __spark_entry__ as e
assert len(e.queries()) >= {len(NAMES)} and not any(n.startswith('op') for n in e.queries()), sorted(e.queries())
assert e.TEXT_OPERATORS_LACK
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(registered.__file__).parent, timeout=120)
