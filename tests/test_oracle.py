"""Every registered query against its SQL on the same tables."""

import oracle
import pytest

from cadenza.suite import REGISTRY


#: Queries whose thresholds leave no row of the smallest tables.
LARGER = {"trending", "trending_genres"}


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_query_equals_sql(spark, sf_dir, name):
    registered, tables = REGISTRY[name], "/root/testdata/sf0.01" if name in LARGER else sf_dir
    assert oracle.difference(oracle.connect(tables), registered.run(spark, tables), registered.sql) is None


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if not q.sql))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert REGISTRY[name].run(spark, sf_dir).count() > 0


def test_driver_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


def test_contract_imports_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=Path(__file__).parents[1], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
