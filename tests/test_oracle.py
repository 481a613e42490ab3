"""Every registered query against its DuckDB SQL (the driver's gate)."""

import pytest

from climastar.oracle import oracle_sql
from climastar.plans.catalog import QUERIES
from conftest import SF0001, SF001
from oracle_compare import compare, duck



def queries():
    """The core queries; those of other subpackages have tests of their own."""
    return QUERIES


CORE_AT_SF001 = ["clean_temperatures", "fact_city_airport", "report_city_climate",
                 "report_city_veterans", "constraint_violations", "join_star_report"]


@pytest.fixture(scope="module")
def con_small():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle_sf0001(spark, con_small, name):
    r = compare(spark, SF0001, name, queries()[name], oracle_sql().get(name), con_small)
    assert r["status"] in ("ok", "rows-only"), r


@pytest.mark.parametrize("name", CORE_AT_SF001)
def test_query_matches_oracle_sf001(spark, name):
    r = compare(spark, SF001, name, queries()[name], oracle_sql()[name])
    assert r["status"] == "ok", r


def test_every_query_has_oracle():
    assert set(queries()) == set(oracle_sql())


def test_entry_works_without_the_training_data_operators(tmp_path):
    """A copy without that subpackage still imports and registers the core queries."""
    import os
    import shutil
    import subprocess
    import sys

    from conftest import ROOT

    shutil.copytree(os.path.join(ROOT, "climastar"), tmp_path / "climastar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; from climastar.plans.catalog import QUERIES as q; assert set(e.queries()) == set(q) == set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
