"""Every registered query against its SQL counterpart, value by value."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in driver.queries() if n not in driver.LLM_QUERIES and n != "pipeline"])
def test_query(spark, con, sf_dir, name):
    assert differences(spark, con, name, sf_dir) == []


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 150


def test_the_rest_works_where_the_tokenizers_are_missing():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; "
        "names = set(e.queries()); assert 'user_features' in names and not any(n.startswith('op') or n == 'pipeline' for n in names); "
        "assert set(e.oracle_sql()) <= names"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(driver.__file__).parent)
