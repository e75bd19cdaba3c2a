"""Every registered query against its expected result on the smallest scale."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from oracle.queries import Q as EXPECTED
from ridelake.queries import all_queries

QUERIES = all_queries()
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(entry.queries()) and set(EXPECTED) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_text_operators(tmp_path):
    """The rest imports and has its queries where the folder of the text operators and the
    pipeline are not there."""
    for name in ("ridelake", "oracle"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "ridelake" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(EXPECTED))]


def test_entry_is_lazy_and_stable(spark):
    result = entry.entry(spark)
    assert len(result.columns) == 81
    assert result.columns[:2] == ["station_id", "date_day"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, EXPECTED[name]) == []
