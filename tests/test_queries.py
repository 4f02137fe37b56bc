"""Every registered query against its SQL text, and the shape of the registry."""

from __future__ import annotations

import importlib
import subprocess
import sys
from pathlib import Path

import pytest

from oracle import DATA, spark_rows, sql_rows

ROOT = Path(__file__).resolve().parents[1]
entry = importlib.import_module("__spark_entry__")
registered = importlib.import_module("tillstar.verify.queries")
oracles = importlib.import_module("tillstar.verify.oracles")
SF = str(DATA / "sf0.001")


def test_every_query_has_sql():
    assert set(oracles.oracle_sql()) == set(registered.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_registry_needs_no_session():
    code = "import tillstar.verify.queries as q, tillstar.verify.oracles as o, __spark_entry__ as e"
    code += "; e.queries(), e.oracle_sql(); print(len(q.queries()), len(o.oracle_sql()))"
    ran = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True
    )
    assert ran.returncode == 0, ran.stderr
    assert len(set(ran.stdout.split())) == 1


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_agrees_with_sql(spark, name):
    columns, rows = spark_rows(entry.queries()[name](spark, SF))
    sql_columns, expected = sql_rows(entry.oracle_sql()[name], SF)
    assert columns == sql_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "order_key"
    assert result.count() > 0
