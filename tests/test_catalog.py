"""Every query against its SQL, on whole tables."""

from __future__ import annotations

import os
import time

import pytest

import __spark_entry__ as entry_points
from catalog.oracles import ORACLES
from catalog.queries import CATALOG
from compare import assert_same, duck

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
QUERIES = CATALOG


def test_oracles_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert CATALOG.items() <= entry_points.queries().items()
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    start = time.time()
    result = QUERIES[name](spark, SF_DIR)
    assert assert_same(result, duck(SF_DIR).sql(ORACLES[name])) > 0
    print(f"{name}: {time.time() - start:.2f} s")


def test_entry(spark):
    report = entry_points.entry(spark)
    assert report.columns == ["metric", "label", "value"]
    assert report.count() == 12
