"""Every registered query against its oracle, on the smallest tables."""

from __future__ import annotations

import pathlib

import pytest

import __spark_entry__ as entry
import compare
from tallyhouse.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# The whole job is covered by test_job.py and by compare.py.
SLOW = {"job_summary", "stream_incremental_load"}

pytestmark = pytest.mark.skipif(
    not pathlib.Path(SF_DIR).is_dir(), reason="supplied tables not present"
)


@pytest.fixture(scope="module")
def oracle():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_equals_oracle(spark, oracle, name):
    problem = compare.compare(spark, oracle, name, SF_DIR, QUERIES, ORACLES)
    # Very small tables may leave a filter without rows on both sides.
    assert problem in ("", "no rows on either side")


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries())
