"""Every registered query against its SQL twin on the smallest tables."""

import re
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from check_queries import compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
#: Queries without a twin, each held against rows worked out by hand or by brute force elsewhere in the tests.
NO_TWIN = {"variant_exceptions", "media_records", "rewritten_bodies", "product_json_ld", "content_words", "pipeline"}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    result = compare(spark, FOLDER, name, entry.queries()[name], SQL.get(name))
    no_twin = name in NO_TWIN or re.match(r"op\d+_", name) and name not in SQL
    assert result.startswith("rows-only" if no_twin else "ok"), result


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries())
