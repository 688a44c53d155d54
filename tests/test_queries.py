"""Every query that has SQL gives the rows of its SQL; the others give rows."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare

CORE = [n for m in entry.CORE for n in entry.import_module(m).QUERIES]


@pytest.mark.parametrize("name", sorted(set(CORE)))
def test_query(spark, data, name):
    assert compare(spark, data, name, entry.oracle_sql().get(name))[:4] in ("same", "rows")


def test_entry(spark, data):
    assert entry.entry(spark).columns == ["field", "night_id", "star_id", "frame_index", "aper"]
