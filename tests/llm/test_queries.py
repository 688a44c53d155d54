"""Queries of the subpackage at the smallest size: rows as in their SQL where there is some, and the fixed columns."""

import pytest

import __spark_entry__ as entry
from lightloom.llm.queries import ORACLE, QUERIES
from oracle_check import compare

COLUMNS = {"p2_found": ["pairing", "left_id", "right_id"], "p5_found": ["cat_id", "obj_id"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"]}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    assert name in entry.queries()
    assert compare(spark, data, name, ORACLE.get(name))[:4] in ("same", "rows")
    if name in COLUMNS:
        assert QUERIES[name](spark, data).columns == COLUMNS[name]
