"""The p-queries on the smallest tables: columns, types, no repeated rows, SQL where there is one."""

import pytest

from loomery.llm import queries as Q

from ..oracle import assert_same, connection

COLUMNS = {
    "p1_found": [("src", "string"), ("row_id", "bigint")], "p2_found": [("audit_id", "bigint"), ("field", "string")], "p3_found": [("audit_id", "bigint")], "p4_found": [("src", "string"), ("first_id", "bigint"), ("row_id", "bigint")],
    "p6_found": [("src", "string"), ("row_id", "bigint"), ("field", "string")], "p7_found": [("src", "string"), ("row_id", "bigint"), ("lang", "string")], "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")], "p9_found": [("doc_id", "bigint"), ("item_id", "bigint")], "p10_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_equals_sql(spark, sf_dir, name):
    assert_same(Q.QUERIES[name](spark, sf_dir), connection(sf_dir), Q.SQL[name])


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_runs(spark, sf_dir, name):
    df = Q.QUERIES[name](spark, sf_dir)
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert rows or name == "p9_found"
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
        assert len(set(rows)) == len(rows)
