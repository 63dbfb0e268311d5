"""The queries of this folder against their SQL on the smallest data."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from strandwise.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    df = queries.QUERIES[name](spark, SF)
    r = c.execute(queries.ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(r.fetchall())


def test_columns_of_the_found_queries(spark):
    want = {
        "p2_found": [("node_key", "string"), ("group_key", "string")], "p4_found": [("source_a_id", "bigint"), ("source_b_id", "bigint"), ("content_kind", "string")],
        "p6_found": [("source_id", "bigint"), ("entity_evidence_id", "string"), ("canonical_identifier_type_id", "bigint"), ("canonical_identifier", "string")],
        "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")], "p10_found": [("doc_id", "bigint"), ("lang_code", "string")],
    }
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, SF).dtypes == columns
