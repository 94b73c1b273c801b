"""Every corpus query that SQL can express, against that SQL."""

import pytest
from compare import compare, oracle_connection

from curbline.llm import queries
from curbline.llm.oracles import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLE_SQL[name]) == []
