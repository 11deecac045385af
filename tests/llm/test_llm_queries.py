import os

import pytest

from chatlake.llm import queries as Q
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no test data")


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, name):
    df = Q.queries()[name](spark, oracle.DATA)
    if name in Q.oracle_sql():
        oracle.compare(df, Q.oracle_sql()[name], oracle.views())
    else:
        rows = df.collect()
        assert df.columns and len(rows) == len(set(map(str, rows)))
