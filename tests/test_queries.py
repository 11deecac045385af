import os

import pytest

from chatlake.plans import core_queries
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no test data")
SQL = core_queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.views()


@pytest.mark.parametrize("name", sorted(core_queries.queries()))
def test_query(spark, con, name):
    df = core_queries.queries()[name](spark, oracle.DATA)
    if name in SQL:
        oracle.compare(df, SQL[name], con)
    else:
        assert df.columns and df.count() >= 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm(spark):
    q = core_queries.queries()
    for name in ("canonical_messages", "adjacent_similarity", "pending_web", "hash_reuse", "unified_messages", "upsert_greatest", "tree_canonical_path", "chunk_text"):
        p = plan(q[name](spark, oracle.DATA))
        assert "InPandas" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_anti_joins_and_scans(spark):
    q = core_queries.queries()
    assert "LeftAnti" in plan(q["pending_web"](spark, oracle.DATA))
    p = plan(q["sender_map"](spark, oracle.DATA))
    assert "IsNotNull(record_uuid)" in p and "data:string" not in p


def test_hot_conversation_is_spread(spark):
    """No task sorts a whole conversation: places come from ranges, and the plan has no window over the conversation alone."""
    from chatlake.operators import canonical, segment, sequence

    df = spark.range(5000).selectExpr("'c' as conversation_id", "id as t", "cast(id as string) as uuid", "if(id % 3 = 0, 'a', 'b') as sender", "array(cast(id as double), 1.0) as embedding").repartition(4)
    m = segment.numbered(df, "conversation_id", ["t", "uuid"], ["uuid"])
    assert {r["t"]: r["pos"] for r in m.collect()} == {i: i for i in range(5000)}
    p = plan(segment.boundaries(segment.adjacent_similarity(m)))
    assert "Window" not in p or "windowspecdefinition(conversation_id" not in p.replace("#", "").split("_part")[0]
    got = {r["t"]: r["is_canonical"] for r in canonical.mark_canonical(df.drop("embedding"), "conversation_id", "sender", "t", "uuid").collect()}
    assert got == {i: i == 4999 or (i % 3 == 0) != ((i + 1) % 3 == 0) for i in range(5000)}
    odd = spark.createDataFrame([(None, 1, "x"), ("g", None, "y"), ("g", 2, "z")], "g string, o int, k string")
    assert {r["k"]: (r["pos"], r["is_last"], r["n"]) for r in sequence.placed(odd, "g", ["o", "k"], {"n": "k"}).collect()} == {"x": (None, False, None), "z": (0, False, "y"), "y": (1, True, None)}
