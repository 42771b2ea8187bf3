import random

import pytest

from seqloom.operators.bucketed import lookup_bucketed, store_bucketed
from seqloom.operators.lookup import lookup_embedding


@pytest.fixture
def table(spark, vectors, tmp_path):
    emb = vectors({t: [float(t)] for t in range(60)})
    store_bucketed(emb, "bucketed_vectors", 1, 8, str(tmp_path / "buckets"))
    yield emb
    spark.sql("drop table bucketed_vectors")


def found(df):
    return sorted((r.idx, r.token_id, r.vec, r.hit) for r in df.collect())


@pytest.mark.parametrize("hot", [False, True])
def test_equals_the_plain_lookup(stream, table, hot):
    rng = random.Random(4)
    tokens = [7 if hot and k % 2 else rng.randrange(80) for k in range(900)]
    rows = lookup_bucketed(stream(tokens), "bucketed_vectors", 1)
    assert found(rows) == found(lookup_embedding(stream(tokens), table, 1))


def test_the_table_stays_where_it_is(stream, table):
    rows = lookup_bucketed(stream([k % 70 for k in range(700)]), "bucketed_vectors", 1)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(token_id") == 1, plan
    of_table = plan[plan.index("Sort [_token") :]
    assert "Exchange" not in of_table and "Bucketed: true" in of_table, plan


def test_a_repeated_id_raises(spark, vectors, tmp_path):
    emb = vectors({1: [1.0]})
    with pytest.raises(ValueError, match="repeated"):
        store_bucketed(emb.unionByName(emb), "never_stored", 1, 4, str(tmp_path / "b"))
