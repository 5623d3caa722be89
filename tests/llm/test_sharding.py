from collections import Counter

import pytest
from pyspark.sql import functions as F

from quipu.llm import sharding
from quipu.llm.queries import ORACLE_SQL, op10_sharding
from tests.helpers import DATA, duck, sparked


def test_table_is_even_and_stable():
    names = sharding.shard_names(20)
    table = sharding.lookup_table(names, 2003)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(20))
    fewer = sharding.lookup_table(names[:-1], 2003)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 19)
    assert moved < 0.2 * 2003
    for bad in ((names, 2000), ([], 7), (["a", "a"], 7), (names, 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_claims_follow_the_preference_orders():
    """Brute force: full preference lists, one claim a turn."""
    import hashlib

    names, m = [f"s{k}" for k in range(5)], 31
    number = lambda x, salt: int.from_bytes(hashlib.sha256(f"{salt}:{x}".encode()).digest()[:8], "big")
    orders = [[(number(x, "offset") + j * (number(x, "skip") % (m - 1) + 1)) % m for j in range(m)] for x in names]
    owner = {}
    while len(owner) < m:
        for k, order in enumerate(orders):
            if len(owner) < m:
                owner[next(s for s in order if s not in owner)] = k
    assert sharding.lookup_table(names, m) == [owner[s] for s in range(m)]


def test_placement(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2**40, "e")], "doc_id long, shard_id string")
    rows = sharding.place(df)
    assert rows.columns == ["doc_id", "shard_id", "shard_slot", "shard_id_"]
    got = {r["shard_id"]: r["shard_id_"] for r in rows.collect()}
    assert got["a"] == got["b"] and got["c"] == got["d"] and len(got) == 5
    assert sharding.place(df.filter("spark_partition_id() < 0")).count() == 0
    loads = sharding.shard_loads(sharding.place(spark.range(20_000).withColumnRenamed("id", "doc_id"), names=sharding.shard_names(8)), size=F.lit(2)).collect()
    assert sum(r["n_rows"] for r in loads) == 20_000 and min(r["n_rows"] for r in loads) > 2000 and all(r["n_bytes"] == 2 * r["n_rows"] for r in loads)


def test_query_equals_sql(spark):
    assert sparked(op10_sharding(spark, f"{DATA}/sf0.001")) == duck("sf0.001", ORACLE_SQL["op10_sharding"])
    plan = op10_sharding(spark, f"{DATA}/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan
