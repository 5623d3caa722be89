"""Exact quantiles, sums and row numbers against plain ones."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.functions.predicates import total
from quipu.operators.quantiles import quantiles
from quipu.sources import delimited
from quipu.sources.facts import with_row_numbers


def test_quantiles_equal_plain_ones(spark):
    rng = random.Random(3)
    groups = {"hot": [round(rng.lognormvariate(9, 2), 2) for _ in range(3000)], "ties": [5.0] * 50 + [7.0] * 2, "one": [3.5], None: [rng.uniform(-9, 9) for _ in range(41)], "zero": [0.0, 0.0, 1e12, -1e12], "bad": []}
    rows = [(g, v, "x") for g, vs in groups.items() for v in vs] + [("bad", None, "x"), ("bad", float("nan"), "x"), ("ties", None, "x")]
    df = spark.createDataFrame(rows, "g string, v double, n string").repartition(5)
    got = {r["g"]: r for r in quantiles(df, ["g"], "v", {"med": 0.5, "q": 0.99, "low": 0.0}).collect()}
    assert set(got) == {g for g, vs in groups.items() if vs}
    for g, vs in groups.items():
        if vs:
            assert got[g]["n"] == len(vs)
            assert [got[g][c] for c in ("med", "q", "low")] == pytest.approx([np.quantile(vs, p) for p in (0.5, 0.99, 0.0)], rel=1e-12)
    assert {r["g"] for r in quantiles(df, ["g"], "v", {"med": 0.5}, least=50).collect()} == {"hot", "ties"}
    every = sorted(v for vs in groups.values() for v in vs)
    whole = quantiles(df, [], "v", {"q": 0.99}, discrete=True).collect()
    assert len(whole) == 1 and whole[0]["q"] == every[int(np.ceil(0.99 * len(every))) - 1]
    assert quantiles(df.limit(0), [], "v", {"q": 0.5}).count() == 0


def test_sums_are_exact_and_never_crash(spark):
    rng = random.Random(1)
    groups = {"small": [0.004] * 3, "nan": [float("nan"), 5.25], "inf": [float("inf"), float("-inf")], "large": [1e17, 1e17, 0.5], "minus": [-1.25, -2.5], "none": [None], "many": [round(rng.uniform(-1e6, 1e6), 2) for _ in range(5000)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, monto_devengado double").repartition(4)
    got = {r["g"]: r["t"] for r in df.groupBy("g").agg(total().alias("t")).collect()}
    exact = lambda vs: float(sum(Decimal(repr(v)) for v in vs))
    assert got == {"small": 0.012, "nan": 5.25, "inf": None, "large": 2e17, "minus": -3.75, "none": None, "many": exact(groups["many"])}
    assert df.filter("g = 'minus'").agg(total(when=F.col("monto_devengado") < -2).alias("t")).first()["t"] == -2.5


def test_row_numbers_of_a_file_in_many_splits(spark, tmp_path):
    lines = [f"{k};{'x' * (k % 97)}" for k in range(1, 6001)]
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("\n".join(["k;t", *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        rows = delimited.read_delimited(spark, str(tmp_path / "a.csv"))
        assert rows.rdd.getNumPartitions() > 5
        numbered = with_row_numbers(rows)
        found = numbered.collect()
        assert len(found) == 6000 and all(int(r["k"]) == r["source_row_number"] for r in found)
        assert "SinglePartition" not in numbered._jdf.queryExecution().toString()
        both = with_row_numbers(spark.read.csv(str(tmp_path / "*.csv"), header=True, sep=";"))
        assert all(int(r["k"]) == r["source_row_number"] for r in both.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    memory = with_row_numbers(spark.createDataFrame([(1,), (2,), (3,)], "k int").coalesce(1))
    assert sorted(r["source_row_number"] for r in memory.collect()) == [1, 2, 3]
    assert with_row_numbers(spark.createDataFrame([], "k int")).count() == 0
