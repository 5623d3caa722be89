import random
import unicodedata

import duckdb
from pyspark.sql import functions as F

from quipu.functions.text import ACCENTED, ratio_bound, sequence_ratio, strip_accents
from quipu.operators import bitmaps, evidence, sketches


def test_quantiles_of_merged_years_are_near(spark):
    rng = random.Random(5)
    rows = [(f"O{k % 3}", 2020 + k % 4, rng.choice([rng.gauss(0, 1), rng.expovariate(1e-6)]), f"P{rng.randrange(300)}") for k in range(30_000)]
    rows += [("O0", 2020, float("inf"), "P1"), ("O0", 2020, float("nan"), None), ("none", 2020, None, None)]
    df = spark.createDataFrame(rows, "organization_id string, periodo long, monto_devengado double, provider_id string").repartition(4)
    stored = sketches.sketched(df, ["organization_id"], distinct="provider_id")
    assert stored.count() == 13
    wanted = {f"q{k}": k / 100 for k in (1, 25, 50, 75, 99)}
    got = {r["organization_id"]: r for r in sketches.quantiles_of(sketches.merged(stored, ["organization_id"]), ["organization_id"], wanted).collect()}
    assert got["none"]["n"] == 0 and got["none"]["q50"] is None
    for o in ("O0", "O1", "O2"):
        mine = sorted(r[2] for r in rows if r[0] == o and r[2] is not None and r[2] == r[2] and r[2] != float("inf"))
        assert got[o]["n"] == len(mine) and got[o]["distinct"] == len({r[3] for r in rows if r[0] == o and r[3]})
        for name, p in wanted.items():
            assert abs(sum(x <= got[o][name] for x in mine) / len(mine) - p) <= 2 * sketches.RANK_ERROR


def test_bitmaps_equal_filter_and_count(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.randrange(12), rng.choice([True, False, None])) for _ in range(50_000)]
    maps = bitmaps.bitmaps(spark.createDataFrame(rows, "region string, mes int, mark boolean").repartition(3), ["region", "mes", "mark"]).cache()
    some = [r for r in rows if r[0] in "ab" and r[1] in (1, 2, 3) and r[2] is None]
    assert bitmaps.count(maps, region=["a", "b"], mes=[1, 2, 3], mark=[None]).first()["n"] == len(some)
    assert bitmaps.count(maps, region=["z"], mes=[1]).first()["n"] == 0
    got = {r["value"]: r["n"] for r in bitmaps.facet(maps, "mes", region=["a"], mark=["true"]).collect()}
    assert got == {str(m): n for m in range(12) if (n := sum(r[:2] == ("a", m) and r[2] is True for r in rows))}
    assert sum(r["n"] for r in bitmaps.facet(maps, "region").collect()) == len(rows)
    maps.unpersist()


def test_letters_of_every_script_are_folded(spark):
    every = [chr(k) for k in range(0x20, 0x10000) if not 0xD800 <= k < 0xE000 and chr(k) not in "\r\n"]
    got = {r["c"]: r["s"] for r in spark.createDataFrame([(c,) for c in every], "c string").select("c", strip_accents("c").alias("s")).collect()}
    for c in every:
        nfd = unicodedata.normalize("NFD", c)
        if c in ACCENTED:
            assert got[c] == "".join(unicodedata.normalize("NFKD", x)[0] for x in nfd[:1] if not unicodedata.combining(x)), hex(ord(c))
        else:
            assert got[c] == c
    con = duckdb.connect()
    for text in ("Hà Nội Điện lực", "Αθήνα ΰ Ὀδυσσεύς", "Йошкар-Ола Ёлка", "Çeşme İzmir", "naïve é", "Łódź Ñandú"):
        want = con.execute("SELECT strip_accents(?)", (text,)).fetchone()[0]
        assert spark.createDataFrame([(text,)], "t string").select(strip_accents("t")).first()[0] == want


def test_letters_bound_the_ratio(spark):
    rng = random.Random(8)
    names = ["".join(rng.choice("ABCE 1") for _ in range(rng.randint(0, 14))) for _ in range(120)] + ["A" * 300, "AB" * 150]
    pairs = spark.createDataFrame([(a, b) for a in names[:40] for b in names], "key string, ext_key string")
    assert pairs.filter(ratio_bound("key", "ext_key") < sequence_ratio(F.col("key"), F.col("ext_key")) - 1e-12).count() == 0
    words = ["NORTE", "SUR", "ESTE", "UNO", "DOS", "TRES", "ALFA", "BETA", "GAMA"]
    rows = [" ".join([*(f"EMPRESA SERVICIOS GENERALES INTEGRALES DEL PACIFICO Y CHILE {w}").split(), v]) for w in words for v in words]
    some = spark.createDataFrame([(a, b) for a in rows for b in rows], "key string, ext_key string")
    before = some.filter((F.col("key") == F.col("ext_key")) | (evidence.token_jaccard("key", "ext_key") >= evidence.NEEDED_SHARED - 1e-9))
    after = evidence.likely(some)
    linked = lambda rows: sorted(map(tuple, rows.withColumn("s", evidence.similarity("key", "ext_key")).filter(F.col("s") >= evidence.FUZZY_FLOOR).select("key", "ext_key").collect()))
    assert after.count() < 0.7 * before.count() and linked(after) == linked(before) != []


def test_sketched_query_counts_providers_beyond_the_sketch(spark, tmp_path):
    """Six thousand providers of one organisation, over 2**LG_ENTRIES, are counted exactly."""
    from quipu.plans import more

    n = 6000
    k = F.col("id")
    day = F.lit("1996-01-02").cast("timestamp")
    spark.range(n).select(k.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), k.alias("l_partkey"), k.alias("l_suppkey"), F.lit(1.0).alias("l_quantity"), k.cast("double").alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(n).select(k.alias("o_orderkey"), F.lit(1).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), day.alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2).select(k.alias("c_custkey"), F.lit(3).alias("c_nationkey"), F.lit("x").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    assert {(r["n"], r["providers"], r["near"]) for r in more.sketched_quantiles(spark, str(tmp_path)).collect()} == {(n, n, True)}
