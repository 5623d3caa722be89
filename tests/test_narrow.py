"""Steps that move hashes or sums instead of whole rows: the same results, and few bytes a row."""

import pytest
from pyspark.sql import functions as F

from quipu.operators import narrow, priority, signals
from quipu.operators.quantiles import quantiles
from quipu.plans import shared
from quipu.sources.star import facts as star_facts

ROWS = 40_000


def shuffled(spark, act) -> int:
    """Bytes that all stages of ``act`` write for shuffles."""
    sc, jvm = spark.sparkContext, spark._jvm

    def total():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(stages.apply(i).stageId(), stages.apply(i).attemptId()): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    before = total()
    act()
    return sum(n for key, n in total().items() if key not in before)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Rows of which few repeat, with ids that don't compress."""
    k = F.col("id")
    rows = spark.range(ROWS).select(
        F.concat(F.lit("TRX-"), F.upper(F.substring(F.md5(k.cast("string")), 1, 24))).alias("transaction_id"), F.concat(F.lit("ORG-"), (k % 5).cast("string")).alias("organization_id"),
        F.concat(F.lit("RCV-"), (k % 9973).cast("string")).alias("recipient_id"), F.concat(F.lit("PRV-"), F.pmod(F.xxhash64("id"), F.lit(9000)).cast("string")).alias("provider_id"),
        F.lit(True).alias("is_provider"), F.lit(False).alias("is_aggregated"), (2020 + k % 4).alias("periodo"), (k % 12 + 1).alias("mes"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**6)) + 1).cast("double").alias("monto_devengado"),
        F.lit("22").alias("subtitulo"), F.lit("04").alias("item"), F.expr("date_add(date'2020-01-01', cast(id % 900 as int))").alias("fecha_documento"),
        (k % 50).alias("dias_de_pago"), k.cast("string").alias("numero_documento"), F.lit("1").alias("folio"),
    )
    path = str(tmp_path_factory.mktemp("narrow") / "facts")
    rows.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("detector, most", [("exact_duplicates", 24), ("fragmentation", 24), ("amount_outlier", 40), ("provider_concentration", 40), ("new_to_series", 24), ("payment_delay", 4)])
def test_detectors_move_few_bytes_a_row(spark, facts, detector, most):
    assert shuffled(spark, lambda: getattr(signals, detector)(facts).collect()) < most * ROWS


def test_repeated_keeps_all_that_repeat(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, None), (2, None), (3, "d")], "x long, y string")
    assert sorted(map(str, narrow.repeated(rows, ["x", "y"]).collect())) == sorted(map(str, rows.filter("(x = 1 and y = 'a') or x is null or y is null").collect()))


def test_reaching_keeps_all_at_their_limit(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("v"))
    stats = rows.groupBy("g").agg(F.max("v").alias("top"))
    assert narrow.reaching(rows, stats, ["g"], "v", F.col("top")).join(stats, "g").filter("v >= top").count() == 7


def test_alike_joins_nulls(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, n int")
    other = spark.createDataFrame([(None, 10), ("a", 20)], "k string, m int")
    assert {tuple(r) for r in narrow.alike(rows, other, ["k"], "m").collect()} == {(None, 1, 10), ("a", 2, 20)}
    assert {r["n"] for r in narrow.alike(rows, other, ["k"]).collect()} == {1, 2}


def test_newcomers_without_a_year_before_are_none(spark, facts):
    assert signals.new_to_series(facts.filter("periodo = 2023")).isEmpty() and signals.new_to_series(facts.limit(0)).isEmpty()


@pytest.fixture()
def no_small_tables(spark):
    """As at a size where nothing is small enough for Spark to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sieve_keeps_all_chosen_and_few_others(spark, no_small_tables, tmp_path):
    rows = spark.range(100_000).withColumn("h", F.xxhash64("id"))
    for n in (0, 1, 5_000):
        rows.filter(F.col("id") < n).select(F.col("h").alias("chosen")).write.parquet(f"{tmp_path}/{n}")
        kept = narrow.sieve(rows, F.col("h"), spark.read.parquet(f"{tmp_path}/{n}"), "chosen")
        assert kept.columns == ["id", "h"] and kept.filter(F.col("id") < n).count() == n and kept.count() <= n + 10_000 * (n > 0)


def test_rows_stay_where_they_are_however_many_repeat(spark, facts, no_small_tables):
    twice = facts.unionByName(facts.filter("cast(numero_documento as long) % 40 = 7"))
    assert shuffled(spark, lambda: narrow.repeated(twice, ["transaction_id"]).write.format("noop").mode("overwrite").save()) < 24 * ROWS


def test_context_moves_few_rows_that_are_not_flagged(spark, facts, no_small_tables):
    whole = facts.withColumns({c: F.col("transaction_id") for c in ("nombre_area", "nombre_capitulo", "nombre_partida", "nombre_beneficiario", "orden_compra", "codigo_bip", "region")})
    flagged = facts.filter("cast(numero_documento as long) % 40 = 7").select("transaction_id")
    found = []
    assert shuffled(spark, lambda: found.extend(priority.transaction_context(whole, flagged).collect())) < 30 * ROWS
    assert len(found) == ROWS // 40 and all(r["organization_name"] == r["transaction_id"] for r in found)


def test_lines_are_dealt_once_for_the_join_with_orders(spark, no_small_tables):
    plan = star_facts(spark, "/root/testdata/sf0.001", "transaction_id", "recipient_id")._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_quantiles_of_many_groups_leave_rows_where_they_are(spark, no_small_tables):
    """Rows outside the wanted buckets are not moved, and the quantiles are the same as without."""
    rows = spark.range(ROWS * 4).select((F.col("id") % 20).cast("string").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10**6)) / 7).alias("v")).repartition(4)
    rows = rows.unionByName(spark.createDataFrame([(None, 1.0), (None, 2.0), ("1", None)], "g string, v double"))
    moved, found = {}, {}
    for sift in (False, True):
        moved[sift] = shuffled(spark, lambda: found.update({sift: sorted(map(str, quantiles(rows, ["g"], "v", {"med": 0.5, "q": 0.99}, sift=sift).collect()))}))
    assert found[True] == found[False] and len(found[True]) == 21 and moved[True] < moved[False] * 0.7


def test_facts_hold_what_their_readers_read(spark):
    """Each column is a column of all lines, moved with them and written: none is carried along for no reader."""
    assert "monto_pago" not in shared.full_rows(spark, "/root/testdata/sf0.001").columns
    assert not {"region", "nombre_beneficiario", "orden_compra", "codigo_bip"} & set(shared.signal_rows(spark, "/root/testdata/sf0.001").columns)


def test_lines_are_moved_with_days_not_times(spark, no_small_tables):
    plan = star_facts(spark, "/root/testdata/sf0.001", "transaction_id", "recipient_id", "fecha_pago")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as date)") == 1 and "as date) AS l_shipdate" in plan.split("Join Inner")[1]
