from quipu.streaming import distinct_facts, stream_facts, weekly_clusters


def test_rows_that_come_twice_are_one(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for name in ("a", "b"):
        (src / f"{name}.tsv").write_text("PERIODO\tMES\tBENEFICIARIO\tNOMBRE_BENEFICIARIO\tFECHA_DOCUMENTO\tDEVENGO\tsource_row_number\n2025\t1\tX\tAna\t2025-01-06\t10\t1\n2025\t1\tX\tAna\t2025-01-07\t10\t2\n")
    schema = "PERIODO string, MES string, BENEFICIARIO string, NOMBRE_BENEFICIARIO string, FECHA_DOCUMENTO string, DEVENGO string, source_row_number long"
    query = distinct_facts(stream_facts(spark, str(src), schema, files_per_trigger=1)).writeStream.format("memory").queryName("facts_seen").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.sql("select count(*), count(distinct transaction_id) from facts_seen").first() == (2, 2)


def test_weeks_start_on_monday(spark, tmp_path):
    spark.sql("select 1 as u, timestamp'2025-01-06 00:00:00' as ts, 1.0D as value union all select 1, timestamp'2025-01-12 23:00:00', 3.0D union all select 1, timestamp'2025-01-13 00:00:00', 5.0D").write.parquet(str(tmp_path / "e"))
    rows = spark.readStream.schema("u int, ts timestamp, value double").parquet(str(tmp_path / "e"))
    query = weekly_clusters(rows, ["u"]).writeStream.format("memory").outputMode("complete").queryName("weeks").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted((str(r["week"])[:10], r["n"], r["mean"]) for r in spark.table("weeks").collect()) == [("2025-01-06", 2, 2.0), ("2025-01-13", 1, 5.0)]
