"""Data-quality audit in one pass, and the checks that the target model's constraints become."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import present, total

#: Coverage ratio -> the measure it is a share of all rows of.
COVERAGE = {
    "valid_rut": "rut_rows", "hashed_source_identity": "hashed_identity_rows", "provider_flag": "provider_rows", "person_flag": "person_rows",
    "beneficiary_name": "beneficiary_name_rows", "monto_devengado": "devengado_rows", "monto_pago": "pago_rows",
    "fecha_documento": "document_date_rows", "fecha_pago": "payment_date_rows", "orden_compra": "purchase_order_rows", "bip": "bip_rows",
    "region": "region_rows", "sector": "sector_rows",
}


def audit(facts: DataFrame) -> DataFrame:
    """One row: measures, coverage ratios, collision ratios, warnings and status.

    The two distinct counts are made by their own aggregates over one column
    each, so the wide pass has no expansion of rows.
    """
    n = lambda p: F.count_if(p)
    bad = F.col("periodo").isNull() | F.col("mes").isNull() | ~F.col("mes").between(1, 12)
    wide = facts.agg(
        F.count("*").alias("row_count"),
        n(bad).alias("invalid_period_rows"),
        n(present("rut_beneficiario")).alias("rut_rows"),
        n(F.col("beneficiario_id_type") == "HASH_SHA1").alias("hashed_identity_rows"),
        n(F.col("is_provider")).alias("provider_rows"),
        n(F.col("is_person")).alias("person_rows"),
        n(present("nombre_beneficiario")).alias("beneficiary_name_rows"),
        F.count("monto_devengado").alias("devengado_rows"),
        F.count("monto_pago").alias("pago_rows"),
        F.count("fecha_documento").alias("document_date_rows"),
        F.count("fecha_pago").alias("payment_date_rows"),
        n(present("orden_compra")).alias("purchase_order_rows"),
        n(present("codigo_bip")).alias("bip_rows"),
        n(present("region")).alias("region_rows"),
        n(present("sector")).alias("sector_rows"),
        n(F.col("monto_devengado") < 0).alias("negative_devengado_rows"),
        F.min("periodo").alias("first_year"),
        F.max("periodo").alias("last_year"),
        F.coalesce(total(), F.lit(0.0)).alias("devengado_total"),
    )
    ids = facts.groupBy("transaction_id").agg(F.lit(1).alias("x")).agg(F.count("transaction_id").alias("distinct_transaction_ids"))
    prints = facts.groupBy("transaction_fingerprint").agg(F.lit(1).alias("x")).agg(F.count("transaction_fingerprint").alias("distinct_transaction_fingerprints"))
    row = wide.crossJoin(ids).crossJoin(prints)
    rate = lambda c: F.coalesce(F.round(F.try_divide(F.col(c), F.col("row_count")), 6), F.lit(0.0))
    lost = lambda c: F.coalesce(1 - F.try_divide(F.col(c), F.col("row_count")), F.lit(0.0))
    row = row.withColumns({
        **{f"coverage_{k}": rate(c) for k, c in COVERAGE.items()},
        "transaction_id_collision_ratio": F.round(lost("distinct_transaction_ids"), 8),
        "source_fact_repeat_ratio": F.round(lost("distinct_transaction_fingerprints"), 8),
        "repeated_fingerprint_rows": F.greatest(F.lit(0), F.col("row_count") - F.col("distinct_transaction_fingerprints")),
    })
    some = F.col("row_count") > 0
    warnings = F.concat_ws(
        ",",
        F.when(~some, "EMPTY_DATASET"),
        F.when(some & (F.col("coverage_monto_devengado") < 0.5), "LOW_DEVENGADO_COVERAGE"),
        F.when(F.col("distinct_transaction_ids") < F.col("row_count"), "TRANSACTION_ID_NOT_UNIQUE"),
        F.when(F.col("invalid_period_rows") > 0, "INVALID_PERIOD_ROWS"),
    )
    return row.withColumn("warnings", warnings).withColumn("status", F.when(F.col("warnings") == "", "PASS").otherwise("WARN"))


def require_unique_ids(facts: DataFrame) -> None:
    """Stop a run whose transaction ids collide."""
    twice = facts.groupBy("transaction_id").count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"transaction id isn't unique: {twice[0][0]}")


def violations(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
    """How many rows break each rule (an SQL condition that must hold; null counts as broken)."""
    counts = rows.agg(*[F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(k) for k, p in rules.items()])
    return counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in rules]), F.array(*[F.col(k) for k in rules]))).alias("rule", "broken"))


PRIORITY_RULES = {
    "score_in_range": "investigation_priority_score between 0 and 100",
    "known_tier": "priority_tier in ('P1', 'P2', 'P3')",
    "signal_has_id": "signal_id is not null",
}


def value_counts(rows: DataFrame, columns: list[str], top: int = 20) -> DataFrame:
    """The most frequent values per column: one grouped pass over all columns, then the first ``top`` of each."""
    from pyspark.sql import Window

    pairs = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns])).alias("p")).select("p.*")
    counts = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= top)
