"""The latest eligible document of each resolved provider."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import blank_to_null


def latest_documents(facts: DataFrame) -> DataFrame:
    """One document per entity: a provider's, neither intra-state nor a person's, dated, typed and numbered.

    A maximum of a struct instead of a ranking window: it is partial map-side,
    so an entity with a third of all rows is no hot task.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    number = F.coalesce(blank_to_null("numero_documento"), blank_to_null("folio"))
    day = F.col("fecha_documento").cast("date")
    fine = facts.filter(
        F.col("entity_id").isNotNull() & flag("is_provider") & ~flag("is_intra_state") & ~flag("is_person") & day.isNotNull() & blank_to_null("tipo_documento").isNotNull() & number.isNotNull()
    )
    kept = {
        "rut": F.col("rut_beneficiario"), "provider_name": F.col("nombre_beneficiario"), "tipo_documento": F.col("tipo_documento"), "numero_documento": number, "fecha_documento": day,
        "transaction_id": F.col("transaction_id"), "transaction_fingerprint": F.col("transaction_fingerprint"), "periodo": F.col("periodo"), "mes": F.col("mes"),
        "source_file": F.col("source_file"), "source_row_number": F.col("source_row_number"),
    }
    best = F.max_by(F.struct(*[v.alias(k) for k, v in kept.items()]), F.struct(day, "periodo", "mes", "transaction_id"))
    return fine.groupBy("entity_id").agg(best.alias("d")).select("entity_id", "d.*", F.lit("PRESUPUESTO_ABIERTO").alias("candidate_source"), F.lit("SPECIFIC_DOCUMENT_VERIFICATION_CANDIDATE").alias("observation_intent"))


def document_stats(documents: DataFrame) -> DataFrame:
    return documents.agg(
        F.count("*").alias("rows"), F.count_distinct("entity_id").alias("entities"), F.min("fecha_documento").alias("min_document_date"),
        F.max("fecha_documento").alias("max_document_date"), F.count_distinct("tipo_documento").alias("document_type_labels"),
    )
