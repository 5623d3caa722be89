"""Profiles of providers, recipients and organisations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import month_date, provider_scope, total, valid_month
from ..functions.text import finite


def _seen():
    """Valid months only: an invalid month is no date."""
    month = F.when(valid_month(), month_date())
    return F.min(month).alias("first_seen"), F.max(month).alias("last_seen")


def provider_profiles(facts: DataFrame) -> DataFrame:
    """One row per provider.  Of several names or keys the least is shown, so the result is stable.

    What is counted once is made distinct first, map-side, as (provider, kind,
    value); so no wide row is expanded for a distinct count.  Facts are read twice: give a written table where they are dear.
    """
    mine = facts.filter(provider_scope())
    base = mine.groupBy("provider_id").agg(
        F.min("rut_beneficiario").alias("rut"),
        F.min("beneficiario_id_type").alias("identity_key_type"),
        F.min("nombre_beneficiario").alias("nombre"),
        *_seen(),
        F.count("*").alias("transactions"),
        total().alias("amount_devengado"),
        F.avg(finite("monto_devengado")).alias("avg_amount"),
        F.stddev_pop(finite("monto_devengado")).alias("sd_amount"),
    )
    kinds = {
        "organizations": F.col("organization_id"),
        "budget_categories": F.concat_ws("-", F.coalesce("subtitulo", F.lit("")), F.coalesce("item", F.lit(""))),
        "geographic_destinations": F.coalesce("nombre_ubicacion_geografica", F.lit("")),
    }
    values = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])
    pairs = mine.select(F.col("provider_id").alias("p"), F.explode(values).alias("v")).select("p", "v.*").distinct()
    counts = pairs.groupBy("p").agg(*[F.count(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k in kinds])
    return base.join(counts, F.col("provider_id") == F.col("p")).drop("p")


def recipient_profiles(facts: DataFrame) -> DataFrame:
    """One row per recipient, whatever its scope."""
    return facts.groupBy("recipient_id").agg(
        F.max("provider_id").alias("provider_id"),
        F.min("rut_beneficiario").alias("rut"),
        F.min("nombre_beneficiario").alias("nombre"),
        F.bool_or("is_provider").alias("is_provider"),
        F.bool_or("is_person").alias("is_person"),
        *_seen(),
        F.count("*").alias("transactions"),
        F.count_distinct("organization_id").alias("organizations"),
        total().alias("amount_devengado"),
    )


def _concentration(facts: DataFrame, who: str, count: str, index: str) -> DataFrame:
    """How many different ``who`` an organisation pays, and their Herfindahl index, null where nothing is spent.

    Pairs are summed first; their count, sum and sum of squares are partial
    map-side, so a hot organisation is no hot task, and no row is expanded for a
    distinct count.
    """
    pairs = facts.groupBy("organization_id", who).agg(total().alias("amount"))
    whole = F.sum("amount")
    return pairs.groupBy("organization_id").agg(F.count(who).alias(count), F.when(whole > 0, F.sum(F.pow("amount", F.lit(2.0))) / (whole * whole)).alias(index))


def organization_profiles(facts: DataFrame) -> DataFrame:
    """One row per organisation with supplier and recipient concentration."""
    base = facts.groupBy("organization_id").agg(
        F.min("nombre_partida").alias("institucion"),
        F.min("nombre_capitulo").alias("servicio"),
        F.min("nombre_area").alias("area"),
        F.count("*").alias("transactions"),
        total().alias("amount_devengado"),
    )
    recipients = _concentration(facts, "recipient_id", "recipients", "recipient_hhi")
    suppliers = _concentration(facts.filter(provider_scope()), "provider_id", "providers", "supplier_hhi")
    return base.join(recipients, "organization_id", "left").join(suppliers, "organization_id", "left").withColumn("providers", F.coalesce("providers", F.lit(0)))
