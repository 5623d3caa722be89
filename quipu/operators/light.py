"""Facts for the interface: service grain and two provider scopes, from raw delimited columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import flag_is_true, normalize_rut, provider_id, service_id
from ..functions.predicates import PUBLIC_PATTERNS, public_name
from ..functions.text import name_ascii

KEPT = "partida capitulo area nombre_capitulo nombre_partida region nombre_subtitulo subtitulo nombre_beneficiario".split()


def light_facts(raw: DataFrame, patterns=PUBLIC_PATTERNS) -> DataFrame:
    """One row per raw row of a valid month.

    ``is_provider_source`` is the source's flag; ``is_provider`` also asks for
    no intra-state payment and no public counterparty, by name.  Identifiers are
    expressions over the row, so no map of identifiers is joined and no row can
    multiply; the names of services are joined as distinct keys.
    """
    have = {c.lower() for c in raw.columns}
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")
    rows = raw.select(
        F.col("periodo").try_cast("int").alias("periodo"), F.col("mes").try_cast("int").alias("mes"), F.col("devengo").try_cast("double").alias("monto_devengado"),
        F.col("monto").try_cast("double").alias("monto_pago"), text("fecha_pago").alias("fecha_pago"), flag_is_true(text("proveedor")).alias("is_provider_source"),
        flag_is_true(text("intraestado")).alias("is_intra_state"), flag_is_true(text("agregado")).alias("is_aggregated"), text("beneficiario").alias("beneficiario_source_id"),
        text("nombre_area").alias("area_name"), text("orden_de_compra").alias("orden_compra"), text("proveedor").alias("proveedor"), *[text(c).alias(c) for c in KEPT],
    ).filter("periodo is not null and mes between 1 and 12")
    rows = rows.withColumns({"organization_id": service_id("partida", "capitulo"), "rut_beneficiario": normalize_rut("beneficiario_source_id"), "name_key": name_ascii("nombre_beneficiario")})
    rows = rows.withColumn("provider_id", provider_id("beneficiario_source_id", "nombre_beneficiario", "proveedor", "organization_id"))
    services = rows.select(name_ascii("nombre_capitulo").alias("service_key")).filter("service_key <> ''").distinct()
    marked = rows.join(services, rows["name_key"] == services["service_key"], "left")
    public = (F.col("name_key") != "") & (F.col("service_key").isNotNull() | public_name(F.col("name_key"), patterns))
    out = marked.withColumn("is_public_counterparty_name", public).withColumn("is_provider", F.col("is_provider_source") & ~F.col("is_intra_state") & ~F.col("is_public_counterparty_name"))
    return out.withColumn("nombre_area", F.col("nombre_capitulo")).drop("name_key", "service_key", "proveedor")


def light_coverage(light: DataFrame) -> DataFrame:
    """One row of counters."""
    some = lambda p, c: F.count_distinct(F.when(p & (F.col(c) != ""), F.col(c)))
    return light.agg(
        F.count("*").alias("rows"), F.count_distinct("organization_id").alias("services"), F.count_distinct("partida", "capitulo", "area").alias("areas"),
        some(F.col("is_provider"), "provider_id").alias("providers"), some(F.col("is_provider_source"), "provider_id").alias("source_providers"),
        some(F.lit(True), "rut_beneficiario").alias("recipient_ruts"), some(F.col("is_provider_source") & F.col("is_public_counterparty_name"), "provider_id").alias("public_name_providers"),
        F.max(F.when(F.coalesce("monto_devengado", F.lit(0.0)) != 0, F.make_date("periodo", "mes", F.lit(1)))).alias("latest_devengo_month"),
    )
