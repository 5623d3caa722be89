"""Several years: relations without public counterparties, marks on all of them, and the cut that is published.

Metrics and marks are made on the full set of private relations before anything
is cut, so what is shown never changes what is measured.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import PUBLIC_PATTERNS, dominant, first_present, provider_scope, public_name, total
from ..functions.text import name_ascii
from .quantiles import quantiles

#: An organisation whose relations are always published.
REFERENCE = "UNIDAD DE ANALISIS FINANCIERO"


def _size():
    return F.abs("monto_devengado")


def service_years(facts: DataFrame) -> DataFrame:
    """(organisation, year): dominant name and region, amount, rows."""
    return facts.groupBy("organization_id", F.col("periodo").alias("year")).agg(
        dominant(first_present("nombre_capitulo", "organization_id"), _size()).alias("organization_name"),
        F.coalesce(total(), F.lit(0.0)).alias("amount_clp"), F.count("*").alias("transactions"),
    )


def private_edges(edges: DataFrame, service_names: DataFrame, name: str = "provider_name", patterns=PUBLIC_PATTERNS) -> DataFrame:
    """Edges whose counterparty's name is neither a public body's pattern nor the name of a service.

    ``service_names(name_key)`` is anti-joined, so it may be large.
    """
    rows = edges.withColumn("name_key", name_ascii(name))
    kept = rows.filter(~public_name(F.col("name_key"), patterns) | (F.col("name_key") == ""))
    return kept.join(service_names.select("name_key").filter("name_key <> ''").distinct(), "name_key", "left_anti").drop("name_key")


def service_names(services: DataFrame) -> DataFrame:
    return services.select(name_ascii("organization_name").alias("name_key")).distinct()


def relations(facts: DataFrame) -> DataFrame:
    """(organisation, provider, year) with a sum other than 0, public counterparties included."""
    rows = facts.filter(provider_scope()).groupBy("organization_id", "provider_id", F.col("periodo").alias("year")).agg(
        dominant(first_present("nombre_capitulo", "organization_id"), _size()).alias("organization_name"), dominant(first_present("nombre_beneficiario", "provider_id"), _size()).alias("provider_name"),
        F.coalesce(total(), F.lit(0.0)).alias("amount_clp"), F.count("*").alias("transactions"),
    )
    return rows.filter("amount_clp <> 0")


def provider_years(edges: DataFrame) -> DataFrame:
    """(provider, year) over all relations, with the provider's first year."""
    rows = edges.groupBy("provider_id", "year").agg(total("amount_clp").alias("amount_clp"), F.sum("transactions").alias("transactions"), F.count_distinct("organization_id").alias("organizations"))
    return rows.withColumn("first_year", F.min("year").over(Window.partitionBy("provider_id")))


def service_provider_years(edges: DataFrame) -> DataFrame:
    """(organisation, year): spend with private providers and how many they are."""
    return edges.groupBy("organization_id", "year").agg(total("amount_clp").alias("provider_amount_clp"), F.count("*").alias("providers"))


@dataclass(frozen=True)
class MarkRules:
    """Thresholds of the marks."""

    spike: float = 2.5
    min_providers: int = 8
    min_share: float = 0.45
    min_hhi: float = 0.25
    min_amount: float = 1e7
    min_tx: int = 3
    newcomer_amount: float = 5e7
    quantile: float = 0.99


MARK_COLUMNS = ("scope", "entity_id", "organization_id", "year", "signal_type", "severity", "metric", "hhi")


def _mark(rows: DataFrame, scope: str, entity: str, kind: str, metric: Column, severity: Column, organization: Column | None = None, hhi: Column | None = None) -> DataFrame:
    none = F.lit(None)
    return rows.select(
        F.lit(scope).alias("scope"), F.col(entity).alias("entity_id"), (organization if organization is not None else none.cast("string")).alias("organization_id"), "year",
        F.lit(kind).alias("signal_type"), severity.alias("severity"), metric.alias("metric"), (hhi if hhi is not None else none.cast("double")).alias("hhi"),
    )


def month_sums(facts: DataFrame) -> DataFrame:
    """(organization_id, year, mes, a): the sums that spikes are made of."""
    return facts.groupBy("organization_id", F.col("periodo").alias("year"), "mes").agg(F.coalesce(total(), F.lit(0.0)).alias("a"))


def marks(facts: DataFrame, edges: DataFrame, rules: MarkRules = MarkRules()) -> DataFrame:
    """Year-end spikes of services, dominant providers, and newcomers with high spend (nearest-rank quantile)."""
    return marks_of(month_sums(facts), edges, rules)


def marks_of(monthly: DataFrame, edges: DataFrame, rules: MarkRules = MarkRules()) -> DataFrame:
    """:func:`marks` from the sums of :func:`month_sums`."""
    ends = monthly.groupBy("organization_id", "year").agg(F.avg(F.when(F.col("mes") <= 10, F.col("a"))).alias("base"), F.avg(F.when(F.col("mes") > 10, F.col("a"))).alias("end"))
    spikes = ends.filter((F.col("base") > 0) & (F.col("end") / F.col("base") >= rules.spike - 1e-6))
    spike = _mark(spikes, "service", "organization_id", "YEAR_END_SPIKE", F.col("end") / F.col("base"), F.lit("MEDIUM"))

    whole = edges.groupBy("organization_id", "year").agg(
        total("amount_clp").alias("total"), F.count("*").alias("n"), F.sum(F.pow("amount_clp", F.lit(2.0))).alias("squares"),
        F.min_by(F.struct("provider_id", "amount_clp"), F.struct(-F.col("amount_clp"), F.col("provider_id"))).alias("top"),
    ).filter((F.col("total") > 0) & (F.col("n") >= rules.min_providers))
    shares = whole.select("organization_id", "year", F.col("top.provider_id").alias("provider_id"), F.col("top.amount_clp").alias("a"), (F.col("top.amount_clp") / F.col("total")).alias("share"), (F.col("squares") / (F.col("total") * F.col("total"))).alias("h"))
    strong = shares.filter((F.col("share") >= rules.min_share - 1e-6) & (F.col("h") >= rules.min_hhi - 1e-6) & (F.col("a") >= rules.min_amount))
    high = F.when((F.col("share") >= 0.65 - 1e-6) | (F.col("h") >= 0.40 - 1e-6), "HIGH").otherwise("MEDIUM")
    dominance = _mark(strong, "provider", "provider_id", "PROVIDER_CONCENTRATION", F.col("share"), high, F.col("organization_id"), F.col("h"))

    # One row: a proven bound for the broadcast.
    last = monthly.agg(F.max("year").alias("last_year"))
    fresh = provider_years(edges).crossJoin(F.broadcast(last)).filter((F.col("year") == F.col("last_year")) & (F.col("first_year") == F.col("last_year")) & (F.col("transactions") >= rules.min_tx))
    level = quantiles(fresh, [], "amount_clp", {"q": rules.quantile}, discrete=True).select("q")
    new = fresh.join(F.broadcast(level), how="left").filter(F.col("amount_clp") >= F.greatest(F.lit(rules.newcomer_amount), F.coalesce("q", F.lit(0.0))))
    newcomer = _mark(new, "provider", "provider_id", "NEW_TO_SERIES_HIGH_SPEND", F.col("amount_clp"), F.when(F.col("organizations") >= 3, "HIGH").otherwise("MEDIUM"))
    return spike.unionByName(dominance).unionByName(newcomer)


def publish(edges: DataFrame, all_marks: DataFrame, max_seeds: int = 1400, core_seeds: int = 900, max_flows: int = 24_000, per_service: int = 3, reference: str = REFERENCE) -> DataFrame:
    """The relations that are published.

    Seeds: the largest providers, marked ones, and those of the reference
    organisation.  All relations of seeds are kept, and the largest of each
    organisation and year.  If that is over ``max_flows``, only the relations of
    a smaller core of seeds are kept.  The choice is one count, made on the
    cluster.
    """
    by_provider = edges.groupBy("provider_id").agg(F.abs(total("amount_clp")).alias("size"))
    largest = by_provider.orderBy(F.desc("size"), "provider_id").limit(max_seeds)
    placed = largest.withColumn("place", F.row_number().over(Window.orderBy(F.desc("size"), "provider_id"))).select("provider_id", "place")
    always = all_marks.filter("scope = 'provider'").select(F.col("entity_id").alias("provider_id")).union(edges.filter(F.contains(name_ascii("organization_name"), F.lit(reference))).select("provider_id")).distinct()
    seeds = placed.union(always.select("provider_id", F.lit(0).alias("place"))).groupBy("provider_id").agg(F.min("place").alias("place"))
    first = F.row_number().over(Window.partitionBy("organization_id", "year").orderBy(F.abs("amount_clp").desc(), "provider_id"))
    # The rank filter stands alone, so that it reaches into the window; relations of seeds are united with what it leaves.
    of_seeds = edges.join(seeds, "provider_id")
    strong = edges.withColumn("place_in_service", first).filter(F.col("place_in_service") <= per_service).drop("place_in_service")
    others = strong.join(seeds.select("provider_id"), "provider_id", "left_anti").withColumn("place", F.lit(None).cast("int"))
    wide = of_seeds.unionByName(others)
    # One row: a proven bound for the broadcast.
    count = wide.agg(F.count("*").alias("n_wide"))
    return wide.crossJoin(F.broadcast(count)).filter((F.col("n_wide") <= max_flows) | (F.col("place") <= core_seeds)).drop("place", "n_wide").select(*edges.columns)


def payment_months(facts: DataFrame) -> DataFrame:
    """Spend by the month it was paid in, apart from the month it accrued in."""
    paid = facts.filter(provider_scope() & F.col("fecha_pago").isNotNull() & (F.coalesce("monto_pago", F.lit(0.0)) != 0))
    return paid.groupBy("provider_id", F.date_format("fecha_pago", "yyyy-MM").alias("period")).agg(total("monto_pago").alias("amount_clp"), F.count("*").alias("transactions"))


def accrual_months(facts: DataFrame) -> DataFrame:
    rows = facts.filter(provider_scope()).groupBy("provider_id", F.format_string("%04d-%02d", "periodo", "mes").alias("period")).agg(F.coalesce(total(), F.lit(0.0)).alias("amount_clp"), F.count("*").alias("transactions"))
    return rows.filter("amount_clp <> 0")


def service_areas(facts: DataFrame, area: str = "area", area_name: str = "nombre_area", top: int = 12) -> DataFrame:
    """The largest areas of each service, nested; only ``top`` rows per service are ever gathered."""
    sums = facts.groupBy("organization_id", area).agg(dominant(F.col(area_name), _size()).alias("area_name"), F.coalesce(total(), F.lit(0.0)).alias("amount_clp")).filter("amount_clp <> 0")
    rank = F.row_number().over(Window.partitionBy("organization_id").orderBy(F.desc("amount_clp"), area))
    kept = sums.withColumn("rank", rank).filter(F.col("rank") <= top)
    return kept.groupBy("organization_id").agg(F.sort_array(F.collect_list(F.struct("rank", F.col(area).alias("area"), "area_name", "amount_clp"))).alias("areas"))


def yearly_nested(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Years nested per key; there are as many as there are years."""
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("year", "amount_clp", "transactions"))).alias("yearly"))


def receiver_proxy() -> Column:
    """Not aggregated, known tax number, and not personnel (subtitle 21)."""
    return ~F.coalesce(F.col("is_aggregated"), F.lit(False)) & (F.coalesce("rut_beneficiario", F.lit("")) != "") & (F.regexp_replace(F.coalesce("subtitulo", F.lit("")), "^0+", "") != "21")


def parity_metrics(facts: DataFrame, year: int) -> DataFrame:
    """One row of totals that an official page can be held against."""
    mine = facts.filter(F.col("periodo") == year)
    distinct = lambda p, c: F.count_distinct(F.when(p, F.col(c)))
    return mine.agg(
        F.count_distinct("organization_id").alias("services_with_rows"),
        distinct(~F.coalesce(F.col("is_aggregated"), F.lit(False)), "organization_id").alias("transactional_services"),
        F.coalesce(total(), F.lit(0.0)).alias("devengo_clp"), F.coalesce(total("monto_pago"), F.lit(0.0)).alias("payment_clp"),
        distinct(receiver_proxy(), "rut_beneficiario").alias("receiver_ruts"), F.coalesce(total(when=receiver_proxy()), F.lit(0.0)).alias("receiver_clp"),
        distinct(provider_scope(), "provider_id").alias("provider_ids"), F.coalesce(total(when=provider_scope()), F.lit(0.0)).alias("provider_clp"),
    )


def parity_top(facts: DataFrame, year: int, top: int = 30) -> DataFrame:
    rows = facts.filter((F.col("periodo") == year) & receiver_proxy()).groupBy("rut_beneficiario").agg(dominant(F.col("nombre_beneficiario"), _size()).alias("provider_name"), F.coalesce(total(), F.lit(0.0)).alias("amount_clp"))
    return rows.orderBy(F.desc("amount_clp"), "rut_beneficiario").limit(top)


def parity_differences(local: DataFrame, official: DataFrame) -> DataFrame:
    """Local against official amounts by tax number (digits and K only)."""
    from ..functions.identity import rut_key

    theirs = official.select(rut_key("rut").alias("k"), F.col("amount_clp").alias("official_amount_clp"))
    rows = local.withColumn("k", rut_key("rut_beneficiario")).join(theirs, "k").drop("k")
    gap = F.col("amount_clp") - F.col("official_amount_clp")
    return rows.withColumns({"difference_clp": gap, "difference_pct": F.when(F.col("official_amount_clp") != 0, gap / F.col("official_amount_clp"))})


def reference_payments(facts: DataFrame, institution: str, year: int) -> DataFrame:
    """Payments of one institution to its providers in a year: amount, rows, documents, months, share."""
    name = F.lit(institution)
    same = (name_ascii("nombre_partida") == name_ascii(name)) | (name_ascii("nombre_capitulo") == name_ascii(name)) | (name_ascii("nombre_area") == name_ascii(name))
    mine = facts.filter((F.col("periodo") == year) & provider_scope() & same)
    rows = mine.groupBy("provider_id").agg(
        dominant(F.col("nombre_beneficiario"), F.abs("monto_pago")).alias("provider_name"), F.coalesce(total("monto_pago"), F.lit(0.0)).alias("amount_paid"), F.count("*").alias("payment_rows"),
        F.count_distinct("numero_documento").alias("distinct_documents"), F.array_sort(F.collect_set("mes")).alias("months_with_payments"),
    )
    # One row: a proven bound for the broadcast.
    whole = mine.agg(F.coalesce(total("monto_pago"), F.lit(0.0)).alias("whole"))
    return rows.crossJoin(F.broadcast(whole)).withColumn("share", F.when(F.col("whole") != 0, F.col("amount_paid") / F.col("whole"))).drop("whole")
