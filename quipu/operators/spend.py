"""Rolling twelve-month spend view: organisations, providers, and the flows between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import blank_to_null, dominant, first_present, month_date, present, provider_scope, share, total, valid_month


def _amount_size():
    return F.abs("amount")


def with_months(facts: DataFrame) -> DataFrame:
    """Facts of valid months with ``month_date`` and ``amount`` (missing amounts as 0)."""
    return facts.filter(valid_month()).withColumns({"month_date": month_date(), "amount": F.coalesce("monto_devengado", F.lit(0.0))})


def bounds(facts: DataFrame) -> DataFrame:
    """One row: the last month with spend, the twelve months to it, and the twelve before."""
    end = with_months(facts).filter("amount <> 0").agg(F.max("month_date").alias("end_month"))
    back = lambda n: F.add_months("end_month", -n)
    return end.select("end_month", back(11).alias("start_month"), back(23).alias("prev_start"), back(12).alias("prev_end"))


def window_of(facts: DataFrame, limits) -> tuple[DataFrame, DataFrame]:
    """The last twelve months and the twelve before.

    ``limits`` is the row of :func:`bounds`.  As literals the limits reach the
    scan, where a join with a one-row table would not.
    """
    rows = with_months(facts)
    period = lambda a, b: (F.col("periodo") * 12 + F.col("mes")).between(a.year * 12 + a.month, b.year * 12 + b.month) & F.col("periodo").between(a.year, b.year)
    return rows.filter(period(limits["start_month"], limits["end_month"])), rows.filter(period(limits["prev_start"], limits["prev_end"]))


def limits_of(facts: DataFrame):
    found = bounds(facts.select("periodo", "mes", "monto_devengado")).first()
    if found is None or found["end_month"] is None:
        raise ValueError("no month has any spend")
    return found


def organization_name():
    return first_present("nombre_area", "nombre_capitulo", "nombre_partida", "organization_id")


def provider_name():
    return first_present("nombre_beneficiario", "provider_id")


def monthly_calendar(l12: DataFrame, limits) -> DataFrame:
    """Twelve rows, also for months without facts."""
    spark = l12.sparkSession
    calendar = spark.range(1).select(F.explode(F.sequence(F.lit(limits["start_month"]), F.lit(limits["end_month"]), F.expr("interval 1 month"))).alias("month_date"))
    sums = l12.groupBy("month_date").agg(total("amount").alias("a"), total("amount", provider_scope()).alias("p"), F.count("organization_id").alias("n"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return calendar.join(sums, "month_date", "left").select(
        F.date_format("month_date", "yyyy-MM").alias("period"), zero("a").alias("amount_clp"), zero("p").alias("provider_amount_clp"), F.coalesce("n", F.lit(0)).alias("transactions")
    )


def overview(l12: DataFrame, prev12: DataFrame) -> DataFrame:
    now = l12.agg(
        F.coalesce(total("amount"), F.lit(0.0)).alias("amount_l12"), F.count("*").alias("transactions_l12"), F.count_distinct("organization_id").alias("organizations_l12"),
        F.count_distinct(F.when(provider_scope(), F.col("provider_id"))).alias("providers_l12"), F.coalesce(total("amount", provider_scope()), F.lit(0.0)).alias("provider_amount_l12"),
    )
    before = prev12.agg(F.coalesce(total("amount"), F.lit(0.0)).alias("amount_prev12"))
    return now.crossJoin(before).withColumn("variation_l12", share("amount_l12", "amount_prev12") - 1)


def services(l12: DataFrame, prev12: DataFrame, top: int = 2000) -> DataFrame:
    """The largest organisations with their dominant name, region and subtitle, change and last-quarter share."""
    q4 = F.month("month_date").isin(10, 11, 12)
    now = l12.groupBy("organization_id").agg(
        dominant(organization_name(), _amount_size()).alias("organization_name"), dominant(blank_to_null("region"), _amount_size()).alias("main_region"),
        total("amount").alias("amount_l12"), F.count("*").alias("transactions_l12"), F.count_distinct(F.when(provider_scope(), F.col("provider_id"))).alias("providers_l12"),
        total("amount", provider_scope()).alias("provider_amount_l12"), total("amount", q4).alias("q4_amount"),
    )
    before = prev12.groupBy("organization_id").agg(total("amount").alias("amount_prev12"))
    by_subtitle = l12.groupBy("organization_id", "nombre_subtitulo", "subtitulo").agg(total("amount").alias("amount"))
    subtitle = by_subtitle.groupBy("organization_id").agg(dominant(first_present("nombre_subtitulo", "subtitulo"), F.col("amount")).alias("dominant_subtitle"))
    rows = now.join(before, "organization_id", "left").join(subtitle, "organization_id", "left")
    return rows.withColumns({"variation_l12": share("amount_l12", "amount_prev12") - 1, "q4_share": share("q4_amount", "amount_l12")}).orderBy(F.desc("amount_l12"), "organization_id").limit(top)


def service_months(l12: DataFrame, published: DataFrame | None = None) -> DataFrame:
    rows = l12.join(published.select("organization_id"), "organization_id", "left_semi") if published is not None else l12
    return rows.groupBy("organization_id", F.date_format("month_date", "yyyy-MM").alias("period")).agg(total("amount").alias("amount_clp"), total("amount", provider_scope()).alias("provider_amount_clp"))


def pairs(l12: DataFrame) -> DataFrame:
    """(organisation, provider) edges of the flow graph."""
    return l12.filter(provider_scope()).groupBy("organization_id", "provider_id").agg(
        dominant(organization_name(), _amount_size()).alias("organization_name"), dominant(provider_name(), _amount_size()).alias("provider_name"),
        total("amount").alias("amount_clp"), F.count("*").alias("transactions"), F.count_distinct("month_date").alias("months_active"), F.max("month_date").alias("last_month"),
    )


def flows(edges: DataFrame, per_service: int = 8, top: int = 12_000) -> DataFrame:
    """The largest edges of each organisation with their shares of both ends.

    Shares come from joins with the ends' sums: a hot end is a skewed join key,
    which AQE can split, where a window couldn't.
    """
    by_service = edges.groupBy("organization_id").agg(total("amount_clp").alias("service_provider_amount"))
    by_provider = edges.groupBy("provider_id").agg(total("amount_clp").alias("provider_amount"))
    rank = F.row_number().over(Window.partitionBy("organization_id").orderBy(F.desc("amount_clp"), "provider_id"))
    kept = edges.withColumn("service_rank", rank).filter(F.col("service_rank") <= per_service).drop("service_rank")
    rows = kept.join(by_service, "organization_id").join(by_provider, "provider_id")
    return rows.withColumns({"share_of_service": share("amount_clp", "service_provider_amount"), "share_of_provider": share("amount_clp", "provider_amount")}).orderBy(F.desc("amount_clp"), "organization_id", "provider_id").limit(top)


def flow_months(l12: DataFrame, published: DataFrame) -> DataFrame:
    """Published edges with their months nested."""
    keys = ["organization_id", "provider_id"]
    rows = l12.filter(provider_scope()).join(published.select(*keys), keys, "left_semi")
    months = rows.groupBy(*keys, F.date_format("month_date", "yyyy-MM").alias("period")).agg(total("amount").alias("amount_clp"), F.count("*").alias("transactions"))
    return months.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("period", "amount_clp", "transactions"))).alias("monthly"))


def providers(facts: DataFrame, l12: DataFrame, prev12: DataFrame, top: int = 1500) -> DataFrame:
    """The largest providers: change, last quarter, missing purchase orders, first month ever, main client and dependence on it."""
    mine, q4 = l12.filter(provider_scope()), F.month("month_date").isin(10, 11, 12)
    now = mine.groupBy("provider_id").agg(
        dominant(provider_name(), _amount_size()).alias("provider_name"), total("amount").alias("amount_l12"), F.count("*").alias("transactions_l12"),
        F.count_distinct("organization_id").alias("organizations_l12"), F.count_distinct("month_date").alias("months_active"), total("amount", q4).alias("q4_amount"),
        F.avg(F.when(present("orden_compra"), 0.0).otherwise(1.0)).alias("missing_oc_share"),
    )
    before = prev12.filter(provider_scope()).groupBy("provider_id").agg(total("amount").alias("amount_prev12"))
    first = with_months(facts).filter(provider_scope()).groupBy("provider_id").agg(F.min("month_date").alias("first_seen"))
    clients = mine.groupBy("provider_id", "organization_id").agg(total("amount").alias("pair_amount"))
    client = clients.groupBy("provider_id").agg(dominant(F.col("organization_id"), F.col("pair_amount")).alias("top_client_id"), F.max("pair_amount").alias("top_client_amount"))
    rows = now.join(before, "provider_id", "left").join(first, "provider_id", "left").join(client, "provider_id", "left")
    return rows.withColumns({
        "variation_l12": share("amount_l12", "amount_prev12") - 1, "q4_share": share("q4_amount", "amount_l12"), "dependence_top_client": share("top_client_amount", "amount_l12"),
    }).orderBy(F.desc("amount_l12"), "provider_id").limit(top)


def concentration(l12: DataFrame, top: int = 10) -> DataFrame:
    """Share of the ten largest providers, and the Herfindahl index over all; no global window."""
    spend = l12.filter(provider_scope()).groupBy("provider_id").agg(total("amount").alias("a"))
    first = spend.orderBy(F.desc("a"), "provider_id").limit(top).agg(total("a").alias("first"))
    whole = spend.agg(total("a").alias("total"), F.sum(F.pow("a", F.lit(2.0))).alias("squares"))
    return whole.crossJoin(first).select(
        F.coalesce(share("first", "total"), F.lit(0.0)).alias("top10_provider_share"), F.coalesce(share("squares", F.col("total") * F.col("total")), F.lit(0.0)).alias("provider_hhi"), "total"
    )


def service_concentration(l12: DataFrame) -> DataFrame:
    """Largest provider, its share, and the Herfindahl index per organisation."""
    spend = l12.filter(provider_scope()).groupBy("organization_id", "provider_id").agg(dominant(provider_name(), _amount_size()).alias("provider_name"), total("amount").alias("a"))
    rows = spend.groupBy("organization_id").agg(
        F.min_by(F.struct("provider_id", "provider_name", "a"), F.struct(-F.col("a"), F.col("provider_id"))).alias("top"), total("a").alias("total"), F.sum(F.pow("a", F.lit(2.0))).alias("squares")
    )
    return rows.select("organization_id", F.col("top.provider_id").alias("top_provider_id"), F.col("top.provider_name").alias("top_provider_name"), share("top.a", "total").alias("top_provider_share"), share("squares", F.col("total") * F.col("total")).alias("provider_hhi"))


def signal_overlay(prioritized: DataFrame, limits, key: str) -> DataFrame:
    """Signals, P1 signals and the highest score per ``key`` inside the window; a signal without a month counts as January."""
    month = F.make_date(F.col("periodo").cast("int"), F.coalesce(F.col("mes").cast("int"), F.lit(1)), F.lit(1))
    rows = prioritized.filter(present(key) & month.between(F.lit(limits["start_month"]), F.lit(limits["end_month"])))
    return rows.groupBy(key).agg(F.count("*").alias("signal_count"), F.count_if(F.col("priority_tier") == "P1").alias("p1_count"), F.max("investigation_priority_score").alias("max_priority_score"))


def compact(edges: DataFrame, profiles: DataFrame, service_names: DataFrame, cap: int = 3200, per_service: int = 2) -> tuple[DataFrame, DataFrame]:
    """Edges without public counterparties: the first of each organisation, then the largest others up to ``cap``; and the providers of these, with stubs where there is no profile."""
    from .multiyear import private_edges

    mine = private_edges(edges, service_names)
    first = F.row_number().over(Window.partitionBy("organization_id").orderBy(F.desc("amount_clp"), "provider_id"))
    ranked = mine.withColumn("in_service", first)
    kept = ranked.orderBy((F.col("in_service") > per_service).cast("int"), F.desc("amount_clp"), "organization_id", "provider_id").limit(cap)
    # The first of each organisation stay even beyond the cap.
    must = ranked.filter(F.col("in_service") <= per_service)
    edges_kept = kept.unionByName(must).dropDuplicates(["organization_id", "provider_id"]).drop("in_service")
    people = edges_kept.groupBy("provider_id").agg(F.min("provider_name").alias("flow_name"))
    stubs = people.join(profiles, "provider_id", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("amount_l12", "transactions_l12", "organizations_l12", "months_active") if c in profiles.columns}
    return edges_kept, stubs.withColumns({**zero, "provider_name": F.coalesce("provider_name", "flow_name")}).drop("flow_name")


def services_nested(service_rows: DataFrame, months: DataFrame, strongest: DataFrame, overlay: DataFrame | None = None) -> DataFrame:
    """Services as documents: their months nested, the strongest provider, and signals where there are any."""
    nested = months.groupBy("organization_id").agg(F.sort_array(F.collect_list(F.struct("period", "amount_clp", "provider_amount_clp"))).alias("monthly"))
    out = service_rows.join(nested, "organization_id", "left").join(strongest, "organization_id", "left")
    if overlay is not None:
        out = out.join(overlay, "organization_id", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("signal_count", "p1_count")})
    return out
