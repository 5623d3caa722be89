"""What an explorer of the flow graph asks: scoping, dependence, ranking, finding, growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import rut_key
from ..functions.predicates import exact_sum, share, total
from ..functions.text import fold


def scope(edges: DataFrame, **equal) -> DataFrame:
    """Cross-filter: edges that agree with all values given."""
    for c, v in equal.items():
        if v is not None:
            edges = edges.filter(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return edges


def ends(edges: DataFrame) -> DataFrame:
    """Sums of both ends of the scoped edges."""
    side = lambda c, kind: edges.groupBy(F.col(c).alias("entity_id")).agg(total("amount_clp").alias("amount_clp")).withColumn("kind", F.lit(kind))
    return side("organization_id", "service").unionByName(side("provider_id", "provider"))


def dependence_influence(edges: DataFrame) -> DataFrame:
    """Per provider: its largest edge over its own total (dependence) and over that organisation's total (influence)."""
    by_provider = edges.groupBy("provider_id").agg(total("amount_clp").alias("provider_total"), F.min_by(F.struct("organization_id", "amount_clp"), F.struct(-F.col("amount_clp"), F.col("organization_id"))).alias("top"))
    by_service = edges.groupBy("organization_id").agg(total("amount_clp").alias("service_total"))
    rows = by_provider.select("provider_id", "provider_total", F.col("top.organization_id").alias("organization_id"), F.col("top.amount_clp").alias("top_amount")).join(by_service, "organization_id")
    return rows.select("provider_id", "organization_id", "top_amount", share("top_amount", "provider_total").alias("dependence"), share("top_amount", "service_total").alias("influence"))


def kpis(edges: DataFrame, top: int = 10) -> DataFrame:
    by_provider = edges.groupBy("provider_id").agg(total("amount_clp").alias("a"))
    first = by_provider.orderBy(F.desc("a"), "provider_id").limit(top).agg(total("a").alias("first"))
    whole = by_provider.agg(total("a").alias("flow_total"), F.sum(F.pow("a", F.lit(2.0))).alias("squares"), F.min_by("provider_id", F.struct(-F.col("a"), F.col("provider_id"))).alias("top_provider_id"), F.count("*").alias("providers"))
    return whole.crossJoin(first).select("flow_total", "providers", "top_provider_id", share("first", "flow_total").alias("top10_share"), share("squares", F.col("flow_total") * F.col("flow_total")).alias("hhi"))


def pareto(rows: DataFrame, key: str, amount: str, top: int = 100) -> DataFrame:
    """Running share of the whole over the largest ``top`` rows; the running sum sees no more rows than are shown."""
    whole = rows.agg(total(amount).alias("whole"))
    first = rows.orderBy(F.desc(amount), key).limit(top)
    w = Window.orderBy(F.desc(amount), key).rowsBetween(Window.unboundedPreceding, 0)
    running = first.withColumns({"rank": F.row_number().over(Window.orderBy(F.desc(amount), key)), "running": exact_sum(amount, over=w)})
    # One row: a proven bound for the broadcast.
    return running.crossJoin(F.broadcast(whole)).select(key, amount, "rank", share("running", "whole").alias("cumulative_share"))


def nested_top(edges: DataFrame, services: int = 5, providers: int = 10, flows: int = 24) -> DataFrame:
    """The largest flows between the largest services and, among what these pay, the largest providers; each cut is a distributed top-k."""
    sums = lambda rows, c: rows.groupBy(c).agg(total("amount_clp").alias("a"))
    first = sums(edges, "organization_id").orderBy(F.desc("a"), "organization_id").limit(services)
    mine = edges.join(first.select("organization_id"), "organization_id", "left_semi")
    paid = sums(mine, "provider_id").orderBy(F.desc("a"), "provider_id").limit(providers)
    return mine.join(paid.select("provider_id"), "provider_id", "left_semi").orderBy(F.desc("amount_clp"), "organization_id", "provider_id").limit(flows)


#: Flows shown when one organisation, or one provider, is looked at.
FOCUSED_SERVICE, FOCUSED_PROVIDER = 14, 12
#: Rows that the tables of services, providers and flows show.
TABLE_ROWS = {"services": 300, "providers": 300, "flows": 400}


def focused_flows(edges: DataFrame, organization: str | None = None, provider: str | None = None) -> DataFrame:
    """The largest flows of an organisation or a provider; without either those of :func:`nested_top`."""
    if organization is None and provider is None:
        return nested_top(edges)
    mine = scope(edges, organization_id=organization, provider_id=provider)
    return mine.orderBy(F.desc("amount_clp"), "organization_id", "provider_id").limit(FOCUSED_SERVICE if organization is not None else FOCUSED_PROVIDER)


def table_rows(rows: DataFrame, kind: str, names: list[str], text: str = "", amount: str = "amount_clp") -> DataFrame:
    """What a table shows: rows one of whose ``names`` holds the text (accents and case aside), the largest first."""
    if text:
        rows = rows.filter(F.contains(fold(F.concat_ws(" ", *names)), fold(F.lit(text))))
    return rows.orderBy(F.desc(amount), *names).limit(TABLE_ROWS[kind])


def joined_feeds(providers: DataFrame, order: dict[str, str], **feeds: DataFrame) -> DataFrame:
    """``providers(rut, ...)`` with a record of each feed that has their tax number, however it is written, or null.

    Of several rows of a feed with one number the last by its column ``order[feed]`` counts; rows without a number never match.
    """
    out = providers.withColumn("key_", rut_key("rut"))
    for name, feed in feeds.items():
        last = feed.withColumn("feed_key_", rut_key("rut")).filter("feed_key_ <> ''").groupBy("feed_key_").agg(F.max_by(F.struct(*feed.columns), order[name]).alias(name))
        out = out.join(last, F.col("key_") == F.col("feed_key_"), "left").drop("feed_key_")
    return out.drop("key_")


def variation(yearly: DataFrame, key: str) -> DataFrame:
    """Change against the previous year with data."""
    before = F.lag("amount_clp").over(Window.partitionBy(key).orderBy("year"))
    return yearly.withColumn("previous_amount", before).withColumn("variation", F.when(F.col("previous_amount") > 0, F.col("amount_clp") / F.col("previous_amount") - 1))


def growth_ranking(changes: DataFrame, key: str, year: int, top: int = 10) -> DataFrame:
    """Growth weighed by size: log10(a + 10) * log1p(100 v)."""
    rows = changes.filter((F.col("year") == year) & (F.col("variation") > 0))
    score = F.log10(F.col("amount_clp") + 10) * F.log1p(100 * F.col("variation"))
    return rows.withColumn("growth_score", score).orderBy(F.desc("growth_score"), key).limit(top)


def find_entities(rows: DataFrame, text: str, name: str = "provider_name", rut: str = "rut", top: int = 14) -> DataFrame:
    """Entities whose name or tax number starts with, then holds, the text."""
    q = "".join(text.lower().split()) and " ".join(text.lower().split())
    n, k = fold(name), F.regexp_replace(F.lower(F.coalesce(rut, F.lit(""))), "[^0-9k]", "")
    digits = "".join(c for c in q if c in "0123456789k")
    by_rut = F.lit(bool(digits) and digits == q.replace(".", "").replace("-", ""))
    score = F.when(n.startswith(q), 4).when(by_rut & k.startswith(digits), 3).when(n.contains(q), 2).when(by_rut & k.contains(digits), 1).otherwise(0)
    return rows.withColumn("match_score", score).filter("match_score > 0").orderBy(F.desc("match_score"), name, rut).limit(top)


def union_marks(*marks: DataFrame) -> DataFrame:
    """Marks of several sources, each (entity, type, year, source) once."""
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m, allowMissingColumns=True)
    return out.dropDuplicates(["entity_id", "signal_type", "year", "source"])


def mark_summary(marks: DataFrame, sizes: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Distinct entities and their (not additive) amounts per mark, in a given order of marks, then by name."""
    once = marks.select("entity_id", "signal_type").distinct()
    rows = once.join(sizes, "entity_id").groupBy("signal_type").agg(F.count("*").alias("entities"), total("amount_clp").alias("amount_clp"))
    place = F.array_position(F.array(*[F.lit(x) for x in order or ["-"]]), F.col("signal_type"))
    return rows.orderBy(F.when(place == 0, 1_000_000).otherwise(place), "signal_type")


def with_mark(edges: DataFrame, marks: DataFrame, signal_type: str) -> DataFrame:
    """Edges of the providers that carry a mark."""
    return edges.join(marks.filter(F.col("signal_type") == signal_type).select(F.col("entity_id").alias("provider_id")), "provider_id", "left_semi")


def months_with_fallback(paid: DataFrame, accrued: DataFrame, key: str = "provider_id") -> DataFrame:
    """Payment months, and for entities without any the accrual months."""
    rest = accrued.join(paid.select(key).distinct(), key, "left_anti").withColumn("basis", F.lit("accrual"))
    return paid.withColumn("basis", F.lit("payment")).unionByName(rest)


def yearly_from_months(months: DataFrame, key: str) -> DataFrame:
    return months.groupBy(key, F.substring("period", 1, 4).cast("int").alias("year")).agg(total("amount_clp").alias("amount_clp"))


def weekly_clusters(events: DataFrame, least: int = 3) -> DataFrame:
    """Rows per user and week, from weekly windows."""
    return events.groupBy("user_id", F.date_trunc("week", "ts").alias("week")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
