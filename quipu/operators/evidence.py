"""Candidate links between local entities and an external register, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import provider_scope
from ..functions.text import name_key, ratio_bound, region_agrees, similarity, token_jaccard
from ..ship import ship

FUZZY_FLOOR, LEAST_SHARED = 0.94, 0.60
#: A similarity of the floor needs so many shared words even if the texts are alike in all else.
NEEDED_SHARED = max(LEAST_SHARED, (FUZZY_FLOOR - 0.65) / 0.35)
EXACT, FUZZY = "EXACT_NORMALIZED_NAME", "FUZZY_NAME_HIGH"


def findings_index(findings: DataFrame) -> DataFrame:
    """Per document: count, highest score, highest severity, families and up to ten addresses, sorted."""
    rank = F.when(F.upper("severity") == "HIGH", 3).when(F.upper("severity") == "MEDIUM", 2).when(F.upper("severity") == "LOW", 1).otherwise(0)
    named = lambda c: F.sort_array(F.collect_set(F.when(F.col(c) != "", F.col(c))))
    rows = findings.withColumn("document_id", F.trim(F.col("document_id").cast("string"))).filter("document_id <> ''")
    return rows.groupBy("document_id").agg(
        F.count("*").alias("finding_count"), F.max("aml_score").alias("max_aml_score"),
        F.max(F.struct(rank.alias("r"), F.upper(F.coalesce("severity", F.lit(""))).alias("s")))["s"].alias("max_severity"),
        named("risk_family").alias("risk_families"), F.slice(named("source_url"), 1, 10).alias("source_urls"),
    )


def likely(pairs: DataFrame) -> DataFrame:
    """Pairs of ``key`` and ``ext_key`` that can reach the floor: enough shared words, and enough shared letters that the ratio, were it as high as letters allow, would do."""
    shared = token_jaccard("key", "ext_key")
    enough = (shared >= NEEDED_SHARED - 1e-9) & (0.65 * ratio_bound("key", "ext_key") + 0.35 * shared >= FUZZY_FLOOR - 1e-9)
    return pairs.filter((F.col("key") == F.col("ext_key")) | enough)


def best_matches(local: DataFrame, external: DataFrame) -> DataFrame:
    """The best external name per local entity.

    local(local_id, name, region) may have several names per id; external
    (external_id, name, normalized_name, region, ...).  A fuzzy link needs a
    similarity of 0.94, so 83 % shared words even where the matching-blocks
    ratio is 1; pairs are found by an equi-join instead of a product: a name's
    words are ordered from rare to common, and two names that share 83 % of
    their words share one within the first 17 % (and one more) of either, the
    prefix filter of set-similarity joins, so only those words are indexed.
    Common words seldom lie in a prefix, which keeps hot words out of the join.
    Of these, pairs whose letters can't make up the similarity are dropped
    (:func:`likely`); only what is left goes through the ratio, the one Python step.
    """
    ship(local.sparkSession)
    mine = local.withColumn("key", name_key("name")).filter("key <> ''").dropDuplicates(["local_id", "key"])
    theirs = external.withColumn("ext_key", name_key(F.coalesce(F.expr("nullif(normalized_name, '')"), F.col("name")))).filter("ext_key <> '' and coalesce(external_id, '') <> ''")
    words = lambda c: F.array_remove(F.array_distinct(F.split(c, " ")), "")
    keys = mine.select(F.col("key").alias("k")).union(theirs.select(F.col("ext_key"))).distinct()
    spread = keys.select("k", F.explode(words("k")).alias("w"))
    frequency = spread.groupBy("w").agg(F.count("*").alias("n"))
    order = Window.partitionBy("k").orderBy("n", "w")
    sized = spread.join(frequency, "w").withColumn("at", F.row_number().over(order)).withColumn("size", F.count("*").over(Window.partitionBy("k")))
    prefix = sized.filter(F.col("at") <= F.col("size") - F.ceil(F.col("size") * NEEDED_SHARED - 1e-9) + 1).select("k", "w")
    left, right = mine.select("key").distinct().join(prefix, F.col("key") == F.col("k")).drop("k"), theirs.select("ext_key").distinct().join(prefix, F.col("ext_key") == F.col("k")).drop("k")
    pairs = left.join(right, "w").select("key", "ext_key").distinct()
    near = likely(pairs)
    scored = near.withColumn("similarity", similarity("key", "ext_key")).filter((F.col("similarity") == 1.0) | (F.col("similarity") >= FUZZY_FLOOR))
    linked = scored.join(mine.withColumnRenamed("region", "local_region"), "key").join(theirs.withColumnRenamed("region", "ext_region").withColumnRenamed("name", "external_name"), "ext_key")
    best = F.row_number().over(Window.partitionBy("local_id").orderBy(F.desc("similarity"), "external_id", "key"))
    return linked.withColumn("best", best).filter("best = 1").drop("best").withColumn("method", F.when(F.col("similarity") == 1.0, EXACT).otherwise(FUZZY))


def make_links(matches: DataFrame, findings: DataFrame, entity_type: str, system: str = "EXTERNAL_REGISTER") -> DataFrame:
    """Matches as candidate links with a confidence and what the register found."""
    agrees = region_agrees("local_region", "ext_region")
    base = F.when(F.col("method") == EXACT, 0.92).otherwise(0.82) + F.when(agrees, 0.03).when(~agrees, -0.07).otherwise(0.0)
    confidence = F.least(F.lit(0.93), F.greatest(F.lit(0.0), base * (0.75 + 0.25 * F.coalesce("confidence", F.lit(0.75)))))
    document = F.coalesce("source_document_id", F.lit(""))
    found = findings_index(findings)
    rows = matches.withColumn("document", document).join(found, F.col("document") == found["document_id"], "left")
    link = F.upper(F.substring(F.sha2(F.concat_ws("|", F.lit(entity_type), "local_id", "external_id", "document", "method"), 256), 1, 24))
    return rows.select(
        F.concat(F.lit("EVL-PA-CGR-"), link).alias("evidence_link_id"), F.lit(entity_type).alias("local_entity_type"), F.col("local_id").alias("local_entity_id"),
        F.col("name").alias("local_name"), F.lit(system).alias("external_system"), F.col("external_id").alias("external_entity_id"), "external_name",
        F.col("document").alias("external_document_id"), F.col("method").alias("match_method"), F.round("similarity", 6).alias("name_similarity"),
        agrees.alias("region_agreement"), F.round(confidence, 6).alias("confidence"), F.lit("CANDIDATE").alias("status"),
        F.coalesce("finding_count", F.lit(0)).cast("long").alias("cgr_finding_count"), F.col("max_aml_score").cast("double").alias("cgr_max_aml_score"),
        F.coalesce("max_severity", F.lit("")).alias("cgr_max_severity"), F.to_json(F.coalesce("risk_families", F.array().cast("array<string>"))).alias("cgr_risk_families"),
        F.to_json(F.coalesce("source_urls", F.array().cast("array<string>"))).alias("cgr_source_urls"),
        F.to_json(F.struct(F.col("method").alias("name"), F.round("similarity", 6).alias("similarity"), agrees.alias("region_agreement"))).alias("match_basis"),
    )


def local_providers(facts: DataFrame) -> DataFrame:
    return facts.filter(provider_scope()).groupBy(F.col("provider_id").alias("local_id")).agg(F.min("nombre_beneficiario").alias("name"), F.min("region").alias("region"))


def local_organizations(facts: DataFrame) -> DataFrame:
    """Three candidate names per organisation: area, chapter, ministry."""
    orgs = facts.groupBy(F.col("organization_id").alias("local_id")).agg(
        F.min("nombre_area").alias("a"), F.min("nombre_capitulo").alias("b"), F.min("nombre_partida").alias("c"), F.min("region").alias("region")
    )
    return orgs.select("local_id", F.explode(F.array("a", "b", "c")).alias("name"), "region").filter("coalesce(name, '') <> ''")


def correlate(facts: DataFrame, providers: DataFrame, organizations: DataFrame, findings: DataFrame) -> DataFrame:
    """Links of providers and organisations with the register."""
    sides = (("PROVIDER", local_providers(facts), providers, "provider_id"), ("ORGANIZATION", local_organizations(facts), organizations, "organization_id"))
    links = [make_links(best_matches(mine, theirs.withColumnRenamed(key, "external_id")), findings, kind) for kind, mine, theirs, key in sides]
    return links[0].unionByName(links[1])


def summarize_links(links: DataFrame) -> DataFrame:
    n = F.count_if
    return links.agg(
        F.count("*").alias("links"), n(F.col("local_entity_type") == "PROVIDER").alias("provider_links"), n(F.col("local_entity_type") == "ORGANIZATION").alias("organization_links"),
        n(F.col("cgr_finding_count") > 0).alias("links_with_findings"), n(F.col("confidence") >= 0.88).alias("high_confidence_links"),
    )


def top_links(links: DataFrame, top: int = 50) -> DataFrame:
    return links.orderBy(F.desc("confidence"), F.coalesce("cgr_max_aml_score", F.lit(0.0)).desc(), F.desc("cgr_finding_count"), "evidence_link_id").limit(top)
