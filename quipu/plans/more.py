"""Further registered queries: sources and sinks over written files, evidence with links, marks and views over made-up cases.

The tables hold few duplicates, newcomers and registry cases; these queries make
them from the tables by rules that both forms share.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.predicates import total
from ..operators import bitmaps, dashboard, documents, enrich, evidence, explore, multiyear, priority, search, signals, sketches, spend
from ..scratch import materialize, shared_dir
from ..sources import delimited, html_tables, profile, sinks, splits, yearly
from ..sources.facts import normalize
from ..sources.star import facts
from . import registry
from .registry import _ALL, _DUP_KEYS, _DUPLICATE, _EDGES, _MARK_RULES, _MARKS, _PATTERNS, _PRIORITY, _YEAR_COLUMNS, A, PROVIDER, T, _dominant, _plain, _shown, _written_edges, _edges, query, rounded
from .shared import detect, full_facts, full_rows, signal_rows  # noqa: F401  the tests make full_facts once for both modules
from .years import Years

# --- sources and sinks ----------------------------------------------------------------------------------------------


def _raw_orders(spark, sf_dir) -> DataFrame:
    """Orders in the shape of a raw payment file, as texts: dates in two forms, an identity under two headers, amounts with gaps."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    even = F.col("o_orderkey") % 2 == 0
    day = F.col("o_orderdate").cast("date")
    source = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    return o.select(
        F.year(day).cast("string").alias("Período"), F.month(day).cast("string").alias("MES"), F.lit("07").alias("Partida"), F.lpad((F.col("o_custkey") % 5).cast("string"), 2, "0").alias("CAPITULO"),
        F.when(even, source).otherwise(" ").alias("BENEFICIARIO"), F.when(even, "").otherwise(source).alias("RUT BENEFICIARIO"), F.col("o_orderkey").cast("string").alias("NUMERO_DOCUMENTO"),
        F.when(even, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "dd-MM-yyyy")).alias("Fecha Documento"), F.col("o_orderstatus").alias("FOLIO"),
        F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("DEVENGO"), F.when(even, "1").otherwise("0").alias("PROVEEDOR"), F.lit("x;y").alias("Glosa"),
    )


def _written(rows: DataFrame, name: str, **options) -> str:
    """A folder of files, as many as the rows have tasks, each with a header."""
    folder = f"{shared_dir(rows.sparkSession)}/{name}"
    rows.write.csv(folder, header=True, **options)
    return folder


_RAW = """r AS (SELECT *, CAST(o_orderdate AS DATE) AS d, o_orderkey % 2 = 0 AS even, row_number() OVER (ORDER BY o_orderkey) AS n, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount FROM orders),
p AS (SELECT *, 'C' || CAST(o_custkey AS VARCHAR) AS who, lpad(CAST(o_custkey % 5 AS VARCHAR), 2, '0') AS cap FROM r),
f AS (SELECT *, 'FP-PA-' || upper(substr(sha256(concat_ws('|', year(d), month(d), '07', cap, '', who, o_orderkey, o_orderstatus, CAST(d AS VARCHAR), coalesce(CAST(amount AS VARCHAR), ''), '', '')), 1, 24)) AS fp FROM p)"""


@query(f"""WITH {_RAW}
SELECT CAST(n AS BIGINT) AS source_row_number, CAST(year(d) AS BIGINT) AS periodo, CAST(month(d) AS BIGINT) AS mes, d AS fecha_documento, CAST(amount AS DOUBLE) AS monto_devengado, who AS beneficiario_source_id, even AS is_provider,
       'ORG-PA-07-' || cap || '-000' AS organization_id, 'SOURCE_ID' AS beneficiario_id_type, fp AS transaction_fingerprint, 'x;y' AS glosa, '' AS nombre_item,
       'TRX-PA-' || upper(substr(sha256(concat_ws('|', 'ORDERS.GZ', n, fp)), 1, 24)) AS transaction_id FROM f""")
def normalized_delimited(spark, sf_dir):
    """Gzip files with semicolons are written in ranges of the key, read from restart points inside them, and normalised; rows are numbered over all of them."""
    raw = _raw_orders(spark, sf_dir).withColumn("k", F.col("NUMERO_DOCUMENTO").cast("long")).repartitionByRange("k").sortWithinPartitions("k").drop("k")
    files = _written(raw, "orders", sep=";", compression="gzip", quoteAll=True)
    rows = normalize(splits.read_gzip(spark, files, spacing=1 << 18, across=True), source_file="orders.gz", row_number=False)
    shown = "source_row_number periodo mes monto_devengado beneficiario_source_id is_provider organization_id beneficiario_id_type transaction_fingerprint glosa nombre_item transaction_id"
    return rows.select(*shown.split(), F.col("fecha_documento").cast("date").alias("fecha_documento"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END AS nation, CASE WHEN s_suppkey % 2 = 1 THEN 'odd' END AS note FROM supplier""")
def delimited_union_by_name(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("nation"), F.lit("odd").alias("note"))
    paths = [_written(s.filter("id % 2 = 0").select("id", "name", "nation"), "even", sep="\t"), _written(s.filter("id % 2 = 1").select("note", "name", "id"), "odd", sep="\t")]
    return delimited.read_many_delimited(spark, paths)


@query("SELECT CAST(event_id AS BIGINT) AS event_id, event_type, CAST(value AS DOUBLE) AS value FROM events WHERE event_id % 3 <> 0")
def json_lines_with_broken_rows(spark, sf_dir):
    """Every third line is cut short, and a file that is not there adds nothing."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    folder = shared_dir(spark)
    e.select(F.when(F.col("event_id") % 3 == 0, F.substring(line, 1, 15)).otherwise(line).alias("value")).write.text(f"{folder}/events.jsonl")
    schema = "event_id long, event_type string, value double"
    rows = delimited.read_json_lines(spark, f"{folder}/events.jsonl", schema).filter("event_id is not null")
    return rows.unionByName(delimited.read_json_lines(spark, f"{folder}/missing.jsonl", schema))


@query("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation")
def json_documents_exploded(spark, sf_dir):
    """A document of several lines for each region."""
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("entries"))
    folder = f"{shared_dir(spark)}/documents"
    whole = F.to_json(F.struct(F.lit("now").alias("generated"), "entries"), {"pretty": "true"})
    rows.select("n_regionkey", whole.alias("value")).write.partitionBy("n_regionkey").text(folder)
    return profile.exploded(profile.read_documents(spark, folder), "entries")


_TABLE = "<TABLE><TR class=x><td>a <b>bold</b>\n cell</td><td> {} </td><td></td></TR><tr><th>Name</th><th>x</th></tr><tr><td>alone</td></tr><tr><TD>p</TD><td>q</td></tr></TABLE>"


@query(rf"""WITH pages AS (SELECT page_id, html || replace('{_TABLE}', '{{}}', CAST(page_id AS VARCHAR)) AS html FROM pages), r AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)</tr>', 1)) AS row_html FROM pages),
c AS (SELECT page_id, list_transform(regexp_extract_all(row_html, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS cells FROM r)
SELECT page_id, list_aggregate(cells, 'string_agg', '|') AS cells FROM c WHERE len(cells) >= 2 AND NOT list_has_any(cells, ['Name', 'Total'])""")
def page_table_rows(spark, sf_dir):
    table = F.replace(F.lit(_TABLE), F.lit("{}"), F.col("page_id").cast("string"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.concat("html", table).alias("html"))
    return delimited.table_rows(pages, least=2, skip=("Name", "Total")).select("page_id", F.array_join("cells", "|").alias("cells"))


_NESTED = (
    "<!-- <table><tr><td>no</td></tr></table> --><TABLE border=1><tr><th colspan=2>Page {} &amp; more<th>x<tr><td rowspan='2'>a{}<td><script>'</table><td>'</script>b"
    "<table><tr><td>inner {}</table><td>&lt;c&gt;<tr><td>d<td>e&#8364;</tr></table>"
)


@query("""WITH p AS (SELECT page_id, CAST(page_id AS VARCHAR) AS k FROM pages)
SELECT page_id, 0 AS table_no, -1 AS parent_no, 0 AS row_no, TRUE AS header, 'Page ' || k || ' & more|Page ' || k || ' & more|x' AS cells FROM p UNION ALL SELECT page_id, 0, -1, 1, FALSE, 'a' || k || '|b|<c>' FROM p
UNION ALL SELECT page_id, 0, -1, 2, FALSE, 'a' || k || '|d|e€' FROM p UNION ALL SELECT page_id, 1, 0, 0, FALSE, 'inner ' || k FROM p""")
def page_tables(spark, sf_dir):
    """Every page with nested, spanned and unended tables at its end."""
    end = F.replace(F.lit(_NESTED), F.lit("{}"), F.col("page_id").cast("string"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.concat("html", end).alias("html"))
    found = html_tables.page_tables(pages)
    return found.withColumns({"cells": F.array_join("cells", "|"), "parent_no": F.coalesce("parent_no", F.lit(-1))})


@query("""WITH o AS (SELECT year(o_orderdate) AS y, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS a FROM orders), s AS (SELECT count(*) AS n, CAST(sum(CAST(a AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM o)
SELECT kind, n, amount FROM s, (VALUES ('parquet by year'), ('replaced twice'), ('csv'), ('json')) t(kind) UNION ALL SELECT 'empty dropped', 0, NULL""")
def sinks_read_back(spark, sf_dir):
    """What each writer wrote, read again; a table that is replaced while it is read; an output that an empty result removes."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.year("o_orderdate").alias("y"), F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("a"))
    folder = shared_dir(spark)
    sinks.write_parquet(o, f"{folder}/p", partition_by="y")
    sinks.write_parquet(o, f"{folder}/r")
    sinks.replace_parquet(spark.read.parquet(f"{folder}/r").withColumn("twice", F.col("a") * 2), f"{folder}/r")
    sinks.replace_parquet(spark.read.parquet(f"{folder}/r").select("y", "a"), f"{folder}/r")
    sinks.write_csv(o, f"{folder}/c")
    sinks.write_json(o.withColumn("bad", F.lit(float("nan"))), f"{folder}/j")
    sinks.check_json(spark, f"{folder}/j")
    sinks.write_parquet(o, f"{folder}/e")
    sinks.drop_if_empty(o.limit(0), f"{folder}/e")
    read = {
        "parquet by year": spark.read.parquet(f"{folder}/p"), "replaced twice": spark.read.parquet(f"{folder}/r"), "csv": spark.read.csv(f"{folder}/c", header=True, inferSchema=True),
        "json": spark.read.schema("a double, bad double").json(f"{folder}/j").filter("bad is null"), "empty dropped": delimited.read_optional(spark, f"{folder}/e", "a double"),
    }
    parts = [rows.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), total("a").alias("amount")) for kind, rows in read.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _yearly(f: DataFrame, folder: str) -> None:
    """Facts as a folder a year; years that are there already are left alone, except those of ``f``."""
    f.withColumn("year", F.col("periodo")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(folder)


def _kept_years(spark, sf_dir) -> Years:
    """All years are kept, of which one is wrong in every amount and has rows too many; then its file is mended, and only that year is read again."""
    yearly.register(spark)
    folder = shared_dir(spark)
    f = facts(spark, sf_dir, *_YEAR_COLUMNS.split())
    wrong = F.when(F.col("periodo") == 1996, F.col("monto_devengado") * 2 + 1).otherwise(F.col("monto_devengado"))
    spoilt = f.withColumn("monto_devengado", wrong)
    _yearly(spoilt.unionByName(spoilt.filter("periodo = 1996 and mes < 4").withColumn("provider_id", F.concat("provider_id", F.lit("-X")))), f"{folder}/files")
    states = lambda: spark.read.format("yearly_source").options(years="1985-2010", address=f"{folder}/files/year={{year}}", folder=f"{folder}/fetched").load()
    files = lambda rows: rows.withColumn("path", F.concat(F.lit(f"{folder}/files/year="), F.col("year").cast("string")))
    read = lambda spark, path: spark.read.parquet(path)
    kept = Years(spark, f"{folder}/kept").update(files(states()), read, drop=False)
    _yearly(f.filter("periodo = 1996"), f"{folder}/files")
    sinks.drop_files(spark, [f"{folder}/fetched"])
    now = files(states())
    if sorted(kept.stale(now)) != [1996]:
        raise ValueError("other years than the mended one are stale")
    return kept.update(now, read)


@query(f"""re AS (SELECT organization_id, provider_id, periodo AS year, {A} AS a, count(*) AS n FROM facts WHERE {PROVIDER} GROUP BY 1, 2, 3 HAVING coalesce({A}, 0.0) <> 0)
SELECT organization_id, provider_id, round(sum(a), 2) AS amount_clp, CAST(sum(n) AS BIGINT) AS transactions FROM re GROUP BY 1, 2""")
def incremental_years(spark, sf_dir):
    """Sums over years after one year's file changed: its old sums are taken away and its new ones added."""
    return _kept_years(spark, sf_dir).totals().select("organization_id", "provider_id", F.round(F.col("amount_clp").cast("double"), 2).alias("amount_clp"), "transactions")


@query(f"{_MARKS} SELECT scope, entity_id, organization_id, year, signal_type, severity, round(metric, 6) AS metric, round(hhi, 6) AS hhi FROM mk")
def incremental_marks(spark, sf_dir):
    """The marks of all years, from the sums that are kept."""
    return rounded(_kept_years(spark, sf_dir).marks(_MARK_RULES, patterns=_PATTERNS), "metric", "hhi")


@query("""WITH w AS (SELECT unnest(range(1990, 2001)) AS y), f AS (SELECT year(o_orderdate) AS y, string_agg(CAST(o_orderkey AS VARCHAR) || chr(10), '' ORDER BY o_orderkey) AS body FROM orders GROUP BY 1)
SELECT CAST(w.y AS INTEGER) AS year, CASE WHEN body IS NOT NULL THEN 'downloaded' WHEN w.y IN (1994, 1999) THEN 'linked_unavailable' ELSE 'probed_missing' END AS status, CAST(strlen(body) AS BIGINT) AS content_length, CAST(strlen(body) AS BIGINT) AS bytes, sha256(body) AS sha256
FROM w LEFT JOIN f USING (y)""")
def yearly_source_states(spark, sf_dir):
    """Orders are written as a folder a year, and the years probed, fetched and digested side by side; a page links two of them."""
    yearly.register(spark)
    folder, y, k = shared_dir(spark), F.year("o_orderdate").alias("year"), F.col("o_orderkey")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(y, k.cast("string").alias("value"), k)
    o.repartitionByRange("year", "o_orderkey").sortWithinPartitions("year", "o_orderkey").drop("o_orderkey").write.partitionBy("year").text(f"{folder}/data")
    links = "".join(f'<a href="{folder}/data/year={x}">{x}</a>' for x in (1994, 1999))
    spark.createDataFrame([(f"<html>{links}</html>",)], "value string").write.text(f"{folder}/page")
    source = spark.read.format("yearly_source").options(years="1990-2000", address=f"{folder}/data/year={{year}}", pages=f"{folder}/page", pattern=r"/year=(\d{4})$", folder=f"{folder}/fetched")
    return source.load().select("year", "status", "content_length", "bytes", "sha256")


@query("""WITH o AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS periodo, 'orders-' || CAST(o_orderkey % 3 AS VARCHAR) || '.txt' AS source_file FROM orders)
SELECT periodo, source_file, count(*) AS n_rows, CAST(6 AS BIGINT) AS n_bytes, sha256(replace(source_file, '.txt', '')[8:] || 'file' || chr(10)) AS sha256, ';' AS delimiter FROM o GROUP BY 1, 2""")
def snapshot_manifest(spark, sf_dir):
    """Rows per year and source file, with size, digest and delimiter of the file."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.year("o_orderdate").cast("long").alias("periodo"), F.concat(F.lit("orders-"), (F.col("o_orderkey") % 3).cast("string"), F.lit(".txt")).alias("source_file"))
    folder, parts = shared_dir(spark), None
    for k in range(3):
        spark.createDataFrame([(f"{k}file",)], "value string").coalesce(1).write.text(f"{folder}/orders-{k}.txt")
        one = sinks.file_digests(spark, f"{folder}/orders-{k}.txt/part-*").withColumn("source_file", F.lit(f"orders-{k}.txt"))
        parts = one if parts is None else parts.unionByName(one)
    return sinks.manifest(o, parts.drop("path").withColumn("delimiter", F.lit(";")))


@query("""x AS (SELECT * FROM facts), w AS (SELECT * FROM (VALUES (1990), (1996), (1997), (2030), (2031)) t(y)), s AS (SELECT * FROM (VALUES (1996, 'u6', 'linked_available', 'aa', 10, ';'), (1997, 'u7', 'probed_available', 'bb', 11, ','), (1990, 'u0', 'probed_missing', NULL, NULL, NULL), (2031, 'u1', 'linked_available', 'cc', 12, ';')) t(y, u, st, sha, b, de)),
n AS (SELECT periodo AS y, count(*) AS n, count(*) FILTER (WHERE monto_devengado >= 50000) AS m FROM x GROUP BY 1), a AS (SELECT * FROM s WHERE st IN ('linked_available', 'probed_available'))
SELECT CAST(w.y AS BIGINT) AS periodo, u AS source_url, st AS source_status, sha AS source_sha256, CAST(b AS BIGINT) AS source_bytes, de AS delimiter, coalesce(n, 0) AS normalized_rows, coalesce(m, 0) AS matched_rows,
       CASE WHEN u IS NULL THEN 'SOURCE_NOT_CONFIRMED' WHEN n IS NULL THEN 'PROCESSING_ERROR' ELSE 'PROCESSED' END AS status FROM w LEFT JOIN a ON a.y = w.y LEFT JOIN n ON n.y = w.y""")
def multi_year_states(spark, sf_dir):
    f = facts(spark, sf_dir, "transaction_id", "periodo", "monto_devengado")
    sources = spark.createDataFrame([(1996, "u6", "linked_available", "aa", 10, ";"), (1997, "u7", "probed_available", "bb", 11, ","), (1990, "u0", "probed_missing", None, None, None), (2031, "u1", "linked_available", "cc", 12, ";")], search.SOURCES)
    return search.year_states(f, [1990, 1996, 1997, 2030, 2031], sources, f.filter("monto_devengado >= 50000"))


# --- cuts and feeds of the explorer, areas, stubs -------------------------------------------------------------------

_FLOWS = f"{_EDGES}, e AS (SELECT organization_id, provider_id, min(provider_name) AS provider_name, round(sum(amount_clp), 2) AS amount_clp FROM ed GROUP BY 1, 2)"


def _flows(spark, sf_dir) -> DataFrame:
    return _edges(spark, sf_dir)[1].groupBy("organization_id", "provider_id").agg(F.min("provider_name").alias("provider_name"), total("amount_clp").alias("amount_clp"))


@query(f"""{_FLOWS}, a AS (SELECT 'service' AS focus, * FROM e WHERE organization_id = 'ORG-07' ORDER BY amount_clp DESC, organization_id, provider_id LIMIT 14), b AS (SELECT 'provider' AS focus, * FROM e WHERE provider_id = 'PRV-000007' ORDER BY amount_clp DESC, organization_id, provider_id LIMIT 12)
SELECT * FROM a UNION ALL SELECT * FROM b""")
def flows_in_focus(spark, sf_dir):
    flows = materialize(_flows(spark, sf_dir), "flows")
    service, provider = explore.focused_flows(flows, organization="ORG-07"), explore.focused_flows(flows, provider="PRV-000007")
    return service.withColumn("focus", F.lit("service")).unionByName(provider.withColumn("focus", F.lit("provider")))


@query(f"{_FLOWS} SELECT organization_id, provider_id, provider_name, amount_clp FROM e WHERE lower(provider_name || ' ' || organization_id) LIKE '%7 org-1%' ORDER BY amount_clp DESC, provider_name, organization_id LIMIT 400")
def table_of_flows(spark, sf_dir):
    return explore.table_rows(_flows(spark, sf_dir), "flows", ["provider_name", "organization_id"], "7 Órg-1").select("organization_id", "provider_id", "provider_name", "amount_clp")


@query(f"""p AS (SELECT provider_id, min(rut_beneficiario) AS rut, CAST(substr(provider_id, 5) AS BIGINT) AS k FROM facts WHERE {PROVIDER} GROUP BY 1)
SELECT provider_id, rut, CASE WHEN k % 2 = 0 THEN 'state ' || CAST(k % 5 + 1 AS VARCHAR) END AS registry, CASE WHEN k % 3 = 0 THEN k % 4 END AS events, k % 5 = 0 AS watched FROM p""")
def three_feeds(spark, sf_dir):
    """Providers with three feeds that write tax numbers in forms of their own; the registry has two states of each, of which the later counts."""
    f = facts(spark, sf_dir, "provider_id", "is_provider", "rut_beneficiario").filter("is_provider and provider_id <> ''")
    p = materialize(f.groupBy("provider_id").agg(F.min("rut_beneficiario").alias("rut")), "providers")
    k = F.substring("provider_id", 5, 20).cast("long")
    dotted = F.lower(F.regexp_replace("rut", r"^(\d+)(\d{3})(\d{3})-", "$1.$2.$3 - "))
    registry = p.filter(k % 2 == 0).select(dotted.alias("rut"), F.explode(F.array(F.lit(0), F.lit(1))).alias("version"), k.alias("k"))
    registry = registry.select("rut", "version", F.concat(F.lit("state "), (F.col("k") % 5 + F.col("version")).cast("string")).alias("state"))
    events = p.filter(k % 3 == 0).select(F.regexp_replace("rut", "-", "").alias("rut"), (k % 4).alias("n")).union(spark.createDataFrame([("", 9), (None, 9)], "rut string, n long"))
    watched = p.filter(k % 5 == 0).select("rut")
    rows = explore.joined_feeds(p, {"registry": "version", "events": "n", "watched": "rut"}, registry=registry, events=events, watched=watched)
    return rows.select("provider_id", "rut", F.col("registry.state").alias("registry"), F.col("events.n").alias("events"), F.col("watched").isNotNull().alias("watched"))


@query(f"""s AS (SELECT organization_id, subtitulo AS area, {_dominant("nombre_subtitulo", "abs(monto_devengado)")} AS area_name, coalesce({A}, 0.0) AS amount_clp FROM facts GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY organization_id ORDER BY amount_clp DESC, area) AS rank FROM s WHERE amount_clp <> 0) SELECT organization_id, CAST(rank AS INTEGER) AS rank, area, area_name, amount_clp FROM r WHERE rank <= 12""")
def largest_areas(spark, sf_dir):
    f = facts(spark, sf_dir, "organization_id", "subtitulo", "nombre_subtitulo", "monto_devengado")
    return multiyear.service_areas(f, "subtitulo", "nombre_subtitulo").select("organization_id", F.explode("areas").alias("a")).select("organization_id", "a.*")


@query(f"""{_FLOWS}, m AS (SELECT provider_id, min(provider_name) AS flow_name FROM e GROUP BY 1), q AS (SELECT *, CAST(substr(provider_id, 5) AS BIGINT) AS k FROM m)
SELECT provider_id, CASE WHEN k % 3 = 0 THEN flow_name ELSE 'profile ' || CAST(k AS VARCHAR) END AS provider_name, CASE WHEN k % 3 = 0 THEN 0 ELSE k END AS transactions_l12 FROM q""")
def compact_providers(spark, sf_dir):
    """Providers of the compact view; a third of them have no profile and get a stub with the name of their flows."""
    flows = _flows(spark, sf_dir)
    k = F.substring("provider_id", 5, 20).cast("long")
    profiles = flows.select("provider_id").distinct().filter(k % 3 != 0).select("provider_id", F.concat(F.lit("profile "), k.cast("string")).alias("provider_name"), k.alias("transactions_l12"))
    none = spark.range(0).select(F.lit("").alias("name_key"))
    return spend.compact(flows, profiles, none, cap=1_000_000)[1].select("provider_id", "provider_name", "transactions_l12")


@query("""a AS (SELECT organization_id, min(nombre_area) AS name, min(region) AS region FROM facts GROUP BY 1), x AS (SELECT 'E' || CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CASE WHEN n_nationkey % 4 = 0 THEN r_name WHEN n_nationkey % 4 = 2 THEN 'ELSEWHERE' END AS region, 'D' || CAST(n_nationkey % 7 AS VARCHAR) AS doc, n_nationkey AS k FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0),
l AS (SELECT a.organization_id, x.id, x.doc, x.k, CASE WHEN x.region IS NULL THEN NULL ELSE x.region = a.region END AS agrees FROM a JOIN x ON a.name = x.name)
SELECT 'EVL-PA-CGR-' || upper(substr(sha256(concat_ws('|', 'ORGANIZATION', organization_id, id, doc, 'EXACT_NORMALIZED_NAME')), 1, 24)) AS evidence_link_id, organization_id AS local_entity_id, id AS external_entity_id, agrees AS region_agreement,
       CAST(round(least(0.93, (0.92 + CASE WHEN agrees THEN 0.03 WHEN NOT agrees THEN -0.07 ELSE 0 END) * (0.75 + 0.25 * 0.9)), 6) AS DOUBLE) AS confidence, CASE WHEN k % 7 < 3 THEN CAST(2 AS BIGINT) ELSE 0 END AS cgr_finding_count, CASE WHEN k % 7 < 3 THEN CAST(10.0 * (k % 7) + 5 AS DOUBLE) END AS cgr_max_aml_score FROM l""")
def evidence_links_organizations(spark, sf_dir):
    """Organisations of the register by any of three names, with what the register found; no two names are near enough for a fuzzy link."""
    f = facts(spark, sf_dir, "organization_id", "nombre_area", "nombre_capitulo", "nombre_partida", "region")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").join(spark.read.parquet(f"{sf_dir}/region.parquet"), F.col("n_regionkey") == F.col("r_regionkey")).filter("n_nationkey % 2 = 0")
    k = F.col("n_nationkey")
    region = F.when(k % 4 == 0, F.col("r_name")).when(k % 4 == 2, F.lit("ELSEWHERE"))
    theirs = n.select(F.concat(F.lit("E"), k.cast("string")).alias("external_id"), F.col("n_name").alias("name"), F.lit("").alias("normalized_name"), region.alias("region"), F.lit(0.9).alias("confidence"), F.concat(F.lit("D"), (k % 7).cast("string")).alias("source_document_id"))
    found = n.select((k % 7).alias("d")).distinct().filter("d < 3").withColumn("half", F.explode(F.array(F.lit(0.0), F.lit(5.0))))
    findings = found.select(F.concat(F.lit("D"), F.col("d").cast("string")).alias("document_id"), F.lit("f").alias("finding_id"), (F.col("d") * 10.0 + F.col("half")).alias("aml_score"), F.lit("LOW").alias("severity"), F.lit("x").alias("risk_family"), F.lit("u").alias("source_url"))
    links = evidence.make_links(evidence.best_matches(evidence.local_organizations(f), theirs), findings, "ORGANIZATION")
    return links.select(*_LINK_COLUMNS.split(", "))


# --- stored sketches, bitmaps, scripts ------------------------------------------------------------------------------


@query("""c AS (SELECT organization_id, count(monto_devengado) AS n, count(DISTINCT provider_id) FILTER (WHERE provider_id <> '') AS providers FROM facts GROUP BY 1), q AS (SELECT CAST(unnest([0.25, 0.5, 0.99]) AS DOUBLE) AS p)
SELECT organization_id, n, providers, p, TRUE AS near FROM c, q""")
def sketched_quantiles(spark, sf_dir):
    """Quantiles of each organisation from sketches stored per year, and its providers from what is stored of each year; near: the rank that the value really has is within twice the sketch's error."""
    f = facts(spark, sf_dir, "organization_id", "periodo", "monto_devengado", "provider_id").withColumn("provider_id", F.expr("nullif(provider_id, '')"))
    stored = materialize(sketches.sketched(f, ["organization_id"]), "sketches")
    things = materialize(sketches.things(f, ["organization_id"], "provider_id"), "things")
    wanted = {"q25": 0.25, "q50": 0.5, "q99": 0.99}
    found = materialize(sketches.quantiles_of(sketches.merged(stored, ["organization_id"]), ["organization_id"], wanted), "quantiles")
    counted = sketches.counted(things, ["organization_id"]).select(F.col("organization_id").alias("counted"), F.col("distinct").alias("providers"))
    values = found.join(counted, F.col("organization_id") == F.col("counted"), "left").select(F.col("organization_id").alias("o"), "n", F.coalesce("providers", F.lit(0)).alias("providers"), *wanted)
    values = materialize(values, "values")
    # A row an organisation; AQE broadcasts it where it is small.
    ranks = f.join(values, F.col("organization_id") == F.col("o")).groupBy("organization_id").agg(F.max("n").alias("n"), F.max("providers").alias("providers"), *[F.count_if(F.col("monto_devengado") <= F.col(q)).alias(q) for q in wanted])
    cases = F.array(*[F.struct(F.lit(p).alias("p"), F.col(q).alias("rank")) for q, p in wanted.items()])
    rows = ranks.select("organization_id", "n", "providers", F.explode(cases).alias("c"))
    return rows.select("organization_id", "n", "providers", "c.p", (F.abs(F.col("c.rank") / F.col("n") - F.col("c.p")) <= 2 * sketches.RANK_ERROR + 1 / F.col("n")).alias("near"))


@query("""x AS (SELECT 1) SELECT sector AS value, count(*) AS n FROM facts WHERE region IN ('ASIA', 'EUROPE') AND mes IN (1, 2, 3, 7) AND is_honorarium = FALSE GROUP BY 1""")
def cross_filter_bitmaps(spark, sf_dir):
    """Rows of each sector under filters of three other dimensions, from bitmaps alone."""
    f = materialize(facts(spark, sf_dir, "region", "mes", "is_honorarium", "sector"), "filtered")
    maps = materialize(bitmaps.bitmaps(f, ["region", "mes", "is_honorarium", "sector"]), "bitmaps")
    return bitmaps.facet(maps, "sector", region=["ASIA", "EUROPE"], mes=[1, 2, 3, 7], is_honorarium=["false"])


# Names in several scripts, dealt by supplier.
_SCRIPTS = ("Điện lực Hà Nội", "ΔΉΜΟΣ ΑΘΗΝΑΊΩΝ", "Йошкар-Ола Ёлка", "Łódź Gżegżółka", "İZMİR Çeşme", "plain name")


@query(f"""n AS (SELECT transaction_id, list_extract([{", ".join(f"'{x}'" for x in _SCRIPTS)}], CAST(CAST(substr(nombre_beneficiario, -9) AS BIGINT) % {len(_SCRIPTS)} AS INTEGER) + 1) AS name FROM facts)
SELECT transaction_id FROM n WHERE lower(strip_accents(name)) LIKE '%ha noi%' OR lower(strip_accents(name)) LIKE '%αθηναιων%' OR lower(strip_accents(name)) LIKE '%елка%'""")
def search_every_script(spark, sf_dir):
    """Words of Latin, Greek and Cyrillic letters are found whatever their accents and case."""
    f = facts(spark, sf_dir, "transaction_id", "nombre_beneficiario")
    name = F.element_at(F.array(*map(F.lit, _SCRIPTS)), (F.expr("cast(right(nombre_beneficiario, 9) as bigint)") % len(_SCRIPTS)).cast("int") + 1)
    body = text.fold(name)
    return f.filter(search.text_condition(body, "Hà_Nội Αθηναίων ёлка".replace("_", ""), "any") | search.text_condition(body, "ha nội", "phrase")).select("transaction_id")


# --- detectors over made-up cases -----------------------------------------------------------------------------------

# Some lines occur twice under ids of their own, and in the last year every ninth supplier goes under a new identity.
_CASES = """fx AS (SELECT * REPLACE (CASE WHEN provider_id <> '' AND CAST(substr(provider_id, 5) AS BIGINT) % 9 = 0 AND periodo = (SELECT max(periodo) FROM facts0) THEN provider_id || '-N' ELSE provider_id END AS provider_id) FROM facts0),
facts AS (SELECT * FROM fx UNION ALL SELECT * REPLACE (transaction_id || '-2' AS transaction_id) FROM fx WHERE CAST(numero_documento AS BIGINT) % 40 = 7)"""


def _case_rows(spark, sf_dir, f: DataFrame) -> DataFrame:
    """The cases of ``f``, which is read once."""
    last = facts(spark, sf_dir, "periodo").agg(F.max("periodo")).first()[0]
    new = (F.col("provider_id") != "") & (F.substring("provider_id", 5, 20).try_cast("long") % 9 == 0) & (F.col("periodo") == F.lit(last).cast("long"))
    rows = f.withColumn("provider_id", F.when(new, F.concat("provider_id", F.lit("-N"))).otherwise(F.col("provider_id")))
    ends = F.when(F.col("numero_documento").cast("long") % 40 == 7, F.array(F.lit(""), F.lit("-2"))).otherwise(F.array(F.lit("")))
    return rows.withColumn("end_", F.explode(ends)).withColumn("transaction_id", F.concat("transaction_id", "end_")).drop("end_")


def _cases(spark, sf_dir, f: DataFrame | None = None) -> DataFrame:
    """The cases of ``f``, or of the rows that all detectors read, written."""
    return materialize(_case_rows(spark, sf_dir, f if f is not None else full_rows(spark, sf_dir)), "cases")


def _case_sql(body: str) -> str:
    """A query's SQL over the cases instead of the facts."""
    from ..sources.star import facts_sql

    return f"WITH facts0 AS ({facts_sql()}), {_CASES}, {body.strip()}"


def case_query(body: str):
    def add(f):
        registry.QUERIES[f.__name__], registry.ORACLE_SQL[f.__name__] = f, _case_sql(body)
        return f

    return add


@case_query(f"{_ALL} {_shown('sig')}")
def signals_of_all_kinds(spark, sf_dir):
    """All seven detectors with rows, duplicates and newcomers among them."""
    return _plain(signals.all_signals(_cases(spark, sf_dir, signal_rows(spark, sf_dir)), T))


def _broken_sql(body: str) -> str:
    """A query's SQL over the cases, with the amounts that :func:`_broken` spoils as missing."""
    whole = _case_sql(body)
    head, rest = whole.split("facts AS (SELECT * FROM fx", 1)
    cases, tail = rest.split("numero_documento AS BIGINT) % 40 = 7)", 1)
    spoilt = "CASE WHEN CAST(numero_documento AS BIGINT) % 11 < 3 THEN NULL ELSE monto_devengado END AS monto_devengado"
    return f"{head}facts1 AS (SELECT * FROM fx{cases}numero_documento AS BIGINT) % 40 = 7), facts AS (SELECT * REPLACE ({spoilt}) FROM facts1){tail}"


def _broken(f: DataFrame) -> DataFrame:
    """Three of eleven documents get an amount that is NaN or infinite."""
    k = F.col("numero_documento").cast("long") % 11
    amount = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, float("-inf")).otherwise(F.col("monto_devengado"))
    return materialize(f.withColumn("monto_devengado", amount), "broken")


def signals_with_broken_amounts(spark, sf_dir):
    """All seven detectors over facts with NaN and infinite amounts, which count as missing."""
    return _plain(signals.all_signals(_broken(_case_rows(spark, sf_dir, signal_rows(spark, sf_dir))), T))


registry.QUERIES["signals_with_broken_amounts"] = signals_with_broken_amounts
registry.ORACLE_SQL["signals_with_broken_amounts"] = _broken_sql(f"{_ALL} {_shown('sig')}")

_LINKS = """ln AS (SELECT 'PROVIDER' AS kind, provider_id AS id, 0.7 + (CAST(substr(provider_id, 5, 6) AS BIGINT) % 4) * 0.08 AS conf, CAST(CAST(substr(provider_id, 5, 6) AS BIGINT) % 3 * 40 AS DOUBLE) AS aml, CAST(substr(provider_id, 5, 6) AS BIGINT) % 5 AS n FROM (SELECT DISTINCT provider_id FROM facts WHERE is_provider AND provider_id <> '')
 UNION ALL SELECT 'ORGANIZATION', organization_id, 0.75 + (CAST(substr(organization_id, 5) AS BIGINT) % 3) * 0.1, CAST(CAST(substr(organization_id, 5) AS BIGINT) % 2 * 75 AS DOUBLE), 1 FROM (SELECT DISTINCT organization_id FROM facts)),
lp AS (SELECT id, conf, aml FROM ln WHERE kind = 'PROVIDER'), lo AS (SELECT id, conf, aml FROM ln WHERE kind = 'ORGANIZATION')"""
_WITH_LINKS = _PRIORITY.split("pr AS (")[0] + _LINKS + """,
pl AS (SELECT pc.*, CASE WHEN signal_type = 'YEAR_END_SPIKE' THEN coalesce(lo.conf, 0) ELSE greatest(coalesce(lp.conf, 0), coalesce(lo.conf, 0)) END AS conf,
       CASE WHEN signal_type = 'YEAR_END_SPIKE' THEN coalesce(lo.aml, 0) ELSE greatest(coalesce(lp.aml, 0), coalesce(lo.aml, 0)) END AS aml FROM pc LEFT JOIN lp ON lp.id = provider_id LEFT JOIN lo ON lo.id = organization_id),
pe AS (SELECT *, CASE WHEN conf >= 0.88 - 1e-9 THEN 15 WHEN conf >= 0.80 - 1e-9 THEN 10 ELSE 0 END + CASE WHEN aml >= 70 THEN 5 ELSE 0 END AS external_evidence_component FROM pl),
pr AS (SELECT *, least(100, severity_component + signal_component + cooccurrence_component + external_evidence_component + actionability_component + materiality_component) AS investigation_priority_score FROM pe)"""


def _linked(spark, sf_dir) -> DataFrame:
    f = _cases(spark, sf_dir)
    n = lambda c: F.substring(c, 5, 6).try_cast("long")
    people = f.filter("is_provider and provider_id <> ''").select("provider_id").distinct().withColumn("n", n("provider_id"))
    bodies = f.select("organization_id").distinct().withColumn("n", n("organization_id"))
    link = lambda rows, kind, key, conf, aml, found: rows.select(F.lit(kind).alias("local_entity_type"), F.col(key).alias("local_entity_id"), F.round(conf, 6).alias("confidence"), aml.cast("double").alias("cgr_max_aml_score"), found.cast("long").alias("cgr_finding_count"))
    k = F.col("n")
    links = link(people, "PROVIDER", "provider_id", 0.7 + (k % 4) * 0.08, k % 3 * 40, k % 5).unionByName(link(bodies, "ORGANIZATION", "organization_id", 0.75 + (k % 3) * 0.1, k % 2 * 75, F.lit(1)))
    return priority.prioritize(materialize(signals.all_signals(f, T), "signals"), f, links)


_LINK_SHOWN = "signal_id, investigation_priority_score, external_evidence_component, CASE WHEN investigation_priority_score >= 70 THEN 'P1' WHEN investigation_priority_score >= 50 THEN 'P2' ELSE 'P3' END AS priority_tier"


@case_query(f"{_WITH_LINKS} SELECT {_LINK_SHOWN} FROM pr")
def priority_with_evidence(spark, sf_dir):
    return _linked(spark, sf_dir).select("signal_id", "investigation_priority_score", "external_evidence_component", "priority_tier")


@case_query(f"""{_WITH_LINKS} SELECT signal_id, signal_type, investigation_priority_score FROM pr ORDER BY investigation_priority_score DESC, CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, round(coalesce(deviation, 0), 6) DESC, signal_id LIMIT 8""")
def fusion_preview(spark, sf_dir):
    ranked = _linked(spark, sf_dir).withColumn("deviation", F.round("deviation", 6))
    return dashboard.preview(priority.queue(ranked)).select("signal_id", "signal_type", "investigation_priority_score")


@case_query(f"""s AS (SELECT periodo, mes, organization_id, recipient_id, numero_documento, transaction_id, row_number() OVER (PARTITION BY periodo, mes, organization_id, recipient_id, numero_documento ORDER BY transaction_id) AS rn FROM facts)
SELECT periodo, mes, organization_id, recipient_id, numero_documento, string_agg(transaction_id, ' ' ORDER BY transaction_id) AS ids FROM s WHERE rn <= 50 GROUP BY ALL HAVING count(*) > 1""")
def duplicate_supporting_ids(spark, sf_dir):
    f = _cases(spark, sf_dir, facts(spark, sf_dir, *detect("numero_documento")))
    keys = ["periodo", "mes", "organization_id", "recipient_id", "numero_documento"]
    return signals.supporting_transactions(f, keys).select(*keys, F.array_join("supporting_transactions", " ").alias("ids"))


@case_query(f"{_DUPLICATE.format(keys=_DUP_KEYS)} {_shown('s_duplicate')}")
def exact_duplicates_default_keys(spark, sf_dir):
    return _plain(signals.exact_duplicates(_cases(spark, sf_dir, facts(spark, sf_dir, *detect("numero_documento folio fecha_documento")))))


@case_query(f"{_MARKS} SELECT scope, entity_id, organization_id, year, signal_type, severity, round(metric, 6) AS metric, round(hhi, 6) AS hhi FROM mk")
def multiyear_marks_of_all_kinds(spark, sf_dir):
    columns = "organization_id provider_id is_provider periodo mes nombre_capitulo nombre_beneficiario monto_devengado numero_documento transaction_id"
    f = _cases(spark, sf_dir, facts(spark, sf_dir, *columns.split()))
    from .registry import _PATTERNS

    edges = materialize(multiyear.private_edges(multiyear.relations(f), multiyear.service_names(multiyear.service_years(f)), patterns=_PATTERNS), "relations")
    return rounded(multiyear.marks(f, edges, _MARK_RULES), "metric", "hhi")


# --- several years: the core, the reference organisation, names of services ------------------------------------------


@query(f"""{_MARKS}, sz AS (SELECT provider_id, round(abs(sum(amount_clp)), 2) AS size FROM ed GROUP BY 1), pl AS (SELECT provider_id, row_number() OVER (ORDER BY size DESC, provider_id) AS place FROM sz ORDER BY size DESC, provider_id LIMIT 40),
se AS (SELECT provider_id, min(place) AS place FROM (SELECT * FROM pl UNION ALL SELECT entity_id, 0 FROM mk WHERE scope = 'provider' UNION ALL SELECT provider_id, 0 FROM ed WHERE organization_name = 'NATION_7') GROUP BY 1)
SELECT ed.* FROM ed JOIN se USING (provider_id) WHERE place <= 15""")
def multiyear_flows_core(spark, sf_dir):
    """So many flows that only those of the core, the marked and the reference organisation's providers are kept."""
    f, edges = _written_edges(spark, sf_dir)
    return multiyear.publish(edges, multiyear.marks(f, edges, _MARK_RULES), max_seeds=40, core_seeds=15, max_flows=10, reference="NATION 7")


@query("""x AS (SELECT organization_id, provider_id, periodo, nombre_capitulo, CASE WHEN CAST(substr(provider_id, 5) AS BIGINT) % 4 = 0 THEN ' nation 3' ELSE nombre_beneficiario END AS nombre_beneficiario, monto_devengado FROM facts WHERE is_provider AND provider_id <> ''),
r AS (SELECT organization_id, provider_id, periodo AS year, max(nombre_beneficiario) AS name, CAST(sum(CAST(monto_devengado AS DECIMAL(18,2))) AS DOUBLE) AS amount_clp FROM x GROUP BY 1, 2, 3)
SELECT organization_id, provider_id, year, amount_clp FROM r WHERE trim(upper(name)) <> 'NATION 3' AND amount_clp <> 0""")
def service_name_exclusion(spark, sf_dir):
    """Counterparties that carry the name of a service are left out by the anti-join."""
    f = facts(spark, sf_dir, *"organization_id provider_id is_provider periodo nombre_capitulo nombre_beneficiario monto_devengado".split())
    odd = F.substring("provider_id", 5, 6).try_cast("long") % 4 == 0
    f = f.withColumn("nombre_beneficiario", F.when(odd, " nation 3").otherwise(F.col("nombre_beneficiario")))
    kept = multiyear.private_edges(multiyear.relations(f), multiyear.service_names(multiyear.service_years(f)), patterns=("NO SUCH PATTERN",))
    return kept.select("organization_id", "provider_id", "year", "amount_clp")


# --- evidence -------------------------------------------------------------------------------------------------------

_EVIDENCE = """p AS (SELECT provider_id AS local_id, min(nombre_beneficiario) AS name, min(region) AS region FROM facts WHERE is_provider AND coalesce(provider_id, '') <> '' GROUP BY 1),
k AS (SELECT *, CAST(substr(local_id, 5) AS BIGINT) AS n FROM p), e AS (SELECT *, 'EXT-' || CAST(n AS VARCHAR) AS external_id, CASE n % 3 WHEN 0 THEN region WHEN 1 THEN '' ELSE 'NOWHERE' END AS ext_region, 0.6 + (n % 5) * 0.1 AS c, CAST(n % 50 AS VARCHAR) AS document FROM k),
fi AS (SELECT CAST(user_id AS VARCHAR) AS document, count(*) AS fc, max(value) AS aml FROM events GROUP BY 1),
l AS (SELECT e.*, CASE WHEN ext_region <> '' THEN ext_region = region END AS agrees, coalesce(fc, 0) AS fc, aml FROM e LEFT JOIN fi USING (document)),
lk AS (SELECT 'EVL-PA-CGR-' || upper(substr(sha256(concat_ws('|', 'PROVIDER', local_id, external_id, document, 'EXACT_NORMALIZED_NAME')), 1, 24)) AS evidence_link_id, local_id AS local_entity_id, external_id AS external_entity_id, agrees AS region_agreement,
       round(least(0.93, (0.92 + CASE WHEN agrees THEN 0.03 WHEN NOT agrees THEN -0.07 ELSE 0 END) * (0.75 + 0.25 * c)), 6) AS confidence, fc AS cgr_finding_count, round(aml, 6) AS cgr_max_aml_score FROM l)"""


def _evidence_links(spark, sf_dir) -> DataFrame:
    f = facts(spark, sf_dir, "provider_id", "is_provider", "nombre_beneficiario", "region")
    local = evidence.local_providers(f)
    n = F.substring("local_id", 5, 6).cast("long")
    theirs = local.select(
        F.concat(F.lit("EXT-"), n.cast("string")).alias("external_id"), F.lower("name").alias("name"), F.lit("").alias("normalized_name"),
        F.when(n % 3 == 0, F.col("region")).when(n % 3 == 1, "").otherwise("NOWHERE").alias("region"), (0.6 + (n % 5) * 0.1).alias("confidence"), (n % 50).cast("string").alias("source_document_id"),
    )
    findings = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("document_id"), F.col("value").alias("aml_score"), F.lit("LOW").alias("severity"), F.col("event_type").alias("risk_family"), F.lit("u").alias("source_url"))
    links = evidence.make_links(evidence.best_matches(local, theirs), findings, "PROVIDER")
    return links.withColumn("cgr_max_aml_score", F.round("cgr_max_aml_score", 6))


_LINK_COLUMNS = "evidence_link_id, local_entity_id, external_entity_id, region_agreement, confidence, cgr_finding_count, cgr_max_aml_score"


@query(f"{_EVIDENCE} SELECT {_LINK_COLUMNS} FROM lk")
def evidence_links(spark, sf_dir):
    return _evidence_links(spark, sf_dir).select(*_LINK_COLUMNS.split(", "))


@query(f"{_EVIDENCE} SELECT {_LINK_COLUMNS} FROM lk ORDER BY confidence DESC, coalesce(cgr_max_aml_score, 0) DESC, cgr_finding_count DESC, evidence_link_id LIMIT 50")
def evidence_links_topk(spark, sf_dir):
    return evidence.top_links(_evidence_links(spark, sf_dir)).select(*_LINK_COLUMNS.split(", "))


@query(f"{_EVIDENCE} SELECT count(*) AS links, count(*) AS provider_links, CAST(0 AS BIGINT) AS organization_links, count(*) FILTER (WHERE cgr_finding_count > 0) AS links_with_findings, count(*) FILTER (WHERE confidence >= 0.88) AS high_confidence_links FROM lk")
def evidence_summary(spark, sf_dir):
    return evidence.summarize_links(_evidence_links(spark, sf_dir))


# --- registry -------------------------------------------------------------------------------------------------------

_REG = """h AS (SELECT CAST(o_custkey AS VARCHAR) AS rut, year(o_orderdate) AS y, CAST(count(*) AS INTEGER) + 6 AS band, CAST(sum(o_orderkey) % 30 AS INTEGER) AS w, max(o_orderkey) % 3 AS eq, max(o_orderkey) % 6 = 0 AS ended FROM orders GROUP BY 1, 2),
z AS (SELECT *, row_number() OVER (PARTITION BY rut ORDER BY y DESC) AS rn FROM h), en AS (SELECT rut, bool_or(ended) AS ended FROM h GROUP BY 1),
nm AS (SELECT CAST(c_custkey AS VARCHAR) AS rut, c_name AS legal_name, CASE WHEN c_custkey % 2 = 0 THEN 'ACTIVE_AS_PUBLISHED' ELSE 'ENDED' END AS tax_status, CAST(1990 + c_custkey % 9 AS VARCHAR) || '-01-01' AS start_date, c_custkey % 8 AS na FROM customer)"""


def _registry_tables(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    history = o.groupBy(F.col("o_custkey").cast("string").alias("rut"), F.year("o_orderdate").alias("commercial_year")).agg(
        (F.count("*") + 6).alias("sales_band_code"), (F.sum("o_orderkey") % 30).alias("workers"), F.when(F.max("o_orderkey") % 3 == 0, "nan").when(F.max("o_orderkey") % 3 == 1, "B").otherwise("").alias("negative_equity_band"),
        F.when(F.max("o_orderkey") % 6 == 0, "2020-01-01").otherwise("").alias("termination_date"),
    ).withColumns({"main_region": F.lit("R"), "main_activity": F.lit("A")})
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    names = c.select(k.cast("string").alias("rut"), F.col("c_name").alias("legal_name"), F.when(k % 2 == 0, "ACTIVE_AS_PUBLISHED").otherwise("ENDED").alias("current_status"), F.concat((1990 + k % 9).cast("string"), F.lit("-01-01")).alias("activity_start_date"))
    codes = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("x")  # ten rows, of which some repeat an activity and some are left out
    acts = c.select(k.alias("k"), codes).filter("x < k % 8 or x = 9 and k % 8 > 0").select(F.col("k").cast("string").alias("rut"), F.when(F.col("x") == 9, 0).otherwise(F.col("x")).cast("string").alias("activity_code"), F.lit("n").alias("activity_name"), F.lit("s").alias("activity_status"), F.lit("c").alias("activity_category"))
    return history, names, acts


@query(f"""WITH {_REG}
SELECT rut, 'RECENT_START_HIGH_SALES' AS mark, 'MEDIUM' AS severity, CAST(y AS VARCHAR) AS year FROM z JOIN nm USING (rut) WHERE rn = 1 AND band >= 10 AND y - CAST(substr(start_date, 1, 4) AS INTEGER) BETWEEN 0 AND 2
UNION ALL SELECT rut, 'ACTIVITY_BREADTH', 'LOW', 'CURRENT' FROM nm WHERE na >= 6
UNION ALL SELECT rut, 'REACTIVATION_PATTERN', 'LOW', 'CURRENT' FROM nm JOIN en USING (rut) WHERE tax_status = 'ACTIVE_AS_PUBLISHED' AND ended
UNION ALL SELECT rut, 'HIGH_SALES_NEGATIVE_EQUITY', 'MEDIUM', CAST(y AS VARCHAR) FROM z WHERE rn = 1 AND band >= 10 AND eq = 1""")
def registry_marks_of_names_and_activities(spark, sf_dir):
    marks = enrich.registry_marks(*_registry_tables(spark, sf_dir))
    return marks.filter(F.col("mark").isin("RECENT_START_HIGH_SALES", "ACTIVITY_BREADTH", "REACTIVATION_PATTERN", "HIGH_SALES_NEGATIVE_EQUITY"))


@query(f"""WITH {_REG}, y AS (SELECT rut, count(*) AS years, min(y) AS first_year, max(y) AS last_year FROM h GROUP BY 1)
SELECT rut, 'ENT-RUT-' || rut AS entity_id, legal_name, tax_status, start_date, CAST(na AS INTEGER) AS n_activities, CAST(coalesce(years, 0) AS INTEGER) AS n_years, first_year, last_year FROM nm LEFT JOIN y USING (rut)""")
def registry_entities(spark, sf_dir):
    rows = enrich.registry_entities(*_registry_tables(spark, sf_dir))
    years = F.transform("history", lambda h: h["commercial_year"])
    return rows.select("rut", "entity_id", "legal_name", "tax_status", "start_date", F.size("activities").alias("n_activities"), F.size("history").alias("n_years"), F.array_min(years).alias("first_year"), F.array_max(years).alias("last_year"))


# --- explorer -------------------------------------------------------------------------------------------------------


@query(f"""{_MARKS}, u AS (SELECT entity_id, signal_type, year, 'budget' AS source FROM mk WHERE scope = 'provider' UNION SELECT entity_id, signal_type, year, 'registry' FROM mk WHERE scope = 'provider' AND year >= 1997)
SELECT source, signal_type, count(*) AS marks FROM u GROUP BY 1, 2""")
def marks_united(spark, sf_dir):
    f, edges = _written_edges(spark, sf_dir)
    mine = multiyear.marks(f, edges, _MARK_RULES).filter("scope = 'provider'").select("entity_id", "signal_type", "year")
    budget, registry = mine.withColumn("source", F.lit("budget")), mine.filter("year >= 1997").withColumn("source", F.lit("registry"))
    return explore.union_marks(budget, registry, budget).groupBy("source", "signal_type").agg(F.count("*").alias("marks"))


@query(f"""{_MARKS} SELECT organization_id, provider_id, year, amount_clp FROM ed WHERE provider_id IN (SELECT entity_id FROM mk WHERE signal_type = 'PROVIDER_CONCENTRATION')""")
def edges_with_mark(spark, sf_dir):
    f, edges = _written_edges(spark, sf_dir)
    return explore.with_mark(edges, multiyear.marks(f, edges, _MARK_RULES), "PROVIDER_CONCENTRATION").select("organization_id", "provider_id", "year", "amount_clp")


@query("""p AS (SELECT provider_id, strftime(fecha_pago, '%Y-%m') AS period, CAST(sum(CAST(monto_pago AS DECIMAL(18,2))) AS DOUBLE) AS a FROM facts WHERE is_provider AND provider_id <> '' AND fecha_pago IS NOT NULL AND coalesce(monto_pago, 0) <> 0 AND CAST(substr(provider_id, 5) AS BIGINT) % 2 = 0 GROUP BY 1, 2),
c AS (SELECT provider_id, printf('%04d-%02d', periodo, mes) AS period, CAST(sum(CAST(monto_devengado AS DECIMAL(18,2))) AS DOUBLE) AS a FROM facts WHERE is_provider AND provider_id <> '' GROUP BY 1, 2 HAVING sum(CAST(monto_devengado AS DECIMAL(18,2))) <> 0)
SELECT provider_id, period, a AS amount_clp, 'payment' AS basis FROM p UNION ALL SELECT provider_id, period, a, 'accrual' FROM c WHERE provider_id NOT IN (SELECT provider_id FROM p)""")
def months_with_fallback(spark, sf_dir):
    f = facts(spark, sf_dir, "provider_id", "is_provider", "fecha_pago", "monto_pago", "periodo", "mes", "monto_devengado")
    paid = multiyear.payment_months(f).filter(F.substring("provider_id", 5, 6).cast("long") % 2 == 0)
    return explore.months_with_fallback(paid, multiyear.accrual_months(f)).select("provider_id", "period", "amount_clp", "basis")


@query("""c AS (SELECT provider_id, periodo AS year, CAST(sum(CAST(monto_devengado AS DECIMAL(18,2))) AS DOUBLE) AS a FROM facts WHERE is_provider AND provider_id <> '' GROUP BY 1, 2) SELECT provider_id, CAST(year AS INTEGER) AS year, a AS amount_clp FROM c""")
def years_from_months(spark, sf_dir):
    f = facts(spark, sf_dir, "provider_id", "is_provider", "periodo", "mes", "monto_devengado")
    return explore.yearly_from_months(multiyear.accrual_months(f), "provider_id")


@query(f"""{_EDGES}, e AS (SELECT organization_id, provider_id, round(sum(amount_clp), 2) AS amount_clp FROM ed GROUP BY 1, 2), s AS (SELECT organization_id FROM e GROUP BY 1 ORDER BY round(sum(amount_clp), 2) DESC, organization_id LIMIT 5),
m AS (SELECT * FROM e WHERE organization_id IN (SELECT organization_id FROM s)), p AS (SELECT provider_id FROM m GROUP BY 1 ORDER BY round(sum(amount_clp), 2) DESC, provider_id LIMIT 10)
SELECT * FROM m WHERE provider_id IN (SELECT provider_id FROM p) ORDER BY amount_clp DESC, organization_id, provider_id LIMIT 24""")
def flows_nested_topk(spark, sf_dir):
    edges = _edges(spark, sf_dir)[1].groupBy("organization_id", "provider_id").agg(total("amount_clp").alias("amount_clp"))
    return explore.nested_top(materialize(edges, "flows"))


@query("""x AS (SELECT count(*) AS rows, count(DISTINCT entity_id) AS entities, count(DISTINCT tipo_documento) AS document_type_labels FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY fecha_documento DESC, periodo DESC, mes DESC, transaction_id DESC) AS rn
FROM facts WHERE is_provider AND NOT is_intra_state AND NOT is_person AND fecha_documento IS NOT NULL) WHERE rn = 1) SELECT * FROM x""")
def document_statistics(spark, sf_dir):
    columns = "entity_id rut_beneficiario nombre_beneficiario tipo_documento numero_documento folio fecha_documento transaction_id transaction_fingerprint periodo mes source_file source_row_number is_provider is_intra_state is_person"
    return documents.document_stats(documents.latest_documents(facts(spark, sf_dir, *columns.split()))).select("rows", "entities", "document_type_labels")


# --- functions ------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CAST(nullif(regexp_replace('$ ' || CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) || '.-', '[^0-9]', '', 'g'), '') AS BIGINT) AS digits,
CASE WHEN o_orderkey % 3 = 0 THEN '{"a": null, "b": "NaN Infinity", "c": [null, 1]}' ELSE '{"a": 1.5}' END AS strict, left(o_orderpriority, 4) || '…' AS shortened FROM orders WHERE length(o_orderpriority) > 5
UNION ALL SELECT o_orderkey, CAST(nullif(regexp_replace('$ ' || CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) || '.-', '[^0-9]', '', 'g'), '') AS BIGINT), CASE WHEN o_orderkey % 3 = 0 THEN '{"a": null, "b": "NaN Infinity", "c": [null, 1]}' ELSE '{"a": 1.5}' END, o_orderpriority FROM orders WHERE length(o_orderpriority) <= 5""")
def text_helpers(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("shown", F.concat(F.lit("$ "), F.rint("o_totalprice").cast("long").cast("string"), F.lit(".-")))
    raw = F.when(F.col("o_orderkey") % 3 == 0, '{"a": NaN, "b": "NaN Infinity", "c": [-Infinity, 1]}').otherwise('{"a": 1.5}')
    return o.select("o_orderkey", text.money_int("shown").alias("digits"), text.strict_json(raw).alias("strict"), text.shorten("o_orderpriority", 5).alias("shortened"))


@query("""WITH v AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN s_suppkey * 1e9 WHEN 2 THEN -(s_suppkey * 1e6) WHEN 3 THEN s_suppkey * 1e3 ELSE CAST(s_suppkey AS DOUBLE) END AS x FROM supplier)
SELECT s_suppkey, CASE WHEN x IS NULL THEN '-' WHEN abs(x) >= 1e9 THEN format('{:,.1f}', x / 1e9) || ' B' WHEN abs(x) >= 1e6 THEN format('{:,.1f}', x / 1e6) || ' M' WHEN abs(x) >= 1e3 THEN format('{:,.1f}', x / 1e3) || ' K' ELSE format('{:,.0f}', x) END AS shown FROM v""")
def amounts_for_people(spark, sf_dir):
    k = F.col("s_suppkey").cast("double")
    x = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, k * 1e9).when(k % 5 == 2, -(k * 1e6)).when(k % 5 == 3, k * 1e3).otherwise(k)
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", text.money_short(x).alias("shown"))


@query("""WITH p AS (SELECT n_nationkey, n_name AS a, CASE n_nationkey % 3 WHEN 0 THEN 'Region of ' || replace(n_name, '_', ' ') WHEN 1 THEN '' ELSE 'elsewhere' END AS b FROM nation)
SELECT n_nationkey, CASE WHEN b = '' THEN NULL ELSE n_nationkey % 3 = 0 END AS agrees FROM p""")
def region_agreement(spark, sf_dir):
    k = F.col("n_nationkey")
    other = F.when(k % 3 == 0, F.concat(F.lit("Region of "), F.replace("n_name", F.lit("_"), F.lit(" ")))).when(k % 3 == 1, "").otherwise("elsewhere")
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", text.region_agrees(F.col("n_name"), other).alias("agrees"))
