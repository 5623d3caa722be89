r"""URL filters: rules first, then the standing of the host in the link graph.

A rule is a host and a path; it fits its host and all subdomains if the path of
the url starts with the rule's, and the longest fitting rule decides.  What no
rule fits is judged by its host.

Graph.  A host links to another if a page of it has an ``<a href>`` there; the
weight is the number of its pages that have one.  Links within a host and links
without a host of their own (relative ones) are no edges.

Seeds.  A host of whose pages rules allow at least half is a trusted seed, one
of whose pages they block at least half a blocked one, with that share as weight.

Propagation.  Trust is the personalised PageRank of the trusted seeds along the
links; distrust is that of the blocked seeds against them: who links to a
blocked host is distrusted.  With damping d,

    score = (1 - d) * seed + d * sum over edges of share of the edge * score

A host is blocked if its distrust exceeds its trust and ``threshold`` of what a
host has all of whose pages are blocked and that links nowhere; all others
are allowed, those without any link or rule too.

Scale.  Scores are whole numbers, rounded down at each edge, so sums don't
depend on the order of rows and executors can come and go.  Hosts, edges and
seeds are tables; a round is one join and one sum over both directions at once,
written to the shared folder, and rounds end early when no score changes.  The
html is read once, by the pass that counts edges map-side; the last pass reads
keys and urls and joins the hosts' scores, which Spark broadcasts only if they
are small.

Defined results
    null url or none with "://": host and path empty, no rule, allowed, no part
    in the graph.  Null or broken html: no links.  Hosts are taken as written
    (ports, user parts and trailing dots included), A-Z lower-cased.  Of equally
    long rules the one with the longer host decides, then the first given.
    Repeated rows and rows without a key are judged one by one and counted as
    pages; a very long page or url is one.  Extra columns, whatever their names, are ignored;
    an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, materialize


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(text: str, verdict: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(host, slash + path, verdict)


# The rules that op11 applies.
RULES = (rule("org/", "allow"), rule("example.org/es/", "block"), rule("example.org/en/1", "block"), rule("com/fr/", "allow"), rule("com/de/", "block"))

#: Value of a whole seed, and of the seeds of all hosts together at most: products of a score and a share stay below 2**63.
UNIT, MASS, SHARE = 1 << 20, 1 << 42, 1 << 20
LINK = r"""<[aA][ \t\n\r\f](?:[^<>]*?[ \t\n\r\f])?[hH][rR][eE][fF][ \t\n\r\f]*=[ \t\n\r\f]*("[^"]*"|'[^']*'|[^ \t\n\r\f"'<>]+)"""
LINK_HOST = r"""^["']?[ \t\n\r\f]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"' \t\n\r\f]*)"""


@dataclass(frozen=True)
class Params:
    #: Damping in hundredths.
    damping: int = 85
    rounds: int = 20
    #: Hundredths of the distrust of a host that is all blocked.
    threshold: int = 1


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    after = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, "^([^/?#]*)", 1)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the rule that decides, both null if none fits."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _urls(pages: DataFrame, rules: tuple[Rule, ...], *columns: Column) -> DataFrame:
    host, path = host_and_path(F.col("url_"))
    named = pages.select(*columns, F.col("`url`").alias("url_")).withColumns({"host": host, "path": path}).drop("url_")
    text, verdict = ruled(F.col("host"), F.col("path"), rules)
    return named.withColumns({"rule": text, "ruled": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, pages): how many pages of a host link to another."""
    found = F.transform(F.regexp_extract_all("html_", F.lit(LINK), F.lit(1)), lambda x: lower_ascii(F.regexp_extract(x, LINK_HOST, 1)))
    host, _ = host_and_path(F.col("url_"))
    linked = pages.select(F.col("`url`").alias("url_"), F.col("`html`").alias("html_")).select(host.alias("source"), F.explode(F.array_distinct(found)).alias("target"))
    return linked.filter("source <> '' and target <> '' and source <> target").groupBy("source", "target").agg(F.count("*").alias("pages"))


def host_scores(pages: DataFrame, rules: tuple[Rule, ...] = RULES, params: Params = Params()) -> DataFrame:
    """(host, trust, distrust, unit) of every host that has some; ``unit`` is the value of a whole seed."""
    d = params.damping
    with Scratch(pages.sparkSession) as scratch:
        seen = _urls(pages, rules).filter("host <> ''").groupBy("host").agg(
            F.count("*").alias("n"), F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
        )
        hosts = scratch.put(seen, "hosts")
        links = scratch.put(host_edges(pages), "links")
        unit = min(UNIT, MASS // max(1, hosts.count()))
        share = lambda of, to, by, kind: links.join(links.groupBy(by).agg(F.sum("pages").alias("all")), by).select(
            F.col(of).alias("from"), F.col(to).alias("to"), F.lit(kind).alias("kind"), F.expr(f"pages * {SHARE} div all").alias("share")
        )
        edges = scratch.put(share("source", "target", "source", 0).unionByName(share("target", "source", "target", 1)).filter("share > 0"), "edges")
        seed = lambda count, kind: hosts.select("host", "n", count, F.lit(kind).alias("kind"), F.expr(f"{unit} * {count} div n").alias("seed")).filter(f"seed > 0 and 2 * {count} >= n").drop("n", count)
        seeds = scratch.put(seed("allowed", 0).unionByName(seed("blocked", 1)), "seeds")
        own = seeds.select("host", "kind", (F.col("seed") * (100 - d)).alias("part"))
        summed = lambda parts: parts.groupBy("host", "kind").agg(F.expr("sum(part) div 100").alias("score")).filter("score > 0")
        now, mark = scratch.put(summed(own), "scores"), None
        for _ in range(params.rounds):
            came = edges.join(now, (F.col("from") == F.col("host")) & (edges["kind"] == now["kind"])).select(
                F.col("to").alias("host"), edges["kind"], (F.expr(f"score * share div {SHARE}") * d).alias("part")
            )
            now = scratch.put(summed(own.unionByName(came)), "scores")
            seen_now = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("host", "kind", "score").cast("decimal(38,0)"))).first())
            if seen_now == mark:
                break
            mark = seen_now
        of = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0).cast("long"))
        return materialize(now.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust")).withColumn("unit", F.lit(unit).cast("long")), "host_scores")


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, params: Params = Params(), key: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every row of ``pages`` (columns ``url`` and ``html``)."""
    scores = host_scores(pages, rules, params).withColumnRenamed("host", "host_")
    urls = _urls(pages, rules, F.col(f"`{key}`").alias("page_id"))
    joined = urls.join(scores, F.col("host") == F.col("host_"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0).cast("long")), F.coalesce("distrust", F.lit(0).cast("long"))
    bar = F.expr(f"unit * {100 - params.damping} div 100") * params.threshold
    blocked = (distrust > trust) & (distrust * 100 > bar)
    verdict = F.coalesce("ruled", F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def sql(rules: tuple[Rule, ...] = RULES, params: Params = Params()) -> str:
    """DuckDB form of what op11 returns; rounds that change nothing are run all the same."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    d = params.damping
    lower = lambda x: f"translate({x}, '{ascii_uppercase}', '{ascii_lowercase}')"
    best = sorted(rules, key=lambda r: (-len(r.text), -len(r.host)))
    fits = [f"WHEN (host = {quoted(r.host)} OR ends_with(host, {quoted('.' + r.host)})) AND starts_with(path, {quoted(r.path)}) THEN" for r in best]
    case = lambda of: "CASE " + " ".join(f"{f} {quoted(of(r))}" for f, r in zip(fits, best)) + " END"
    steps = []
    for k in range(1, params.rounds + 1):
        steps.append(f"""s{k} AS MATERIALIZED (
  SELECT host, kind, CAST(sum(part) AS BIGINT) // 100 AS score FROM (
    SELECT host, kind, part FROM own UNION ALL
    SELECT e.dst, e.kind, (s.score * e.share // {SHARE}) * {d} FROM edges e JOIN s{k - 1} s ON e.src = s.host AND e.kind = s.kind
  ) GROUP BY host, kind HAVING score > 0)""")
    return f"""
WITH cut AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, html, coalesce({lower("regexp_extract(rest, '^([^/?#]*)', 1)")}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), judged AS MATERIALIZED (
  SELECT *, {case(lambda r: r.text)} AS rule, {case(lambda r: r.verdict)} AS ruled FROM named
), hosts AS MATERIALIZED (
  SELECT host, count(*) AS n, count(*) FILTER (ruled = 'allow') AS allowed, count(*) FILTER (ruled = 'block') AS blocked FROM judged WHERE host <> '' GROUP BY host
), unit AS (
  SELECT least({UNIT}, {MASS} // greatest(1, count(*))) AS unit FROM hosts
), hits AS (
  SELECT page_id, host AS source, list_distinct(list_transform(regexp_extract_all(html, {quoted(LINK)}, 1), lambda x: {lower("regexp_extract(x, " + quoted(LINK_HOST) + ", 1)")})) AS targets FROM judged
), links AS MATERIALIZED (
  SELECT source, target, count(*) AS pages FROM (SELECT source, unnest(targets) AS target FROM hits) WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL
), edges AS MATERIALIZED (
  SELECT * FROM (
    SELECT source AS src, target AS dst, 0 AS kind, CAST(pages * {SHARE} // sum(pages) OVER (PARTITION BY source) AS BIGINT) AS share FROM links UNION ALL
    SELECT target, source, 1, CAST(pages * {SHARE} // sum(pages) OVER (PARTITION BY target) AS BIGINT) FROM links
  ) WHERE share > 0
), own AS MATERIALIZED (
  SELECT host, kind, seed * {100 - d} AS part FROM (
    SELECT host, 0 AS kind, unit * allowed // n AS seed FROM hosts, unit WHERE 2 * allowed >= n UNION ALL
    SELECT host, 1, unit * blocked // n FROM hosts, unit WHERE 2 * blocked >= n
  ) WHERE seed > 0
), s0 AS MATERIALIZED (
  SELECT host, kind, CAST(sum(part) AS BIGINT) // 100 AS score FROM own GROUP BY host, kind HAVING score > 0
), {", ".join(steps)}, scores AS (
  SELECT host, coalesce(max(score) FILTER (kind = 0), 0) AS trust, coalesce(max(score) FILTER (kind = 1), 0) AS distrust FROM s{params.rounds} GROUP BY host
)
SELECT page_id, j.host, path, rule, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust,
       coalesce(ruled, CASE WHEN distrust > trust AND distrust * 100 > (unit * {100 - d} // 100) * {params.threshold} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j CROSS JOIN unit LEFT JOIN scores s ON j.host = s.host
"""
