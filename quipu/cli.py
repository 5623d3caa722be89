"""Command line: probe, run, update, search, years, fts, profile."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators import fulltext, search, signals
from .plans import run
from .plans.years import Years
from .scratch import materialize
from .sources import delimited, remote, sinks, yearly
from .sources.facts import parse_years
from .sources.profile import source_profile


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quipu")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="raw files to facts, signals, queue and views")
    r.add_argument("files", nargs="+")
    r.add_argument("--out", required=True)
    r.add_argument("--thresholds")
    r.add_argument("--register")
    r.add_argument("--skip-index", action="store_true")
    for name in ("search", "years"):
        s = sub.add_parser(name, help="structured and text search over facts")
        s.add_argument("--facts", required=True)
        s.add_argument("--filters", default="{}", help="JSON object of search parameters")
        if name == "years":
            s.add_argument("--years", required=True)
            s.add_argument("--out", required=True)
            s.add_argument("--summary-scope", default="limited")
            s.add_argument("--sources", help="JSON lines as probe prints them")
    b = sub.add_parser("probe", help="which years have a source, and which of them have facts")
    b.add_argument("--years", required=True)
    b.add_argument("--address", required=True, help="where a year's file is expected, with {year}")
    b.add_argument("--page", action="append", default=[], help="a saved web page that links files, as ADDRESS=FILE")
    b.add_argument("--facts")
    u = sub.add_parser("update", help="fetch yearly files and bring the kept years up to date")
    u.add_argument("--years", required=True)
    u.add_argument("--address", required=True, help="where a year's file is expected, with {year}")
    u.add_argument("--pages", default="", help="saved web pages that link files, parted by ;")
    u.add_argument("--out", required=True, help="a folder that all executors share, as an address")
    f = sub.add_parser("fts", help="ranked full-text search")
    f.add_argument("query")
    f.add_argument("--out", required=True)
    f.add_argument("--limit", type=int, default=50)
    g = sub.add_parser("profile", help="what a raw file holds")
    g.add_argument("file")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quipu").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "run":
        rules = signals.Thresholds.from_nested(remote.load_thresholds(a.thresholds)) if a.thresholds else signals.Thresholds()
        print(json.dumps(run.analyze(run.ingest(spark, a.files, a.out), a.out, rules, a.register, not a.skip_index), indent=2))
    elif a.command == "search":
        for line in search.search(delimited.read_parquet(spark, a.facts), **json.loads(a.filters)).toJSON().toLocalIterator():
            print(line)
    elif a.command == "years":
        rows, years, filters = delimited.read_parquet(spark, a.facts), parse_years(a.years), json.loads(a.filters)
        parts = search.search_years(rows, years, a.summary_scope, **filters)
        sources = delimited.read_json_lines(spark, a.sources, search.SOURCES) if a.sources else spark.createDataFrame([], search.SOURCES)
        parts["states"] = search.year_states(rows, years, sources, parts["rows"])
        for name, part in parts.items():
            sinks.write_csv(part, f"{a.out}/{name}_csv")
            sinks.write_json(part, f"{a.out}/{name}_json")
        found = {n: spark.read.csv(f"{a.out}/{n}_csv", header=True).count() for n in parts}
        made = spark.createDataFrame([(json.dumps({"years": years, "filters": filters, "summary_scope": a.summary_scope, "rows": found}, ensure_ascii=False),)], "value string")
        made.coalesce(1).write.mode("overwrite").text(f"{a.out}/query_metadata")
    elif a.command == "probe":
        pages = {}
        for page in a.page:
            address, _, file = page.partition("=")
            with open(file, encoding="utf-8") as f:
                pages[address] = f.read()
        years = parse_years(a.years)
        records = remote.discover(pages, years, lambda year: a.address.format(year=year))
        have = {r["periodo"] for r in delimited.read_parquet(spark, a.facts).select("periodo").distinct().collect()} if a.facts else set()  # years
        for r in records:
            print(json.dumps(r | {"periodo": r["year"], "source_url": r["url"], "source_status": r["status"], "has_facts": r["year"] in have}, ensure_ascii=False))
    elif a.command == "update":
        yearly.register(spark)
        options = {"years": a.years, "address": a.address, "pages": a.pages, "folder": f"{a.out}/fetched"}
        states = materialize(spark.read.format("yearly_source").options(**options).load(), "states")
        kept = Years(spark, f"{a.out}/years").update(states)
        for line in states.toJSON().toLocalIterator():
            print(line)
        print(json.dumps({"version": kept.state.version, "years": sorted(kept.state.years)}))
    elif a.command == "fts":
        for line in fulltext.search(run.open_index(spark, a.out), a.query, a.limit).toJSON().toLocalIterator():
            print(line)
    else:
        found = source_profile(delimited.read_delimited(spark, a.file))
        print(json.dumps({k: v if isinstance(v, dict) else [json.loads(x) for x in v.toJSON().collect()] for k, v in found.items() if v is not None}, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
