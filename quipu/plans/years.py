"""Facts and yearly sums of many years, kept up to date a year at a time.

Each year has immutable folders: its facts, its relations, its services and its
months.  A snapshot (:mod:`..sources.snapshots`) names the folders that count
and the digest of the file that each year came from.  An update compares digests, so it
reads only the years whose files changed or are new; sums over years are kept
by taking away the old year's sums and adding the new one's, as decimals, so
nothing is lost however often it is done.  Marks are made from the yearly sums.
Files that a year was read from are deleted when its year has been committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import multiyear
from ..sources import delimited, sinks, snapshots, splits
from ..sources.facts import normalize

#: Folders of a year besides its facts: what each holds follows from the facts.
YEARLY: dict[str, Callable[[DataFrame], DataFrame]] = {"relations": multiyear.relations, "services": multiyear.service_years, "months": multiyear.month_sums}
MONEY = "decimal(38,6)"


@dataclass(frozen=True)
class State:
    version: int = 0
    #: year -> digest of its file, and the folder below which its tables lie.
    years: dict[int, tuple[str, str]] = field(default_factory=dict)
    totals: str | None = None

    def text(self) -> str:
        return json.dumps({"version": self.version, "years": {str(y): v for y, v in self.years.items()}, "totals": self.totals})

    @classmethod
    def of(cls, text: str) -> State:
        d = json.loads(text)
        return cls(d["version"], {int(y): tuple(v) for y, v in d["years"].items()}, d["totals"])


def read_year(spark: SparkSession, path: str, url: str = "") -> DataFrame:
    """Facts of one yearly file, gzip or not."""
    if path.endswith(".gz"):
        return normalize(splits.read_gzip(spark, path), source_url=url, source_file=path.rsplit("/", 1)[-1], row_number=False)
    return normalize(delimited.read_delimited(spark, path), source_url=url, source_file=path.rsplit("/", 1)[-1])


class Years:
    """The years kept below ``root``, as of one snapshot."""

    def __init__(self, spark: SparkSession, root: str, state: State | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        if state is None:
            text = snapshots.latest(spark, self.root)
            state = State.of(text) if text else State()
        self.state = state

    def stale(self, sources: DataFrame) -> dict[int, tuple[str, str]]:
        """Years of ``sources(year, path, sha256)`` that are new or whose digest differs, with path and digest; the driver gets a row a year."""
        found = {r["year"]: (r["path"], r["sha256"]) for r in sources.filter("sha256 is not null").select("year", "path", "sha256").collect()}
        return {y: v for y, v in sorted(found.items()) if self.state.years.get(y, ("",))[0] != v[1]}

    def _tables(self, kind: str, years: list[int] | None = None) -> DataFrame:
        """A table of the kept years, or of some; folders of other years aren't looked at."""
        held = [folder for y, (_, folder) in sorted(self.state.years.items()) if years is None or y in years]
        if not held:
            raise ValueError("no such year is kept")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self.spark.read.parquet(f"{folder}/{kind}") for folder in held])

    def facts(self, years: list[int] | None = None) -> DataFrame:
        return self._tables("facts", years)

    def relations(self) -> DataFrame:
        return self._tables("relations")

    def services(self) -> DataFrame:
        return self._tables("services")

    def totals(self) -> DataFrame:
        """(organization_id, provider_id, amount_clp, transactions) over all kept years."""
        return self.spark.read.parquet(self.state.totals)

    def marks(self, rules: multiyear.MarkRules = multiyear.MarkRules(), **exclusion) -> DataFrame:
        """Marks of all years, from yearly sums alone."""
        edges = multiyear.private_edges(self.relations(), multiyear.service_names(self.services()), **exclusion)
        return multiyear.marks_of(self._tables("months"), edges, rules)

    def update(self, sources: DataFrame, read: Callable[[SparkSession, str], DataFrame] = read_year, drop: bool = True) -> Years:
        """Bring the years of ``sources(year, path, sha256)`` up to date; ``drop`` deletes the files that were read and the folders that no longer count.

        A file that fails leaves the snapshot as it was.
        """
        stale = self.stale(sources)
        if not stale:
            return self
        spark, fresh, changes = self.spark, {}, []
        for year, (path, sha256) in stale.items():
            folder = f"{self.root}/{year}/{sha256[:16]}_{uuid.uuid4().hex[:8]}"
            sinks.write_parquet(read(spark, path), f"{folder}/facts")
            facts = spark.read.parquet(f"{folder}/facts")
            for kind, make in YEARLY.items():
                sinks.write_parquet(make(facts), f"{folder}/{kind}")
            fresh[year] = (sha256, folder)
            changes.append(self._signed(folder, 1))
            if year in self.state.years:
                changes.append(self._signed(self.state.years[year][1], -1))
        totals = self._summed(changes)
        then = Years(spark, self.root, State(self.state.version + 1, self.state.years | fresh, totals))
        snapshots.commit(spark, self.root, then.state.version, then.state.text())
        if drop:
            sinks.drop_files(spark, [path for path, _ in stale.values()])
            for folder in [self.state.years[y][1] for y in fresh if y in self.state.years] + [self.state.totals] * bool(self.state.totals):
                snapshots.delete(spark, folder)
        return then

    def _summed(self, changes: list[DataFrame]) -> str:
        """The folder of the totals after ``changes``."""
        folder, every = f"{self.root}/totals/{uuid.uuid4().hex}", changes + ([self.totals()] if self.state.totals else [])
        sums = reduce(DataFrame.unionByName, every).groupBy("organization_id", "provider_id").agg(F.sum("amount_clp").cast(MONEY).alias("amount_clp"), F.sum("transactions").alias("transactions"))
        sinks.write_parquet(sums.filter("transactions <> 0"), folder)
        return folder

    def _signed(self, folder: str, sign: int) -> DataFrame:
        rows = self.spark.read.parquet(f"{folder}/relations")
        return rows.select("organization_id", "provider_id", (F.col("amount_clp").cast(MONEY) * sign).cast(MONEY).alias("amount_clp"), (F.col("transactions") * sign).alias("transactions"))

    def forget(self, years: list[int]) -> Years:
        """Take years out; their folders are deleted."""
        gone = [y for y in years if y in self.state.years]
        if not gone:
            return self
        totals = self._summed([self._signed(self.state.years[y][1], -1) for y in gone])
        then = Years(self.spark, self.root, replace(self.state, version=self.state.version + 1, years={y: v for y, v in self.state.years.items() if y not in gone}, totals=totals))
        snapshots.commit(self.spark, self.root, then.state.version, then.state.text())
        for folder in [*[self.state.years[y][1] for y in gone], self.state.totals]:
            snapshots.delete(self.spark, folder)
        return then
