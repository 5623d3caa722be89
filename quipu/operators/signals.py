"""Anomaly detectors.  Each returns the same seventeen columns; ``all_signals`` unites them."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import short_md5
from ..functions.predicates import not_aggregated, provider_scope, total
from ..functions.text import finite
from ..scratch import materialize
from .narrow import alike, reaching, repeated
from .quantiles import quantiles

#: Rules compare amounts with quantiles; both sides of the comparison carry rounding of the last bit.
SLACK = 1e-6


@dataclass(frozen=True)
class Thresholds:
    """The published default thresholds."""

    outlier_z: float = 4.5
    outlier_high_z: float = 7.0
    outlier_min_group: int = 20
    outlier_min_ratio: float = 3.0
    outlier_quantile: float = 0.99
    fragment_min: int = 3
    fragment_max_cv: float = 0.15
    spike_ratio: float = 2.5
    concentration_min_providers: int = 8
    concentration_min_share: float = 0.45
    concentration_min_hhi: float = 0.25
    concentration_min_amount: float = 1e7
    delay_min_days: float = 60
    delay_min_group: int = 20
    delay_quantile: float = 0.99
    newcomer_min_amount: float = 5e7
    newcomer_quantile: float = 0.99
    newcomer_min_tx: int = 3

    @classmethod
    def from_nested(cls, config: dict) -> Thresholds:
        """From the nested form of a threshold file; what is absent keeps its default."""
        places = {
            "outlier_z": ("amount_outlier", "threshold"),
            "outlier_min_group": ("amount_outlier", "min_group"),
            "outlier_min_ratio": ("amount_outlier", "min_ratio"),
            "outlier_quantile": ("amount_outlier", "quantile_floor"),
            "fragment_min": ("potential_fragmentation", "min_count"),
            "fragment_max_cv": ("potential_fragmentation", "max_cv"),
            "spike_ratio": ("year_end_spike", "ratio"),
            "concentration_min_providers": ("provider_concentration", "min_providers"),
            "concentration_min_share": ("provider_concentration", "min_share"),
            "concentration_min_hhi": ("provider_concentration", "min_hhi"),
            "concentration_min_amount": ("provider_concentration", "min_amount"),
            "delay_min_days": ("payment_delay_outlier", "min_days"),
            "delay_min_group": ("payment_delay_outlier", "min_group"),
            "delay_quantile": ("payment_delay_outlier", "quantile"),
            "newcomer_min_amount": ("new_to_series_high_spend", "min_amount"),
            "newcomer_quantile": ("new_to_series_high_spend", "quantile"),
        }
        found = {k: (config.get(a) or {}).get(b) for k, (a, b) in places.items()}
        return cls(**{k: v for k, v in found.items() if v is not None})


#: What a reader should check, by type of signal.
ADVICE: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "AMOUNT_OUTLIER": ("Amount in the far tail of its organisation, subtitle and item.", "Needs a documentary explanation; no irregularity by itself.", ("Document and purchase order", "Provider's history with the organisation", "Contract milestones")),
    "POTENTIAL_FRAGMENTATION": ("Several documents of like amounts for the same parties in one week.", "May be periodic billing or part payments.", ("Purchase order or tender", "Documents grouped by object")),
    "YEAR_END_SPIKE": ("Monthly spend in November and December far above January to October.", "Budget seasons can be legitimate.", ("Earlier years", "Concentration by provider")),
    "EXACT_DUPLICATE_CANDIDATE": ("Rows agree in all main document keys.", "May be a repeated source row, an adjustment or a part payment.", ("Repeated source row", "Folio and dates")),
    "PROVIDER_CONCENTRATION": ("One provider has a material share of an organisation's spend in a year.", "May follow from framework contracts or a sole supplier.", ("Category and procurement route", "Index in earlier years")),
    "PAYMENT_DELAY_OUTLIER": ("Payment term in the far tail of the organisation.", "May follow from disputes or late acceptance.", ("Date of acceptance", "Other payments of the contract")),
    "NEW_TO_SERIES_HIGH_SPEND": ("Provider without earlier years enters with spend in the tail of its peers.", "New in the series isn't a new company.", ("First appearance in the full series", "First award")),
}

COLUMNS = (
    "signal_id signal_type transaction_id organization_id recipient_id provider_id periodo mes observed_value expected_value deviation severity "
    "confidence record_class why_flagged investigation_hypothesis recommended_checks"
).split()


def _signals(rows: DataFrame, kind: str, key: tuple, observed, expected, deviation, severity: Column, id_stem: str = "", **other) -> DataFrame:
    why, guess, checks = ADVICE[kind]
    col = lambda c: F.col(c) if isinstance(c, str) else c
    values = {
        "signal_id": F.concat(F.lit(f"SIG-PA-{id_stem or kind}-"), short_md5(*key)),
        "signal_type": F.lit(kind),
        **{c: col(other.get(c, c)) for c in ("transaction_id", "organization_id", "recipient_id", "provider_id")},
        "periodo": F.col("periodo").cast("long"),
        "mes": col(other.get("mes", "mes")).cast("long"),
        "observed_value": col(observed).cast("double"),
        "expected_value": col(expected).cast("double"),
        "deviation": col(deviation).cast("double"),
        "severity": severity,
        "confidence": F.lit("MEDIUM"),
        "record_class": F.lit("DERIVED_SIGNAL"),
        "why_flagged": F.lit(why),
        "investigation_hypothesis": F.lit(guess),
        "recommended_checks": F.lit(json.dumps(checks)),
    }
    return rows.select(*[values[c].alias(c) for c in COLUMNS])


def known_amounts(facts: DataFrame) -> DataFrame:
    """``facts`` with amounts that are NaN or infinite as missing, the rule of every detector."""
    return facts.withColumn("monto_devengado", finite("monto_devengado"))


def below_infinity(c: str) -> Column:
    """The same rule as a condition, for rows that a missing value drops anyway; NaN is above all numbers."""
    return F.col(c) < float("inf")


def robust_outliers(rows: DataFrame, group: list[str], value: str, z: float, min_group: int, min_ratio: float, quantile: float) -> DataFrame:
    """Rows of ``rows`` far above their group: ``med``, ``mad``, ``q`` and the robust score ``z`` are added; values that are NaN or infinite are missing.

    All quantiles are exact; those of logarithms follow from the values beside
    the median, and no group is gathered (see :mod:`.quantiles`).  The rows are
    read several times: give a written table where they are dear.  Statistics
    are small next to the rows, so AQE broadcasts them when they are.
    """
    log = lambda c: F.log(1 + F.greatest(F.col(c), F.lit(0.0)))
    rows = rows.filter(F.abs(value) < float("inf"))
    b = rows.withColumn("x", log(value))
    first = quantiles(rows, group, value, {"med": 0.5, "q": quantile}, least=min_group, sift=True)
    half = F.when(F.col("n") % 2 == 0, 0.5).otherwise(0.0)
    # One row per group, read by three branches.
    first = materialize(first.withColumn("med_x", log("med_low") + (log("med_high") - log("med_low")) * half).select(*group, "med", "q", "med_x"), "medians")
    spread = quantiles(b.join(first.select(*group, "med_x"), group).withColumn("dev", F.abs(F.col("x") - F.col("med_x"))), group, "dev", {"mad": 0.5}, sift=True)
    stats = first.join(spread.select(*group, "mad"), group).filter("mad > 0")
    # Whole rows are moved for the join, so those that lie below every limit they could meet stay where they are.
    b = reaching(b, first, group, value, F.greatest(F.col("q"), F.col("med") * min_ratio) - SLACK)
    scored = b.join(stats, group).withColumn("z", 0.6745 * (F.col("x") - F.col("med_x")) / F.col("mad"))
    return scored.filter((F.col(value) >= F.col("q") - SLACK) & (F.col(value) >= F.col("med") * min_ratio - SLACK) & (F.col("z") >= z - SLACK)).drop("x")


def amount_outlier(facts: DataFrame, t: Thresholds = Thresholds(), provider_only: bool = True, exclude_aggregated: bool = True) -> DataFrame:
    rows = facts.filter((F.col("monto_devengado") >= 0) & below_infinity("monto_devengado"))
    rows = rows.filter(provider_scope()) if provider_only else rows
    rows = rows.filter(not_aggregated()) if exclude_aggregated else rows
    rows = rows.withColumns({"subtitulo": F.coalesce("subtitulo", F.lit("")), "item": F.coalesce("item", F.lit(""))})
    found = robust_outliers(rows, ["organization_id", "subtitulo", "item"], "monto_devengado", t.outlier_z, t.outlier_min_group, t.outlier_min_ratio, t.outlier_quantile)
    return _signals(found, "AMOUNT_OUTLIER", ("transaction_id",), "monto_devengado", "med", "z", F.when(F.col("z") >= t.outlier_high_z, "HIGH").otherwise("MEDIUM"))


def fragmentation(facts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    rows = facts.filter(provider_scope() & not_aggregated() & F.col("fecha_documento").isNotNull() & (F.col("monto_devengado") > 0) & below_infinity("monto_devengado"))
    keys = ["organization_id", "provider_id", "recipient_id", "item", "week"]
    rows = rows.withColumns({"item": F.coalesce("item", F.lit("")), "week": F.date_trunc("week", F.col("fecha_documento"))})
    groups = repeated(rows, keys, t.fragment_min).groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("monto_devengado").alias("mean"), F.stddev_pop("monto_devengado").alias("sd"),
        F.min("transaction_id").alias("transaction_id"), F.min("periodo").alias("periodo"), F.min("mes").alias("mes"),
    )
    found = groups.withColumn("cv", F.col("sd") / F.col("mean")).filter((F.col("n") >= t.fragment_min) & (F.col("cv") <= t.fragment_max_cv + SLACK))
    key = ("organization_id", "provider_id", "item", F.date_format("week", "yyyy-MM-dd HH:mm:ss"))
    return _signals(found, "POTENTIAL_FRAGMENTATION", key, "n", F.lit(t.fragment_min), "cv", F.lit("MEDIUM"))


def year_end_spike(facts: DataFrame, t: Thresholds = Thresholds(), entity: str = "organization_id") -> DataFrame:
    """Averages run over the months that have a known amount; the least transaction is that of all rows; a year without November and December gives nothing."""
    monthly = facts.groupBy(entity, "periodo", "mes").agg(total().alias("amount"), F.min("transaction_id").alias("transaction_id"))
    yearly = monthly.groupBy(entity, "periodo").agg(
        F.avg(F.when(F.col("mes").between(1, 10), F.col("amount"))).alias("base"),
        F.avg(F.when(F.col("mes").between(11, 12), F.col("amount"))).alias("end"),
        F.min("transaction_id").alias("transaction_id"),
    )
    found = yearly.filter((F.col("base") > 0) & F.col("end").isNotNull()).withColumn("ratio", F.col("end") / F.col("base")).filter(F.col("ratio") >= t.spike_ratio - SLACK)
    none = F.lit("")
    return _signals(found, "YEAR_END_SPIKE", (entity, "periodo"), "end", "base", "ratio", F.lit("MEDIUM"), organization_id=F.col(entity), recipient_id=none, provider_id=none, mes=F.lit(None))


def exact_duplicates(facts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Groups of rows that agree in period, parties, document, amount and folio (or in ``keys`` besides period and parties)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    amount = F.coalesce(F.col("monto_devengado").cast("decimal(20,2)").cast("string"), F.lit(""))
    own = {f"key_{k}": blank(c) for k, c in enumerate(keys)} if keys is not None else {"key_doc": blank("numero_documento"), "key_date": blank("fecha_documento"), "key_amount": amount, "key_folio": blank("folio")}
    by = ["periodo", "mes", "organization_id", "recipient_id", *own]
    rows = known_amounts(facts).filter(not_aggregated()).withColumns(own)
    groups = repeated(rows, by).groupBy(*by).agg(F.max("provider_id").alias("provider_id"), F.count("*").alias("n"), F.min("transaction_id").alias("transaction_id"))
    return _signals(groups.filter("n > 1"), "EXACT_DUPLICATE_CANDIDATE", ("transaction_id",), "n", F.lit(1), F.col("n") - 1, F.lit("HIGH"), id_stem="EXACT_DUPLICATE")


def provider_concentration(facts: DataFrame, t: Thresholds = Thresholds(), entity: str = "organization_id") -> DataFrame:
    """The dominant provider of an organisation and year; sums alone are moved, and the rows of those found are looked at again for their ids."""
    rows = facts.filter(provider_scope() & not_aggregated() & (F.col("monto_devengado") > 0) & below_infinity("monto_devengado"))
    spend = rows.groupBy(entity, "periodo", "provider_id").agg(total().alias("amount"))
    # Two aggregates and a per-key maximum instead of windows: each is partial map-side, so no year of an organisation has to fit in one task.
    whole = spend.groupBy(entity, "periodo").agg(
        total("amount").alias("total"), F.count("*").alias("providers"), F.sum(F.pow("amount", F.lit(2.0))).alias("squares"),
        F.min_by(F.struct("provider_id", "amount"), F.struct(-F.col("amount"), F.col("provider_id"))).alias("top"),
    )
    found = whole.filter("total > 0").select(
        entity, "periodo", "providers", "top.*", (F.col("top.amount") / F.col("total")).alias("share"), (F.col("squares") / (F.col("total") * F.col("total"))).alias("hhi")
    )
    kept = found.filter(
        (F.col("providers") >= t.concentration_min_providers) & (F.col("share") >= t.concentration_min_share - SLACK)
        & (F.col("hhi") >= t.concentration_min_hhi - SLACK) & (F.col("amount") >= t.concentration_min_amount)
    )
    kept = materialize(kept, "dominant")
    key = [entity, "periodo", "provider_id"]
    ids = alike(rows, kept, key).groupBy(*key).agg(F.min("recipient_id").alias("recipient_id"), F.min("transaction_id").alias("transaction_id"), F.min("mes").alias("mes"))
    kept = alike(kept, ids, key, "recipient_id", "transaction_id", "mes")
    severity = F.when((F.col("share") >= 0.65 - SLACK) | (F.col("hhi") >= 0.40 - SLACK), "HIGH").otherwise("MEDIUM")
    sep = F.lit("|")
    return _signals(kept, "PROVIDER_CONCENTRATION", (entity, sep, "periodo", sep, "provider_id"), "share", 1.0 / F.col("providers"), "hhi", severity, organization_id=F.col(entity))


def payment_delay(facts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Days are few distinct numbers, so what a quantile of them holds is small however many rows a group has."""
    rows = facts.filter(provider_scope() & not_aggregated()).withColumn("days", F.col("dias_de_pago").try_cast("double")).filter("days >= 0")
    stats = rows.groupBy("organization_id").agg(F.count("*").alias("n"), F.median("days").alias("med"), F.percentile("days", F.lit(t.delay_quantile)).alias("q"))
    stats = materialize(stats.filter(F.col("n") >= t.delay_min_group), "delays")  # so that its size is known, and rows stay where they are if it is small
    found = rows.join(stats, "organization_id").filter(
        (F.col("days") >= t.delay_min_days) & (F.col("days") >= F.col("q") - SLACK) & ((F.col("med") <= 0) | (F.col("days") >= F.col("med") * 2))
    )
    ratio = F.when(F.col("med") > 0, F.col("days") / F.col("med")).otherwise(F.col("days"))
    return _signals(found, "PAYMENT_DELAY_OUTLIER", ("transaction_id",), "days", "med", ratio, F.when(F.col("days") >= 120, "HIGH").otherwise("MEDIUM"))


def new_to_series(facts: DataFrame, t: Thresholds = Thresholds(), entity: Column | str = "provider_id") -> DataFrame:
    """Providers first seen in the series' last year.

    First sight counts aggregated rows, current spend does not.  First years
    are minima per provider; only the last year's rows of newcomers are
    gathered.  The series' ends become literals.
    """
    who = F.col(entity) if isinstance(entity, str) else entity
    mine = facts.filter(provider_scope()).withColumn("who", who)
    own = ~F.coalesce(F.col("is_aggregated"), F.lit(False))
    first, last = facts.agg(F.min("periodo"), F.max("periodo")).first()
    last_year = F.lit(last).cast("long")
    fresh = mine.groupBy("who").agg(F.min("periodo").alias("first_year")).filter((F.col("first_year") == last_year) & F.lit(first != last)).select("who")
    newcomers = alike(mine.filter(F.col("periodo") == last_year), materialize(fresh, "newcomers"), ["who"])
    yearly = newcomers.groupBy("who", "periodo").agg(
        F.min(F.when(own, F.col("provider_id"))).alias("provider_id"), F.min(F.when(own, F.col("recipient_id"))).alias("recipient_id"),
        F.min(F.when(own, F.col("organization_id"))).alias("organization_id"), F.min(F.when(own, F.col("transaction_id"))).alias("transaction_id"),
        F.min(F.when(own, F.col("mes"))).alias("mes"), F.count(F.when(own, 1)).alias("tx"),
        F.count_distinct(F.when(own, F.col("organization_id"))).alias("organizations"), total(when=own).alias("amount"),
    )
    current = materialize(yearly.filter("tx > 0"), "current")  # read by two branches
    q = quantiles(current, [], "amount", {"q": t.newcomer_quantile}).select("q")
    found = current.join(F.broadcast(q), how="left").filter((F.col("tx") >= t.newcomer_min_tx) & (F.col("amount") >= F.greatest(F.lit(t.newcomer_min_amount), F.coalesce("q", F.lit(0.0))) - SLACK))
    return _signals(found, "NEW_TO_SERIES_HIGH_SPEND", ("who", F.lit("|"), "periodo"), "amount", "q", "organizations", F.when(F.col("organizations") >= 3, "HIGH").otherwise("MEDIUM"))


def supporting_transactions(facts: DataFrame, keys: list[str], most: int = 50) -> DataFrame:
    """The first ``most`` transaction ids of each group of over one row; the rank is cut map-side, so no more are ever gathered."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("transaction_id"))
    first = facts.select(*keys, "transaction_id").withColumn("rank", rank).filter(F.col("rank") <= most)
    groups = first.groupBy(*keys).agg(F.array_sort(F.collect_list("transaction_id")).alias("supporting_transactions"))
    return groups.filter(F.size("supporting_transactions") > 1)


def severity_rank(c="severity") -> Column:
    return F.when(F.col(c) == "HIGH", 1).when(F.col(c) == "MEDIUM", 2).otherwise(3)


def dedupe(signals: DataFrame) -> DataFrame:
    """One row per signal id: the most severe, then the largest deviation, then the least transaction."""
    w = Window.partitionBy("signal_id").orderBy(severity_rank(), F.coalesce("deviation", F.lit(0.0)).desc(), "transaction_id", "recipient_id")
    return signals.withColumn("rank_in_id", F.row_number().over(w)).filter("rank_in_id = 1").drop("rank_in_id")


def all_signals(facts: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """The seven detectors united and deduplicated."""
    parts = [f(facts, t) for f in (amount_outlier, fragmentation, year_end_spike, provider_concentration, payment_delay, new_to_series)]
    return dedupe(reduce(DataFrame.unionByName, [*parts, exact_duplicates(facts)]))
