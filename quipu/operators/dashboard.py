"""Headline metrics and a compact preview of the queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import provider_scope, total

# What a preview row may show.
PREVIEW = (
    "signal_id", "signal_type", "transaction_id", "organization_id", "organization_name", "recipient_id", "provider_id", "provider_or_recipient_name", "periodo", "mes",
    "observed_value", "expected_value", "deviation", "severity", "confidence", "investigation_priority_score", "priority_tier", "priority_explanation", "cgr_match_count", "why_flagged",
)


def metrics(facts: DataFrame, signals: DataFrame) -> DataFrame:
    """One row of seven metrics; each distinct count is an aggregate of its own over one narrow column."""
    wide = facts.agg(F.count("*").alias("transactions"), total().alias("amount_devengado"), total("monto_pago").alias("amount_paid"))
    distinct = lambda rows, c, name: rows.select(c).filter(F.col(c).isNotNull()).distinct().agg(F.count("*").alias(name))
    out = wide
    for part in (distinct(facts, "organization_id", "organizations"), distinct(facts, "recipient_id", "recipients"), distinct(facts.filter(provider_scope()), "provider_id", "providers"), signals.agg(F.count("*").alias("signals"))):
        out = out.crossJoin(part)  # one row each
    return out


def preview(queue: DataFrame, top: int = 8) -> DataFrame:
    return queue.limit(top).select(*[c for c in PREVIEW if c in queue.columns])


def queue_or_signals(prioritized: DataFrame | None, signals: DataFrame, top: int = 250) -> DataFrame:
    """The queue, or the plain signals by severity where no queue was made."""
    from .priority import queue
    from .signals import severity_rank

    return queue(prioritized, top) if prioritized is not None else signals.orderBy(severity_rank(), F.coalesce("deviation", F.lit(0.0)).desc(), "signal_id").limit(top)
