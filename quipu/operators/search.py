"""Hybrid search: a conjunction of typed predicates, named orders, a bounded limit."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import normalize_rut
from ..functions.predicates import present, total
from ..functions.text import fold

# Which columns each search field covers.
FIELDS = {
    "beneficiary": ("nombre_beneficiario", "rut_beneficiario", "beneficiario_source_id"),
    "institution": ("nombre_partida", "nombre_capitulo", "nombre_area"),
    "budget": ("nombre_subtitulo", "nombre_item", "nombre_asignacion", "nombre_programa_presupuestario"),
    "documents": ("numero_documento", "tipo_documento"),
    "purchase_order": ("orden_compra",),
    "bip": ("codigo_bip", "nombre_bip"),
    "geography": ("nombre_ubicacion_geografica", "region", "sector"),
}
EQUAL = {
    "source_id": "beneficiario_source_id", "identity_type": "beneficiario_id_type", "organization_id": "organization_id", "recipient_id": "recipient_id",
    "provider_id": "provider_id", "partida": "partida", "capitulo": "capitulo", "area": "area", "purchase_order": "orden_compra", "bip": "codigo_bip",
    "document_number": "numero_documento",
}
HOLDS = {"location": "nombre_ubicacion_geografica", "region": "region", "sector": "sector", "document_type": "tipo_documento", "currency": "moneda_presupuestaria"}
AT_LEAST = {"min_amount": "monto_devengado", "min_paid_amount": "monto_pago", "min_payment_days": "dias_de_pago"}
AT_MOST = {"max_amount": "monto_devengado", "max_paid_amount": "monto_pago", "max_payment_days": "dias_de_pago"}
FLAGS = {
    "provider_only": "is_provider", "person_only": "is_person", "honorarium_only": "is_honorarium", "intra_state_only": "is_intra_state",
    "floating_debt_only": "is_floating_debt", "aggregated_only": "is_aggregated",
}
HAS = {"has_purchase_order": "orden_compra", "has_bip": "codigo_bip", "has_valid_rut": "rut_beneficiario"}
OWN = {"text", "text_mode", "exclude_text", "search_fields", "rut", "year", "month", "date_from", "date_to", "budget_code", "sort_by", "limit"}
MOST_ROWS = 10_000


def blob(rows: DataFrame, fields: list[str] | None = None) -> Column:
    """The folded text that a search looks at."""
    if unknown := set(fields or ()) - set(FIELDS):
        raise ValueError(f"unknown search fields: {sorted(unknown)}")
    columns = [c for f in (fields or FIELDS) for c in FIELDS[f] if c in rows.columns]
    return fold(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def _folded_words(text: str) -> list[str]:
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", plain.lower()).strip().split(" ") if plain.strip() else []


def predicates(rows: DataFrame, **f) -> list[Column]:
    """The conditions of a search; absent and empty parameters give none."""
    known = {*EQUAL, *HOLDS, *AT_LEAST, *AT_MOST, *FLAGS, *HAS, *OWN}
    if unknown := set(f) - known:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    out: list[Column] = []
    body = blob(rows, f.get("search_fields"))
    if (said := text_condition(body, f.get("text"), f.get("text_mode"), f.get("exclude_text"))) is not None:
        out.append(said)
    if f.get("rut"):
        out.append(_rut_condition(rows, f["rut"]))
    out += [F.col(c) == str(f[k]) for k, c in EQUAL.items() if f.get(k)]
    out += [F.col(c) == int(f[k]) for k, c in (("year", "periodo"), ("month", "mes")) if f.get(k) is not None]
    day = F.coalesce(F.col("fecha_documento").cast("date"), F.col("fecha_pago").cast("date")) if f.get("date_from") or f.get("date_to") else None
    if f.get("date_from"):
        out.append(day >= F.lit(f["date_from"]).cast("date"))
    if f.get("date_to"):
        out.append(day <= F.lit(f["date_to"]).cast("date"))
    kinds = dict(rows.dtypes)
    number = lambda c: F.col(c).try_cast("double") if kinds.get(c) == "string" else F.col(c)  # noqa: E731  typed columns are pushed down
    out += [number(c) >= float(f[k]) for k, c in AT_LEAST.items() if f.get(k) is not None]
    out += [number(c) <= float(f[k]) for k, c in AT_MOST.items() if f.get(k) is not None]
    out += [fold(c).contains(" ".join(_folded_words(f[k]))) for k, c in HOLDS.items() if f.get(k)]
    if f.get("budget_code"):
        out.append(F.concat_ws(".", *[F.coalesce(F.col(c), F.lit("")) for c in ("subtitulo", "item", "asignacion")]).startswith(f["budget_code"]))
    out += [F.col(c) == F.lit(bool(f[k])) for k, c in FLAGS.items() if f.get(k) is not None]
    out += [present(c) if f[k] else ~present(c) for k, c in HAS.items() if f.get(k) is not None]
    return out


def text_condition(body: Column, text: str | None, mode: str | None = None, exclude: str | None = None) -> Column | None:
    """All conditions on the searched text.

    They are asked of the one element of an array, so the text is built and
    folded once a row, not once per word.
    """
    mode = (mode or "all").lower()
    if mode not in ("all", "any", "phrase"):
        raise ValueError("text_mode is all, any or phrase")
    words, banned = _folded_words(text or ""), _folded_words(exclude or "")
    if not words and not banned:
        return None

    def holds(b: Column) -> Column:
        tests = [b.contains(" ".join(words))] if mode == "phrase" and words else [b.contains(w) for w in words]
        joined = [reduce(Column.__or__ if mode == "any" else Column.__and__, tests)] if tests else []
        return reduce(Column.__and__, [*joined, *(~b.contains(w) for w in banned)])

    return F.exists(F.array(body), holds)


def _rut_condition(rows: DataFrame, rut: str) -> Column:
    checked = rows.sparkSession.range(1).select(normalize_rut(F.lit(rut))).first()[0]
    if not checked:
        raise ValueError("not a valid tax number")
    return F.col("rut_beneficiario") == checked


def _order(sort_by: str) -> list[Column]:
    amount = F.col("monto_devengado")
    late = [F.desc_nulls_last("periodo"), F.desc_nulls_last("mes")]
    orders = {
        "date_amount": [*late, amount.desc_nulls_last()],
        "amount_desc": [amount.desc_nulls_last(), *late],
        "amount_asc": [amount.asc_nulls_last(), *late],
        "oldest": [F.asc_nulls_last("periodo"), F.asc_nulls_last("mes"), amount.desc_nulls_last()],
    }
    if sort_by not in orders:
        raise ValueError(f"unknown order: {sort_by}")
    return [*orders[sort_by], F.col("transaction_id").asc()]


def search(facts: DataFrame, **filters) -> DataFrame:
    """Matching facts in a named order, at most ``limit`` (1 to 10,000, default 100) of them: a distributed top-k."""
    tests = predicates(facts, **filters)
    rows = facts.filter(reduce(Column.__and__, tests)) if tests else facts
    limit = max(1, min(int(filters.get("limit") or 100), MOST_ROWS))
    return rows.orderBy(*_order(filters.get("sort_by") or "date_amount")).limit(limit)


def summarize(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and sums per recipient or organisation, the largest first."""
    sums = rows.groupBy(*keys).agg(
        F.count("transaction_id").alias("transacciones"), total().alias("monto_devengado"), total("monto_pago").alias("monto_pagado"),
        F.min("periodo").alias("primer_periodo"), F.max("periodo").alias("ultimo_periodo"),
    )
    return sums.orderBy(F.desc_nulls_last("monto_devengado"), F.desc("transacciones"), *keys)


SOURCES = "periodo long, source_url string, source_status string, source_sha256 string, source_bytes long, delimiter string"
#: States of a source that can be read.
AVAILABLE = ("linked_available", "probed_available")


def year_states(facts: DataFrame, wanted: list[int], sources: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per wanted year: whether it was processed or why not, where it came from, and how many rows it has and matched.

    ``sources`` has the columns of ``SOURCES``.  A year without a readable source
    is not confirmed; one with a source but without facts failed on the way.
    """
    spark = facts.sparkSession
    years = spark.range(1).select(F.explode(F.array(*[F.lit(int(y)).cast("long") for y in sorted(set(wanted))])).alias("periodo"))
    have = facts.groupBy("periodo").agg(F.count("*").alias("normalized_rows"))
    hits = matches.groupBy("periodo").agg(F.count("*").alias("matched_rows"))
    rows = years.join(sources.filter(F.col("source_status").isin(*AVAILABLE)), "periodo", "left").join(have, "periodo", "left").join(hits, "periodo", "left")
    status = F.when(F.col("source_url").isNull(), "SOURCE_NOT_CONFIRMED").when(F.col("normalized_rows").isNull(), "PROCESSING_ERROR").otherwise("PROCESSED")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.withColumns({"status": status, "normalized_rows": zero("normalized_rows"), "matched_rows": zero("matched_rows")})


def search_years(facts: DataFrame, years: list[int], summary_scope: str = "limited", **filters) -> dict[str, DataFrame]:
    """Search over several years with summaries and the years without data.

    The years are one predicate, so partitions of other years aren't read.
    summary_scope: "limited" sums the rows shown, "full" all matching rows.
    """
    if summary_scope not in ("limited", "full"):
        raise ValueError("summary_scope is limited or full")
    mine = facts.filter(F.col("periodo").isin([int(y) for y in years]))
    shown = search(mine, **filters)
    tests = predicates(mine, **filters)
    base = shown if summary_scope == "limited" else (mine.filter(reduce(Column.__and__, tests)) if tests else mine)
    wanted = facts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(int(y)).cast("long") for y in years])).alias("periodo"))
    return {
        "rows": shown,
        "recipients": summarize(base, [c for c in ("recipient_id", "provider_id", "rut_beneficiario", "nombre_beneficiario") if c in facts.columns]),
        "organizations": summarize(base, [c for c in ("organization_id", "nombre_partida", "nombre_capitulo") if c in facts.columns]),
        "gaps": wanted.join(mine.select("periodo").distinct(), "periodo", "left_anti"),
    }
