"""Registered queries: each a DataFrame plan with its DuckDB form over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text
from ..functions.predicates import PUBLIC_PATTERNS, total
from ..operators import documents, enrich, evidence, explore, fulltext, light, multiyear, priority, profiles, quality, search, signals, spend, territory
from ..operators.segments import SegmentedIndex
from ..sources import delimited
from ..sources.star import facts, facts_sql
from ..scratch import materialize, shared_dir
from .shared import detect, full_facts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Thresholds under which the sample tables, whose amounts are nearly uniform, give rows.
T = signals.Thresholds(
    outlier_z=1.2, outlier_high_z=1.4, outlier_min_group=8, outlier_min_ratio=1.5, outlier_quantile=0.95, fragment_max_cv=0.35, fragment_min=2,
    concentration_min_share=0.03, concentration_min_hhi=0.005, concentration_min_amount=1000.0, newcomer_min_amount=1000.0, newcomer_min_tx=1, spike_ratio=1.2,
)


def query(sql: str | None = None):
    """Register a plan; ``sql`` may refer to ``facts``."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"WITH facts AS ({facts_sql()}), {sql.strip()}" if "facts" in sql else sql.strip()
        return f

    return add


def rounded(rows: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Last bits differ between engines; published ratios are rounded."""
    return rows.withColumns({c: F.round(c, digits) for c in columns})


def money_sql(c: str = "monto_devengado", when: str = "") -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,2))){f' FILTER (WHERE {when})' if when else ''} AS DOUBLE)"


PROVIDER = "(is_provider AND coalesce(provider_id, '') <> '')"
OWN = "NOT coalesce(is_aggregated, FALSE)"
A = money_sql()

# --- profiles and quality -------------------------------------------------------------------------------------------


@query(f"""
x AS (SELECT 1)
SELECT provider_id, min(rut_beneficiario) AS rut, min(beneficiario_id_type) AS identity_key_type, min(nombre_beneficiario) AS nombre,
       min(make_date(periodo, mes, 1)) AS first_seen, max(make_date(periodo, mes, 1)) AS last_seen, count(*) AS transactions,
       count(DISTINCT organization_id) AS organizations, count(DISTINCT coalesce(subtitulo, '') || '-' || coalesce(item, '')) AS budget_categories,
       {A} AS amount_devengado, round(avg(monto_devengado), 4) AS avg_amount, round(stddev_pop(monto_devengado), 4) AS sd_amount,
       count(DISTINCT coalesce(nombre_ubicacion_geografica, '')) AS geographic_destinations
FROM facts WHERE {PROVIDER} GROUP BY provider_id
""")
def profiles_provider(spark, sf_dir):
    f = facts(spark, sf_dir, *"provider_id is_provider rut_beneficiario beneficiario_id_type nombre_beneficiario periodo mes organization_id subtitulo item monto_devengado nombre_ubicacion_geografica".split())
    return rounded(profiles.provider_profiles(f), "avg_amount", "sd_amount", digits=4)


@query(f"""
x AS (SELECT 1)
SELECT recipient_id, max(provider_id) AS provider_id, min(rut_beneficiario) AS rut, min(nombre_beneficiario) AS nombre, bool_or(is_provider) AS is_provider,
       bool_or(is_person) AS is_person, min(make_date(periodo, mes, 1)) AS first_seen, max(make_date(periodo, mes, 1)) AS last_seen, count(*) AS transactions,
       count(DISTINCT organization_id) AS organizations, {A} AS amount_devengado
FROM facts GROUP BY recipient_id
""")
def profiles_recipient(spark, sf_dir):
    return profiles.recipient_profiles(facts(spark, sf_dir, *"recipient_id provider_id rut_beneficiario nombre_beneficiario is_provider is_person periodo mes organization_id monto_devengado".split()))


@query(f"""
s AS (SELECT organization_id, provider_id, {A} AS a FROM facts WHERE {PROVIDER} GROUP BY ALL),
sh AS (SELECT organization_id, CASE WHEN sum(a) > 0 THEN round(sum(power(a / t, 2)), 8) END AS supplier_hhi FROM (SELECT *, sum(a) OVER (PARTITION BY organization_id) AS t FROM s) GROUP BY 1),
r AS (SELECT organization_id, recipient_id, {A} AS a FROM facts GROUP BY ALL),
rh AS (SELECT organization_id, CASE WHEN sum(a) > 0 THEN round(sum(power(a / t, 2)), 8) END AS recipient_hhi FROM (SELECT *, sum(a) OVER (PARTITION BY organization_id) AS t FROM r) GROUP BY 1),
b AS (SELECT organization_id, min(nombre_partida) AS institucion, min(nombre_capitulo) AS servicio, min(nombre_area) AS area, count(*) AS transactions,
      count(DISTINCT recipient_id) AS recipients, count(DISTINCT provider_id) FILTER (WHERE {PROVIDER}) AS providers, {A} AS amount_devengado FROM facts GROUP BY 1)
SELECT b.*, supplier_hhi, recipient_hhi FROM b LEFT JOIN sh USING (organization_id) LEFT JOIN rh USING (organization_id)
""")
def profiles_organization(spark, sf_dir):
    f = facts(spark, sf_dir, *"organization_id provider_id recipient_id is_provider nombre_partida nombre_capitulo nombre_area monto_devengado".split())
    return rounded(profiles.organization_profiles(f), "supplier_hhi", "recipient_hhi", digits=8)


_COUNTS = {
    "invalid_period_rows": "periodo IS NULL OR mes IS NULL OR mes NOT BETWEEN 1 AND 12", "rut_rows": "coalesce(rut_beneficiario, '') <> ''",
    "hashed_identity_rows": "beneficiario_id_type = 'HASH_SHA1'", "provider_rows": "is_provider", "person_rows": "is_person",
    "beneficiary_name_rows": "coalesce(nombre_beneficiario, '') <> ''", "devengado_rows": "monto_devengado IS NOT NULL", "pago_rows": "monto_pago IS NOT NULL",
    "document_date_rows": "fecha_documento IS NOT NULL", "payment_date_rows": "fecha_pago IS NOT NULL", "purchase_order_rows": "coalesce(orden_compra, '') <> ''",
    "bip_rows": "coalesce(codigo_bip, '') <> ''", "region_rows": "coalesce(region, '') <> ''", "sector_rows": "coalesce(sector, '') <> ''",
    "negative_devengado_rows": "monto_devengado < 0",
}


@query(f"""
m AS (SELECT count(*) AS row_count, {', '.join(f'count(*) FILTER (WHERE {p}) AS {k}' for k, p in _COUNTS.items())}, min(periodo) AS first_year, max(periodo) AS last_year,
      coalesce({A}, 0.0) AS devengado_total, count(DISTINCT transaction_id) AS distinct_transaction_ids, count(DISTINCT transaction_fingerprint) AS distinct_transaction_fingerprints FROM facts)
SELECT *, {', '.join(f'round({c} / row_count, 6) AS coverage_{k}' for k, c in quality.COVERAGE.items())},
       round(1 - distinct_transaction_ids / row_count, 8) AS transaction_id_collision_ratio, round(1 - distinct_transaction_fingerprints / row_count, 8) AS source_fact_repeat_ratio,
       greatest(0, row_count - distinct_transaction_fingerprints) AS repeated_fingerprint_rows,
       concat_ws(',', CASE WHEN distinct_transaction_ids < row_count THEN 'TRANSACTION_ID_NOT_UNIQUE' END, CASE WHEN invalid_period_rows > 0 THEN 'INVALID_PERIOD_ROWS' END) AS warnings,
       CASE WHEN distinct_transaction_ids < row_count OR invalid_period_rows > 0 THEN 'WARN' ELSE 'PASS' END AS status
FROM m
""")
def quality_audit(spark, sf_dir):
    columns = "transaction_id transaction_fingerprint periodo mes rut_beneficiario beneficiario_id_type is_provider is_person nombre_beneficiario monto_devengado monto_pago fecha_documento fecha_pago orden_compra codigo_bip region sector"
    return quality.audit(facts(spark, sf_dir, *columns.split()))


# --- detectors ------------------------------------------------------------------------------------------------------

_SIGNAL = "signal_id, signal_type, transaction_id, organization_id, recipient_id, provider_id, periodo, mes, observed_value, expected_value, deviation, severity"


def _id(kind: str, expression: str) -> str:
    return f"'SIG-PA-{kind}-' || upper(substr(md5({expression}), 1, 20)) AS signal_id"


_OUTLIER = f"""
ob AS (SELECT *, coalesce(subtitulo, '') AS sub, coalesce(item, '') AS it, ln(1 + greatest(monto_devengado, 0)) AS x FROM facts WHERE {PROVIDER} AND {OWN} AND monto_devengado >= 0),
om AS (SELECT organization_id, sub, it, count(*) AS n, median(x) AS med_x, median(monto_devengado) AS med, quantile_cont(monto_devengado, {T.outlier_quantile}) AS q FROM ob GROUP BY ALL HAVING count(*) >= {T.outlier_min_group}),
od AS (SELECT organization_id, sub, it, median(abs(x - med_x)) AS mad FROM ob JOIN om USING (organization_id, sub, it) GROUP BY ALL HAVING median(abs(x - med_x)) > 0),
oz AS (SELECT ob.*, med, q, 0.6745 * (x - med_x) / mad AS z FROM ob JOIN om USING (organization_id, sub, it) JOIN od USING (organization_id, sub, it)),
s_outlier AS (SELECT {_id('AMOUNT_OUTLIER', 'transaction_id')}, 'AMOUNT_OUTLIER' AS signal_type, transaction_id, organization_id, recipient_id, provider_id, periodo, mes,
      monto_devengado AS observed_value, med AS expected_value, z AS deviation, CASE WHEN z >= {T.outlier_high_z} THEN 'HIGH' ELSE 'MEDIUM' END AS severity
      FROM oz WHERE monto_devengado >= q - 1e-6 AND monto_devengado >= med * {T.outlier_min_ratio} - 1e-6 AND z >= {T.outlier_z} - 1e-6)"""
_FRAGMENT = f"""
fg AS (SELECT organization_id, provider_id, recipient_id, coalesce(item, '') AS it, date_trunc('week', fecha_documento) AS wk, count(*) AS n, avg(monto_devengado) AS av, stddev_pop(monto_devengado) AS sd,
       min(transaction_id) AS transaction_id, min(periodo) AS periodo, min(mes) AS mes FROM facts WHERE {PROVIDER} AND {OWN} AND fecha_documento IS NOT NULL AND monto_devengado > 0 GROUP BY ALL),
s_fragment AS (SELECT {_id('POTENTIAL_FRAGMENTATION', "organization_id || provider_id || it || strftime(wk, '%Y-%m-%d 00:00:00')")}, 'POTENTIAL_FRAGMENTATION' AS signal_type, transaction_id, organization_id, recipient_id, provider_id,
       periodo, mes, CAST(n AS DOUBLE) AS observed_value, CAST({T.fragment_min} AS DOUBLE) AS expected_value, sd / av AS deviation, 'MEDIUM' AS severity FROM fg WHERE n >= {T.fragment_min} AND sd / av <= {T.fragment_max_cv} + 1e-6)"""


def _spike(entity: str) -> str:
    return f"""
mo AS (SELECT {entity} AS e, periodo, mes, {A} AS amount, min(transaction_id) AS transaction_id FROM facts GROUP BY ALL),
yr AS (SELECT e, periodo, avg(amount) FILTER (WHERE mes <= 10) AS base, avg(amount) FILTER (WHERE mes >= 11) AS en, min(transaction_id) AS transaction_id FROM mo GROUP BY ALL),
s_spike AS (SELECT {_id('YEAR_END_SPIKE', 'e || CAST(periodo AS VARCHAR)')}, 'YEAR_END_SPIKE' AS signal_type, transaction_id, e AS organization_id, '' AS recipient_id, '' AS provider_id,
      periodo, CAST(NULL AS BIGINT) AS mes, en AS observed_value, base AS expected_value, en / base AS deviation, 'MEDIUM' AS severity FROM yr WHERE base > 0 AND en IS NOT NULL AND en / base >= {{ratio}} - 1e-6)"""


_DUPLICATE = f"""
du AS (SELECT periodo, mes, organization_id, recipient_id, {{keys}}, max(provider_id) AS provider_id, count(*) AS n, min(transaction_id) AS transaction_id FROM facts WHERE {OWN} GROUP BY ALL HAVING count(*) > 1),
s_duplicate AS (SELECT {_id('EXACT_DUPLICATE', 'transaction_id')}, 'EXACT_DUPLICATE_CANDIDATE' AS signal_type, transaction_id, organization_id, recipient_id, provider_id, periodo, mes,
      CAST(n AS DOUBLE) AS observed_value, CAST(1 AS DOUBLE) AS expected_value, CAST(n - 1 AS DOUBLE) AS deviation, 'HIGH' AS severity FROM du)"""
_DUP_KEYS = "coalesce(numero_documento, '') AS k1, coalesce(CAST(fecha_documento AS VARCHAR), '') AS k2, coalesce(CAST(CAST(monto_devengado AS DECIMAL(20,2)) AS VARCHAR), '') AS k3, coalesce(folio, '') AS k4"


def _concentrated(entity: str, share: float, hhi: float, amount: float) -> str:
    return f"""
sp AS (SELECT {entity} AS e, periodo, provider_id, min(recipient_id) AS recipient_id, {A} AS amount, min(transaction_id) AS transaction_id, min(mes) AS mes FROM facts WHERE {PROVIDER} AND {OWN} AND monto_devengado > 0 GROUP BY ALL),
rk AS (SELECT *, sum(amount) OVER w AS total, count(*) OVER w AS providers, row_number() OVER (PARTITION BY e, periodo ORDER BY amount DESC, provider_id) AS rn FROM sp WINDOW w AS (PARTITION BY e, periodo)),
hh AS (SELECT *, amount / total AS share, sum(power(amount / total, 2)) OVER (PARTITION BY e, periodo) AS hhi FROM rk),
s_concentration AS (SELECT {_id('PROVIDER_CONCENTRATION', "e || '|' || CAST(periodo AS VARCHAR) || '|' || provider_id")}, 'PROVIDER_CONCENTRATION' AS signal_type, transaction_id, e AS organization_id, recipient_id, provider_id,
      periodo, mes, share AS observed_value, 1.0 / providers AS expected_value, hhi AS deviation, CASE WHEN share >= 0.65 - 1e-6 OR hhi >= 0.40 - 1e-6 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
      FROM hh WHERE rn = 1 AND providers >= {T.concentration_min_providers} AND share >= {share} - 1e-6 AND hhi >= {hhi} - 1e-6 AND amount >= {amount})"""


_DELAY = f"""
dl AS (SELECT *, CAST(dias_de_pago AS DOUBLE) AS days FROM facts WHERE {PROVIDER} AND {OWN} AND dias_de_pago >= 0),
ds AS (SELECT organization_id, count(*) AS n, median(days) AS med, quantile_cont(days, {T.delay_quantile}) AS q FROM dl GROUP BY 1 HAVING count(*) >= {T.delay_min_group}),
s_delay AS (SELECT {_id('PAYMENT_DELAY_OUTLIER', 'transaction_id')}, 'PAYMENT_DELAY_OUTLIER' AS signal_type, transaction_id, organization_id, recipient_id, provider_id, periodo, mes, days AS observed_value, med AS expected_value,
      CASE WHEN med > 0 THEN days / med ELSE days END AS deviation, CASE WHEN days >= 120 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
      FROM dl JOIN ds USING (organization_id) WHERE days >= {T.delay_min_days} AND days >= q - 1e-6 AND (med <= 0 OR days >= med * 2))"""


def _newcomer(entity: str) -> str:
    return f"""
nf AS (SELECT *, {entity} AS who FROM facts WHERE {PROVIDER}), nm AS (SELECT count(DISTINCT periodo) AS years, max(periodo) AS last_year FROM facts),
n1 AS (SELECT who, min(periodo) AS first_year FROM nf GROUP BY 1),
nc AS (SELECT who, periodo, min(provider_id) AS provider_id, min(recipient_id) AS recipient_id, min(organization_id) AS organization_id, min(transaction_id) AS transaction_id, min(mes) AS mes, count(*) AS tx,
       count(DISTINCT organization_id) AS organizations, {A} AS amount FROM nf JOIN n1 USING (who), nm WHERE {OWN} AND first_year = last_year AND periodo = last_year AND years > 1 GROUP BY ALL),
nq AS (SELECT quantile_cont(amount, {T.newcomer_quantile}) AS q FROM nc),
s_newcomer AS (SELECT {_id('NEW_TO_SERIES_HIGH_SPEND', "who || '|' || CAST(periodo AS VARCHAR)")}, 'NEW_TO_SERIES_HIGH_SPEND' AS signal_type, transaction_id, organization_id, recipient_id, provider_id, periodo, mes, amount AS observed_value,
      q AS expected_value, CAST(organizations AS DOUBLE) AS deviation, CASE WHEN organizations >= 3 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM nc, nq WHERE tx >= {T.newcomer_min_tx} AND amount >= greatest({T.newcomer_min_amount}, coalesce(q, 0)) - 1e-6)"""


def _shown(table: str) -> str:
    return f"SELECT {_SIGNAL.replace('observed_value', 'round(observed_value, 6) AS observed_value').replace('expected_value', 'round(expected_value, 6) AS expected_value').replace('deviation', 'round(deviation, 6) AS deviation')} FROM {table}"


def _plain(rows: DataFrame) -> DataFrame:
    return rounded(rows.select(*_SIGNAL.split(", ")), "observed_value", "expected_value", "deviation")


@query(f"{_OUTLIER} {_shown('s_outlier')}")
def amount_outlier(spark, sf_dir):
    return _plain(signals.amount_outlier(materialize(facts(spark, sf_dir, *detect("subtitulo item")), "facts"), T))


@query(f"""
WITH b AS (SELECT *, ln(1 + greatest(value, 0)) AS x FROM events WHERE value >= 0),
m AS (SELECT event_type, count(*) AS n, median(x) AS med_x, median(value) AS med, quantile_cont(value, 0.99) AS q FROM b GROUP BY 1 HAVING count(*) >= 20),
d AS (SELECT event_type, median(abs(x - med_x)) AS mad FROM b JOIN m USING (event_type) GROUP BY 1)
SELECT event_id, event_type, user_id, value, round(med, 6) AS med, round(0.6745 * (x - med_x) / mad, 6) AS z FROM b JOIN m USING (event_type) JOIN d USING (event_type)
WHERE mad > 0 AND value >= q - 1e-6 AND value >= med * 3.0 - 1e-6 AND 0.6745 * (x - med_x) / mad >= 1.5 - 1e-6
""")
def amount_outlier_events(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("value >= 0").select("event_id", "event_type", "user_id", "value")
    return rounded(signals.robust_outliers(events, ["event_type"], "value", 1.5, 20, 3.0, 0.99).select("event_id", "event_type", "user_id", "value", "med", "z"), "med", "z")


@query(f"{_FRAGMENT} {_shown('s_fragment')}")
def fragmentation(spark, sf_dir):
    return _plain(signals.fragmentation(facts(spark, sf_dir, *detect("item fecha_documento")), T))


@query(f"{_spike('recipient_id').format(ratio=2.5)} {_shown('s_spike')}")
def year_end_spike(spark, sf_dir):
    return _plain(signals.year_end_spike(facts(spark, sf_dir, "recipient_id", "periodo", "mes", "monto_devengado", "transaction_id"), entity="recipient_id"))


@query(f"{_DUPLICATE.format(keys='transaction_fingerprint')} {_shown('s_duplicate')}")
def exact_duplicates(spark, sf_dir):
    f = facts(spark, sf_dir, *detect("transaction_fingerprint"))
    return _plain(signals.exact_duplicates(f, ["transaction_fingerprint"]))


@query(f"{_DUPLICATE.format(keys='numero_documento')} {_shown('s_duplicate')}")
def exact_duplicates_documents(spark, sf_dir):
    return _plain(signals.exact_duplicates(facts(spark, sf_dir, *detect("numero_documento")), ["numero_documento"]))


@query(f"{_concentrated('organization_id', T.concentration_min_share, T.concentration_min_hhi, T.concentration_min_amount)} {_shown('s_concentration')}")
def provider_concentration(spark, sf_dir):
    return _plain(signals.provider_concentration(facts(spark, sf_dir, *detect("")), T))


@query(f"{_concentrated('recipient_id', 0.15, 0.05, 1000.0).replace('min(recipient_id)', 'min(recipient_id)')} {_shown('s_concentration')}")
def provider_concentration_customers(spark, sf_dir):
    t = signals.Thresholds(concentration_min_share=0.15, concentration_min_hhi=0.05, concentration_min_amount=1000.0)
    f = facts(spark, sf_dir, *detect("")).withColumn("customer_id", F.col("recipient_id"))
    return _plain(signals.provider_concentration(f, t, "customer_id"))


@query(f"{_DELAY} {_shown('s_delay')}")
def payment_delay(spark, sf_dir):
    return _plain(signals.payment_delay(facts(spark, sf_dir, *detect("dias_de_pago")), T))


@query(f"""{_newcomer("recipient_id || '/' || provider_id")} {_shown('s_newcomer')}""")
def new_to_series(spark, sf_dir):
    f = materialize(facts(spark, sf_dir, *detect("")), "facts")  # read in several branches
    return _plain(signals.new_to_series(f, T, F.concat_ws("/", "recipient_id", "provider_id")))


_ALL = ",".join([_OUTLIER, _FRAGMENT, _spike("organization_id").format(ratio=T.spike_ratio), _DUPLICATE.format(keys=_DUP_KEYS), _concentrated("organization_id", T.concentration_min_share, T.concentration_min_hhi, T.concentration_min_amount), _DELAY, _newcomer("provider_id")]) + f""",
un AS ({' UNION ALL '.join(f'SELECT {_SIGNAL} FROM {t}' for t in ('s_outlier', 's_fragment', 's_spike', 's_duplicate', 's_concentration', 's_delay', 's_newcomer'))}),
sig AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY signal_id ORDER BY CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, round(coalesce(deviation, 0), 9) DESC, transaction_id, recipient_id) AS rn FROM un) WHERE rn = 1)"""


@query(f"{_ALL} {_shown('sig')}")
def signals_dedup(spark, sf_dir):
    return _plain(signals.all_signals(full_facts(spark, sf_dir), T))


@query(f"{_ALL} SELECT signal_type, severity, count(*) AS signals FROM sig GROUP BY ALL")
def signal_histogram(spark, sf_dir):
    return signals.all_signals(full_facts(spark, sf_dir), T).groupBy("signal_type", "severity").agg(F.count("*").alias("signals"))


_PRIORITY = _ALL + f""",
tc AS (SELECT transaction_id, min(coalesce(nullif(trim(nombre_area), ''), nullif(trim(nombre_capitulo), ''), nombre_partida)) AS organization_name, min(nombre_beneficiario) AS provider_or_recipient_name,
       max(monto_devengado) AS transaction_amount, bool_or(coalesce(trim(orden_compra), '') <> '') AS po, bool_or(coalesce(trim(codigo_bip), '') <> '') AS bip, min(region) AS region FROM facts GROUP BY 1),
ps AS (SELECT provider_id, count(DISTINCT signal_type) AS pt FROM sig WHERE coalesce(provider_id, '') <> '' AND signal_type <> 'YEAR_END_SPIKE' GROUP BY 1),
os AS (SELECT organization_id, count(DISTINCT signal_type) AS ot FROM sig WHERE coalesce(organization_id, '') <> '' GROUP BY 1),
pc AS (SELECT sig.*, organization_name, provider_or_recipient_name, transaction_amount, region, coalesce(pt, 0) AS provider_signal_types, coalesce(ot, 0) AS organization_signal_types,
       CASE severity WHEN 'HIGH' THEN 30 WHEN 'MEDIUM' THEN 20 ELSE 10 END AS severity_component,
       CASE signal_type {' '.join(f"WHEN '{k}' THEN {v}" for k, v in priority.TYPE_POINTS.items())} ELSE 6 END AS signal_component,
       CASE WHEN coalesce(pt, 0) >= 3 THEN 20 WHEN coalesce(pt, 0) >= 2 THEN 12 ELSE 0 END + CASE WHEN coalesce(ot, 0) >= 4 THEN 10 WHEN coalesce(ot, 0) >= 2 THEN 5 ELSE 0 END AS cooccurrence_component,
       CASE WHEN coalesce(po, FALSE) OR coalesce(bip, FALSE) THEN 5 ELSE 0 END AS actionability_component,
       CASE WHEN coalesce(transaction_amount, 0) >= 1e9 THEN 10 WHEN coalesce(transaction_amount, 0) >= 1e8 THEN 7 WHEN coalesce(transaction_amount, 0) >= 1e7 THEN 4 ELSE 0 END AS materiality_component
       FROM sig LEFT JOIN tc USING (transaction_id) LEFT JOIN ps USING (provider_id) LEFT JOIN os USING (organization_id)),
pr AS (SELECT *, least(100, severity_component + signal_component + cooccurrence_component + actionability_component + materiality_component) AS investigation_priority_score FROM pc),
pri AS (SELECT *, CASE WHEN investigation_priority_score >= 70 THEN 'P1' WHEN investigation_priority_score >= 50 THEN 'P2' ELSE 'P3' END AS priority_tier,
       'severidad=' || severity_component || ' | señal=' || signal_component || ' | coocurrencia=' || cooccurrence_component || ' | evidencia_CGR=0 | accionabilidad=' || actionability_component || ' | materialidad=' || materiality_component AS priority_explanation FROM pr)"""
_PRI_COLUMNS = "signal_id, organization_name, provider_or_recipient_name, transaction_amount, region, provider_signal_types, organization_signal_types, investigation_priority_score, priority_tier, priority_explanation"


def _prioritized(spark, sf_dir) -> DataFrame:
    f = full_facts(spark, sf_dir)
    return _ranked(f)


def _ranked(f: DataFrame) -> DataFrame:
    # Signals are read by four branches of the plan; small next to the facts.
    return priority.prioritize(materialize(signals.all_signals(f, T), "signals"), f)


@query(f"{_PRIORITY} SELECT {_PRI_COLUMNS} FROM pri")
def priority_score(spark, sf_dir):
    return _prioritized(spark, sf_dir).select(*_PRI_COLUMNS.split(", "))


@query(f"{_PRIORITY} SELECT {_PRI_COLUMNS} FROM pri ORDER BY investigation_priority_score DESC, CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, round(coalesce(deviation, 0), 6) DESC, signal_id LIMIT 250")
def investigation_queue_topk(spark, sf_dir):
    rows = _prioritized(spark, sf_dir).withColumn("deviation", F.round("deviation", 6))
    return priority.queue(rows).select(*_PRI_COLUMNS.split(", "))


@query(f"{_PRIORITY} SELECT priority_tier, count(*) AS signals FROM pri GROUP BY 1")
def priority_tiers(spark, sf_dir):
    return priority.tier_histogram(_prioritized(spark, sf_dir))


@query(f"""{_ALL}, p AS (SELECT 1)
SELECT (SELECT count(*) FROM facts) AS transactions, (SELECT count(DISTINCT organization_id) FROM facts) AS organizations, (SELECT count(DISTINCT recipient_id) FROM facts) AS recipients,
       (SELECT count(DISTINCT provider_id) FROM facts WHERE {PROVIDER}) AS providers, (SELECT {A} FROM facts) AS amount_devengado, (SELECT {money_sql('monto_pago')} FROM facts) AS amount_paid, (SELECT count(*) FROM sig) AS signals
""")
def dashboard_metrics(spark, sf_dir):
    from ..operators.dashboard import metrics

    f = full_facts(spark, sf_dir, "monto_pago")
    return metrics(f, signals.all_signals(f, T))


# --- rolling year ---------------------------------------------------------------------------------------------------

_ORG = "coalesce(nullif(trim(nombre_area), ''), nullif(trim(nombre_capitulo), ''), nullif(trim(nombre_partida), ''), organization_id)"
_PRV = "coalesce(nullif(trim(nombre_beneficiario), ''), provider_id)"
_L12 = """
fm AS (SELECT *, make_date(periodo, mes, 1) AS month_date, coalesce(CAST(monto_devengado AS DECIMAL(18,2)), 0) AS amount FROM facts WHERE mes BETWEEN 1 AND 12),
bo AS (SELECT max(month_date) AS e FROM fm WHERE amount <> 0),
l12 AS (SELECT fm.* FROM fm, bo WHERE month_date BETWEEN e - INTERVAL 11 MONTH AND e),
p12 AS (SELECT fm.* FROM fm, bo WHERE month_date BETWEEN e - INTERVAL 23 MONTH AND e - INTERVAL 12 MONTH)"""


def _sum(when: str = "") -> str:
    return f"CAST(sum(amount){f' FILTER (WHERE {when})' if when else ''} AS DOUBLE)"


def _rolling(spark, sf_dir, columns: str):
    f = facts(spark, sf_dir, *dict.fromkeys(f"periodo mes monto_devengado {columns}".split()))
    limits = spend.limits_of(f)
    return f, limits, *spend.window_of(f, limits)


@query(f"""{_L12}, c AS (SELECT CAST(e - to_months(11 - i) AS DATE) AS m FROM bo, range(12) t(i)),
s AS (SELECT month_date, {_sum()} AS a, {_sum(PROVIDER)} AS p, count(*) AS n FROM l12 GROUP BY 1)
SELECT strftime(m, '%Y-%m') AS period, coalesce(a, 0.0) AS amount_clp, coalesce(p, 0.0) AS provider_amount_clp, coalesce(n, 0) AS transactions FROM c LEFT JOIN s ON s.month_date = c.m""")
def l12_months_calendar(spark, sf_dir):
    _, limits, now, _ = _rolling(spark, sf_dir, "organization_id provider_id is_provider")
    return spend.monthly_calendar(now, limits)


@query(f"""{_L12}
SELECT coalesce(n.a, 0.0) AS amount_l12, t AS transactions_l12, o AS organizations_l12, p AS providers_l12, coalesce(pa, 0.0) AS provider_amount_l12, coalesce(b.a, 0.0) AS amount_prev12, round(n.a / nullif(b.a, 0) - 1, 6) AS variation_l12
FROM (SELECT {_sum()} AS a, count(*) AS t, count(DISTINCT organization_id) AS o, count(DISTINCT provider_id) FILTER (WHERE {PROVIDER}) AS p, {_sum(PROVIDER)} AS pa FROM l12) n, (SELECT {_sum()} AS a FROM p12) b""")
def l12_overview(spark, sf_dir):
    _, _, now, before = _rolling(spark, sf_dir, "organization_id provider_id is_provider")
    return rounded(spend.overview(now, before), "variation_l12")


def _dominant(value: str, size: str = "abs(amount)") -> str:
    return f"max(CASE WHEN {value} IS NOT NULL THEN {{'s': {size}, 'v': {value}}} END).v"


@query(f"""{_L12},
n AS (SELECT organization_id, {_dominant(_ORG)} AS organization_name, {_dominant("nullif(trim(region), '')")} AS main_region, {_sum()} AS amount_l12, count(*) AS transactions_l12,
      count(DISTINCT provider_id) FILTER (WHERE {PROVIDER}) AS providers_l12, {_sum(PROVIDER)} AS provider_amount_l12, {_sum("month(month_date) >= 10")} AS q4_amount FROM l12 GROUP BY 1),
b AS (SELECT organization_id, {_sum()} AS amount_prev12 FROM p12 GROUP BY 1),
s AS (SELECT organization_id, {_dominant("coalesce(nullif(trim(nombre_subtitulo), ''), subtitulo)", 'a')} AS dominant_subtitle FROM (SELECT organization_id, nombre_subtitulo, subtitulo, {_sum()} AS a FROM l12 GROUP BY ALL) GROUP BY 1)
SELECT n.*, amount_prev12, dominant_subtitle, round(amount_l12 / nullif(amount_prev12, 0) - 1, 6) AS variation_l12, round(q4_amount / nullif(amount_l12, 0), 6) AS q4_share
FROM n LEFT JOIN b USING (organization_id) LEFT JOIN s USING (organization_id) ORDER BY amount_l12 DESC, organization_id LIMIT 2000""")
def l12_services(spark, sf_dir):
    _, _, now, before = _rolling(spark, sf_dir, "organization_id provider_id is_provider nombre_area nombre_capitulo nombre_partida region nombre_subtitulo subtitulo")
    return rounded(spend.services(now, before), "variation_l12", "q4_share")


@query(f"{_L12} SELECT organization_id, strftime(month_date, '%Y-%m') AS period, {_sum()} AS amount_clp, {_sum(PROVIDER)} AS provider_amount_clp FROM l12 GROUP BY ALL")
def l12_service_months(spark, sf_dir):
    _, _, now, _ = _rolling(spark, sf_dir, "organization_id provider_id is_provider")
    return spend.service_months(now)


_PAIRS = f"""{_L12},
pa AS (SELECT organization_id, provider_id, {_dominant(_ORG)} AS organization_name, {_dominant(_PRV)} AS provider_name, {_sum()} AS amount_clp, count(*) AS transactions, count(DISTINCT month_date) AS months_active, max(month_date) AS last_month
       FROM l12 WHERE {PROVIDER} GROUP BY 1, 2),
en AS (SELECT *, sum(amount_clp) OVER (PARTITION BY organization_id) AS so, sum(amount_clp) OVER (PARTITION BY provider_id) AS sp, row_number() OVER (PARTITION BY organization_id ORDER BY amount_clp DESC, provider_id) AS rn FROM pa),
fl AS (SELECT * FROM en WHERE rn <= 8 ORDER BY amount_clp DESC, organization_id, provider_id LIMIT 12000)"""
_PAIR_COLUMNS = "organization_id provider_id is_provider nombre_area nombre_capitulo nombre_partida nombre_beneficiario"


@query(f"""{_PAIRS} SELECT organization_id, provider_id, organization_name, provider_name, amount_clp, transactions, months_active, last_month, round(so, 2) AS service_provider_amount, round(sp, 2) AS provider_amount,
round(amount_clp / so, 6) AS share_of_service, round(amount_clp / sp, 6) AS share_of_provider FROM fl""")
def l12_flows_topk(spark, sf_dir):
    _, _, now, _ = _rolling(spark, sf_dir, _PAIR_COLUMNS)
    return rounded(spend.flows(spend.pairs(now)), "share_of_service", "share_of_provider")


@query(f"""{_PAIRS}, m AS (SELECT organization_id, provider_id, strftime(month_date, '%Y-%m') AS period, {_sum()} AS a, count(*) AS n FROM l12 SEMI JOIN fl USING (organization_id, provider_id) WHERE {PROVIDER} GROUP BY ALL)
SELECT organization_id, provider_id, string_agg(period || '=' || CAST(CAST(a AS DECIMAL(20,2)) AS VARCHAR) || '/' || n, ' ' ORDER BY period) AS monthly FROM m GROUP BY 1, 2""")
def l12_flow_months(spark, sf_dir):
    _, _, now, _ = _rolling(spark, sf_dir, _PAIR_COLUMNS)
    nested = spend.flow_months(now, spend.flows(spend.pairs(now)))
    shown = F.transform("monthly", lambda m: F.concat(m["period"], F.lit("="), m["amount_clp"].cast("decimal(20,2)").cast("string"), F.lit("/"), m["transactions"].cast("string")))
    return nested.select("organization_id", "provider_id", F.array_join(shown, " ").alias("monthly"))


@query(f"""{_L12},
n AS (SELECT provider_id, {_dominant(_PRV)} AS provider_name, {_sum()} AS amount_l12, count(*) AS transactions_l12, count(DISTINCT organization_id) AS organizations_l12, count(DISTINCT month_date) AS months_active,
      {_sum("month(month_date) >= 10")} AS q4_amount, round(avg(CASE WHEN coalesce(trim(orden_compra), '') = '' THEN 1.0 ELSE 0.0 END), 6) AS missing_oc_share FROM l12 WHERE {PROVIDER} GROUP BY 1),
b AS (SELECT provider_id, {_sum()} AS amount_prev12 FROM p12 WHERE {PROVIDER} GROUP BY 1), fs AS (SELECT provider_id, min(month_date) AS first_seen FROM fm WHERE {PROVIDER} GROUP BY 1),
c AS (SELECT provider_id, organization_id, {_sum()} AS a FROM l12 WHERE {PROVIDER} GROUP BY 1, 2), t AS (SELECT provider_id, {_dominant('organization_id', 'a')} AS top_client_id, max(a) AS top_client_amount FROM c GROUP BY 1)
SELECT n.*, amount_prev12, first_seen, top_client_id, top_client_amount, round(amount_l12 / nullif(amount_prev12, 0) - 1, 6) AS variation_l12, round(q4_amount / nullif(amount_l12, 0), 6) AS q4_share,
       round(top_client_amount / nullif(amount_l12, 0), 6) AS dependence_top_client
FROM n LEFT JOIN b USING (provider_id) LEFT JOIN fs USING (provider_id) LEFT JOIN t USING (provider_id) ORDER BY amount_l12 DESC, provider_id LIMIT 1500""")
def l12_providers(spark, sf_dir):
    f, _, now, before = _rolling(spark, sf_dir, "organization_id provider_id is_provider nombre_beneficiario orden_compra")
    return rounded(spend.providers(f, now, before), "missing_oc_share", "variation_l12", "q4_share", "dependence_top_client")


@query(f"""{_L12}, p AS (SELECT provider_id, {_sum()} AS a FROM l12 WHERE {PROVIDER} GROUP BY 1), r AS (SELECT a, row_number() OVER (ORDER BY a DESC, provider_id) AS rn, sum(a) OVER () AS t FROM p)
SELECT round(coalesce(sum(a) FILTER (WHERE rn <= 10) / max(t), 0), 6) AS top10_provider_share, round(coalesce(sum(power(a / t, 2)), 0), 8) AS provider_hhi, round(max(t), 2) AS total FROM r""")
def l12_concentration(spark, sf_dir):
    _, _, now, _ = _rolling(spark, sf_dir, "provider_id is_provider")
    return rounded(rounded(spend.concentration(now), "top10_provider_share"), "provider_hhi", digits=8)


@query(f"""{_L12}, p AS (SELECT organization_id, provider_id, {_dominant(_PRV)} AS provider_name, {_sum()} AS a FROM l12 WHERE {PROVIDER} GROUP BY 1, 2),
x AS (SELECT *, sum(a) OVER (PARTITION BY organization_id) AS t, row_number() OVER (PARTITION BY organization_id ORDER BY a DESC, provider_id) AS rn FROM p)
SELECT organization_id, max(provider_id) FILTER (WHERE rn = 1) AS top_provider_id, max(provider_name) FILTER (WHERE rn = 1) AS top_provider_name, round(max(CASE WHEN rn = 1 THEN a / t END), 6) AS top_provider_share,
       round(sum(power(a / t, 2)), 8) AS provider_hhi FROM x GROUP BY 1""")
def l12_service_concentration(spark, sf_dir):
    _, _, now, _ = _rolling(spark, sf_dir, "organization_id provider_id is_provider nombre_beneficiario")
    return rounded(rounded(spend.service_concentration(now), "top_provider_share"), "provider_hhi", digits=8)


_WINDOW = "make_date(periodo, coalesce(mes, 1), 1) BETWEEN (SELECT e - INTERVAL 11 MONTH FROM bo) AND (SELECT e FROM bo)"


@query(f"{_PRIORITY}, {_L12} SELECT organization_id, count(*) AS signal_count, count(*) FILTER (WHERE priority_tier = 'P1') AS p1_count, max(investigation_priority_score) AS max_priority_score FROM pri WHERE coalesce(organization_id, '') <> '' AND {_WINDOW} GROUP BY 1")
def l12_signal_overlay_services(spark, sf_dir):
    limits = spend.limits_of(facts(spark, sf_dir, "periodo", "mes", "monto_devengado"))
    return spend.signal_overlay(_prioritized(spark, sf_dir), limits, "organization_id")


@query(f"{_PRIORITY}, {_L12} SELECT provider_id, count(*) AS signal_count, count(*) FILTER (WHERE priority_tier = 'P1') AS p1_count, max(investigation_priority_score) AS max_priority_score FROM pri WHERE coalesce(provider_id, '') <> '' AND {_WINDOW} GROUP BY 1")
def l12_signal_overlay_providers(spark, sf_dir):
    limits = spend.limits_of(facts(spark, sf_dir, "periodo", "mes", "monto_devengado"))
    return spend.signal_overlay(_prioritized(spark, sf_dir), limits, "provider_id")


# --- territory and documents ----------------------------------------------------------------------------------------


@query(f"""{_PRIORITY},
s AS (SELECT coalesce(nullif(trim(region), ''), 'UNKNOWN') AS region, count(*) AS transactions, coalesce({A}, 0) AS amount_clp, count(DISTINCT organization_id) AS organizations, count(DISTINCT provider_id) FILTER (WHERE coalesce(provider_id, '') <> '') AS providers FROM facts GROUP BY 1),
g AS (SELECT coalesce(nullif(trim(region), ''), 'UNKNOWN') AS region, count(*) AS anomaly_signals, count(*) FILTER (WHERE priority_tier = 'P1') AS p1_signals, count(*) FILTER (WHERE severity = 'HIGH') AS high_severity_signals,
      round(avg(investigation_priority_score), 3) AS avg_investigation_priority, CAST(0 AS BIGINT) AS cgr_linked_signals, count(DISTINCT signal_type) AS signal_type_count FROM pri GROUP BY 1)
SELECT s.*, coalesce(anomaly_signals, 0) AS anomaly_signals, coalesce(p1_signals, 0) AS p1_signals, coalesce(high_severity_signals, 0) AS high_severity_signals, avg_investigation_priority, coalesce(cgr_linked_signals, 0) AS cgr_linked_signals,
       coalesce(signal_type_count, 0) AS signal_type_count, round(100000.0 * coalesce(p1_signals, 0) / transactions, 4) AS p1_per_100k_transactions, round(100000.0 * coalesce(anomaly_signals, 0) / transactions, 4) AS signals_per_100k_transactions,
       round(amount_clp / transactions, 2) AS amount_per_transaction FROM s LEFT JOIN g USING (region)""")
def territorial_regions(spark, sf_dir):
    f = full_facts(spark, sf_dir)
    return territory.regions(f, _ranked(f))


@query(f"""{_PRIORITY},
s AS (SELECT region, codigo_ubicacion_geografica AS geographic_unit_code, nombre_ubicacion_geografica AS geographic_unit_name, count(*) AS transactions, coalesce({A}, 0) AS amount_clp, count(DISTINCT organization_id) AS organizations,
      count(DISTINCT provider_id) FILTER (WHERE coalesce(provider_id, '') <> '') AS providers FROM facts GROUP BY 1, 2, 3),
w AS (SELECT transaction_id, min(region) AS region, min(codigo_ubicacion_geografica) AS geographic_unit_code, min(nombre_ubicacion_geografica) AS geographic_unit_name FROM facts GROUP BY 1),
g AS (SELECT w.region, geographic_unit_code, geographic_unit_name, count(*) AS anomaly_signals, count(*) FILTER (WHERE priority_tier = 'P1') AS p1_signals, round(avg(investigation_priority_score), 3) AS avg_investigation_priority
      FROM pri JOIN w USING (transaction_id) GROUP BY 1, 2, 3)
SELECT s.*, coalesce(anomaly_signals, 0) AS anomaly_signals, coalesce(p1_signals, 0) AS p1_signals, avg_investigation_priority, round(100000.0 * coalesce(p1_signals, 0) / transactions, 4) AS p1_per_100k_transactions
FROM s LEFT JOIN g USING (region, geographic_unit_code, geographic_unit_name)""")
def geo_units(spark, sf_dir):
    f = full_facts(spark, sf_dir)
    return territory.geographic_units(f, _ranked(f))


@query("""x AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY fecha_documento DESC, periodo DESC, mes DESC, transaction_id DESC) AS rn FROM facts WHERE is_provider AND NOT is_intra_state AND NOT is_person AND fecha_documento IS NOT NULL)
SELECT entity_id, rut_beneficiario AS rut, nombre_beneficiario AS provider_name, tipo_documento, numero_documento, fecha_documento, transaction_id, transaction_fingerprint, periodo, mes, source_file, source_row_number,
       'PRESUPUESTO_ABIERTO' AS candidate_source, 'SPECIFIC_DOCUMENT_VERIFICATION_CANDIDATE' AS observation_intent FROM x WHERE rn = 1""")
def latest_document_per_entity(spark, sf_dir):
    columns = "entity_id rut_beneficiario nombre_beneficiario tipo_documento numero_documento folio fecha_documento transaction_id transaction_fingerprint periodo mes source_file source_row_number is_provider is_intra_state is_person"
    return documents.latest_documents(facts(spark, sf_dir, *columns.split()))


# --- search ---------------------------------------------------------------------------------------------------------

_BLOB = "lower(concat_ws(' ', coalesce(nombre_beneficiario, ''), coalesce(rut_beneficiario, ''), coalesce(nombre_partida, ''), coalesce(nombre_capitulo, ''), coalesce(nombre_area, ''), coalesce(nombre_subtitulo, ''), coalesce(nombre_item, ''), coalesce(numero_documento, ''), coalesce(tipo_documento, ''), coalesce(orden_compra, ''), coalesce(codigo_bip, ''), coalesce(nombre_ubicacion_geografica, ''), coalesce(region, ''), coalesce(sector, '')))"
_ORDERS = {
    "date_amount": "periodo DESC, mes DESC, monto_devengado DESC", "amount_desc": "monto_devengado DESC, periodo DESC, mes DESC",
    "amount_asc": "monto_devengado ASC, periodo DESC, mes DESC", "oldest": "periodo ASC, mes ASC, monto_devengado DESC",
}
_HIT = "transaction_id, organization_id, provider_id, periodo, mes, monto_devengado"
_SEARCH_COLUMNS = "nombre_beneficiario rut_beneficiario nombre_partida nombre_capitulo nombre_area nombre_subtitulo nombre_item numero_documento tipo_documento orden_compra codigo_bip nombre_ubicacion_geografica region sector"

SEARCHES: dict[str, tuple[dict, str]] = {
    "all": ({"text": "Éurope brand#1 mach"}, f"{_BLOB} LIKE '%europe%' AND {_BLOB} LIKE '%brand#1%' AND {_BLOB} LIKE '%mach%'"),
    "any": ({"text": "unit 3 machinery", "text_mode": "any", "limit": 200}, f"({_BLOB} LIKE '%unit%' OR {_BLOB} LIKE '%3%' OR {_BLOB} LIKE '%machinery%')"),
    "phrase": ({"text": "Unit 7", "text_mode": "phrase", "sort_by": "amount_desc"}, f"{_BLOB} LIKE '%unit 7%'"),
    "exclude": ({"text": "asia", "exclude_text": "oc- promo", "limit": 150}, f"{_BLOB} LIKE '%asia%' AND {_BLOB} NOT LIKE '%oc-%' AND {_BLOB} NOT LIKE '%promo%'"),
    "exclude_fields": ({"text": "asia", "search_fields": ["geography"], "exclude_text": "household", "sort_by": "oldest"},
                       "lower(concat_ws(' ', nombre_ubicacion_geografica, region, sector)) LIKE '%asia%' AND lower(concat_ws(' ', nombre_ubicacion_geografica, region, sector)) NOT LIKE '%household%'"),
    "amount_range": ({"min_amount": 50000, "max_amount": 50500, "sort_by": "amount_asc", "limit": 500}, "monto_devengado >= 50000 AND monto_devengado <= 50500"),
    "paid_range": ({"min_paid_amount": 90000, "min_payment_days": 30, "max_payment_days": 400, "sort_by": "amount_desc"}, "monto_pago >= 90000 AND dias_de_pago >= 30 AND dias_de_pago <= 400"),
    "date_range": ({"date_from": "1996-01-01", "date_to": "1996-03-31", "provider_only": True, "sort_by": "oldest"}, "coalesce(fecha_documento, fecha_pago) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' AND is_provider"),
    "budget_prefix": ({"budget_code": "Brand#2", "year": 1999, "month": 4}, "concat_ws('.', subtitulo, item, asignacion) LIKE 'Brand#2%' AND periodo = 1999 AND mes = 4"),
    "presence": ({"has_purchase_order": True, "has_bip": False, "has_valid_rut": True, "aggregated_only": False, "person_only": False, "intra_state_only": False, "honorarium_only": True, "floating_debt_only": True},
                 "coalesce(orden_compra, '') <> '' AND coalesce(codigo_bip, '') = '' AND coalesce(rut_beneficiario, '') <> '' AND NOT is_aggregated AND NOT is_person AND NOT is_intra_state AND is_honorarium AND is_floating_debt"),
    "identity": ({"organization_id": "ORG-03", "region": "europe", "sector": "BUILD", "currency": "clp", "document_type": "a", "sort_by": "amount_desc"}, "organization_id = 'ORG-03' AND lower(region) LIKE '%europe%' AND lower(sector) LIKE '%build%' AND lower(tipo_documento) LIKE '%a%'"),
    "provider": ({"limit": 300, "provider_id": "PRV-000005"}, "provider_id = 'PRV-000005'"),
}


def _register_search(name: str, filters: dict, where: str) -> None:
    def run(spark, sf_dir):
        used = f"{_HIT.replace(',', '')} monto_pago dias_de_pago fecha_documento fecha_pago subtitulo item asignacion is_provider is_person is_honorarium is_intra_state is_floating_debt is_aggregated moneda_presupuestaria {_SEARCH_COLUMNS}"
        rows = facts(spark, sf_dir, *dict.fromkeys(used.split()))
        return search.search(rows, **{k: v for k, v in filters.items() if v is not None}).select(*_HIT.split(", "))

    run.__name__ = f"hybrid_search_{name}"
    order, limit = _ORDERS[filters.get("sort_by", "date_amount")], filters.get("limit", 100)
    query(f"x AS (SELECT 1) SELECT {_HIT} FROM facts WHERE {where} ORDER BY {order}, transaction_id LIMIT {limit}")(run)


for _name, (_filters, _where) in SEARCHES.items():
    _register_search(_name, _filters, _where)


@query(f"""h AS (SELECT * FROM facts WHERE periodo IN (1996, 1998) AND lower(concat_ws(' ', nombre_partida, nombre_capitulo, nombre_area)) LIKE '%europe%' ORDER BY monto_devengado DESC, periodo DESC, mes DESC, transaction_id LIMIT 500)
SELECT organization_id, nombre_partida, nombre_capitulo, count(*) AS transacciones, {A} AS monto_devengado, {money_sql('monto_pago')} AS monto_pagado, min(periodo) AS primer_periodo, max(periodo) AS ultimo_periodo FROM h GROUP BY 1, 2, 3""")
def multi_year_summaries(spark, sf_dir):
    rows = facts(spark, sf_dir, *"transaction_id organization_id nombre_partida nombre_capitulo nombre_area periodo mes monto_devengado monto_pago".split())
    return search.search_years(rows, [1996, 1998], text="europe", search_fields=["institution"], sort_by="amount_desc", limit=500)["organizations"]


@query("x AS (SELECT unnest([1990, 1996, 2030]) AS periodo) SELECT CAST(periodo AS BIGINT) AS periodo FROM x ANTI JOIN facts USING (periodo)")
def multi_year_gaps(spark, sf_dir):
    rows = facts(spark, sf_dir, *"transaction_id organization_id periodo mes monto_devengado monto_pago".split())
    return search.search_years(rows, [1990, 1996, 2030])["gaps"]


@query()
def bm25_search(spark, sf_dir):
    """Ranking over whole documents; held against an embedded full-text engine in the tests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    index = fulltext.build_index(docs, "doc_id", ["text", "source"])
    return rounded(fulltext.search(index, 'the AND (th* OR "of the") NOT und', 100), "rank")


_BM25 = """c AS (SELECT transaction_id, lower(concat_ws(' ', nombre_beneficiario, nombre_item, region)) AS b FROM facts),
t AS (SELECT transaction_id, [x for x in regexp_split_to_array(b, '[^a-z0-9]+') if x <> ''] AS w FROM c), l AS (SELECT transaction_id, len(w) AS dl FROM t), g AS (SELECT count(*) AS n, avg(dl) AS av FROM l),
h AS (SELECT transaction_id, tok, count(*) AS tf FROM (SELECT transaction_id, unnest(w) AS tok FROM t) WHERE tok IN ('asia', 'promo') GROUP BY 1, 2), d AS (SELECT tok, count(*) AS df FROM h GROUP BY 1),
s AS (SELECT transaction_id, sum((CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / av))) AS score FROM h JOIN d USING (tok) JOIN l USING (transaction_id), g GROUP BY 1)
SELECT transaction_id AS doc, round(-score, 6) AS rank FROM s ORDER BY round(-score, 6), transaction_id LIMIT 50"""


@query(_BM25)
def bm25_facts(spark, sf_dir):
    rows = materialize(facts(spark, sf_dir, "transaction_id", "nombre_beneficiario", "nombre_item", "region"), "facts")  # read in several branches
    index = fulltext.build_index(rows, "transaction_id", ["nombre_beneficiario", "nombre_item", "region"])
    return rounded(fulltext.search(index, "asia OR promo", 50), "rank")


@query(_BM25)
def fts_segments(spark, sf_dir):
    """The same ranking from a kept index: two increments, of which the second mends a tenth of the first, a deletion, and merging."""
    fields = ["nombre_beneficiario", "nombre_item", "region"]
    rows = materialize(facts(spark, sf_dir, "transaction_id", *fields).withColumn("k", F.pmod(F.crc32("transaction_id"), F.lit(20))), "indexed")
    extra = F.concat(F.lit("X-"), "transaction_id")
    wrong = {f: F.when(F.col("k") < 2, "asia promo").otherwise(F.col(f)) for f in fields}
    first = rows.filter("k < 10 or k = 19").withColumns(wrong | {"transaction_id": F.when(F.col("k") == 19, extra).otherwise(F.col("transaction_id"))})
    index = SegmentedIndex.create(spark, f"{shared_dir(spark)}/index", "transaction_id", fields)
    index = index.add(first).add(rows.filter("k < 2 or k > 9")).delete(rows.filter("k = 19").select(extra.alias("transaction_id")))
    return rounded(index.merge().search("asia OR promo", 50), "rank")


# The least start of a phrase at which all of its words stand, for the words of a text numbered from 0.
_NEAR_SQL = """t AS (SELECT doc_id, [x for x in regexp_split_to_array(lower(strip_accents(coalesce(text, ''))), '[^\\p{L}\\p{N}]+') if x <> ''] AS w FROM documents),
g AS (SELECT count(*) AS n, avg(len(w)) AS av FROM t), p AS (SELECT doc_id, unnest(w) AS tok, unnest(range(len(w))) AS p FROM t),
i AS (SELECT a.doc_id, a.p, 0 AS j FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.p = a.p + 1 WHERE a.tok = 'of' AND b.tok = 'the' UNION ALL SELECT doc_id, p, 1 FROM p WHERE starts_with(tok, 'th')),
c AS (SELECT DISTINCT doc_id, p AS m FROM i z WHERE EXISTS (FROM i x WHERE x.doc_id = z.doc_id AND j = 0 AND x.p BETWEEN z.p - 4 AND z.p) AND EXISTS (FROM i x WHERE x.doc_id = z.doc_id AND j = 1 AND x.p BETWEEN z.p - 3 AND z.p)),
h AS (SELECT doc_id, j, count(*) AS tf FROM i WHERE EXISTS (FROM c WHERE c.doc_id = i.doc_id AND m BETWEEN i.p AND i.p + CASE j WHEN 0 THEN 4 ELSE 3 END) GROUP BY 1, 2),
d AS (SELECT j, count(DISTINCT doc_id) AS df FROM i GROUP BY 1),
s AS (SELECT h.doc_id, sum((CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / av))) AS score FROM h JOIN d USING (j) JOIN t USING (doc_id), g GROUP BY 1)"""


@query(f"WITH {_NEAR_SQL} SELECT doc_id AS doc, round(-score, 6) AS rank FROM s")
def fts_near(spark, sf_dir):
    """A phrase and a prefix with at most two words between, over whole documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return rounded(fulltext.search(fulltext.build_index(docs, "doc_id", ["text"]), 'text : NEAR("of the" th*, 2)', None), "rank")


# --- several years --------------------------------------------------------------------------------------------------

_PATTERNS = ("NATION 1", "SUPPLIER#00000001", "SUPPLIER 00000001")
_FOLD = "trim(regexp_replace(upper({}), '[^A-Z0-9]+', ' ', 'g'))"
_EDGES = f"""
re AS (SELECT organization_id, provider_id, periodo AS year, {_dominant("coalesce(nullif(trim(nombre_capitulo), ''), organization_id)", 'abs(monto_devengado)')} AS organization_name, {_dominant(_PRV, 'abs(monto_devengado)')} AS provider_name,
       coalesce({A}, 0.0) AS amount_clp, count(*) AS transactions FROM facts WHERE {PROVIDER} GROUP BY 1, 2, 3 HAVING coalesce({A}, 0.0) <> 0),
ed AS (SELECT * FROM re WHERE NOT regexp_matches({_FOLD.format('provider_name')}, '{'|'.join(_PATTERNS)}'))"""
_YEAR_COLUMNS = "organization_id provider_id is_provider periodo mes nombre_capitulo nombre_beneficiario monto_devengado"


def _edges(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    f = facts(spark, sf_dir, *_YEAR_COLUMNS.split())
    names = multiyear.service_names(multiyear.service_years(f))
    return f, multiyear.private_edges(multiyear.relations(f), names, patterns=_PATTERNS)


def _written_edges(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """For plans that read the relations in several branches."""
    f, edges = _edges(spark, sf_dir)
    return f, materialize(edges, "relations")


@query(f"""x AS (SELECT organization_id, periodo AS year, {_dominant("coalesce(nullif(trim(nombre_capitulo), ''), organization_id)", 'abs(monto_devengado)')} AS organization_name, coalesce({A}, 0.0) AS amount_clp, count(*) AS transactions FROM facts GROUP BY 1, 2)
SELECT * FROM x""")
def multiyear_services(spark, sf_dir):
    return multiyear.service_years(facts(spark, sf_dir, "organization_id", "periodo", "nombre_capitulo", "monto_devengado"))


@query(f"{_EDGES} SELECT * FROM ed")
def public_name_exclusion(spark, sf_dir):
    return _edges(spark, sf_dir)[1]


@query(f"{_EDGES}, p AS (SELECT provider_id, year, round(sum(amount_clp), 2) AS amount_clp, sum(transactions)::BIGINT AS transactions, count(DISTINCT organization_id) AS organizations FROM ed GROUP BY 1, 2) SELECT *, min(year) OVER (PARTITION BY provider_id) AS first_year FROM p")
def multiyear_providers(spark, sf_dir):
    return multiyear.provider_years(_edges(spark, sf_dir)[1])


_MARK_RULES = multiyear.MarkRules(spike=1.2, min_share=0.03, min_hhi=0.005, min_amount=1000.0, newcomer_amount=1000.0, min_tx=1)
_MARKS = _EDGES + f""",
mm AS (SELECT organization_id, periodo AS year, mes, {A} AS a FROM facts GROUP BY ALL), me AS (SELECT organization_id, year, avg(a) FILTER (WHERE mes <= 10) AS base, avg(a) FILTER (WHERE mes > 10) AS en FROM mm GROUP BY 1, 2),
mw AS (SELECT *, sum(amount_clp) OVER w AS t, count(*) OVER w AS n, row_number() OVER (PARTITION BY organization_id, year ORDER BY amount_clp DESC, provider_id) AS rn FROM ed WINDOW w AS (PARTITION BY organization_id, year)),
mh AS (SELECT *, sum(power(amount_clp / t, 2)) OVER (PARTITION BY organization_id, year) AS h FROM mw),
mp AS (SELECT provider_id, year, round(sum(amount_clp), 2) AS a, count(DISTINCT organization_id) AS o, sum(transactions) AS tx FROM ed GROUP BY 1, 2), mf AS (SELECT *, min(year) OVER (PARTITION BY provider_id) AS fy FROM mp),
mn AS (SELECT * FROM mf WHERE year = (SELECT max(periodo) FROM facts) AND fy = year AND tx >= 1),
mk AS (SELECT 'service' AS scope, organization_id AS entity_id, NULL AS organization_id, year, 'YEAR_END_SPIKE' AS signal_type, 'MEDIUM' AS severity, en / base AS metric, CAST(NULL AS DOUBLE) AS hhi FROM me WHERE base > 0 AND en / base >= 1.2 - 1e-6
 UNION ALL SELECT 'provider', provider_id, organization_id, year, 'PROVIDER_CONCENTRATION', CASE WHEN amount_clp / t >= 0.65 - 1e-6 OR h >= 0.4 - 1e-6 THEN 'HIGH' ELSE 'MEDIUM' END, amount_clp / t, h FROM mh WHERE rn = 1 AND t > 0 AND n >= 8 AND amount_clp / t >= 0.03 - 1e-6 AND h >= 0.005 - 1e-6 AND amount_clp >= 1000
 UNION ALL SELECT 'provider', provider_id, NULL, year, 'NEW_TO_SERIES_HIGH_SPEND', CASE WHEN o >= 3 THEN 'HIGH' ELSE 'MEDIUM' END, a, NULL FROM mn WHERE a >= greatest(1000.0, coalesce((SELECT quantile_disc(a, 0.99) FROM mn), 0)))"""


@query(f"{_MARKS} SELECT scope, entity_id, organization_id, year, signal_type, severity, round(metric, 6) AS metric, round(hhi, 6) AS hhi FROM mk")
def multiyear_marks(spark, sf_dir):
    return rounded(multiyear.marks(*_written_edges(spark, sf_dir), _MARK_RULES), "metric", "hhi")


@query(f"""{_MARKS}, sz AS (SELECT provider_id, round(abs(sum(amount_clp)), 2) AS size FROM ed GROUP BY 1), pl AS (SELECT provider_id FROM sz ORDER BY size DESC, provider_id LIMIT 40),
se AS (SELECT provider_id FROM pl UNION SELECT entity_id FROM mk WHERE scope = 'provider'), rr AS (SELECT *, row_number() OVER (PARTITION BY organization_id, year ORDER BY abs(amount_clp) DESC, provider_id) AS rn FROM ed)
SELECT organization_id, provider_id, year, organization_name, provider_name, amount_clp, transactions FROM rr WHERE rn <= 3 OR provider_id IN (SELECT provider_id FROM se)""")
def multiyear_flows(spark, sf_dir):
    f, edges = _written_edges(spark, sf_dir)
    return multiyear.publish(edges, multiyear.marks(f, edges, _MARK_RULES), max_seeds=40, max_flows=10_000_000)


@query(f"""p AS (SELECT provider_id, strftime(fecha_pago, '%Y-%m') AS period, {money_sql('monto_pago')} AS a, count(*) AS n FROM facts WHERE {PROVIDER} AND fecha_pago IS NOT NULL AND coalesce(monto_pago, 0) <> 0 GROUP BY 1, 2)
SELECT provider_id, period, a AS amount_clp, n AS transactions FROM p""")
def payment_months(spark, sf_dir):
    return multiyear.payment_months(facts(spark, sf_dir, "provider_id", "is_provider", "fecha_pago", "monto_pago"))


@query(f"p AS (SELECT provider_id, printf('%04d-%02d', periodo, mes) AS period, {A} AS amount_clp, count(*) AS transactions FROM facts WHERE {PROVIDER} GROUP BY 1, 2) SELECT * FROM p WHERE amount_clp <> 0")
def accrual_months(spark, sf_dir):
    return multiyear.accrual_months(facts(spark, sf_dir, "provider_id", "is_provider", "periodo", "mes", "monto_devengado"))


@query(f"""{_EDGES}, e AS (SELECT organization_id, provider_id, provider_name, sum(amount_clp) AS amount_clp FROM re GROUP BY ALL), x AS (SELECT * FROM e WHERE NOT regexp_matches({_FOLD.format('provider_name')}, '{'|'.join(PUBLIC_PATTERNS)}')),
r AS (SELECT *, row_number() OVER (PARTITION BY organization_id ORDER BY round(amount_clp, 2) DESC, provider_id) AS rn FROM x), o AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN rn > 2 THEN 1 ELSE 0 END, round(amount_clp, 2) DESC, organization_id, provider_id) AS g FROM r)
SELECT organization_id, provider_id, provider_name, round(amount_clp, 2) AS amount_clp FROM o WHERE g <= 300 OR rn <= 2""")
def k_per_group_then_fill(spark, sf_dir):
    f = facts(spark, sf_dir, *_YEAR_COLUMNS.split())
    edges = multiyear.relations(f).groupBy("organization_id", "provider_id", "provider_name").agg(total("amount_clp").alias("amount_clp"))
    none = spark.range(0).select(F.lit("").alias("provider_id"), F.lit("").alias("provider_name"))
    return spend.compact(edges, none, multiyear.service_names(multiyear.service_years(f)), cap=300)[0]


_PROXY = "NOT coalesce(is_aggregated, FALSE) AND coalesce(rut_beneficiario, '') <> '' AND ltrim(coalesce(subtitulo, ''), '0') <> '21'"


@query(f"""y AS (SELECT * FROM facts WHERE periodo = 1997)
SELECT count(DISTINCT organization_id) AS services_with_rows, count(DISTINCT organization_id) FILTER (WHERE {OWN}) AS transactional_services, coalesce({A}, 0) AS devengo_clp, coalesce({money_sql('monto_pago')}, 0) AS payment_clp,
count(DISTINCT rut_beneficiario) FILTER (WHERE {_PROXY}) AS receiver_ruts, coalesce({money_sql(when=_PROXY)}, 0) AS receiver_clp, count(DISTINCT provider_id) FILTER (WHERE {PROVIDER}) AS provider_ids, coalesce({money_sql(when=PROVIDER)}, 0) AS provider_clp FROM y""")
def parity_metrics(spark, sf_dir):
    return multiyear.parity_metrics(facts(spark, sf_dir, *"organization_id is_aggregated monto_devengado monto_pago rut_beneficiario subtitulo provider_id is_provider periodo".split()), 1997)


@query(f"""y AS (SELECT * FROM facts WHERE periodo = 1997 AND {_PROXY})
SELECT rut_beneficiario, {_dominant('nombre_beneficiario', 'abs(monto_devengado)')} AS provider_name, {A} AS amount_clp FROM y GROUP BY 1 ORDER BY amount_clp DESC, rut_beneficiario LIMIT 30""")
def parity_receiver_proxy(spark, sf_dir):
    return multiyear.parity_top(facts(spark, sf_dir, *"is_aggregated monto_devengado rut_beneficiario nombre_beneficiario subtitulo periodo".split()), 1997)

@query(f"""m AS (SELECT * FROM facts WHERE periodo = 1997 AND {PROVIDER} AND nombre_area = 'NATION_7'), t AS (SELECT {money_sql('monto_pago')} AS w FROM m)
SELECT provider_id, {_dominant('nombre_beneficiario', 'abs(monto_pago)')} AS provider_name, {money_sql('monto_pago')} AS amount_paid, count(*) AS payment_rows, count(DISTINCT numero_documento) AS distinct_documents,
       string_agg(DISTINCT lpad(CAST(mes AS VARCHAR), 2, '0'), ',' ORDER BY lpad(CAST(mes AS VARCHAR), 2, '0')) AS months_with_payments, round({money_sql('monto_pago')} / any_value(w), 6) AS share FROM m, t GROUP BY 1""")
def reference_payments(spark, sf_dir):
    f = facts(spark, sf_dir, *"periodo mes provider_id is_provider nombre_partida nombre_capitulo nombre_area nombre_beneficiario monto_pago numero_documento".split())
    rows = multiyear.reference_payments(f, "nation 7", 1997)
    return rounded(rows.withColumn("months_with_payments", F.array_join(F.transform("months_with_payments", lambda m: F.lpad(m.cast("string"), 2, "0")), ",")), "share")


@query("""r AS (SELECT partida, capitulo, nombre_capitulo, nombre_beneficiario, periodo, mes, monto_devengado, is_provider AS src, is_intra_state AS intra FROM facts),
p AS (SELECT *, nombre_beneficiario LIKE '%00000001%' AS pub FROM r)
SELECT 'ORG-PA-' || partida || '-' || capitulo AS organization_id, src AS is_provider_source, src AND NOT intra AND NOT pub AS is_provider, pub AS is_public_counterparty_name, count(*) AS n, CAST(sum(CAST(monto_devengado AS DECIMAL(18,2))) AS DOUBLE) AS amount_clp
FROM p GROUP BY ALL""")
def light_facts_scopes(spark, sf_dir):
    f = facts(spark, sf_dir, *"partida capitulo nombre_capitulo nombre_partida nombre_area region nombre_subtitulo subtitulo nombre_beneficiario periodo mes monto_devengado monto_pago orden_compra is_provider is_intra_state is_aggregated rut_beneficiario".split())
    text_of = lambda c: F.col(c).cast("string")
    raw = f.select(
        text_of("periodo").alias("periodo"), text_of("mes").alias("mes"), text_of("monto_devengado").alias("devengo"), text_of("monto_pago").alias("monto"), text_of("is_provider").alias("proveedor"), text_of("is_intra_state").alias("intraestado"),
        text_of("is_aggregated").alias("agregado"), F.col("rut_beneficiario").alias("beneficiario"), "partida", "capitulo", "nombre_capitulo", "nombre_partida", "nombre_area", "region", "nombre_subtitulo", "subtitulo", "nombre_beneficiario", F.col("orden_compra").alias("orden_de_compra"),
    )
    rows = light.light_facts(raw, patterns=("00000001",))
    return rows.groupBy("organization_id", "is_provider_source", "is_provider", "is_public_counterparty_name").agg(F.count("*").alias("n"), total("monto_devengado").alias("amount_clp"))


@query(f"""{_L12}, m AS (SELECT organization_id, strftime(month_date, '%Y-%m') AS period, {_sum()} AS a FROM l12 GROUP BY 1, 2), n AS (SELECT organization_id, string_agg(period || '=' || CAST(CAST(a AS DECIMAL(20,2)) AS VARCHAR), ' ' ORDER BY period) AS monthly FROM m GROUP BY 1),
s AS (SELECT organization_id, {_sum()} AS amount_l12 FROM l12 GROUP BY 1) SELECT organization_id, amount_l12, monthly FROM s JOIN n USING (organization_id)""")
def l12_services_nested(spark, sf_dir):
    _, _, now, before = _rolling(spark, sf_dir, "organization_id provider_id is_provider nombre_area nombre_capitulo nombre_partida nombre_beneficiario region nombre_subtitulo subtitulo")
    nested = spend.services_nested(spend.services(now, before), spend.service_months(now), spend.service_concentration(now))
    return nested.select("organization_id", "amount_l12", F.array_join(F.transform("monthly", lambda m: F.concat(m["period"], F.lit("="), m["amount_clp"].cast("decimal(20,2)").cast("string"))), " ").alias("monthly"))


@query("""SELECT page_id, len(regexp_extract_all(html, '<[a-zA-Z]')) AS n_tags, len(regexp_extract_all(html, '(?is)<tr[^>]*>')) AS n_rows FROM pages""")
def page_structure(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    count = lambda p: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(0))).cast("long")
    return pages.select("page_id", count("<[a-zA-Z]").alias("n_tags"), count("(?is)<tr[^>]*>").alias("n_rows"))


@query(f"""{_EDGES}, e AS (SELECT organization_id, provider_id, round(sum(amount_clp), 2) AS amount_clp FROM ed GROUP BY 1, 2), c AS (SELECT organization_id AS local_rut, round(sum(amount_clp), 2) AS amount_clp FROM e GROUP BY 1)
SELECT local_rut AS organization_id, amount_clp, round(amount_clp - 1000, 2) AS official_amount_clp, round(round(amount_clp - round(amount_clp - 1000, 2), 2) / round(amount_clp - 1000, 2), 6) AS difference_pct FROM c""")
def parity_differences(spark, sf_dir):
    sums = _edges(spark, sf_dir)[1].groupBy("organization_id").agg(total("amount_clp").alias("amount_clp")).withColumn("rut_beneficiario", F.substring("organization_id", 5, 2))
    official = sums.select(F.concat(F.lit("0."), "rut_beneficiario").alias("rut"), F.round(F.col("amount_clp") - 1000, 2).alias("amount_clp")).withColumn("rut", F.substring("rut", 3, 2))
    return rounded(multiyear.parity_differences(sums, official), "difference_pct").select("organization_id", "amount_clp", "official_amount_clp", "difference_pct")


# --- explorer -------------------------------------------------------------------------------------------------------


@query(f"""{_EDGES}, e AS (SELECT organization_id, provider_id, round(sum(amount_clp), 2) AS a FROM ed GROUP BY 1, 2),
t AS (SELECT *, sum(a) OVER (PARTITION BY provider_id) AS pt, sum(a) OVER (PARTITION BY organization_id) AS st, row_number() OVER (PARTITION BY provider_id ORDER BY a DESC, organization_id) AS rn FROM e)
SELECT provider_id, organization_id, a AS top_amount, round(a / pt, 6) AS dependence, round(a / st, 6) AS influence FROM t WHERE rn = 1""")
def dependence_influence(spark, sf_dir):
    edges = _edges(spark, sf_dir)[1].groupBy("organization_id", "provider_id").agg(total("amount_clp").alias("amount_clp"))
    return rounded(explore.dependence_influence(edges), "dependence", "influence")


@query(f"""{_EDGES}, e AS (SELECT provider_id, round(sum(amount_clp), 2) AS a FROM ed WHERE organization_id = 'ORG-05' AND year IN (1997, 1998) GROUP BY 1), r AS (SELECT *, sum(a) OVER () AS t, row_number() OVER (ORDER BY a DESC, provider_id) AS rn FROM e)
SELECT round(max(t), 2) AS flow_total, count(*) AS providers, max(provider_id) FILTER (WHERE rn = 1) AS top_provider_id, round(sum(a) FILTER (WHERE rn <= 10) / max(t), 6) AS top10_share, round(sum(power(a / t, 2)), 6) AS hhi FROM r""")
def explorer_kpis(spark, sf_dir):
    scoped = explore.scope(_edges(spark, sf_dir)[1], organization_id="ORG-05", year=[1997, 1998])
    return rounded(explore.kpis(scoped), "top10_share", "hhi")


@query(f"""{_EDGES}, s AS (SELECT * FROM ed WHERE year = 1999)
SELECT organization_id AS entity_id, round(sum(amount_clp), 2) AS amount_clp, 'service' AS kind FROM s GROUP BY 1 UNION ALL SELECT provider_id, round(sum(amount_clp), 2), 'provider' FROM s GROUP BY 1""")
def cross_filter_ends(spark, sf_dir):
    return explore.ends(explore.scope(_edges(spark, sf_dir)[1], year=1999))


_YEARLY = f"{_EDGES}, y AS (SELECT provider_id, year, round(sum(amount_clp), 2) AS amount_clp FROM ed GROUP BY 1, 2), v AS (SELECT *, lag(amount_clp) OVER (PARTITION BY provider_id ORDER BY year) AS previous_amount FROM y), w AS (SELECT *, CASE WHEN previous_amount > 0 THEN amount_clp / previous_amount - 1 END AS variation FROM v)"


@query(f"{_YEARLY} SELECT provider_id, year, amount_clp, previous_amount, round(variation, 6) AS variation FROM w")
def variation_lag(spark, sf_dir):
    return rounded(explore.variation(multiyear.provider_years(_edges(spark, sf_dir)[1]).select("provider_id", "year", "amount_clp"), "provider_id"), "variation")


@query(f"{_YEARLY}, g AS (SELECT *, log10(amount_clp + 10) * ln(1 + 100 * variation) AS s FROM w WHERE year = 1999 AND variation > 0) SELECT provider_id, year, amount_clp, round(s, 6) AS growth_score FROM g ORDER BY s DESC, provider_id LIMIT 10")
def growth_ranking(spark, sf_dir):
    changes = explore.variation(multiyear.provider_years(_edges(spark, sf_dir)[1]).select("provider_id", "year", "amount_clp"), "provider_id")
    return rounded(explore.growth_ranking(changes, "provider_id", 1999).select("provider_id", "year", "amount_clp", "growth_score"), "growth_score")


@query(f"""{_EDGES}, p AS (SELECT provider_id, round(sum(amount_clp), 2) AS amount_clp FROM ed GROUP BY 1)
SELECT provider_id, amount_clp, CAST(row_number() OVER (ORDER BY amount_clp DESC, provider_id) AS INTEGER) AS rank, round(sum(amount_clp) OVER (ORDER BY amount_clp DESC, provider_id ROWS UNBOUNDED PRECEDING) / (SELECT sum(amount_clp) FROM p), 6) AS cumulative_share
FROM p ORDER BY amount_clp DESC, provider_id LIMIT 100""")
def pareto_cumulative(spark, sf_dir):
    sums = _edges(spark, sf_dir)[1].groupBy("provider_id").agg(total("amount_clp").alias("amount_clp"))
    return rounded(explore.pareto(sums, "provider_id", "amount_clp"), "cumulative_share")


@query(f"""{_MARKS}, o AS (SELECT DISTINCT entity_id, signal_type FROM mk WHERE scope = 'provider'), z AS (SELECT provider_id AS entity_id, round(sum(amount_clp), 2) AS a FROM ed GROUP BY 1)
SELECT signal_type, count(*) AS entities, round(sum(a), 2) AS amount_clp FROM o JOIN z USING (entity_id) GROUP BY 1""")
def mark_summary(spark, sf_dir):
    f, edges = _edges(spark, sf_dir)
    sizes = edges.groupBy(F.col("provider_id").alias("entity_id")).agg(total("amount_clp").alias("amount_clp"))
    return explore.mark_summary(multiyear.marks(f, edges, _MARK_RULES).filter("scope = 'provider'"), sizes, ["PROVIDER_CONCENTRATION"])


@query("""SELECT s_suppkey, s_name, CASE WHEN lower(s_name) LIKE 'supplier#00000001%' THEN 4 ELSE 2 END AS match_score FROM supplier WHERE lower(s_name) LIKE '%supplier#00000001%' ORDER BY match_score DESC, s_name LIMIT 14""")
def entity_finder(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", F.lit("").alias("rut"))
    return explore.find_entities(rows, "Supplier#00000001", "s_name").select("s_suppkey", "s_name", F.col("match_score").cast("int").alias("match_score"))


# --- evidence, registry, functions ----------------------------------------------------------------------------------


@query("""
WITH f AS (SELECT CAST(user_id AS VARCHAR) AS document_id, value AS aml_score, CASE WHEN value > 150 THEN 'HIGH' WHEN value > 40 THEN 'MEDIUM' ELSE 'LOW' END AS severity, event_type AS risk_family FROM events)
SELECT document_id, count(*) AS finding_count, max(aml_score) AS max_aml_score, CASE max(CASE severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END) WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS max_severity,
       string_agg(DISTINCT risk_family, ',' ORDER BY risk_family) AS risk_families FROM f GROUP BY 1
""")
def findings_index(spark, sf_dir):
    v = F.col("value")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("document_id"), v.alias("aml_score"), F.when(v > 150, "HIGH").when(v > 40, "MEDIUM").otherwise("LOW").alias("severity"), F.col("event_type").alias("risk_family"), F.lit("").alias("source_url")
    )
    return evidence.findings_index(rows).select("document_id", "finding_count", "max_aml_score", "max_severity", F.array_join("risk_families", ",").alias("risk_families"))


def _register(spark, sf_dir, spelled) -> DataFrame:
    """An external register made of the suppliers, under other spellings."""
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.concat(F.lit("EXT-"), F.col("s_suppkey").cast("string")).alias("external_id"), spelled.alias("name"), F.lit("").alias("normalized_name"), F.lit("").alias("region"), F.lit(0.8).alias("confidence"), F.lit("").alias("source_document_id")
    )


@query("""x AS (SELECT DISTINCT provider_id, nombre_beneficiario FROM facts WHERE is_provider)
SELECT provider_id AS local_id, 'EXT-' || CAST(CAST(substr(provider_id, 5) AS BIGINT) AS VARCHAR) AS external_id, 'EXACT_NORMALIZED_NAME' AS method, CAST(1 AS DOUBLE) AS similarity FROM x""")
def name_match_exact(spark, sf_dir):
    f = facts(spark, sf_dir, "provider_id", "is_provider", "nombre_beneficiario").withColumn("region", F.lit(""))
    theirs = _register(spark, sf_dir, F.concat(F.lit("  "), F.lower(F.regexp_replace("s_name", "#", " # "))))
    return evidence.best_matches(evidence.local_providers(f), theirs).select("local_id", "external_id", "method", "similarity")


@query()
def name_match_fuzzy(spark, sf_dir):
    """Names with a letter changed; the similarity is no SQL function, the tests hold it against all pairs."""
    long = lambda c: F.trim(F.regexp_replace(F.upper(F.sha2(c, 256)), "(.{4})", "$1 "))  # noqa: E731  sixteen words
    f = facts(spark, sf_dir, "provider_id", "is_provider", "nombre_beneficiario").withColumn("nombre_beneficiario", long("nombre_beneficiario")).withColumn("region", F.lit(""))
    theirs = _register(spark, sf_dir, F.concat(F.lit("X"), long("s_name")))
    return rounded(evidence.best_matches(evidence.local_providers(f), theirs).select("local_id", "external_id", "method", "similarity"), "similarity")


_HISTORY = """
WITH h AS (SELECT CAST(o_custkey AS VARCHAR) AS rut, year(o_orderdate) AS y, CAST(count(*) AS INTEGER) + 6 AS band, CAST(sum(o_totalprice) AS BIGINT) % 30 AS w, min(o_orderstatus) AS reg, max(o_orderpriority) AS act FROM orders GROUP BY 1, 2),
l AS (SELECT *, lag(band) OVER o AS pb, lag(w) OVER o AS pw, lag(reg) OVER o AS pr, lag(act) OVER o AS pa, row_number() OVER (PARTITION BY rut ORDER BY y DESC) AS rn FROM h WINDOW o AS (PARTITION BY rut ORDER BY y)),
z AS (SELECT * FROM l WHERE rn = 1)
SELECT rut, 'SALES_BAND_JUMP' AS mark, 'MEDIUM' AS severity, CAST(y AS VARCHAR) AS year FROM z WHERE band - pb >= 3
UNION ALL SELECT rut, 'HIGH_SALES_LOW_WORKFORCE', 'MEDIUM', CAST(y AS VARCHAR) FROM z WHERE band >= 10 AND w <= 2
UNION ALL SELECT rut, 'WORKFORCE_DROP_STABLE_SALES', 'MEDIUM', CAST(y AS VARCHAR) FROM z WHERE pw >= 10 AND w <= pw * 0.2 AND band > 1 AND pb > 1 AND band >= pb
UNION ALL SELECT rut, 'MAIN_ACTIVITY_CHANGE', 'LOW', CAST(y AS VARCHAR) FROM z WHERE act <> pa
UNION ALL SELECT rut, 'REGION_CHANGE', 'LOW', CAST(y AS VARCHAR) FROM z WHERE reg <> pr
"""


@query(_HISTORY.replace("CAST(sum(o_totalprice) AS BIGINT) % 30", "CAST(sum(o_orderkey) % 30 AS BIGINT)"))
def registry_marks(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    history = orders.groupBy(F.col("o_custkey").cast("string").alias("rut"), F.year("o_orderdate").alias("commercial_year")).agg(
        (F.count("*") + 6).alias("sales_band_code"), (F.sum("o_orderkey") % 30).alias("workers"), F.min("o_orderstatus").alias("main_region"), F.max("o_orderpriority").alias("main_activity")
    )
    history = history.withColumns({"termination_date": F.lit(""), "negative_equity_band": F.lit("")})
    names = spark.createDataFrame([], "rut string, current_status string, activity_start_date string")
    acts = spark.createDataFrame([], "rut string, activity_code string, activity_name string, activity_status string, activity_category string")
    return enrich.registry_marks(history, names, acts)


@query(f"""x AS (SELECT DISTINCT rut_beneficiario, provider_id, substr(provider_id, 5) AS k FROM facts WHERE is_provider)
SELECT rut_beneficiario AS rut, provider_id, 'ENT-RUT-' || rut_beneficiario AS entity_id, 'RUT' AS id_type, '' AS with_wrong_digit FROM x""")
def rut_check_digit(spark, sf_dir):
    f = facts(spark, sf_dir, "rut_beneficiario", "provider_id", "is_provider").filter("is_provider").distinct()
    dotted = F.regexp_replace("rut_beneficiario", r"^(\d\d)(\d{3})(\d{3})", "$1.$2.$3")
    wrong = F.concat(F.substring("rut_beneficiario", 1, 9), F.when(F.substring("rut_beneficiario", 10, 1) == "0", "1").otherwise("0"))
    rut = identity.normalize_rut(dotted)
    return f.select(rut.alias("rut"), "provider_id", F.concat(F.lit("ENT-RUT-"), rut).alias("entity_id"), identity.identifier_type(dotted).alias("id_type"), identity.normalize_rut(wrong).alias("with_wrong_digit"))


@query("""SELECT c_custkey, upper(substr(sha256(upper(trim(c_name)) || '|' || upper(c_mktsegment)), 1, 24)) AS digest, 'RCV-NAME-' || upper(substr(sha256(upper(trim(c_name)) || '|' || upper(c_mktsegment)), 1, 24)) AS recipient_id,
'ORG-PA-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || '-00-000' AS organization_id, upper(substr(md5(c_name), 1, 20)) AS md5_tail FROM customer""")
def id_digests(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.select(
        "c_custkey", identity.digest("c_name", "c_mktsegment", length=24).alias("digest"), identity.recipient_id(F.lit(None), "c_name", "c_mktsegment").alias("recipient_id"),
        identity.organization_id(F.col("c_nationkey") + 1, F.lit(None), F.lit(None), F.lit("")).alias("organization_id"), identity.short_md5("c_name").alias("md5_tail"),
    )


@query("""SELECT s_suppkey, lower(strip_accents('Ñandú ' || s_name || ' Ção')) AS folded, trim(regexp_replace(upper(strip_accents('Ñandú ' || s_name || ' Ção')), '[^A-Z0-9]+', ' ', 'g')) AS name_key FROM supplier""")
def text_folding(spark, sf_dir):
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    name = F.concat(F.lit("Ñandú "), "s_name", F.lit(" Ção"))
    return s.select("s_suppkey", text.fold(name).alias("folded"), text.name_ascii(name).alias("name_key"))


@query("""WITH p AS (SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders),
c AS (SELECT "column", value, count(*) AS n FROM p GROUP BY 1, 2), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INTEGER) AS rank FROM c) SELECT * FROM r WHERE rank <= 20""")
def value_counts_topk(spark, sf_dir):
    return quality.value_counts(spark.read.parquet(f"{sf_dir}/orders.parquet"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("""SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages) GROUP BY 1, 2""")
def html_link_extraction(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return delimited.page_links(pages).groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id, date_trunc('week', ts) AS week, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, CAST(week AS DATE) AS week, n FROM e WHERE n >= 2""")
def weekly_event_clusters(spark, sf_dir):
    rows = explore.weekly_clusters(spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts"), 2)
    return rows.select("user_id", F.col("week").cast("date").alias("week"), "n")


@query("""x AS (SELECT * FROM facts) SELECT rule, CAST(broken AS BIGINT) AS broken FROM (SELECT 'amount_not_negative' AS rule, count(*) FILTER (WHERE NOT monto_devengado >= 0) AS broken FROM x UNION ALL SELECT 'known_month', count(*) FILTER (WHERE NOT mes BETWEEN 1 AND 12) FROM x
UNION ALL SELECT 'paid_after_document', count(*) FILTER (WHERE NOT fecha_pago >= fecha_documento) FROM x)""")
def constraint_violations(spark, sf_dir):
    rules = {"amount_not_negative": "monto_devengado >= 0", "known_month": "mes between 1 and 12", "paid_after_document": "fecha_pago >= fecha_documento"}
    return quality.violations(facts(spark, sf_dir, "monto_devengado", "mes", "fecha_pago", "fecha_documento"), rules)
