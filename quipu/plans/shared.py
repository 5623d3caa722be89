"""Column sets of the star-schema facts that several queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..scratch import materialize
from ..sources.star import facts

_DETECT = "transaction_id organization_id recipient_id provider_id is_provider is_aggregated periodo mes monto_devengado"


def detect(more: str) -> list[str]:
    """What every detector reads, and ``more``."""
    return [*_DETECT.split(), *more.split()]


#: What the detectors read besides, together, and what priority and territory read of a transaction.
_MEASURES = "subtitulo item fecha_documento dias_de_pago numero_documento folio"
_CONTEXT = "nombre_area nombre_capitulo nombre_partida region nombre_beneficiario orden_compra codigo_bip codigo_ubicacion_geografica nombre_ubicacion_geografica"


def signal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the seven detectors read together, not yet written."""
    return facts(spark, sf_dir, *detect(_MEASURES))


def full_rows(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """What detectors, priority and territory read together, and the columns ``more``, not yet written."""
    return facts(spark, sf_dir, *detect(f"{_MEASURES} {_CONTEXT}"), *more)


def full_facts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """:func:`full_rows` joined once and written, since each plan reads a few columns of it in nine or more branches."""
    return materialize(full_rows(spark, sf_dir, *more), "facts")
