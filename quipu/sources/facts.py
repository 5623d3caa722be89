"""From raw delimited columns to the canonical fact schema."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import digest, flag_is_true, identifier_type, normalize_rut, organization_id, provider_id, recipient_id
from ..functions.predicates import blank_to_null
from ..functions.text import finite, normalize_text

# The source's column names that differ from the canonical ones; all others map to their own lower case.
RENAMED = {
    "BENEFICIARIO": "beneficiario_source_id", "RUT_BENEFICIARIO": "beneficiario_source_id", "ORDEN_DE_COMPRA": "orden_compra",
    "MONEDA": "moneda_presupuestaria", "MONTO": "monto_pago", "MONTO_ORIGINAL": "monto_pago_original",
    "DEVENGO": "monto_devengado", "DEVENGO_ORIGINAL": "monto_devengado_original",
}
# The canonical text columns.
TEXTS = (
    "partida", "nombre_partida", "capitulo", "nombre_capitulo", "area", "nombre_area", "subtitulo", "nombre_subtitulo", "item", "nombre_item",
    "asignacion", "nombre_asignacion", "beneficiario_source_id", "nombre_beneficiario", "numero_documento", "tipo_documento", "orden_compra",
    "moneda_presupuestaria", "rut_principal", "nombre_principal", "folio", "usuario_aprobador", "agregado", "bloqueo_oc", "codigo_bip", "nombre_bip",
    "codigo_ubicacion_geografica", "nombre_ubicacion_geografica", "codigo_programa_presupuestario", "nombre_programa_presupuestario", "honorario",
    "proveedor", "sector", "region", "persona", "intraestado", "dias_de_pago", "dias_de_pago_cat", "deuda_flotante",
)
# Dates, amounts, numbers and flags of the canonical schema.
DATES = ("fecha_documento", "fecha_ingreso", "fecha_recepcion_conforme", "fecha_pago")
AMOUNTS = ("monto_devengado", "monto_pago", "monto_devengado_original", "monto_pago_original")
NUMBERS = ("periodo", "mes")
FLAGS = {
    "is_provider": "proveedor", "is_person": "persona", "is_honorarium": "honorario", "is_intra_state": "intraestado",
    "is_floating_debt": "deuda_flotante", "is_aggregated": "agregado",
}


def canonical_name(header: str) -> str:
    folded = "".join(c for c in unicodedata.normalize("NFKD", header) if not unicodedata.combining(c))
    key = re.sub(r"_+", "_", re.sub(r"\s+", " ", folded.upper()).strip().replace(" ", "_"))
    return RENAMED.get(key, key.lower())


def canonical_columns(raw: DataFrame) -> DataFrame:
    """Columns under canonical names; of several for one name, the first that isn't blank, left to right."""
    sources: dict[str, list[str]] = {}
    for c in raw.columns:
        sources.setdefault(canonical_name(c), []).append(c)
    one = lambda c: F.col(f"`{c}`")
    return raw.select(*[(one(cs[0]) if len(cs) == 1 else F.coalesce(*[blank_to_null(one(c)) for c in cs])).alias(name) for name, cs in sources.items()])


def parse_date(c: Column) -> Column:
    """ISO first, then day-month-year; row by row, so the result doesn't depend on neighbours."""
    text = F.trim(c.cast("string"))
    iso = F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)) for f in ("dd-MM-yyyy", "dd/MM/yyyy")])


def with_row_numbers(rows: DataFrame) -> DataFrame:
    """``source_row_number``: the place of a row in its file, from 1.

    Rows are counted per block of a file first; a row's number is its place in
    its block and the rows of the blocks before.  One row per block is ranked
    within its file and joined back, so no task sees more than its own blocks
    and the driver none.  Both scans of the join have one plan, so a block is
    read by the same task in both; files that must be read once, or are packed, go through
    :func:`.splits.read_gzip`, whose rows are numbered already.
    """
    place = rows.withColumns({"file_": F.input_file_name(), "block_": F.input_file_block_start(), "part_": F.spark_partition_id(), "nth_": F.monotonically_increasing_id()})
    key = ["file_", "block_", "part_"]
    blocks = place.groupBy(*key).agg(F.min("nth_").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file_").orderBy("block_", "part_").rowsBetween(Window.unboundedPreceding, -1)
    known = blocks.select(*key, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("offset_"))
    return place.join(known, key, "left").withColumn("source_row_number", F.col("nth_") + F.col("offset_")).drop(*key, "nth_", "offset_")


def normalize(raw: DataFrame, source_url: str = "", source_file: str = "", row_number: bool = True) -> DataFrame:
    """Canonical facts: typed columns, identities, lineage and ids; unknown columns stay as texts.

    The physical row number is the row's place in its file; with ``row_number=False`` it is taken from a column
    ``source_row_number`` of ``raw``.
    """
    rows = canonical_columns(raw)
    if row_number:
        rows = with_row_numbers(rows)
    have = set(rows.columns)
    special = {*DATES, *AMOUNTS, *NUMBERS, "source_row_number"}
    typed = {}
    for c in dict.fromkeys([*rows.columns, *TEXTS, *DATES, *AMOUNTS, *NUMBERS]):
        x = F.col(c) if c in have else F.lit(None).cast("string")
        if c in DATES:
            typed[c] = parse_date(x)
        elif c in AMOUNTS:
            typed[c] = finite(x.try_cast("double"))
        elif c in NUMBERS:
            typed[c] = x.try_cast("double").cast("long")
        elif c not in special:
            typed[c] = F.coalesce(x.cast("string"), F.lit(""))
        else:
            typed[c] = x
    rows = rows.select(*[v.alias(k) for k, v in typed.items()])
    source = F.col("beneficiario_source_id")
    rows = rows.withColumns({
        "rut_beneficiario": normalize_rut(source),
        "beneficiario_normalizado": normalize_text("nombre_beneficiario"),
        **{flag: flag_is_true(c) for flag, c in FLAGS.items()},
        "organization_id": organization_id("partida", "capitulo", "area", "nombre_area"),
    })
    known = F.col("rut_beneficiario") != ""
    entity = F.when(known, F.concat(F.lit("ENT-RUT-"), "rut_beneficiario"))
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    cents = lambda c: F.coalesce(F.col(c).cast("decimal(20,2)").cast("string"), F.lit(""))
    rows = rows.withColumns({
        "rut_beneficiario_normalizado": F.col("rut_beneficiario"),
        "beneficiario_id_type": identifier_type(source, F.col("rut_beneficiario")),
        "entity_id": entity,
        "recipient_entity_id": entity,
        "identity_status": F.when(known, "RESOLVED").otherwise("UNRESOLVED"),
        "identity_method": F.when(known, "RUT_EXACT").otherwise("SOURCE_LOCAL_ONLY"),
        "identity_confidence": F.when(known, 1.0).otherwise(0.0),
        "recipient_id": recipient_id(source, "beneficiario_normalizado", "organization_id", F.col("rut_beneficiario")),
        "provider_id": provider_id(source, "beneficiario_normalizado", "proveedor", "organization_id", F.col("rut_beneficiario")),
        "source_system": F.lit("PRESUPUESTO_ABIERTO"),
        "source_url": F.lit(source_url),
        "source_file": F.lit(source_file),
        "transaction_fingerprint": F.concat(F.lit("FP-PA-"), digest(
            "periodo", "mes", "partida", "capitulo", "area", F.coalesce(blank_to_null("beneficiario_source_id"), F.col("rut_beneficiario")),
            "numero_documento", "folio", day("fecha_documento"), cents("monto_devengado"), day("fecha_pago"), cents("monto_pago"), length=24)),
        "record_class": F.lit("SOURCE_FACT"),
    })
    return rows.withColumn("transaction_id", F.concat(F.lit("TRX-PA-"), digest("source_file", "source_row_number", "transaction_fingerprint", length=24)))


def parse_years(spec: str) -> list[int]:
    """Years of a text such as "2024 2026,2025" or "2016-2026"; years before 2016 are refused."""
    years: set[int] = set()
    for part in re.split(r"[\s,;]+", (spec or "").strip()):
        if m := re.fullmatch(r"(\d{4})(?:-(\d{4}))?", part):
            a, b = sorted((int(m[1]), int(m[2] or m[1])))
            years.update(range(a, b + 1))
        elif part:
            raise ValueError(f"not a year: {part}")
    if not years or min(years) < 2016:
        raise ValueError("years from 2016 on are needed")
    return sorted(years)
