"""Scope predicates and small numeric helpers that the operators share; each is defined once."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col
from .text import finite

# Words that mark a counterparty as a public body.
PUBLIC_PATTERNS = (
    "TESORERIA GENERAL DE LA REPUBLICA", "SERVICIO DE IMPUESTOS INTERNOS", "SERVICIO DE REGISTRO CIVIL", "SERVICIO MEDICO LEGAL",
    "SERVICIO NACIONAL DE", "SERVICIO DE SALUD", "SUBSECRETARIA DE", "MINISTERIO DE", "MUNICIPALIDAD DE", "ILUSTRE MUNICIPALIDAD",
    "GOBIERNO REGIONAL", "CONTRALORIA GENERAL DE LA REPUBLICA", "FONDO NACIONAL DE SALUD", "INSTITUTO DE PREVISION SOCIAL",
    "DEFENSORIA PENAL PUBLICA", "JUNTA NACIONAL DE", "DIRECCION GENERAL DE", "DIRECCION NACIONAL DE",
    "POLICIA DE INVESTIGACIONES DE CHILE", "CARABINEROS DE CHILE", "EJERCITO DE CHILE", "ARMADA DE CHILE", "FUERZA AEREA DE CHILE",
)


def provider_scope() -> Column:
    return F.coalesce(F.col("is_provider"), F.lit(False)) & (F.coalesce("provider_id", F.lit("")) != "")


def not_aggregated() -> Column:
    return ~F.coalesce(F.col("is_aggregated"), F.lit(False))


def valid_month() -> Column:
    return F.col("periodo").isNotNull() & F.col("mes").between(1, 12)


def public_name(folded: Column, patterns=PUBLIC_PATTERNS) -> Column:
    return folded.rlike("|".join(patterns))


def present(c) -> Column:
    return F.coalesce(F.trim(as_col(c).cast("string")), F.lit("")) != ""


def blank_to_null(c) -> Column:
    x = F.trim(as_col(c).cast("string"))
    return F.when(x != "", x)


def first_present(*columns) -> Column:
    """The first column that isn't blank; the last is taken as it is."""
    return F.coalesce(*[blank_to_null(c) for c in columns[:-1]], as_col(columns[-1]))


def exact_sum(c="monto_devengado", when: Column | None = None, over=None) -> Column:
    """Sum of amounts as a double, exact to the millionth; NaN and infinities count as missing.

    Whole units and millionths are summed as integers, so that the sum does not
    depend on the order of rows and is far cheaper than decimals made of
    doubles; the two are put together as decimals, once per group.  An amount,
    or a sum, beyond 9e18 units raises, it never wraps.
    """
    x = finite(as_col(c).cast("double"))
    x = F.when(when, x) if when is not None else x
    added = lambda v: F.sum(v) if over is None else F.sum(v).over(over)
    whole = F.floor(x)
    units, millionths = added(whole.cast("long")), added(F.rint((x - whole) * 1_000_000).cast("long"))
    return (units.cast("decimal(20,0)") + millionths.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast("double")


def total(c="monto_devengado", when: Column | None = None) -> Column:
    """Exact sum as a double; map-side partial like any sum."""
    return exact_sum(c, when)


def dominant(value: Column, size: Column) -> Column:
    """The non-null value with the largest size; of equal sizes the largest value."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(size, value)))


def share(part, whole) -> Column:
    return F.when(as_col(whole) != 0, as_col(part) / as_col(whole))


def month_date() -> Column:
    return F.make_date(F.col("periodo").cast("int"), F.col("mes").cast("int"), F.lit(1))
