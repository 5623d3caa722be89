"""Tax-number validation and identifier construction, as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col
from .text import normalize_text

SHA1 = "^[0-9a-fA-F]{40}$"
#: Weights of the eight digits of a padded body, left to right.
RUT_WEIGHTS = (3, 2, 7, 6, 5, 4, 3, 2)


def rut_check_digit(body: Column) -> Column:
    """Check digit of a body of up to eight digits: modulo 11, weights 2 to 7 from the right."""
    padded = F.lpad(body, 8, "0")
    total = sum((F.substring(padded, i + 1, 1).cast("int") * w for i, w in enumerate(RUT_WEIGHTS)), F.lit(0))
    return check_letter(total)


def check_letter(total: Column) -> Column:
    """11 less the remainder, with 11 as 0 and 10 as K; one look into a literal, so the sum is made once."""
    return F.substring(F.lit("0K987654321"), (total % 11 + 1).cast("int"), F.lit(1))


def rut_of_number(number: Column) -> Column:
    """Canonical tax number of a numeric body of up to eight digits, by integer arithmetic."""
    total = sum((F.floor(number / 10**k).cast("long") % 10 * (2 + k % 6) for k in range(8)), F.lit(0))
    return F.concat(number.cast("string"), F.lit("-"), check_letter(total))


def normalize_rut(c) -> Column:
    """Canonical ``body-digit`` if the check digit holds, else ''."""
    raw = F.trim(F.coalesce(as_col(c).cast("string"), F.lit("")))
    compact = F.upper(F.regexp_replace(raw, "[^0-9Kk]", ""))
    body = F.substring(compact, F.lit(1), F.greatest(F.length(compact) - 1, F.lit(0)))
    digit = F.substring(compact, F.length(compact), F.lit(1))
    shape = ~raw.rlike(SHA1) & ~raw.rlike("[A-JL-Za-jl-z]") & compact.rlike("^[0-9]{1,8}[0-9K]$")
    number = F.regexp_replace(body, "^0+(?=[0-9])", "")
    return F.when(shape & (F.when(shape, rut_check_digit(body)) == digit), F.concat(number, F.lit("-"), digit)).otherwise("")


def rut_key(c) -> Column:
    """Digits and K of a tax number, unchecked."""
    return F.regexp_replace(F.upper(F.coalesce(as_col(c), F.lit(""))), "[^0-9K]", "")


def identifier_type(c, rut: Column | None = None) -> Column:
    """MISSING, RUT, HASH_SHA1 or SOURCE_ID, tested in this order.  rut: the normalised number, where it is at hand."""
    raw = F.trim(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return F.when(raw == "", "MISSING").when((rut if rut is not None else normalize_rut(raw)) != "", "RUT").when(raw.rlike(SHA1), "HASH_SHA1").otherwise("SOURCE_ID")


def flag_is_true(c) -> Column:
    return normalize_text(c).isin("1", "TRUE", "T", "SI", "YES", "Y")


def digest(*parts, length: int = 18) -> Column:
    """First characters of the SHA-256 of the normalised parts, in capitals."""
    return F.upper(F.substring(F.sha2(F.concat_ws("|", *[normalize_text(p) for p in parts]), 256), 1, length))


def _padded(c, n: int) -> Column:
    x = F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.when(F.length(x) >= n, x).otherwise(F.lpad(x, n, "0"))


def organization_id(ministry, chapter, area, name) -> Column:
    parts = [_padded(ministry, 2), _padded(chapter, 2), _padded(area, 3)]
    coded = F.concat_ws("", *[F.trim(F.regexp_replace(p, "^0+|0+$", "")) for p in parts]) != ""
    return F.when(coded, F.concat_ws("-", F.lit("ORG-PA"), *parts)).otherwise(F.concat(F.lit("ORG-PA-"), digest(name)))


def recipient_id(source, name, organization, rut: Column | None = None) -> Column:
    raw = F.trim(F.coalesce(as_col(source).cast("string"), F.lit("")))
    rut = normalize_rut(raw) if rut is None else rut
    return (
        F.when(rut != "", F.concat(F.lit("RCV-RUT-"), rut))
        .when(raw.rlike(SHA1), F.concat(F.lit("RCV-SHA1-"), F.upper(raw)))
        .when(raw != "", F.concat(F.lit("RCV-PA-"), digest(raw, name, organization, length=24)))
        .otherwise(F.concat(F.lit("RCV-NAME-"), digest(name, organization, length=24)))
    )


def provider_id(source, name, flag, organization, rut: Column | None = None) -> Column:
    """'' unless the provider flag is set; a flag may be given as text or as boolean."""
    raw = F.trim(F.coalesce(as_col(source).cast("string"), F.lit("")))
    rut = normalize_rut(raw) if rut is None else rut
    return (
        F.when(~flag_is_true(flag), "")
        .when(rut != "", F.concat(F.lit("PRV-RUT-"), rut))
        .when(raw.rlike(SHA1), F.concat(F.lit("PRV-SHA1-"), F.upper(raw)))
        .otherwise(F.concat(F.lit("PRV-PA-"), digest(raw, name, organization, length=24)))
    )


def service_id(ministry, chapter) -> Column:
    """Identifier at the grain of ministry and chapter."""
    return F.concat_ws("-", F.lit("ORG-PA"), _padded(ministry, 2), _padded(chapter, 2))


def short_md5(*parts) -> Column:
    """Twenty capitals of an MD5, the tail of signal ids."""
    return F.upper(F.substring(F.md5(F.concat(*[as_col(p).cast("string") for p in parts]).cast("binary")), 1, 20))
