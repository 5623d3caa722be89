"""Facts from a star schema of orders and order lines.

The dimension joins are foreign-key joins that lose and add no row, so a join is
made only if a wanted column needs it: the plan of a query holds the joins it
uses, which Catalyst can't find out on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import rut_of_number

L, O, C, N, R, S, P = "lineitem orders customer nation region supplier part".split()
#: Column -> (tables besides lineitem, expression).
COLUMNS: dict[str, tuple[tuple[str, ...], str]] = {
    "transaction_id": ((), "concat('TRX-', upper(substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint), cast(l_extendedprice as decimal(18,2)), l_returnflag, l_linestatus, cast(l_shipdate as date))), 1, 24)))"),
    "transaction_fingerprint": ((), "concat('FP-', l_orderkey, '-', l_linenumber)"),
    "source_row_number": ((), "cast(l_linenumber as bigint)"),
    "periodo": ((), "cast(year(l_shipdate) as bigint)"),
    "mes": ((), "cast(month(l_shipdate) as bigint)"),
    "monto_devengado": ((), "l_extendedprice"),
    "monto_pago": ((), "cast(cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(18,2)) as double)"),
    "fecha_documento": ((O,), "cast(o_orderdate as date)"),
    "fecha_pago": ((), "cast(l_shipdate as date)"),
    "dias_de_pago": ((O,), "datediff(cast(l_shipdate as date), cast(o_orderdate as date))"),
    "organization_id": ((O, C), "concat('ORG-', lpad(cast(c_nationkey as string), 2, '0'))"),
    "partida": ((O, C, N), "lpad(cast(n_regionkey as string), 2, '0')"),
    "capitulo": ((O, C), "lpad(cast(c_nationkey as string), 2, '0')"),
    "nombre_area": ((O, C, N), "n_name"),
    "nombre_capitulo": ((O, C, N), "n_name"),
    "nombre_partida": ((O, C, N, R), "r_name"),
    "region": ((O, C, N, R), "r_name"),
    "is_provider": ((O,), "o_orderstatus <> 'P'"),
    "provider_id": ((O,), "case when o_orderstatus <> 'P' then concat('PRV-', lpad(cast(l_suppkey as string), 6, '0')) else '' end"),
    "recipient_id": ((O,), "concat('RCV-', lpad(cast(o_custkey as string), 6, '0'))"),
    "nombre_beneficiario": ((S,), "s_name"),
    "codigo_ubicacion_geografica": ((S,), "lpad(cast(s_nationkey as string), 2, '0')"),
    "nombre_ubicacion_geografica": ((S,), "concat('UNIT ', cast(s_nationkey as string))"),
    "subtitulo": ((P,), "p_brand"),
    "nombre_subtitulo": ((P,), "p_brand"),
    "item": ((P,), "p_type"),
    "nombre_item": ((P,), "p_type"),
    "asignacion": ((P,), "cast(p_size as string)"),
    "numero_documento": ((), "cast(l_orderkey as string)"),
    "folio": ((), "cast(l_linenumber as string)"),
    "tipo_documento": ((), "concat(l_returnflag, l_linestatus)"),
    "orden_compra": ((O,), "case when o_orderpriority in ('1-URGENT', '2-HIGH') then concat('OC-', l_orderkey) else '' end"),
    "codigo_bip": ((), "case when l_linenumber = 1 then concat('BIP-', l_partkey) else '' end"),
    "sector": ((O, C), "c_mktsegment"),
    "is_person": ((O, C), "c_mktsegment = 'HOUSEHOLD'"),
    "is_intra_state": ((O, C), "c_mktsegment = 'MACHINERY'"),
    "is_honorarium": ((), "l_returnflag = 'A'"),
    "is_floating_debt": ((), "l_linestatus = 'O'"),
    "is_aggregated": ((), "l_linenumber = 7"),
    "moneda_presupuestaria": ((), "'CLP'"),
    "source_file": ((), "'lineitem'"),
}
KEYS = {O: "l_orderkey = o_orderkey", C: "o_custkey = c_custkey", N: "c_nationkey = n_nationkey", R: "n_regionkey = r_regionkey", S: "l_suppkey = s_suppkey", P: "l_partkey = p_partkey"}


def few(rows: DataFrame) -> bool:
    """Whether a table is read by fewer tasks than there are cores."""
    return rows.rdd.getNumPartitions() < rows.sparkSession.sparkContext.defaultParallelism


def spread(rows: DataFrame, *order: str) -> DataFrame:
    """Deal out a table that is read by fewer tasks than there are cores, in ranges of ``order`` and sorted by it if given.

    A file of one row group is one task, whatever the splits.  Tables of many
    files already have more splits than cores and are left as they are, so no
    shuffle is added where it would cost.
    """
    if not few(rows):
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartitionByRange(cores, *order).sortWithinPartitions(*order) if order else rows.repartition(cores)


def facts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The wanted columns (all if none is named) of one fact per order line."""
    wanted = columns or (*COLUMNS, "rut_beneficiario", "entity_id", "beneficiario_id_type")
    plain = [c for c in wanted if c in COLUMNS]
    derived = {c for c in wanted if c not in COLUMNS}
    needed = {t for c in plain for t in COLUMNS[c][0]}
    # All expressions read the day of a time, which is half as long to move.
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    held = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in KEYS if t in needed}
    rows = lines if O in held else spread(lines)
    # What hangs on orders is joined to these first: they are fewer than their lines, which are then moved once for all of it.
    for table, below in ((N, R), (C, N), (O, C)):
        if below in held:
            held[table] = held[table].join(held.pop(below), F.expr(KEYS[below]))
    # Parts come first, since they add little to a line, and suppliers, the smallest, last.
    for table in (P, O, S):
        if table in held:
            # Lines of few tasks are dealt by the key of this join, which then needs no exchange of its own.
            rows = rows.repartition("l_orderkey") if table == O and few(lines) else rows
            rows = rows.join(held[table], F.expr(KEYS[table]))
    out = rows.select(*[F.expr(COLUMNS[c][1]).alias(c) for c in plain], "l_suppkey")
    if derived:
        rut = rut_of_number(F.col("l_suppkey") + 10_000_000)
        values = {"rut_beneficiario": rut, "entity_id": F.concat(F.lit("ENT-RUT-"), rut), "beneficiario_id_type": F.lit("RUT")}
        out = out.withColumns({c: values[c] for c in sorted(derived)})
    return out.select(*wanted)


_RUT_SUM = " + ".join(f"CAST(substr(CAST(l_suppkey + 10000000 AS VARCHAR), {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate((3, 2, 7, 6, 5, 4, 3, 2)))
_RUT = f"CAST(l_suppkey + 10000000 AS VARCHAR) || '-' || CASE 11 - ({_RUT_SUM}) % 11 WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST(11 - ({_RUT_SUM}) % 11 AS VARCHAR) END"
_DIALECT = {
    "dias_de_pago": "CAST(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)",
}


def facts_sql() -> str:
    """The same facts as a DuckDB subquery."""
    cells = [f"{_DIALECT.get(c, e).replace(' as string', ' as varchar')} AS {c}" for c, (_, e) in COLUMNS.items()]
    cells += [f"{_RUT} AS rut_beneficiario", f"'ENT-RUT-' || {_RUT} AS entity_id", "'RUT' AS beneficiario_id_type"]
    return f"SELECT {', '.join(cells)} FROM lineitem JOIN " + " JOIN ".join(f"{t} ON {on}" for t, on in KEYS.items())
