"""Marks from a tax registry: yearly history, activities and names per tax number."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import rut_key
from ..functions.predicates import present

# Sales band of large companies, and values that stand for no information.
LARGE, NO_EQUITY = 10, ("nan", "0", "sin informacion", "sin información")


def activities(rows: DataFrame) -> DataFrame:
    """Distinct activities per tax number."""
    keys = ("activity_code", "activity_name", "activity_status", "activity_category")
    once = rows.withColumn("rut", rut_key("rut")).filter("rut <> ''").dropDuplicates(["rut", *keys])
    return once.groupBy("rut").agg(F.count("*").alias("n_activities"))


def registry_entities(history: DataFrame, names: DataFrame, acts: DataFrame) -> DataFrame:
    """One document per tax number: name and status, distinct activities, yearly history and marks, whichever of them is known."""
    keys = ("activity_code", "activity_name", "activity_status", "activity_category")
    named = names.withColumn("rut", rut_key("rut")).filter("rut <> ''").groupBy("rut").agg(F.max("legal_name").alias("legal_name"), F.max("current_status").alias("tax_status"), F.max("activity_start_date").alias("start_date"))
    listed = acts.withColumn("rut", rut_key("rut")).filter("rut <> ''").groupBy("rut").agg(F.array_sort(F.collect_set(F.struct(*keys))).alias("activities"))
    fields = ("commercial_year", "sales_band_code", "workers", "main_region", "main_activity")
    years = history.withColumn("rut", rut_key("rut")).filter("rut <> '' and commercial_year is not null").groupBy("rut").agg(F.array_sort(F.collect_set(F.struct(*fields))).alias("history"))
    marks = registry_marks(history, names, acts).groupBy("rut").agg(F.array_sort(F.collect_set(F.struct("mark", "severity", "year"))).alias("marks"))
    rows = named.join(listed, "rut", "full").join(years, "rut", "full").join(marks, "rut", "left")
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType))
    return rows.withColumns({c: empty(c) for c in ("activities", "history", "marks")}).withColumn("entity_id", F.concat(F.lit("ENT-RUT-"), "rut"))


def registry_marks(history: DataFrame, names: DataFrame, acts: DataFrame) -> DataFrame:
    """(rut, mark, severity, year): what the last year with data shows, alone and against the one before."""
    h = history.withColumn("rut", rut_key("rut")).filter("rut <> '' and commercial_year is not null")
    order = Window.partitionBy("rut").orderBy("commercial_year")
    fields = ("sales_band_code", "workers", "main_region", "main_activity")
    rows = h.withColumns({**{f"prev_{c}": F.lag(c).over(order) for c in fields}, "from_last": F.row_number().over(Window.partitionBy("rut").orderBy(F.desc("commercial_year")))})
    ended = h.groupBy("rut").agg(F.bool_or(present("termination_date")).alias("ended"))
    # Names and activities may be the only thing known of a company.
    last = rows.filter("from_last = 1").drop("termination_date")
    named = names.withColumn("rut", rut_key("rut")).filter("rut <> ''").groupBy("rut").agg(F.max("current_status").alias("tax_status"), F.max("activity_start_date").alias("start_date"))
    all_ = last.join(named, "rut", "full").join(activities(acts), "rut", "full").join(ended, "rut", "left")
    band, workers = F.col("sales_band_code").try_cast("int"), F.col("workers").try_cast("int")
    pband, pworkers = F.col("prev_sales_band_code").try_cast("int"), F.col("prev_workers").try_cast("int")
    age = F.col("commercial_year").try_cast("int") - F.substring("start_date", 1, 4).try_cast("int")
    year, changed = F.col("commercial_year").cast("string"), lambda c: present(c) & present(f"prev_{c}") & (F.trim(c) != F.trim(f"prev_{c}"))
    equity = F.lower(F.trim(F.coalesce(F.col("negative_equity_band").cast("string"), F.lit(""))))
    now = F.lit("CURRENT")
    rules = {
        "SALES_BAND_JUMP": ("MEDIUM", year, band - pband >= 3),
        "HIGH_SALES_LOW_WORKFORCE": ("MEDIUM", year, (band >= LARGE) & (workers <= 2)),
        "RECENT_START_HIGH_SALES": ("MEDIUM", year, (band >= LARGE) & age.between(0, 2)),
        "WORKFORCE_DROP_STABLE_SALES": ("MEDIUM", year, (pworkers >= 10) & (workers <= pworkers * 0.2) & (band > 1) & (pband > 1) & (band >= pband)),
        "MAIN_ACTIVITY_CHANGE": ("LOW", year, changed("main_activity")),
        "REGION_CHANGE": ("LOW", year, changed("main_region")),
        "ACTIVITY_BREADTH": ("LOW", now, F.col("n_activities") >= 6),
        "REACTIVATION_PATTERN": ("LOW", now, (F.col("tax_status") == "ACTIVE_AS_PUBLISHED") & F.col("ended")),
        "HIGH_SALES_NEGATIVE_EQUITY": ("MEDIUM", year, (band >= LARGE) & (equity != "") & ~equity.isin(*NO_EQUITY)),
    }
    found = F.array_compact(F.array(*[F.when(p, F.struct(F.lit(k).alias("mark"), F.lit(s).alias("severity"), y.alias("year"))) for k, (s, y, p) in rules.items()]))
    return all_.select("rut", F.explode(found).alias("m")).select("rut", "m.*")
