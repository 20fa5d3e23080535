"""Id -> name tables (regions, districts, wards, countries) read from CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.functions.numbers import int_text
from ledgerlift.functions.text import strip


def id_key(c) -> Column:
    """Ids compare as integer text, so `155.0` and `1.55e+2` meet `155`."""
    return F.nullif(int_text(c), F.lit(""))


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """(id, name) from a two-column CSV; header, blank and repeated rows drop out."""
    raw = spark.read.schema("id string, name string").option("escape", '"').csv(path)
    return dimension(raw)


def dimension(raw: DataFrame, id_col: str = "id", name_col: str = "name") -> DataFrame:
    rows = raw.select(id_key(id_col).alias("id"), F.nullif(strip(name_col), F.lit("")).alias("name"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("name").isNotNull() & (F.lower("id") != "id"))
    return rows.groupBy("id").agg(F.min("name").alias("name"))


def zone_map(regions: DataFrame, zones: DataFrame) -> DataFrame:
    """Region name -> zone (id, name): both hops joined once, one row per region name."""
    hops = regions.select(F.col("name").alias("region"), F.col("zone_id").alias("__z")).join(
        zones.select(F.col("id").alias("zone_id"), F.col("name").alias("zone_name")), F.col("__z") == F.col("zone_id")
    )
    first = hops.groupBy(F.lower(F.trim("region")).alias("region")).agg(F.min(F.struct("zone_id", "zone_name")).alias("z"))
    return first.select("region", "z.zone_id", "z.zone_name")
