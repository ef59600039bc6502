"""Geography dimensions from the county crosswalk and the area config."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions.exprs import lower_key, upper_key
from muster.operators.filters import residential
from muster.operators.report import first_per_key


def area_crosswalk(crosswalk: DataFrame, areas: DataFrame) -> DataFrame:
    """Residential ZIP rows of the counties of each area.

    ``crosswalk`` has ``geoid, county, city, state, res_ratio, ord``; ``areas`` the fields of the
    area config.
    """
    counties = areas.select("msa", F.posexplode("county_fips").alias("county_pos", "county"))
    rows = crosswalk.filter(residential(F.col("geoid"), F.col("res_ratio")))
    return rows.join(counties, "county").select(
        "msa",
        F.col("geoid").alias("zip"),
        F.col("county").alias("county_fips"),
        lower_key(F.col("city")).alias("city"),
        upper_key(F.col("state")).alias("state"),
        "res_ratio",
        F.struct("county_pos", "ord").alias("ord"),
    )


def zip_dim(rows: DataFrame) -> DataFrame:
    """One row per area and ZIP code: the county with the highest ratio, the first one on ties."""
    ranked = rows.withColumn("_best", F.struct((-F.col("res_ratio")).alias("r"), F.col("ord")))
    return first_per_key(ranked, ["msa", "zip"], "_best").select(
        "msa", "zip", "county_fips", "state", "res_ratio"
    )


def city_counts(rows: DataFrame) -> DataFrame:
    """ZIP rows per area, city and state."""
    named = rows.filter((F.col("city") != "") & (F.col("state") != ""))
    return named.groupBy("msa", F.col("city").alias("city_normalized"), "state").agg(
        F.count(F.lit(1)).cast("int").alias("zip_count")
    )


def curated_cities(areas: DataFrame) -> DataFrame:
    """Every notable city of an area with each of its states, count 0."""
    return (
        areas.select("msa", F.explode("notable_cities").alias("city"), "state_codes")
        .select(
            "msa", lower_key(F.col("city")).alias("city_normalized"),
            F.explode("state_codes").alias("state"),
        )
        .distinct()
        .withColumn("zip_count", F.lit(0))
    )


def city_dim(rows: DataFrame, areas: DataFrame) -> DataFrame:
    """Observed and curated cities; a curated city that was observed keeps its count."""
    return (
        city_counts(rows)
        .unionByName(curated_cities(areas))
        .groupBy("msa", "city_normalized", "state")
        .agg(F.max("zip_count").alias("zip_count"))
    )


def build_geo_dims(crosswalk: DataFrame, areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = area_crosswalk(crosswalk, areas)
    return zip_dim(rows), city_dim(rows, areas)
