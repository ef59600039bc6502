"""Configuration tables: allowlists, area config, name lists, merge groups, tickers, logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster import schemas
from muster.defaults import BACKFILL_SKIPPED_FIELDS
from muster.functions.exprs import lower_key, upper_key
from muster.operators.report import (
    PAGE_VALUES,
    first_per_key,
    grouped_values,
    last_per_key,
    paged_values,
)
from muster.sources.files import read_json_config


def city_dimension(allowlist: DataFrame, ord_col: str = "ord") -> DataFrame:
    """``_city_norm, _state_norm, _msa``, one row per city and state; the first listed one counts."""
    keyed = allowlist.select(
        lower_key(F.col("city_normalized")).alias("_city_norm"),
        upper_key(F.col("state")).alias("_state_norm"),
        F.col("msa").alias("_msa"),
        ord_col,
    )
    return first_per_key(keyed, ["_city_norm", "_state_norm"], ord_col).drop(ord_col)


def zip_dimension(allowlist: DataFrame, ord_col: str = "ord") -> DataFrame:
    """``zip, msa``, one row per ZIP code; the last listed one counts."""
    return last_per_key(allowlist.select("zip", "msa", ord_col), ["zip"], ord_col).drop(ord_col)


def cities_by_state(allowlist: DataFrame) -> DataFrame:
    """``msa, state, cities``."""
    return grouped_values(allowlist, ["msa", "state"], "city_normalized", "cities")


def city_pages(allowlist: DataFrame, page_values: int = PAGE_VALUES) -> DataFrame:
    """``msa, state, page, cities``: as ``cities_by_state``, long lists in several rows."""
    return paged_values(allowlist, ["msa", "state"], "city_normalized", "cities", page_values)


ALLOWLIST_WIDTH = 16  # columns an allowlist may have


def read_city_allowlist(spark: SparkSession, path: str) -> DataFrame:
    """City allowlist CSV with the line order in ``ord``.

    The list is a few thousand short lines, read as one document so that it has an order.
    """
    lines = F.split("value", r"\r?\n")
    cells = ", ".join(f"c{i} string" for i in range(ALLOWLIST_WIDTH))
    fields = lambda line: F.array(*[
        F.from_csv(line, cells, {"quote": '"', "escape": '"'})[f"c{i}"] for i in range(ALLOWLIST_WIDTH)
    ])
    names, parts = fields(F.get(lines, F.lit(0))), fields(F.col("line"))
    cell = lambda c: F.get(parts, (F.array_position("names", c) - 1).cast("int"))
    return (
        spark.read.text(path, wholetext=True)
        .select(names.alias("names"), F.posexplode(lines).alias("ord", "line"))
        .filter((F.col("ord") > 0) & (F.col("line") != ""))
        .select(F.col("ord").cast("bigint").alias("ord"),
                *[cell(c).alias(c) for c in schemas.CITY_DIM_COLUMNS])
        .withColumn("zip_count", F.col("zip_count").try_cast("int"))
    )


def read_area_config(spark: SparkSession, path: str) -> DataFrame:
    """``msa`` and the fields of its entry."""
    doc = read_json_config(spark, path, schemas.MSA_CONFIG_TYPE)
    return doc.select(F.explode("doc.msas").alias("msa", "area")).select("msa", "area.*")


def read_excluded_names(spark: SparkSession, path: str) -> DataFrame:
    doc = read_json_config(spark, path, schemas.EXCLUSIONS_TYPE)
    return doc.select(F.explode("doc.excluded_names").alias("name"))


def read_merge_groups(spark: SparkSession, path: str) -> DataFrame:
    """``group_id, msa, name``; entries without an area or a name are left out."""
    doc = read_json_config(spark, path, schemas.MERGES_TYPE)
    groups = doc.select(F.posexplode("doc.merges").alias("group_id", "entry"))
    return groups.select(
        "group_id", "entry.msa", F.explode("entry.names").alias("name")
    ).filter((F.trim("msa") != "") & (F.col("name") != ""))


def ticker_table(documents: DataFrame, column: str = "value") -> DataFrame:
    """``cik, ticker`` from JSON objects of records; of several tickers the last listed counts."""
    entries = documents.select(
        F.explode(F.from_json(column, schemas.TICKERS_TYPE)).alias("pos", "entry")
    ).select(F.col("pos").try_cast("bigint").alias("ord"), "entry.cik_str", "entry.ticker")
    return (
        last_per_key(entries.filter("cik_str IS NOT NULL"), ["cik_str"], "ord")
        .select(F.col("cik_str").cast("string").alias("cik"), "ticker")
    )


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    return ticker_table(spark.read.text(path, wholetext=True))


def backfill_entries(log: DataFrame) -> DataFrame:
    """Log rows that carry a value to fill in."""
    field = F.col("field")
    return log.filter(field.isNotNull() & ~field.isin(*BACKFILL_SKIPPED_FIELDS))


def read_backfill_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Backfill CSV; ``ord`` numbers the rows by file name and then as they stand in the file.

    Logs are kept by hand, hence small; quoted multi-line text is never split, so a file is one task.
    """
    log = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    placed = log.select("*", place.alias("_place"))
    order = F.row_number().over(Window.orderBy("_place")).cast("bigint")
    return backfill_entries(placed.withColumn("ord", order).drop("_place"))
