"""Counts, pivots, ordered lists and samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from muster import defaults
from muster.functions.exprs import award_search_url, filing_search_url, year_bucket
from muster.operators.columns import ensure_columns
from muster.operators.rules import sample_band
from muster.session import materialize


def interim_counts(roster: DataFrame) -> DataFrame:
    """Entities per area, and how many of them each source knows."""
    return (
        roster.groupBy("msa")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("source_form_d").alias("funded_form_d"),
            F.count_if("source_sbir").alias("sbir_recipients"),
            F.count_if("source_nih").alias("nih_recipients"),
            F.count_if(F.col("tier") == "confirmed_strong").alias("confirmed_strong"),
        )
        .orderBy(F.desc("total"), "msa")
    )


def row_total(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, reduce(add, [F.col(c) for c in columns]))


def pivot_counts(
    df: DataFrame, row: str, column: Column, values: Sequence[str], total: str | None = None
) -> DataFrame:
    """Rows per value of ``column``, one output column per given value, 0 where there are none.

    The columns are fixed, so that one aggregation pass does it.
    """
    counts = df.groupBy(row).agg(*[F.count_if(column == v).alias(v) for v in values])
    return counts if total is None else row_total(counts, values, total)


def tier_pivot(roster: DataFrame, tiers: Sequence[str] = defaults.TIERS) -> DataFrame:
    return pivot_counts(roster, "msa", F.col("tier"), tiers, "TOTAL")


def subcategory_pivot(
    roster: DataFrame, values: Sequence[str] = defaults.SUBCATEGORIES,
    total: str | None = "TOTAL_STARTUPS",
) -> DataFrame:
    return pivot_counts(roster, "msa", F.col("ls_subcategory"), values, total)


def founded_pivot(
    roster: DataFrame, year: str = "founded_year", buckets: Sequence[str] = defaults.FOUNDED_BUCKETS
) -> DataFrame:
    return pivot_counts(roster, "msa", year_bucket(F.col(year)), buckets)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group.  The order must be total for a stable answer.

    Spark limits the groups before it shuffles them, so that a large group costs no more than
    ``k`` rows per task.
    """
    window = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k).drop("_rank")


def top_prospects(prospects: DataFrame, k: int = 25) -> DataFrame:
    order = [F.desc("priority_score"), F.asc("name"), F.asc("ord")]
    return top_k(prospects, ["msa"], order, k).orderBy("msa", *order)


def first_per_key(df: DataFrame, key: Sequence[Column | str], ord_col: str) -> DataFrame:
    """The row with the least ``ord`` of every key."""
    return _single(df, key, F.col(ord_col).asc())


def last_per_key(df: DataFrame, key: Sequence[Column | str], ord_col: str) -> DataFrame:
    return _single(df, key, F.col(ord_col).desc())


def _single(df: DataFrame, key, order: Column) -> DataFrame:
    window = W.partitionBy(*key).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def grouped_values(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Distinct values of each group in order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(name))


PAGE_VALUES = 10_000


def paged_values(
    df: DataFrame, keys: Sequence[str], value: str, name: str, page_values: int = PAGE_VALUES
) -> DataFrame:
    """Distinct values of each group in order, ``page_values`` to a row, with ``page`` from 0.

    For groups whose list is too long for one cell.  The values are written in ranges of (group, value);
    a value's place is its place in its range, after the group's values in the ranges before, so that no
    task needs a whole group.  Null is a group of its own, but no value; a group without values has no page.
    """
    keys = list(keys)
    different = df.select(*keys, F.col(value).alias("_value")).filter("_value IS NOT NULL").distinct()
    ranges = different.repartitionByRange(*keys, "_value").withColumn("_range", F.spark_partition_id())
    # Ranges are drawn from samples, so they are written before they are read twice.
    ranges = materialize(ranges, "ranges")
    sizes = ranges.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_of_range"),
        F.coalesce(before, F.lit(0).cast("bigint")).alias("_before"),
    )
    same = F.col("_range") == F.col("_of_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    inside = F.row_number().over(W.partitionBy("_range", *keys).orderBy("_value")) - 1
    placed = ranges.withColumn("_inside", inside).join(offsets, same)
    page = F.floor((F.col("_before") + F.col("_inside")) / F.lit(page_values)).cast("bigint")
    return placed.groupBy(*keys, page.alias("page")).agg(F.array_sort(F.collect_list("_value")).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def draw_key(seed: int, key: Column) -> Column:
    """Reproducible draw number of a row: it depends on the seed and the row alone."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def sample_per_stratum(
    df: DataFrame, stratum: Column, key: Column, seed: int, n: int, name: str = "sample_band"
) -> DataFrame:
    """``n`` rows of every stratum, drawn by seed; rows without a stratum are never drawn."""
    drawn = df.withColumns({name: stratum, "_draw": draw_key(seed, key)}).filter(F.col(name).isNotNull())
    return top_k(drawn, [name], [F.col("_draw"), key], n).drop("_draw")


def sample_rows(df: DataFrame, key: Column, seed: int, n: int) -> DataFrame:
    """``n`` rows drawn by seed."""
    return df.withColumn("_draw", draw_key(seed, key)).orderBy("_draw", key).limit(n).drop("_draw")


def capped(df: DataFrame, ord_col: str, max_rows: int | None) -> DataFrame:
    """The first rows by ``ord``; the cap bounds calls to a paid or slow service, as asked for."""
    return df if max_rows is None else df.orderBy(ord_col).limit(max_rows)


SAMPLE_TYPES = {
    "source_form_d": "boolean", "source_sbir": "boolean", "source_tto": "boolean",
    "founded_year": "int", "cik": "string", "uei": "string", "website": "string",
}


def review_sheet(sample: DataFrame) -> DataFrame:
    """Columns a reviewer needs: what is claimed, and where to look it up."""
    return ensure_columns(sample, SAMPLE_TYPES).select(
        F.col("name").alias("company_name"),
        "msa",
        "priority_score",
        "sample_band",
        "source_form_d",
        "source_sbir",
        "source_tto",
        "founded_year",
        "cik",
        "uei",
        filing_search_url(F.col("name")).alias("sec_edgar_search_url"),
        award_search_url(F.col("name")).alias("sbir_search_url"),
        F.col("website").alias("company_website"),
        F.lit("").alias("verification_notes"),
    )


def stratified_sample(
    prospects: DataFrame, seed: int, per_band: int = 10, ord_col: str = "ord"
) -> DataFrame:
    band = sample_band(F.col("priority_score"))
    return review_sheet(sample_per_stratum(prospects, band, F.col(ord_col), seed, per_band))
