"""Aggregations: canonical rows, source rollups, stacking and merging of sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster import defaults
from muster.functions.exprs import money, safe_double
from muster.functions.names import normalize_name
from muster.operators.columns import column_or, first_present, resolve_column
from muster.operators.filters import named
from muster.schemas import SUM_COLUMNS


def first_known(column: Column, ord_column: Column) -> Column:
    """First value that is not null, by ``ord_column``."""
    return F.min_by(column, F.when(column.isNotNull(), ord_column))


def classes_of(columns: Sequence[str], skip: Sequence[str]) -> tuple[list, list, list]:
    """Columns to OR (source flags), to sum (counts and amounts), to take the first value of."""
    rest = [c for c in columns if c not in skip]
    flags = [c for c in rest if c.startswith("source_")]
    sums = [c for c in rest if c in SUM_COLUMNS]
    return flags, sums, [c for c in rest if c not in flags and c not in sums]


def canonical_agg(
    df: DataFrame,
    keys: Sequence[str],
    ord_col: str,
    flags: Sequence[str],
    sums: Sequence[str],
    firsts: Sequence[str],
) -> DataFrame:
    """One row per key: flags OR-ed, numbers summed, for the rest the first known value.

    A null flag counts as false and a null number as zero.  ``ord_col`` becomes the least one of the
    group, so that the result can be collapsed again.
    """
    order = F.col(ord_col)
    aggregates = [F.bool_or(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in flags]
    aggregates += [F.coalesce(F.sum(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) for c in sums]
    aggregates += [first_known(F.col(c), order).alias(c) for c in firsts]
    return df.groupBy(*keys).agg(F.min(order).alias(ord_col), *aggregates)


def _rollup(
    rows: DataFrame, keys: Mapping[str, Column], firsts: Mapping[str, Column], order: Column,
    amount: Column | None = None, low_high: Column | None = None, distinct: Column | None = None,
) -> DataFrame:
    """One row per key with the first known values, ``rows``, and sum, range and number of different
    values where asked for.

    The rows of a key mostly repeat its values.  They are therefore first reduced to their different
    value combinations by hash aggregation, before anything is shuffled; only these few are put in
    order.  Values to be counted differ from row to row and would undo that, so a second, narrow
    reading of keys and counted values reduces them apart; both results meet in the last grouping.
    """
    groups = [c.alias(f"_k_{n}") for n, c in keys.items()]
    values = [c.alias(f"_v_{n}") for n, c in firsts.items()]
    extra = [] if low_high is None else [low_high.alias("_range")]
    totals = [] if amount is None else [F.sum(amount).alias("_sum")]
    reduced = rows.groupBy(*groups, *values, *extra).agg(
        F.min(order).alias("_ord"), F.count(F.lit(1)).alias("_rows"), *totals
    )
    by = [f"_k_{n}" for n in keys]
    aggregates = [first_known(F.col(f"_v_{n}"), F.col("_ord")).alias(n) for n in firsts]
    aggregates.append(F.sum("_rows").alias("rows"))
    if amount is not None:
        aggregates.append(F.coalesce(F.sum("_sum"), F.lit(0.0)).alias("amount"))
    if low_high is not None:
        aggregates += [F.min("_range").alias("low"), F.max("_range").alias("high")]
    if distinct is not None:
        seen = rows.select(*groups, distinct.alias("_id")).filter("_id IS NOT NULL").distinct()
        seen = seen.groupBy(*by).agg(F.count(F.lit(1)).alias("_different"))
        reduced = reduced.unionByName(seen, allowMissingColumns=True)
        aggregates.append(F.coalesce(F.sum("_different"), F.lit(0).cast("bigint")).alias("different"))
    return reduced.groupBy(*[F.col(f"_k_{n}").alias(n) for n in keys]).agg(*aggregates)


def rollup_filings(filings: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Filings to one row per area and filer name; rows without an area or name form groups too."""
    keys = {"msa": F.col("_msa"), "name": F.col("ENTITYNAME")}
    firsts = {
        "cik": "CIK", "city": "CITY", "state": "STATEORCOUNTRY", "zip": "ZIPCODE",
        "year_incorp": "YEAROFINC_VALUE_ENTERED", "entity_type": "ENTITYTYPE",
        "industry": "_industry_norm",
    }
    columns = {n: F.col(c) for n, c in firsts.items()}
    rolled = _rollup(
        filings, keys, columns, F.col(ord_col), distinct=F.col("ACCESSIONNUMBER")
    ).drop("rows")
    return rolled.withColumnRenamed("different", "form_d_filings").withColumn("source_form_d", F.lit(True))


def rollup_awards(awards: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Awards to one row per area and firm; the years stay text."""
    keys = {"msa": F.col("_msa"), "name": F.col("Company")}
    firsts = {
        "uei": "UEI", "duns": "Duns", "city": "City", "state": "_state_norm", "zip": "Zip",
        "website": "Company Website", "employees": "Number Employees",
    }
    columns = {n: F.col(c) for n, c in firsts.items()}
    amount = money(F.col("Award Amount")) if "Award Amount" in awards.columns else F.lit(0.0)
    rolled = _rollup(
        awards, keys, columns, F.col(ord_col), amount, F.col("Award Year"), F.col("Contract")
    )
    return rolled.drop("rows").withColumnsRenamed({
        "amount": "sbir_total_usd", "low": "sbir_first_year", "high": "sbir_last_year",
        "different": "sbir_awards",
    }).withColumn("source_sbir", F.lit(True))


def rollup_grants(grants: DataFrame, ord_col: str = "ord") -> DataFrame | None:
    """Grants to one row per area and organization; None when no column names the organization."""
    name = resolve_column(grants, defaults.ORG_ALIASES["name"])
    if name is None:
        return None
    keys = {"msa": F.col("_msa"), "name": column_or(grants, [name], F.lit(""))}
    firsts = {
        n: column_or(grants, defaults.ORG_ALIASES[n], F.lit("")) for n in ("city", "state", "zip")
    }
    amount = safe_double(column_or(grants, defaults.AMOUNT_ALIASES, F.lit(0.0)))
    return (
        _rollup(grants, keys, firsts, F.col(ord_col), amount)
        .withColumnsRenamed({"rows": "nih_grants", "amount": "nih_total_usd"})
        .withColumn("source_nih", F.lit(True))
    )


def stack_sources(parts: Mapping[str, DataFrame | None]) -> DataFrame | None:
    """Union by name of the sources, in order; null where a source lacks a column.

    ``ord`` orders the rows by source, then by the source's own ``ord``, or by name where a rollup
    left it without one.
    """
    stacked = None
    for rank, part in enumerate(parts.values()):
        if part is None:
            continue
        own = first_present(part, ["ord"], "bigint").cast("bigint")
        key = F.lit("") if "ord" in part.columns else F.col("name")
        part = part.withColumn(
            "ord", F.struct(F.lit(rank).alias("rank"), key.alias("key"), own.alias("pos"))
        )
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def merge_sources(stacked: DataFrame, ord_col: str = "ord") -> DataFrame:
    """One row per area and normalized name over all sources; rows without either are left out."""
    keys = ["msa", "name_norm"]
    rows = stacked.withColumn("name_norm", normalize_name(F.col("name"))).filter(
        named(F.col("name_norm")) & F.col("msa").isNotNull()
    )
    flags, sums, firsts = classes_of(rows.columns, keys + [ord_col])
    return canonical_agg(rows, keys, ord_col, flags, sums, firsts)


def group_counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def slice_summary(df: DataFrame, slice_col: str, kept: Column) -> DataFrame:
    """Rows read and rows kept per slice of the input."""
    return df.groupBy(slice_col).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(kept).alias("kept")
    )


def filled_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Number of rows and of known values per column, in one row."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in columns])
