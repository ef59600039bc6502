"""Joins with dimensions, lists, and tables of one row per key.

A dimension of known small size is broadcast by Catalyst.  Any other is written first: then its real
size decides, and as it is no longer aggregated by the key within the join's own plan, AQE can split the
hot keys of the other side.  Joins with a count per key take hot keys out of the shuffle themselves.  A
key is hot from ``HOT_ROWS`` rows on, so there is at most one per that many rows, and the few rows of the
other side that belong to hot keys are a bounded table, safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions.names import cik_text, resolve_name
from muster.operators.columns import suffix_collisions
from muster.session import materialize


HOT_ROWS = 1_000_000


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate is below the session's broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def join_counted(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner join with a table of one row per key that has the key's number of rows in ``count``.

    Rows of hot keys stay where they are; all others are joined by shuffle.
    """
    keys = list(keys)
    hot = table.filter(F.col(count) >= hot_rows).drop(count)
    cold = table.filter(F.col(count) < hot_rows).drop(count)
    spread = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return spread.unionByName(rest)


def settled(dim: DataFrame) -> DataFrame:
    """The dimension itself if it is small enough to broadcast, else written and read back."""
    return dim if fits_broadcast(dim) else materialize(dim, "dimension")


def lookup(rows: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Left or left-anti join with a dimension of one row per key; rows without a key are kept.

    The input is read once, whatever the dimension's size.  Rows without a key match nothing; where the
    join shuffles, they are dealt by a hash of their other columns, so that no task gets all of them.
    """
    known = F.xxhash64(key)
    others = [c for c, kind in rows.dtypes if c != key and "map<" not in kind and kind != "variant"]
    dealt = F.when(F.col(key).isNull(), F.xxhash64(*others)).otherwise(known) if others else known
    matched = settled(dim).withColumn("_dealt", known)
    return rows.withColumn("_dealt", dealt).join(matched, [key, "_dealt"], how).drop("_dealt")


def scope(df: DataFrame, dim: DataFrame, on: Sequence[str], keep: Column | None = None) -> DataFrame:
    """Rows whose key is in the dimension, with the dimension's columns."""
    rows = df if keep is None else df.filter(keep)
    return rows.join(settled(dim), list(on), "inner")


def join_filing_tables(
    issuers: DataFrame, offerings: DataFrame, submissions: DataFrame,
    on: Sequence[str] = ("ACCESSIONNUMBER",),
) -> DataFrame:
    """Issuers with their offering and filing date; one row per combination, issuers kept whole."""
    on = list(on)
    dated = [*on, *(c for c in ("FILING_DATE",) if c in submissions.columns)]
    return issuers.join(suffix_collisions(issuers, offerings, on, "_o"), on, "left").join(
        submissions.select(*dated), on, "left"
    )


def with_ticker(df: DataFrame, tickers: DataFrame, cik: str = "cik") -> DataFrame:
    """Look the registry number up among listed companies (columns ``cik``, ``ticker``).

    Of several tickers of a number the last by ``ord`` counts, the greatest where there is no order.
    """
    last = F.max_by("ticker", "ord") if "ord" in tickers.columns else F.max("ticker")
    listed = tickers.groupBy(F.col("cik").alias("_cik")).agg(last.alias("ticker"))
    return lookup(df.withColumn("_cik", cik_text(F.col(cik))), listed, "_cik").drop("_cik")


def listed_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Distinct normal forms of a name list."""
    return names.select(resolve_name(F.col(column)).alias("_norm")).distinct()


def exclude_names(df: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """Rows whose normalized name is not on the list."""
    keyed = df.withColumn("_norm", resolve_name(F.col(name)))
    return lookup(keyed, listed_names(names), "_norm", "left_anti").drop("_norm")


def mark_listed(df: DataFrame, names: DataFrame, flag: str, name: str = "name") -> DataFrame:
    """Add a flag that tells whether the normalized name is on the list."""
    listed = listed_names(names).withColumn(flag, F.lit(True))
    keyed = df.withColumn("_norm", resolve_name(F.col(name)))
    return (
        lookup(keyed, listed, "_norm")
        .drop("_norm")
        .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    )
