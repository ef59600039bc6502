"""Source layers: filings, awards, grants, portfolio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster import defaults, schemas
from muster.functions.exprs import lower_key, state_abbreviation, strip, upper_key
from muster.operators.columns import (
    column_or,
    ensure_columns,
    first_known_of,
    flatten_struct,
    resolve_column,
)
from muster.operators.enrich import portfolio_rows
from muster.operators.joins import join_filing_tables, scope
from muster.sources.files import listed_quarters, read_table_files

CITY_STATE = ["_city_norm", "_state_norm"]


def normalized_filings(filings: DataFrame) -> DataFrame:
    """Filings with normalized city, state and industry, whichever column names a quarter has.

    Quarters with different names are in one table, so the names are tried row by row.
    """
    city = first_known_of(filings, ["ISSUER_CITY", "CITY"])
    state = first_known_of(filings, ["ISSUER_STATEORCOUNTRY", "STATEORCOUNTRY"])
    typed = [c for c in filings.columns if "INDUSTRY" in c and "TYPE" in c]
    industry = first_known_of(filings, typed)
    return filings.withColumns({
        "_city_norm": lower_key(city),
        "_state_norm": upper_key(state),
        "_industry_norm": strip(F.coalesce(industry, F.lit(""))),
    })


def scope_filings(
    filings: DataFrame, city_dim: DataFrame,
    industries: Sequence[str] = defaults.FILING_INDUSTRIES,
) -> DataFrame:
    """Filings of the areas and industries in scope."""
    return scope(
        normalized_filings(filings), city_dim, CITY_STATE, F.col("_industry_norm").isin(*industries)
    )


def read_filings(spark: SparkSession, root: str) -> DataFrame:
    """Joined filing tables of all quarters below ``root``, from three reads for all quarters.

    Tables are joined within a quarter; one that lacks a table is left out.  Issuers have their quarter and accession
    number as order.
    """
    issuers, offerings, submissions = (
        read_table_files(spark, root, prefix)
        for prefix in ("ISSUERS", "OFFERING", "FORMDSUBMISSION")
    )
    if issuers is None or offerings is None or submissions is None:
        raise FileNotFoundError(f"filing tables missing below {root}")
    # A quarter is complete by its files, so no table has to be read to tell.
    complete = sorted(set.intersection(*(
        listed_quarters(spark, root, prefix) for prefix in ("ISSUERS", "OFFERING", "FORMDSUBMISSION")
    )))
    return join_filing_tables(
        issuers.filter(F.col("_quarter").isin(*complete)), offerings, submissions,
        ["_quarter", "ACCESSIONNUMBER"],
    )


def load_filings(
    spark: SparkSession, root: str, city_dim: DataFrame,
    industries: Sequence[str] = defaults.FILING_INDUSTRIES,
) -> DataFrame:
    return scope_filings(read_filings(spark, root), city_dim, industries)


def normalized_awards(awards: DataFrame) -> DataFrame:
    """Awards with normalized city and state; state names become abbreviations."""
    city = resolve_column(awards, defaults.CITY_ALIASES)
    state = resolve_column(awards, defaults.STATE_ALIASES)
    if city is None or state is None:
        raise ValueError(f"no city and state columns among {awards.columns}")
    return awards.withColumns({
        "_city_norm": lower_key(column_or(awards, [city], F.lit(None))),
        "_state_norm": state_abbreviation(column_or(awards, [state], F.lit(None))),
    })


def scope_awards(awards: DataFrame, city_dim: DataFrame) -> DataFrame:
    return scope(normalized_awards(awards), city_dim, CITY_STATE)


def flatten_grants(grants: DataFrame) -> DataFrame:
    """Nested grant records as dotted columns; area and fiscal year tags stay."""
    return flatten_struct(grants, max_level=2)


def build_portfolio(found: Sequence[DataFrame], seeds: DataFrame | None) -> DataFrame:
    """Page entities followed by curated seeds, without noise names.

    Every input has an ``ord``; the result's ``ord`` puts the inputs one after the other.
    """
    stacked = None
    inputs = [*found, *([] if seeds is None else [seeds])]
    for rank, rows in enumerate(inputs):
        blank = {c: "string" for c in schemas.PORTFOLIO_COLUMNS}
        texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("tagline", "location", "url")]
        part = ensure_columns(rows, blank).select(
            "name", "msa", "source", *texts, F.lit(rank).alias("input"), F.col("ord").alias("pos")
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return portfolio_rows(stacked)


def portfolio_part(portfolio: DataFrame) -> DataFrame:
    """Portfolio as a source of the roster."""
    return portfolio.withColumnsRenamed(
        {"location": "tto_location", "source": "tto_source_name"}
    ).withColumn("source_tto", F.lit(True))
