"""Interim and classified roster from the source rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster import defaults
from muster.functions.exprs import text_blob
from muster.operators.columns import ensure_columns, order_columns
from muster.operators.filters import startup_tier
from muster.operators.rollup import merge_sources, stack_sources
from muster.operators.rules import entity_type, interim_tier, subcategory, tier
from muster.schemas import ROSTER_TYPES
from muster.session import materialize


INTERIM_TYPES = {c: ROSTER_TYPES[c] for c in defaults.INTERIM_FRONT if c != "tier"}


def _merged(parts: Mapping[str, DataFrame | None], types: Mapping[str, str]) -> DataFrame:
    """Merged sources with all the columns; absent flags are false, other absent columns null."""
    complete = ensure_columns(merge_sources(stack_sources(parts)), types)
    flags = [c for c in complete.columns if c.startswith("source_")]
    return complete.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})


def interim_roster(parts: Mapping[str, DataFrame | None]) -> DataFrame:
    """Roster of filings, awards and grants with the interim tier."""
    merged = _merged(parts, INTERIM_TYPES).drop("ord")
    tiered = merged.withColumn(
        "tier", interim_tier(F.col("source_form_d"), F.col("source_sbir"), F.col("source_nih"))
    )
    return order_columns(tiered, defaults.INTERIM_FRONT)


def classified_roster(
    parts: Mapping[str, DataFrame | None],
    keywords: Sequence[tuple[str, Sequence[str]]] = defaults.SUBCATEGORY_KEYWORDS,
) -> DataFrame:
    """Roster of all sources with entity type, subcategory and tier."""
    merged = _merged(parts, ROSTER_TYPES).drop("ord")
    flags = [F.col(c) for c in ("source_form_d", "source_sbir", "source_nih")]
    typed = merged.withColumn(
        "entity_type",
        entity_type(F.col("name"), F.col("name_norm"), F.col("entity_type"), *flags),
    ).withColumn(
        # A column of its own, so that the text is put together once for all rules.
        "_text", text_blob(F.col("name"), F.col("industry"), F.col("tagline"))
    ).withColumn(
        "ls_subcategory", subcategory(F.col("_text"), F.col("industry"), keywords)
    ).drop("_text")
    tiered = typed.withColumn(
        "tier",
        tier(F.col("entity_type"), F.col("source_form_d"), F.col("source_sbir"), F.col("source_tto")),
    )
    return order_columns(tiered, defaults.ROSTER_FRONT)


def startups(roster: DataFrame) -> DataFrame:
    return roster.filter(startup_tier(F.col("tier")))


ROSTER_ORDER = ["msa", "tier", "entity_type", "name", "name_norm"]


def number_rows(roster: DataFrame, order: Sequence[str] = ROSTER_ORDER) -> DataFrame:
    """Roster with its sort order as ``ord``, written once so that the numbers stay as they are.

    The roster is written before it is sorted, as sampling for the sort would compute it twice.
    """
    landed = materialize(roster, "roster")
    numbered = landed.orderBy(*order).withColumn("ord", F.monotonically_increasing_id())
    return materialize(numbered, "numbered")
