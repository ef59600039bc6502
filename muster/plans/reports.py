"""Report tables and the verification pack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from muster import defaults
from muster.operators.report import (
    founded_pivot,
    stratified_sample,
    subcategory_pivot,
    top_prospects,
)
from muster.operators.rollup import group_counts
from muster.operators.verify import reconcile, spot_check, year_check
from muster.plans.funnel import FunnelResult, prospect_list


def report_tables(result: FunnelResult, categories: Sequence[str] = defaults.SUBCATEGORIES) -> dict[str, DataFrame]:
    """Tables of the report, by name."""
    kept = result.kept
    return {
        "funnel": result.audit,
        "area_counts": group_counts(kept, "msa", name="prospects").orderBy("msa"),
        "subcategory_by_area": subcategory_pivot(kept, categories, total=None),
        "founded_by_area": founded_pivot(kept),
        "top_prospects": top_prospects(kept),
        "all_prospects": prospect_list(kept),
    }


def verification_pack(
    roster: DataFrame,
    areas: DataFrame,
    external_counts: DataFrame,
    external_years: DataFrame,
    included: Sequence[tuple[str, str]],
    excluded: Sequence[str],
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Sample for review, reconciliation, spot check and year check, by name."""
    return {
        "sample": stratified_sample(roster, seed),
        "source_counts": reconcile(roster, areas, external_counts),
        "spot_check": spot_check(roster, included, excluded),
        "year_check": year_check(roster, external_years, seed + 1),
    }
