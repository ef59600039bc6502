"""The prospect funnel: resolve duplicates, filter with reasons, score, enrich."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster import defaults
from muster.functions.exprs import fill_industry
from muster.operators.columns import ensure_columns
from muster.operators.enrich import fill_from_log, fill_location, fill_years
from muster.operators.filters import (
    first_failure,
    kept_category,
    mature,
    out_of_area,
    recent,
    vehicle_rule,
)
from muster.operators.joins import mark_listed, with_ticker
from muster.operators.resolve import merge_by_groups, merge_by_identity, merge_by_similarity
from muster.operators.rules import founded_year, priority_score
from muster.schemas import ROSTER_TYPES
from muster.session import materialize_counted

BACKFILL_FIELDS = [*ROSTER_TYPES, "founded_year"]


@dataclass(frozen=True)
class FunnelConfig:
    """Inputs of the funnel besides the roster; a list or table left out skips its step."""

    merge_groups: DataFrame | None = None
    vehicle_names: DataFrame | None = None
    tickers: DataFrame | None = None
    excluded_names: DataFrame | None = None
    years_by_cik: DataFrame | None = None
    years_by_url: DataFrame | None = None
    backfill: DataFrame | None = None
    places: dict = field(default_factory=lambda: dict(defaults.OUT_OF_AREA_PLACES))
    kept_categories: Sequence[str] = tuple(defaults.KEPT_CATEGORIES)
    kept_name_words: str = defaults.KEPT_NAME_WORDS
    vehicle_rules: Sequence[tuple[str, str]] = tuple(defaults.VEHICLE_RULES)
    recent_since: int = defaults.RECENT_SINCE
    mature_span: int = defaults.MATURE_SPAN_YEARS
    mature_total: float = defaults.MATURE_TOTAL_USD
    high_categories: Sequence[str] = tuple(defaults.HIGH_CATEGORIES)
    industries: dict = field(default_factory=lambda: dict(defaults.INDUSTRY_BY_SUBCATEGORY))


@dataclass(frozen=True)
class FunnelResult:
    """Kept rows, dropped rows with step and reason, and the row counts of every step."""

    kept: DataFrame
    rejects: DataFrame
    audit: DataFrame


RESOLVE_STEPS = [
    ("Step1_rededup", "same name in an area, or a shared identifier"),
    ("Step2_fuzzy_merge", "similar names in a block without contradicting identifiers"),
    ("Step2b_manual_merges", "listed merge groups"),
]
FILTER_STEPS = [
    ("Step3_geo_cleanup", "portfolio location outside the assigned area"),
    ("Step4_wetlab_subcat", "category not kept"),
    ("Step5_recency", "no recent signal"),
    ("Step6_stage", "long-running and large award history"),
    ("Step7_spv_vehicles", "vehicle name pattern or listed vehicle"),
    ("Step8_public_cos", "listed on an exchange"),
    ("Step9_nonwetlab_excl", "listed exclusion"),
]
FILL_STEPS = [
    ("Step11b_sec_yearofincorp", "cik"),
    ("Step11c_website_scrape", "url"),
]


def _resolved(roster: DataFrame, config: FunnelConfig) -> tuple[DataFrame, list[int]]:
    """The roster after all resolution steps, and its rows before the first and after each of them.

    The roster and each result are written before the next step, which reads them several times.
    """
    steps = [merge_by_identity, merge_by_similarity]
    if config.merge_groups is not None:
        steps.append(lambda rows: merge_by_groups(rows, config.merge_groups))
    every_row = {"n": F.count(F.lit(1))}
    rows, counts = materialize_counted(roster, "roster", every_row)
    sizes = [counts["n"]]
    for step in steps:
        rows, counts = materialize_counted(step(rows), "resolved", every_row)
        sizes.append(counts["n"])
    return rows, sizes + sizes[-1:] * (len(RESOLVE_STEPS) - len(steps))


def filter_checks(config: FunnelConfig) -> list[tuple[str, Column]]:
    """Name and drop condition of every filter step, in funnel order."""
    c = F.col
    conditions = [
        out_of_area(c("source_tto"), c("tto_location"), c("msa"), config.places),
        ~kept_category(
            c("ls_subcategory"), c("name"), config.kept_categories, config.kept_name_words
        ),
        ~recent(c("source_form_d"), c("source_tto"), c("sbir_last_year"), config.recent_since),
        mature(
            c("sbir_first_year"), c("sbir_last_year"), c("sbir_total_usd"), config.mature_span,
            config.mature_total,
        ),
        vehicle_rule(c("name"), config.vehicle_rules).isNotNull() | c("_vehicle"),
        c("ticker").isNotNull(),
        c("_excluded"),
    ]
    return [(name, drop) for (name, _), drop in zip(FILTER_STEPS, conditions)]


def tag_drops(roster: DataFrame, config: FunnelConfig) -> DataFrame:
    """Roster with ``ticker`` and ``drop_step``, the first filter that drops the row.

    All filters are tried in one pass, so that one table holds kept and dropped rows alike.
    """
    looked_up = ensure_columns(roster, ROSTER_TYPES)
    if config.tickers is None:
        looked_up = looked_up.withColumn("ticker", F.lit(None).cast("string"))
    else:
        looked_up = with_ticker(looked_up, config.tickers)
    for flag, names in (("_vehicle", config.vehicle_names), ("_excluded", config.excluded_names)):
        if names is None:
            looked_up = looked_up.withColumn(flag, F.lit(False))
        else:
            looked_up = mark_listed(looked_up, names, flag)
    return looked_up.withColumn("drop_step", first_failure(filter_checks(config))).drop(
        "_vehicle", "_excluded"
    )


def score_and_enrich(kept: DataFrame, config: FunnelConfig) -> DataFrame:
    """Score, city from location, founding year with its lookups, industry, logged values."""
    c = F.col
    scored = fill_location(
        kept.withColumn(
            "priority_score",
            priority_score(
                c("source_form_d"), c("source_tto"), c("sbir_last_year"), c("ls_subcategory"),
                c("year_incorp"), config.high_categories,
            ),
        )
    )
    dated = scored.withColumn("founded_year", founded_year(c("year_incorp"))).drop("year_incorp")
    dated = fill_years(dated, config.years_by_cik, config.years_by_url, source="_year_source")
    filled = dated.withColumn(
        "industry", fill_industry(c("industry"), c("ls_subcategory"), config.industries)
    )
    if config.backfill is not None:
        filled = fill_from_log(filled, config.backfill, BACKFILL_FIELDS)
    return filled


def funnel_audit(
    spark: SparkSession, sizes: Sequence[int], dropped: Mapping[str, int], filled: Mapping[str, int]
) -> DataFrame:
    """``step_name, rows_in, rows_out, rows_removed, reason`` of every step, in order.

    ``sizes`` are the rows before the first and after each resolution step, ``dropped`` the rows that
    each filter dropped, ``filled`` the cells that each lookup filled; all were counted on writing.
    """
    removed = [(name, n - m, reason) for (name, reason), n, m in zip(RESOLVE_STEPS, sizes, sizes[1:])]
    removed += [(name, dropped[name], reason) for name, reason in FILTER_STEPS]
    removed += [(name, 0, f"filled +{filled[by]} founded_year cells") for name, by in FILL_STEPS]
    rows, left = [], sizes[0]
    for pos, (name, gone, reason) in enumerate(removed):
        rows.append((pos, name, left, left - gone, gone, reason))
        left -= gone
    schema = "pos int, step_name string, rows_in bigint, rows_out bigint, rows_removed bigint, reason string"
    return spark.createDataFrame(rows, schema).orderBy("pos").drop("pos")


def run_funnel(roster: DataFrame, config: FunnelConfig = FunnelConfig()) -> FunnelResult:
    """Funnel over a roster with a unique ``ord``.

    The roster, three resolution steps, one tagging pass and one enrichment pass are written to the
    shared folder; results read from there, and the audit's counts are taken on writing.
    """
    resolved, sizes = _resolved(roster, config)
    drops = {name: F.count_if(F.col("drop_step") == name) for name, _ in FILTER_STEPS}
    tagged, dropped = materialize_counted(tag_drops(resolved, config), "tagged", drops)
    reasons = F.create_map(*[F.lit(x) for step in FILTER_STEPS for x in step])
    rejects = tagged.filter("drop_step IS NOT NULL").withColumn(
        "drop_reason", F.concat_ws(": ", "drop_step", F.try_element_at(reasons, F.col("drop_step")))
    )
    kept = tagged.filter("drop_step IS NULL").drop("drop_step", "ticker")
    fills = {by: F.count_if(F.col("_year_source") == by) for _, by in FILL_STEPS}
    final, filled = materialize_counted(score_and_enrich(kept, config), "prospects", fills)
    return FunnelResult(
        kept=final.drop("_year_source"),
        rejects=rejects,
        audit=funnel_audit(roster.sparkSession, sizes, dropped, filled),
    )


def prospect_list(kept: DataFrame) -> DataFrame:
    """Final order: area, then score, then name."""
    return kept.orderBy("msa", F.desc("priority_score"), "name", "ord")
