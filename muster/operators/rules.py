"""Rule tables turned into columns: types, tiers, scores, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from muster import defaults
from muster.functions.exprs import has_any, safe_double, valid_year
from muster.operators.filters import holds


def apply_rules(
    rules: Sequence[tuple[str, Column]], default: Column | str | None = None
) -> Column:
    """Label of the first rule whose condition holds."""
    chosen = default if isinstance(default, Column) else F.lit(default)
    for label, condition in reversed(rules):
        chosen = F.when(holds(condition), F.lit(label)).otherwise(chosen)
    return chosen


def has_words(text: Column, words: str) -> Column:
    """Whether the text contains one of the alternatives as whole words, in any case."""
    return text.rlike(rf"(?iU)\b(?:{words})\b")


def entity_type(
    name: Column, name_norm: Column, filer_type: Column, filed: Column, awarded: Column,
    granted: Column,
) -> Column:
    """Kind of entity from its name, its sources and what it filed as."""
    text = F.concat_ws(" ", F.coalesce(name, F.lit("nan")), F.coalesce(name_norm, F.lit("nan")))
    filed, awarded, granted = holds(filed), holds(awarded), holds(granted)
    return apply_rules(
        [
            ("university", has_words(text, defaults.UNIVERSITY_WORDS)),
            ("hospital", has_words(text, defaults.HOSPITAL_WORDS)),
            ("govt_lab", has_words(text, defaults.GOVERNMENT_WORDS)),
            ("nonprofit", has_words(text, defaults.NONPROFIT_WORDS) & ~filed),
            ("research_inst", granted & ~filed & ~awarded),
            ("nonprofit", has_any(F.lower(filer_type), defaults.NONPROFIT_FILER_TYPES)),
        ],
        "startup",
    )


def subcategory(
    blob: Column,
    industry: Column,
    keywords: Sequence[tuple[str, Sequence[str]]] = defaults.SUBCATEGORY_KEYWORDS,
    by_industry: Sequence[tuple[str, str]] = defaults.SUBCATEGORY_BY_INDUSTRY,
) -> Column:
    """Field of work by keywords of a lower-case text, else by the industry, else ``unknown``."""
    field = F.lower(industry)
    return apply_rules(
        [(label, has_any(blob, words)) for label, words in keywords]
        + [(label, field.contains(word)) for label, word in by_industry],
        "unknown",
    )


def tier(
    kind: Column, filed: Column, awarded: Column, listed: Column,
    research_types: Sequence[str] = defaults.RESEARCH_TYPES,
) -> Column:
    return apply_rules(
        [
            ("research_inst", kind.isin(*research_types)),
            ("operating_company", filed),
            ("grant_only_company", awarded),
            ("tto_spinout", listed),
        ],
        "research_inst",
    )


def interim_tier(filed: Column, awarded: Column, granted: Column) -> Column:
    return apply_rules(
        [
            ("confirmed_strong", holds(filed) & (holds(awarded) | holds(granted))),
            ("confirmed_funded", filed),
            ("confirmed_grant", awarded),
        ],
        "research_org",
    )


def _points(condition: Column, points: int) -> Column:
    return F.when(holds(condition), points).otherwise(0)


def _within(value: Column, low, high) -> Column:
    inside = value >= low
    return inside if high is None else inside & (value <= high)


def priority_score(
    filed: Column, listed: Column, last_year: Column, category: Column, year_incorp: Column,
    high: Sequence[str] = defaults.HIGH_CATEGORIES,
) -> Column:
    """Sum of the points of all signals a row shows."""
    year = safe_double(last_year)
    score = _points(filed, defaults.SCORE_FILING)
    for low, upper, points in defaults.SCORE_LAST_YEAR:
        score = score + _points(_within(year, low, upper), points)
    since, points = defaults.SCORE_INCORPORATED
    return (
        score
        + _points(listed, defaults.SCORE_PORTFOLIO)
        + _points(category.isin(*high), defaults.SCORE_HIGH_CATEGORY)
        + _points(safe_double(year_incorp) >= since, points)
    )


def founded_year(year_incorp: Column) -> Column:
    return valid_year(year_incorp)


def sample_band(score: Column, bands=defaults.SAMPLE_BANDS) -> Column:
    return apply_rules([(label, _within(score, low, high)) for label, low, high in bands])


def ratio_flag(source: Column, quotient: Column, bands=defaults.RATIO_BANDS) -> Column:
    """Whether a count lies in the band expected of its source."""
    inside = F.lit(False)
    for label, (low, high) in bands.items():
        inside = inside | ((source == label) & quotient.between(low, high))
    return (
        F.when(quotient.isNull(), "no_external_data").when(inside, "ok").otherwise("review")
    )
