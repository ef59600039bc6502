"""Row filters.  Predicates are never null, so their complements keep the remaining rows whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster import defaults
from muster.functions.exprs import has_any, is_blank, safe_double, strip


def holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def split_rejects(df: DataFrame, drop_when: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and dropped rows with their reason."""
    drop = holds(drop_when)
    return df.filter(~drop), df.filter(drop).withColumn("drop_reason", F.lit(reason))


def first_failure(checks: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first check, in the given order, that drops the row; null if none does."""
    return F.coalesce(*[F.when(holds(drop), F.lit(name)) for name, drop in checks])


def named(name_norm: Column) -> Column:
    return holds(name_norm != "")


def entity_name_like(name: Column, words: Sequence[str] = defaults.NAVIGATION_WORDS) -> Column:
    """Long enough, short enough, and no word of page navigation."""
    return holds(F.length(name).between(2, 80) & ~F.lower(name).isin(*words))


def image_text_like(alt: Column) -> Column:
    """Image text that may be a name: no file name, no word for the picture itself."""
    text = F.lower(alt)
    ended = F.lit(False)
    for ending in defaults.IMAGE_FILE_ENDINGS:
        ended = ended | text.endswith(ending)
    return holds(
        F.length(alt).between(3, 60) & ~ended & ~has_any(text, defaults.IMAGE_STOP_WORDS)
    )


def startup_tier(tier: Column, tiers: Sequence[str] = defaults.STARTUP_TIERS) -> Column:
    return holds(tier.isin(*tiers))


def out_of_area(
    listed: Column,
    location: Column,
    msa: Column,
    places: Mapping[str, Sequence[str]] = defaults.OUT_OF_AREA_PLACES,
) -> Column:
    """A portfolio row whose stated location names a place outside its area."""
    place = F.lower(strip(location))
    area = F.lower(msa)
    hit = F.lit(False)
    for key, words in places.items():
        hit = F.when(area == key, has_any(place, words)).otherwise(hit)
    return holds(listed) & holds(~place.isin("", "nan", "none")) & holds(hit)


def kept_category(
    category: Column,
    name: Column,
    kept: Sequence[str] = defaults.KEPT_CATEGORIES,
    name_words: str = defaults.KEPT_NAME_WORDS,
    unknown: str = "unknown",
) -> Column:
    """Kept category, or unknown category and a telling name."""
    label = F.coalesce(category, F.lit(unknown))
    return holds(label.isin(*kept)) | (
        holds(label == unknown) & holds(name.rlike(f"(?iu){name_words}"))
    )


def recent(
    filed: Column, listed: Column, last_year: Column, since: int = defaults.RECENT_SINCE
) -> Column:
    return holds(filed) | holds(listed) | holds(safe_double(last_year) >= since)


def mature(
    first_year: Column,
    last_year: Column,
    total: Column,
    span: int = defaults.MATURE_SPAN_YEARS,
    amount: float = defaults.MATURE_TOTAL_USD,
) -> Column:
    years = F.coalesce(safe_double(last_year) - safe_double(first_year), F.lit(0.0))
    return holds((years > span) & (F.coalesce(safe_double(total), F.lit(0.0)) > amount))


def vehicle_rule(
    name: Column, rules: Sequence[tuple[str, str]] = defaults.VEHICLE_RULES
) -> Column:
    """Name of the first vehicle rule that the entity name matches; null if none does.

    One expression over all rules decides first, so that the many other names cost one search.
    """
    any_rule = "(?iU)" + "|".join(f"(?:{pattern})" for _, pattern in rules)
    each = [F.when(name.rlike(f"(?iU){pattern}"), F.lit(label)) for label, pattern in rules]
    return F.when(name.rlike(any_rule), F.coalesce(*each))


def residential(zip_code: Column, ratio: Column) -> Column:
    return holds((zip_code != "") & (F.coalesce(ratio, F.lit(0.0)) > 0))


def enrichable(year: Column, key: Column) -> Column:
    """Blank year and a usable lookup key."""
    return year.isNull() & ~is_blank(key) & holds(F.lower(strip(key.cast("string"))) != "nan")
