"""Scalar expressions.  All of them are built-in column operations; none runs Python per row."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from muster.defaults import (
    AWARD_SEARCH_URL,
    DEFAULT_INDUSTRY,
    FILING_SEARCH_URL,
    FIRST_QUARTER,
    INDUSTRY_BY_SUBCATEGORY,
    PUBLICATION_LAG_DAYS,
    STATE_ABBREVIATIONS,
    YEAR_RANGE,
)

# White space in the sense of Unicode, plus the information separators.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_NUMBER_CHARACTERS = "0123456789+-.eE"


def literal_map(entries: Mapping[str, str]) -> Column:
    """Constant map; it is folded into the plan as one value."""
    return F.from_json(F.lit(json.dumps(dict(entries))), "map<string,string>")


def literal_list(values: Sequence[str]) -> Column:
    """Constant array; it is folded into the plan as one value."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def has_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the text contains one of the words, anywhere and literally.

    One plain search per word, stopping at the first hit, is several times faster on long texts than
    one regular expression of all words.
    """
    return F.exists(literal_list(words), lambda w: F.contains(text, w))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))


def lower_key(text: Column) -> Column:
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def upper_key(text: Column) -> Column:
    return F.upper(strip(F.coalesce(text, F.lit(""))))


def is_blank(value: Column) -> Column:
    """Null, or nothing but white space."""
    return F.coalesce(strip(value.cast("string")) == "", F.lit(True))


def safe_double(value: Column) -> Column:
    """Number of a text; null for anything that is not wholly a number.

    The cast alone would take type letters as in ``12d``, and words like ``nan``.
    """
    text = strip(value.cast("string"))
    return F.when(F.trim(text, F.lit(_NUMBER_CHARACTERS)) == "", text.try_cast("double"))


def money(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    return F.coalesce(safe_double(plain), F.lit(0.0))


def state_abbreviation(state: Column, names: Mapping[str, str] = STATE_ABBREVIATIONS) -> Column:
    key = lower_key(state)
    return F.coalesce(F.try_element_at(literal_map(names), key), F.upper(key))


def title_case(text: Column) -> Column:
    """Capital after every non-letter, not only after blanks."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def valid_year(year: Column, low: int = YEAR_RANGE[0], high: int = YEAR_RANGE[1]) -> Column:
    number = safe_double(year)
    return F.when(number.between(low, high), number.cast("int"))


_LOCATION = r"^\s*([^,]+?)\s*,\s*([A-Za-z]{2})\s*$"


def located_city(location: Column) -> Column:
    return F.when(location.rlike(_LOCATION), strip(F.regexp_extract(location, _LOCATION, 1)))


def located_state(location: Column) -> Column:
    return F.when(location.rlike(_LOCATION), F.upper(F.regexp_extract(location, _LOCATION, 2)))


def normalize_url(url: Column) -> Column:
    text = strip(url)
    full = F.when(text.rlike("^https?://"), text).otherwise(F.concat(F.lit("https://"), text))
    return F.when((text != "") & (F.lower(text) != "nan"), F.rtrim(full, F.lit("/")))


def query_escape(text: Column) -> Column:
    """Form encoding of a query value; only letters, digits and ``_.-~`` stay as they are."""
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def filing_search_url(name: Column) -> Column:
    head, tail = FILING_SEARCH_URL
    return F.concat(F.lit(head), query_escape(name), F.lit(tail))


def award_search_url(name: Column) -> Column:
    head, tail = AWARD_SEARCH_URL
    return F.concat(F.lit(head), query_escape(name), F.lit(tail))


def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def quarter_tag(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("q"), F.quarter(day).cast("string"))


def last_published_quarter(today: Column, lag_days: int = PUBLICATION_LAG_DAYS) -> Column:
    """First day of the last quarter whose archive is out on the given day."""
    return F.trunc(F.date_sub(today, lag_days), "quarter").cast("date")


def quarter_tags(last: Column, first: Column | None = None) -> Column:
    """Tags of all quarters from the first to the last day's quarter; none if they are reversed."""
    start = F.trunc(F.lit(FIRST_QUARTER).cast("date") if first is None else first, "quarter")
    end = F.trunc(last, "quarter")
    days = F.sequence(start, end, F.expr("INTERVAL 3 MONTHS"))
    none = F.array().cast("array<string>")
    return F.when(end < start, none).otherwise(F.transform(days, quarter_tag))


def fill_industry(
    industry: Column,
    subcategory: Column,
    table: Mapping[str, str] = INDUSTRY_BY_SUBCATEGORY,
    default: str = DEFAULT_INDUSTRY,
) -> Column:
    proxy = F.coalesce(F.try_element_at(literal_map(table), subcategory), F.lit(default))
    return F.coalesce(industry, F.when(subcategory.isNotNull(), proxy))


def ratio(ours: Column, external: Column, digits: int = 4) -> Column:
    """Rounded quotient; null when there is nothing to compare with."""
    return F.round(ours.cast("double") / F.nullif(external.cast("double"), F.lit(0.0)), digits)


def text_blob(*fields: Column) -> Column:
    """Lower-case text of the fields for keyword rules; a null field reads ``nan``."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(f, F.lit("nan")) for f in fields]))


def year_bucket(year: Column, oldest: int = 2019, newest: int = 2025) -> Column:
    return (
        F.when(year.isNull(), "Unknown")
        .when(year <= oldest, "2015-2019")
        .when(year >= newest, "2025-2026")
        .otherwise(year.cast("int").cast("string"))
    )
