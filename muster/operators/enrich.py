"""Filling blanks from logs and lookups, and entities from landed pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


from muster.functions.exprs import (
    is_blank,
    located_city,
    located_state,
    normalize_url,
    safe_double,
    valid_year,
)
from muster.functions.names import cik_text
from muster.functions.pages import (
    elements,
    attribute,
    card_name,
    class_of,
    classed_text,
    decoded,
    element_text,
    founding_year,
    name_from_host,
    name_from_image_file,
    page_text,
    squeeze,
)
from muster.operators.filters import entity_name_like, image_text_like
from muster.operators.joins import lookup
from muster.operators.rollup import first_known

NUMERIC_FIELDS = ["founded_year"]


def fill_from_log(
    df: DataFrame, log: DataFrame, fields: Sequence[str], name: str = "name", ord_col: str = "ord",
    numeric: Sequence[str] = NUMERIC_FIELDS,
) -> DataFrame:
    """Fill blank cells from a long log ``name, field, value``, ordered by its ``ord`` column.

    The first usable value logged for a cell counts.  Each row decides for itself whether its cell
    is blank; cells with a value are never changed.
    """
    wanted = [f for f in fields if f in df.columns]
    if not wanted:
        return df
    value, order = F.col("value"), F.col(ord_col)

    def logged(field):
        usable = safe_double(value) if field in numeric else value
        return first_known(F.when(F.col("field") == field, usable), order).alias(f"_log_{field}")

    wide = (
        log.filter(F.col("field").isin(*wanted))
        .groupBy(F.col("name").alias("_logged_entity"))
        .agg(*[logged(f) for f in wanted])
    )
    filled = {}
    for f in wanted:
        known = F.when(~is_blank(F.col(f)), F.col(f))
        logged_value = F.col(f"_log_{f}").try_cast(df.schema[f].dataType)
        filled[f] = F.coalesce(known, logged_value, F.col(f))
    joined = lookup(df.withColumn("_logged_entity", F.col(name)), wide, "_logged_entity")
    return joined.withColumns(filled).drop("_logged_entity", *[f"_log_{f}" for f in wanted])


def fill_years(
    df: DataFrame, by_cik: DataFrame | None, by_url: DataFrame | None, year: str = "founded_year",
    cik: str = "cik", website: str = "website", source: str | None = None,
) -> DataFrame:
    """Fill blank years from lookups ``key, year`` by registry number, then by website.

    ``source`` names an extra column that tells which lookup filled the cell.
    """
    out, found = df, [("known", F.col(year))]
    if by_cik is not None and cik in df.columns:
        table = by_cik.groupBy(F.col("key").alias("_cik")).agg(
            F.min(valid_year(F.left(F.col("year").cast("string"), F.lit(4)))).alias("_year_cik")
        )
        out = lookup(out.withColumn("_cik", cik_text(F.col(cik))), table, "_cik").drop("_cik")
        found.append(("cik", F.col("_year_cik")))
    if by_url is not None and website in df.columns:
        table = by_url.groupBy(F.col("key").alias("_url")).agg(
            F.min(valid_year(F.left(F.col("year").cast("string"), F.lit(4)))).alias("_year_url")
        )
        key = normalize_url(F.col(website))
        out = lookup(out.withColumn("_url", key), table, "_url").drop("_url")
        found.append(("url", F.col("_year_url")))
    if source is not None:
        origin = [F.when(c.isNotNull(), F.lit(label)) for label, c in found]
        out = out.withColumn(source, F.coalesce(*origin))
    out = out.withColumn(year, F.coalesce(*[c for _, c in found]).cast(df.schema[year].dataType))
    return out.drop("_year_cik", "_year_url")


def fill_location(df: DataFrame, location: str = "tto_location") -> DataFrame:
    """City and state from a "City, ST" location for rows without a city."""
    if location not in df.columns:
        return df
    city = located_city(F.col(location))
    parsed = F.col("city").isNull() & city.isNotNull()
    return df.withColumns({
        "city": F.when(parsed, city).otherwise(F.col("city")),
        "state": F.when(parsed, located_state(F.col(location))).otherwise(F.col("state")),
    })


# -- landed pages ----------------------------------------------------------------------------

ABOUT_PATHS = ["", "/about", "/about-us", "/our-story", "/company", "/team"]


def website_years(
    pages: DataFrame, url: str = "url", html: str = "html", paths: Sequence[str] = ABOUT_PATHS
) -> DataFrame:
    """Lookup ``key, year`` of websites: the first of their usual pages that states a year counts."""
    address = normalize_url(F.col(url))
    base = F.regexp_extract(address, r"^(https?://[^/?#]+)", 1)
    path = F.substring(address, F.length(base) + 1, F.length(address))
    rank = F.array_position(F.array(*[F.lit(p) for p in paths]), path)
    read = pages.select(
        base.alias("key"), rank.alias("rank"), founding_year(F.col(html)).alias("year")
    )
    return (
        read.filter((F.col("rank") > 0) & F.col("year").isNotNull())
        .groupBy("key")
        .agg(F.min_by("year", F.struct("rank", "year")).alias("year"))
    )


@dataclass(frozen=True)
class Element:
    """Elements of a tag, a class or both."""

    tag: str | None = None
    css_class: str | None = None

    def inside(self, html: Column, outermost: bool = False) -> Column:
        return elements(html, self.tag, self.css_class, outermost)


@dataclass(frozen=True)
class PageRule:
    """How one kind of page lists entities.

    ``item`` finds the HTML of one entity: an expression (its first group), or the elements of a tag and class,
    each up to its own end tag.  With a ``container`` only what is in such elements counts.
    ``naming`` is how its name is found:
    ``text`` (plain text of the item), ``logo`` (file name of an image, else the link's host),
    ``card`` (heading, link or text lead) or ``alt`` (image text; the item is the image tag).
    """

    source: str
    item: str | Element
    naming: str
    location: str | None = None
    tagline_class: str | None = None
    location_class: str | None = None
    title_class: str | None = None
    logo_class: str | None = None
    container: Element | None = None


# An item ends at its end tag or where the next one starts, so that items within an item are items too.
LIST_ITEM = r"(?is)<li\b[^>]*>(.*?)(?=</li\s*>|<li\b)"
IMAGE = r"(?is)(<img\b[^>]*>)"


def card_item(css_class: str, tag: str = "div") -> str:
    """Cards without nested elements of their own tag."""
    return rf"(?is)(<{tag}\b[^>]*{class_of(css_class)}[^>]*>.*?</{tag}\s*>)"


def _item_name(rule: PageRule, item: Column) -> Column:
    text = squeeze(decoded(page_text(item)))
    if rule.naming == "text":
        return text
    if rule.naming == "alt":
        return attribute("img", "alt", item)
    if rule.naming == "logo":
        image = item
        if rule.logo_class:
            marked = rf"(?is)(<img\b[^>]*{class_of(rule.logo_class)}[^>]*>)"
            image = F.regexp_extract(item, marked, 1)
        spelled = name_from_image_file(attribute("img", "src", image))
        return F.when(spelled != "", spelled).otherwise(name_from_host(attribute("a", "href", item)))
    if rule.title_class:
        return classed_text(item, rule.title_class)
    heading = element_text(item, r"<(h[234])\b[^>]*>")
    strong = element_text(item, r"<(strong)\b[^>]*>")
    return card_name(
        F.when(heading != "", heading).otherwise(strong),
        element_text(item, r"<(a)\b[^>]*>"),
        text,
    )


def extract_page_entities(pages: DataFrame, rule: PageRule, html: str = "html") -> DataFrame:
    """Entity rows of landed pages: ``name, source, tagline, location, url, item_pos`` and the
    page's own columns.  Items without a name are left out."""
    kept = [F.col(c).alias(f"page_{c}" if c == "url" else c) for c in pages.columns if c != html]
    scope = F.col(html)
    if rule.container:
        scope = F.array_join(rule.container.inside(scope, outermost=True), "")
    if isinstance(rule.item, Element):
        listed = rule.item.inside(scope)
    else:
        listed = F.regexp_extract_all(scope, F.lit(rule.item), F.lit(1))
    items = pages.select(*kept, F.posexplode(listed).alias("item_pos", "item"))
    item = F.col("item")
    tagline = classed_text(item, rule.tagline_class) if rule.tagline_class else F.lit("")
    place = classed_text(item, rule.location_class) if rule.location_class else F.lit(rule.location or "")
    link = attribute("a", "href", item) if rule.naming in ("logo", "text") else F.lit("")
    found = items.withColumns({
        "name": _item_name(rule, item), "source": F.lit(rule.source), "tagline": tagline,
        "location": place, "url": link,
    }).drop("item")
    if rule.naming == "alt":
        found = found.filter(image_text_like(F.col("name"))).withColumn("name", squeeze(F.col("name")))
        found = _first_images(found, pages, rule)
    return found.filter(F.length("name") > 0)


def _first_images(found: DataFrame, pages: DataFrame, rule: PageRule) -> DataFrame:
    """Of the images of a source that spell one name, whatever its case, the first."""
    order = [F.col("ord"), F.col("item_pos")] if "ord" in pages.columns else [F.col("item_pos"), F.col("name")]
    place = F.row_number().over(Window.partitionBy(F.lower("name")).orderBy(*order))
    return found.withColumn("_place", place).filter("_place = 1").drop("_place")


def portfolio_rows(found: DataFrame) -> DataFrame:
    return found.filter(entity_name_like(F.col("name")))


