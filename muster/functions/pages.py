"""Expressions over the HTML of a page: plain text, founding year, parts of a card."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from muster.defaults import CARD_STATUS_WORDS, ENTITIES, FOUNDING_PHRASES, VOID_TAGS, YEAR_RANGE
from muster.functions.exprs import strip, title_case


def page_text(html: Column) -> Column:
    """Text of a page without script and style blocks and tags, blanks collapsed."""
    text = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style[^>]*>.*?</style>", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    return F.regexp_replace(text, r"(?U)\s+", " ")


def founding_year(
    html: Column,
    phrases: Sequence[str] = FOUNDING_PHRASES,
    low: int = YEAR_RANGE[0],
    high: int = YEAR_RANGE[1],
) -> Column:
    """Earliest plausible year that the page gives in a founding phrase."""

    def stated(text):
        return F.concat(*[F.regexp_extract_all(text, F.lit("(?iU)" + p), F.lit(1)) for p in phrases])

    # As the argument of a lambda, the text is made once for all phrases.
    found = F.flatten(F.transform(F.array(page_text(html)), stated))
    years = F.transform(found, lambda y: y.try_cast("int"))
    return F.array_min(F.filter(years, lambda y: y.between(low, high)))


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value made once: it is the argument of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decoded(text: Column) -> Column:
    """Text with its character references replaced: numeric ones and the named ones of ``ENTITIES``."""
    return _once(text, lambda t: F.when(F.contains(t, F.lit("&")), _replaced(t)).otherwise(t))


def _replaced(text: Column) -> Column:
    parts = F.split(text, r"&#(?=(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)")

    def character(part):
        digits = F.regexp_extract(part, r"^[xX]?([0-9a-fA-F]+);", 1)
        code = F.when(part.rlike("^[xX]"), F.conv(digits, 16, 16)).otherwise(F.conv(digits, 10, 16))
        known = F.conv(code, 16, 10).cast("bigint").between(1, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        return F.concat(F.when(known, char).otherwise(F.lit("\ufffd")), F.regexp_replace(part, r"^[xX]?[0-9a-fA-F]+;", ""))

    joined = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), character), ""))
    for name, character_of in ENTITIES.items():
        joined = F.replace(joined, F.lit(f"&{name};"), F.lit(character_of))
    return joined


def attribute(tag: str, name: str, html: Column) -> Column:
    """Value of an attribute of the first such tag that has it, '' if there is none.

    The value may stand in double quotes, in single ones or in none.
    """
    value = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
    found = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*?\s{name}\s*=\s*{value}", 1)
    return decoded(F.regexp_replace(found, r"""(?s)^(["'])(.*)\1$""", "$2"))


def elements(html: Column, tag: str | None = None, css_class: str | None = None, outermost: bool = False) -> Column:
    """HTML of every element of the tag and class, in page order, each up to its own end tag.

    Elements of the same tag inside it, and text after these, belong to an element; inside ones that fit are
    elements of their own unless only the ``outermost`` are asked for.  One without an end tag ends with the page.  What
    stands in comments, scripts and styles is no element.
    """
    marked = f"{class_of(css_class)}[^>]*" if css_class else ""
    fits = rf"(?is)^<{tag or '[a-z][a-z0-9:-]*'}(?![\w:-])[^>]*{marked}>"
    visible = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")

    def tags(parts):
        return F.transform(parts, lambda p, at: F.struct(
            at.alias("at"), F.lower(F.regexp_extract(p, r"^</?([A-Za-z][A-Za-z0-9:-]*)", 1)).alias("name"),
            p.startswith(F.lit("</")).alias("closing"), p.rlike(fits).alias("fits")))

    def own(tokens):
        names = F.array_distinct(F.transform(F.filter(tokens, lambda t: t["fits"]), lambda t: t["name"]))
        return _once(names, lambda known: F.filter(tokens, lambda t: F.array_contains(known, t["name"])))

    def found(parts):
        state = "struct<open:array<struct<at:int,name:string,depth:int>>,done:array<struct<at:int,until:int>>>"

        def step(s, t):
            # How deep each open element is in elements of its own tag; at zero its end tag is met.
            moved = F.transform(s["open"], lambda o: F.struct(o["at"].alias("at"), o["name"].alias("name"), (
                o["depth"] + F.when(o["name"] != t["name"], 0).when(t["closing"], -1).otherwise(1)).alias("depth")))
            starts = t["fits"] & ((F.size(s["open"]) == 0) | F.lit(not outermost))
            alone = t["name"].isin(*VOID_TAGS)
            fresh = F.array(F.struct(t["at"].alias("at"), t["name"].alias("name"), F.lit(1).alias("depth")))
            whole = F.array(F.struct(t["at"].alias("at"), t["at"].alias("until")))
            ended = F.transform(F.filter(moved, lambda o: o["depth"] == 0), lambda o: F.struct(o["at"].alias("at"), t["at"].alias("until")))
            still = F.filter(moved, lambda o: o["depth"] > 0)
            return F.struct(
                F.when(starts & ~alone, F.concat(still, fresh)).otherwise(still).alias("open"),
                F.when(starts & alone, F.concat(s["done"], whole)).otherwise(F.concat(s["done"], ended)).alias("done"))

        def finish(s):
            rest = F.transform(s["open"], lambda o: F.struct(o["at"].alias("at"), F.size(parts).alias("until")))
            return F.array_sort(F.concat(s["done"], rest))

        empty = F.from_json(F.lit('{"open":[],"done":[]}'), state)
        spans = F.aggregate(_once(tags(parts), own), empty, lambda s, t: step(s, t).cast(state), finish)
        end = lambda e: F.regexp_extract(F.get(parts, e["until"]), r"^[^>]*>", 0)
        return F.transform(spans, lambda e: F.concat(
            F.array_join(F.slice(parts, e["at"] + 1, F.greatest(e["until"] - e["at"], F.lit(0))), ""), F.coalesce(end(e), F.lit(""))))

    return _once(F.split(visible, "(?=<)"), found)


def element_text(html: Column, opening: str) -> Column:
    """Text inside the first element whose opening tag matches, '' if there is none.

    ``opening`` is an expression with the tag name as its only group.
    """
    inner = F.regexp_extract(html, rf"(?is){opening}(.*?)</\1\s*>", 2)
    return squeeze(decoded(page_text(inner)))


def classed_text(html: Column, css_class: str) -> Column:
    """Text of the first element that carries the class."""
    return element_text(html, rf"<(\w+)\b[^>]*{class_of(css_class)}[^>]*>")


def class_of(css_class: str) -> str:
    """Pattern of a class attribute that has the class among its own, in either quotes or none."""
    return rf"""\sclass\s*=\s*(?:"(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"|'(?:[^']*\s)?{css_class}(?:\s[^']*)?'|{css_class}(?=[\s>]))"""


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def name_from_image_file(path: Column) -> Column:
    """Entity name spelled by a logo file: no folder, ending, colour or logo mark, upload stamp."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)/*$", 1), r"(?<=.)\.[^.]*$", "")
    stem = F.regexp_replace(stem, r"(?i)-white(-e?\d+)?$", "")
    stem = F.regexp_replace(stem, r"(?i)-?logo$", "")
    stem = F.regexp_replace(stem, r"-?\d{8,}$", "")
    return title_case(strip(F.translate(stem, "-_", "  ")))


def name_from_host(url: Column) -> Column:
    """First label of a link's host, without ``www.``, as a name."""
    host = F.regexp_extract(url, r"https?://(?:www\.)?([^/#]+)", 1)
    return title_case(F.replace(F.substring_index(host, ".", 1), F.lit("-"), F.lit(" ")))


def card_name(
    heading: Column, link: Column, text: Column, status_words: Sequence[str] = CARD_STATUS_WORDS
) -> Column:
    """Heading of a card; its link text if the heading is a mere status; else the text lead."""
    lead = strip(F.regexp_extract(text, r"^([^I]{2,80}?)Institution:", 1))
    name = F.when(F.lower(heading).isin(*status_words), link).otherwise(heading)
    return F.when(name == "", lead).otherwise(name)
