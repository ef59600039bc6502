"""Filters, predicates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import (
    PLACES,
    area_of_page,
    areas,
    award_rows,
    city_allowlist,
    customers,
    filing_rows,
    location_of_page,
    quote_list,
    sql_norm,
    sql_resolve,
    suppliers,
    table,
    with_base,
)
from muster import defaults
from muster.functions.names import normalize_name
from muster.operators import columns, filters, joins
from muster.plans.layers import CITY_STATE, normalized_filings, scope_filings
from muster.sources.config import city_dimension

KEPT_REGIONS = ["asia", "europe"]


@query("geo_scope_join", with_base(select=f"""
SELECT c_custkey, lower(n_name) AS _city_norm, area_state AS _state_norm, area AS _msa
FROM customers WHERE area IN ({quote_list(KEPT_REGIONS)}) AND {sql_norm('ename')} <> ''"""))
def geo_scope_join(spark, sf):
    dim = city_dimension(city_allowlist(spark, sf).filter(F.col("msa").isin(*KEPT_REGIONS)))
    rows = customers(spark, sf).select(
        "c_custkey", "ename", F.lower("n_name").alias("_city_norm"), F.col("area_state").alias("_state_norm")
    )
    return joins.scope(rows, dim, CITY_STATE, filters.named(normalize_name(F.col("ename")))).select(
        "c_custkey", "_city_norm", "_state_norm", "_msa"
    )


@query("scope_filter", with_base(select="""
SELECT ord, name, msa, industry FROM scoped_filings"""))
def scope_filter(spark, sf):
    scoped = scope_filings(filing_rows(spark, sf), city_dimension(city_allowlist(spark, sf)))
    return scoped.select(
        "ord", F.col("ENTITYNAME").alias("name"), F.col("_msa").alias("msa"),
        F.col("_industry_norm").alias("industry"),
    )


@query("three_way_left_join", """
SELECT l_orderkey AS "ACCESSIONNUMBER", l_linenumber AS line, l_linestatus AS status,
       o_orderstatus AS status_o, strftime(l_shipdate, '%Y-%m-%d') AS "FILING_DATE"
FROM (SELECT l_orderkey, l_linenumber, l_linestatus, l_shipdate FROM lineitem)
LEFT JOIN (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F') ON l_orderkey = o_orderkey""")
def three_way_left_join(spark, sf):
    """Lines as issuers, open orders as offerings, distinct dated lines as submissions."""
    lines = table(spark, sf, "lineitem")
    key = F.col("l_orderkey").alias("ACCESSIONNUMBER")
    issuers = lines.select(
        key, F.col("l_linenumber").alias("line"), F.col("l_linestatus").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )
    offerings = table(spark, sf, "orders").filter("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("ACCESSIONNUMBER"), F.col("o_orderstatus").alias("status")
    )
    submissions = issuers.select("ACCESSIONNUMBER", F.col("shipped").alias("FILING_DATE")).distinct()
    joined = joins.join_filing_tables(issuers, offerings, submissions)
    # An order has several dated lines, so the join fans out; each line keeps its own date.
    return joined.filter("FILING_DATE = shipped").select(
        "ACCESSIONNUMBER", "line", "status", "status_o", "FILING_DATE"
    )


@query("filing_fan_out", """
SELECT l_orderkey AS "ACCESSIONNUMBER", l_linenumber AS line, o_orderstatus AS status, p_type AS kind
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN (SELECT DISTINCT p_size, p_type FROM part) ON l_orderkey = p_size""")
def filing_fan_out(spark, sf):
    """One row per combination, kept even where the right side has none."""
    issuers = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("ACCESSIONNUMBER"), F.col("l_linenumber").alias("line")
    )
    offerings = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ACCESSIONNUMBER"), F.col("o_orderstatus").alias("status")
    )
    submissions = table(spark, sf, "part").select(
        F.col("p_size").cast("bigint").alias("ACCESSIONNUMBER"), F.col("p_type").alias("FILING_DATE")
    ).distinct()
    return joins.join_filing_tables(issuers, offerings, submissions).withColumnRenamed(
        "FILING_DATE", "kind"
    )


@query("noise_names", with_base(select=f"""
SELECT page_id, CAST(item_pos AS INTEGER) AS item_pos, name FROM portfolio
WHERE length(name) BETWEEN 2 AND 80 AND lower(name) NOT IN ({quote_list(defaults.NAVIGATION_WORDS + ['la', 'sch'])})
  AND length(name) BETWEEN 3 AND 60 AND NOT regexp_matches(lower(name), 'logo|icon|image|photo|background|(.png|.jpg|.jpeg)$')"""))
def noise_names(spark, sf):
    from catalog.enrichment import list_items

    words = defaults.NAVIGATION_WORDS + ["la", "sch"]
    return list_items(spark, sf).filter(
        filters.entity_name_like(F.col("name"), words) & filters.image_text_like(F.col("name"))
    ).select("page_id", "item_pos", "name")


@query("tier_filter", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def tier_filter(spark, sf):
    return table(spark, sf, "orders").filter(
        filters.startup_tier(F.col("o_orderstatus"), ["F", "P"])
    ).select("o_orderkey", "o_orderstatus")


@query("ratio_filter", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0 AND l_returnflag <> ''""")
def ratio_filter(spark, sf):
    return table(spark, sf, "lineitem").filter(
        filters.residential(F.col("l_returnflag"), F.col("l_discount"))
    ).select("l_orderkey", "l_linenumber", "l_discount")


@query("enrich_targets", """
SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 > 2""")
def enrich_targets(spark, sf):
    key = F.col("o_orderkey")
    year = F.when(key % 3 != 0, F.year("o_orderdate"))
    url = F.when(key % 5 == 1, " ").when(key % 5 == 2, "NaN").when(key % 5 > 2, F.col("o_orderstatus"))
    return table(spark, sf, "orders").filter(filters.enrichable(year, url)).select("o_orderkey")


def _place_sql() -> str:
    return " OR ".join(
        f"(msa = '{area}' AND regexp_matches(place, '{'|'.join(w.replace('.', '[.]') for w in words)}'))"
        for area, words in PLACES.items()
    )


@query("geo_anti_keywords", f"""
WITH listed AS (
  SELECT page_id, (['africa', 'america', 'asia', 'europe', 'middle east'])[page_id % 5 + 1] AS msa,
         lower((['Boston, MA', 'Lagos, NG', '', 'Lima,PE'])[page_id % 4 + 1]) AS place,
         page_id % 7 <> 0 AS source_tto
  FROM pages
)
SELECT page_id, msa, place, CASE WHEN source_tto AND place <> '' AND ({_place_sql()})
       THEN 'outside' END AS drop_reason
FROM listed""")
def geo_anti_keywords(spark, sf):
    listed = table(spark, sf, "pages").select(
        "page_id", area_of_page().alias("msa"), F.lower(location_of_page()).alias("place"),
        (F.col("page_id") % 7 != 0).alias("source_tto"),
    )
    drop = filters.out_of_area(F.col("source_tto"), F.col("place"), F.col("msa"), PLACES)
    kept, rejected = filters.split_rejects(listed, drop, "outside")
    return kept.unionByName(rejected, allowMissingColumns=True).drop("source_tto")


@query("place_keywords", f"""
SELECT doc_id FROM documents
WHERE regexp_matches(lower(trim(text)), 'nyc|l[.]a[.]|tion the|que de')
  AND lang IN ('en', 'fr')""")
def place_keywords(spark, sf):
    """Whole texts searched for the literal words of their language."""
    words = ["nyc", "l.a.", "tion the", "que de"]
    bad = filters.out_of_area(F.lit(True), F.col("text"), F.col("lang"), {"en": words, "fr": words})
    return table(spark, sf, "documents").filter(bad).select("doc_id")


@query("category_filter", f"""
SELECT p_partkey, p_type, p_name FROM part
WHERE p_type IN ('SMALL', 'LARGE')
   OR ((p_type IS NULL OR p_type = 'ECONOMY') AND regexp_matches(p_name, '(?i)RING|bolt'))""")
def category_filter(spark, sf):
    keep = filters.kept_category(
        F.col("p_type"), F.col("p_name"), ["SMALL", "LARGE"], "RING|bolt", unknown="ECONOMY"
    )
    return table(spark, sf, "part").filter(keep).select("p_partkey", "p_type", "p_name")


@query("category_by_text", f"""
SELECT doc_id FROM documents
WHERE lang = 'de' OR (lang = 'en' AND regexp_matches(text, '(?i){defaults.KEPT_NAME_WORDS}'))""")
def category_by_text(spark, sf):
    keep = filters.kept_category(F.col("lang"), F.col("text"), ["de"], unknown="en")
    return table(spark, sf, "documents").filter(keep).select("doc_id")


_SPENT = """
WITH spent AS (
  SELECT o_custkey, min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year,
         sum(o_totalprice) AS total, bool_or(o_orderstatus = 'P') AS filed
  FROM orders GROUP BY o_custkey
)"""


def _spent(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min(F.year("o_orderdate")).alias("first_year"),
        F.max(F.year("o_orderdate")).alias("last_year"),
        F.sum("o_totalprice").alias("total"),
        F.bool_or(F.col("o_orderstatus") == "P").alias("filed"),
    )


@query("recency_filter", _SPENT + """
SELECT o_custkey, CAST(last_year AS INTEGER) AS last_year, filed FROM spent
WHERE coalesce(CASE WHEN o_custkey % 2 = 0 THEN filed END, false) OR last_year >= 2001""")
def recency_filter(spark, sf):
    filed = F.when(F.col("o_custkey") % 2 == 0, F.col("filed"))
    keep = filters.recent(filed, F.lit(None).cast("boolean"), F.col("last_year"), since=2001)
    return _spent(spark, sf).filter(keep).select("o_custkey", "last_year", "filed")


@query("maturity_filter", _SPENT + """
SELECT o_custkey, round(total, 2) AS total FROM spent
WHERE NOT (last_year - first_year > 5 AND total > 2000000)""")
def maturity_filter(spark, sf):
    drop = filters.mature(F.col("first_year"), F.col("last_year"), F.col("total"), 5, 2_000_000)
    return _spent(spark, sf).filter(~drop).select("o_custkey", F.round("total", 2).alias("total"))


_VEHICLES = [
    ("brand_one", r"\bBrand\s+1\b"), ("ring_inc", r"\bring\b.*\bInc\b"), ("holdings", r"Holdings\s+Co\.?$"),
]


@query("vehicle_regex", with_base(select="""
SELECT c_custkey, CASE WHEN regexp_matches(ename, '(?i)\\bBrand\\s+1\\b') THEN 'brand_one'
       WHEN regexp_matches(ename, '(?i)\\bring\\b.*\\bInc\\b') THEN 'ring_inc'
       WHEN regexp_matches(ename, '(?i)Holdings\\s+Co\\.?$') THEN 'holdings' END AS drop_rule
FROM customers"""))
def vehicle_regex(spark, sf):
    return customers(spark, sf).select(
        "c_custkey", filters.vehicle_rule(F.col("ename"), _VEHICLES).alias("drop_rule")
    )


def _default_vehicles_sql() -> str:
    cases = " ".join(
        f"WHEN regexp_matches(n, '(?i)' || '{p.replace(chr(39), chr(39) * 2)}') THEN '{label}'"
        for label, p in defaults.VEHICLE_RULES
    )
    return f"CASE {cases} END"


_ENDINGS = ["Series #", "Fund Alpha ", "Fund IV ", "Investors LLC ", "Acquisitions, LLC", "Labs ",
            "- Series Beta ", "SPV "]


@query("vehicle_defaults", with_base(f"""shaped AS (
  SELECT c_custkey, pname || ' ' || ([{quote_list(_ENDINGS)}])[c_custkey % 8 + 1]
         || CASE WHEN c_custkey % 8 = 4 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS n
  FROM customer JOIN parts ON c_custkey = p_partkey)""", select=f"""
SELECT c_custkey, {_default_vehicles_sql()} AS drop_rule FROM shaped"""))
def vehicle_defaults(spark, sf):
    from catalog.tables import parts

    key = F.col("c_custkey")
    ending = F.get(F.array(*[F.lit(e) for e in _ENDINGS]), (key % 8).cast("int"))
    number = F.when(key % 8 == 4, "").otherwise(key.cast("string"))
    return table(spark, sf, "customer").join(parts(spark, sf), key == F.col("p_partkey")).select(
        "c_custkey", filters.vehicle_rule(F.concat("pname", F.lit(" "), ending, number)).alias("drop_rule")
    )


@query("public_anti_join", """
SELECT c_custkey, ticker,
       CASE WHEN ticker IS NOT NULL THEN 'listed on an exchange' END AS drop_reason
FROM customer LEFT JOIN (SELECT s_suppkey * 3 AS cik, 'T' || s_suppkey AS ticker FROM supplier)
  ON CASE WHEN c_custkey % 4 <> 0 THEN c_custkey END = cik""")
def public_anti_join(spark, sf):
    key = F.col("s_suppkey")
    tickers = table(spark, sf, "supplier").select(
        (key * 3).cast("string").alias("cik"), F.concat(F.lit("T"), key.cast("string")).alias("ticker")
    )
    cik = F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey").cast("double"))
    looked_up = joins.with_ticker(table(spark, sf, "customer").select("c_custkey", cik.alias("cik")), tickers)
    kept, rejected = filters.split_rejects(looked_up, F.col("ticker").isNotNull(), "listed on an exchange")
    return kept.unionByName(rejected, allowMissingColumns=True).drop("cik")


@query("exclusion_anti_join", with_base(select=f"""
SELECT c_custkey, ename FROM customers
WHERE {sql_resolve('ename')} NOT IN (SELECT {sql_resolve('ename')} FROM suppliers)"""))
def exclusion_anti_join(spark, sf):
    names = suppliers(spark, sf).select(F.col("ename").alias("name"))
    return joins.exclude_names(customers(spark, sf), names, "ename").select("c_custkey", "ename")


@query("exclusion_marks", with_base(select=f"""
SELECT c_custkey, {sql_resolve('ename')} IN (SELECT {sql_resolve('ename')} FROM suppliers) AS excluded
FROM customers"""))
def exclusion_marks(spark, sf):
    names = suppliers(spark, sf).select(F.col("ename").alias("name"))
    return joins.mark_listed(customers(spark, sf), names, "excluded", "ename").select("c_custkey", "excluded")


@query("column_order", """
SELECT c_name, c_custkey, c_acctbal, c_mktsegment, c_nationkey FROM customer""")
def column_order(spark, sf):
    return columns.order_columns(table(spark, sf, "customer"), ["c_name", "c_custkey", "absent"])


@query("provenance_tags", """
SELECT n_nationkey AS key, n_name AS name, 'nation' AS _layer, 2024 AS _fy FROM nation""")
def provenance_tags(spark, sf):
    renamed = table(spark, sf, "nation").withColumnsRenamed({"n_nationkey": "key", "n_name": "name"})
    return columns.tag(renamed.drop("n_regionkey"), _layer="nation", _fy=2024)


@query("alias_columns", with_base(select="""
SELECT ord, lower(trim(city)) AS _city_norm, upper(state) AS _state_norm, industry AS _industry_norm,
       CAST(NULL AS VARCHAR) AS absent
FROM filings"""))
def alias_columns(spark, sf):
    raw = filing_rows(spark, sf).withColumnsRenamed(
        {"CITY": "ISSUER_CITY", "STATEORCOUNTRY": "ISSUER_STATEORCOUNTRY"}
    )
    return columns.ensure_columns(normalized_filings(raw), {"absent": "string"}).select(
        "ord", *CITY_STATE, "_industry_norm", "absent"
    )


@query("award_scope", with_base(select="""
SELECT ord, name, lower(city) AS _city_norm, state AS _state_norm, msa FROM awards"""))
def award_scope(spark, sf):
    from muster.plans.layers import scope_awards

    scoped = scope_awards(award_rows(spark, sf), city_dimension(city_allowlist(spark, sf)))
    return scoped.select("ord", F.col("Company").alias("name"), *CITY_STATE, F.col("_msa").alias("msa"))


@query("area_lookup", with_base(select="SELECT n_nationkey, area, area_state FROM areas"))
def area_lookup(spark, sf):
    """Nations scoped by the city allowlist, in which each of them is a city."""
    keyed = areas(spark, sf).select("n_nationkey", F.lower("n_name").alias("_city_norm"), F.col("area_state").alias("_state_norm"))
    scoped = joins.scope(keyed, city_dimension(city_allowlist(spark, sf)), CITY_STATE)
    return scoped.select("n_nationkey", F.col("_msa").alias("area"), F.col("_state_norm").alias("area_state"))
