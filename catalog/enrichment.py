"""Pages, backfill, lookups, and checks against expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import areas, customers, suppliers, table, with_base
from muster.defaults import FOUNDING_PHRASES
from muster.operators import enrich, verify
from muster.operators.columns import tag


def list_items(spark, sf):
    """Navigation items of the pages as entities."""
    return enrich.extract_page_entities(
        table(spark, sf, "pages"), enrich.PageRule("pages", enrich.LIST_ITEM, "text")
    )


@query("page_entities", with_base(select="""
SELECT page_id, CAST(item_pos AS INTEGER) AS item_pos, name, url FROM portfolio"""))
def page_entities(spark, sf):
    return list_items(spark, sf).select("page_id", "item_pos", "name", "url")


@query("nested_cards", with_base(select="""
SELECT page_id, CAST(item_pos AS INTEGER) AS item_pos, name, CAST(item_pos AS VARCHAR) AS tagline FROM portfolio"""))
def nested_cards(spark, sf):
    """Cards that hold further elements of their own tag, in a container; what is outside is none."""
    items = F.regexp_extract_all("html", F.lit(r"(?is)<li\b[^>]*>(.*?)</li\s*>"), F.lit(1))
    card = lambda item, at: F.concat(
        F.lit('<div class="card wide"><div><div>Nr.</div><h3>'), item, F.lit("</h3></div><div class='note'>"), at.cast("string"), F.lit("</div> tail</div>"))
    cards = F.array_join(F.transform(items, card), "")
    shaped = table(spark, sf, "pages").select("page_id", F.concat(
        F.lit('<div class="card"><h3>Before</h3></div><section id="a" class="cards all"><!-- <div class="card"> -->'),
        cards, F.lit("</section>"), F.col("html"), F.lit('<div class="card"><h3>After</h3></div>')).alias("html"))
    rule = enrich.PageRule(
        "cards", enrich.Element("div", "card"), "card", tagline_class="note", container=enrich.Element(css_class="cards"))
    return enrich.extract_page_entities(shaped, rule).select("page_id", "item_pos", "name", "tagline")


_ABOUT_URL = ("regexp_extract(url, '^(https?://[^/?#]+)', 1) || "
              "(['', '/about', '/team/', '/press'])[page_id % 4 + 1]")


_STATED_HTML = "html || '<p>Established in ' || (1990 + page_id % 45) || '</p>'"


@query("website_years", f"""
WITH stated AS (
  SELECT page_id, rtrim({_ABOUT_URL}, '/') AS address, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS key,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace({_STATED_HTML}, '(?is)<script[^>]*>.*?</script>', ' ', 'g'),
           '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g') AS t
  FROM pages
),
shaped AS (
  SELECT address, key, list_min(list_filter(list_transform(list_concat(
           {", ".join(f"regexp_extract_all(t, '(?i){p}', 1)" for p in FOUNDING_PHRASES)}), lambda y: CAST(y AS INTEGER)),
         lambda y: y BETWEEN 1900 AND 2030)) AS year
  FROM stated
),
ranked AS (
  SELECT key, year, CASE address[len(key) + 1:] WHEN '' THEN 1 WHEN '/about' THEN 2 WHEN '/team' THEN 6 END AS rank
  FROM shaped WHERE year IS NOT NULL
)
SELECT key, CAST(year AS INTEGER) AS year FROM ranked WHERE rank IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY key ORDER BY rank, year) = 1""")
def website_years(spark, sf):
    """The whole pages with one more statement each, as if they were the usual pages of their hosts."""
    paths = F.array(*[F.lit(p) for p in ("", "/about", "/team/", "/press")])
    shaped = table(spark, sf, "pages").select(
        F.concat(F.regexp_extract("url", r"^(https?://[^/?#]+)", 1),
                 F.get(paths, (F.col("page_id") % 4).cast("int"))).alias("url"),
        F.concat("html", F.lit("<p>Established in "), (1990 + F.col("page_id") % 45).cast("string"), F.lit("</p>")).alias("html"),
    )
    return enrich.website_years(shaped)


_LOG_SQL = """log AS (
  SELECT ename AS name, c_custkey AS ord, (['city', 'founded_year', 'skipped', 'absent'])[c_custkey % 4 + 1] AS field,
         CASE WHEN c_custkey % 4 = 1 AND c_custkey % 3 = 0 THEN 'unknown'
              WHEN c_custkey % 4 = 1 THEN CAST(1990 + c_custkey % 30 AS VARCHAR) ELSE 'City ' || c_custkey END AS value
  FROM customers
),
wide AS (
  SELECT name, arg_min(value, ord) FILTER (field = 'city') AS city,
         arg_min(TRY_CAST(value AS INTEGER), ord) FILTER (field = 'founded_year' AND value <> 'unknown') AS founded_year
  FROM log
  GROUP BY name
)"""


@query("backfill_update", with_base(_LOG_SQL, select="""
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN n_name END, w.city,
                           CASE WHEN c_custkey % 3 = 1 THEN ' ' END) AS city,
       coalesce(CASE WHEN c_custkey % 5 = 0 THEN 1950 END, w.founded_year) AS founded_year
FROM customers LEFT JOIN wide w ON w.name = ename"""))
def backfill_update(spark, sf):
    key = F.col("c_custkey")
    rows = customers(spark, sf).select(
        "c_custkey", F.col("ename").alias("name"),
        F.when(key % 3 == 0, F.col("n_name")).when(key % 3 == 1, " ").alias("city"),
        F.when(key % 5 == 0, 1950).alias("founded_year"),
    )
    fields = F.array(*[F.lit(f) for f in ("city", "founded_year", "skipped", "absent")])
    log = customers(spark, sf).select(
        F.col("ename").alias("name"), key.alias("ord"), F.get(fields, (key % 4).cast("int")).alias("field"),
        F.when((key % 4 == 1) & (key % 3 == 0), "unknown")
        .when(key % 4 == 1, (1990 + key % 30).cast("string"))
        .otherwise(F.concat(F.lit("City "), key.cast("string"))).alias("value"),
    )
    return enrich.fill_from_log(rows, log, ["city", "founded_year", "absent"]).drop("name")


@query("enrich_coalesce", """
WITH by_cik AS (
  SELECT o_custkey, CAST(min(CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) END) AS INTEGER) AS y
  FROM orders WHERE o_custkey % 4 <> 0 GROUP BY o_custkey
),
by_url AS (SELECT s_suppkey, CAST(1990 + s_suppkey % 30 AS INTEGER) AS y FROM supplier)
SELECT c_custkey,
       coalesce(CASE WHEN c_custkey % 3 = 0 THEN 1950 END, by_cik.y, by_url.y) AS founded_year,
       CASE WHEN c_custkey % 3 = 0 THEN 'known' WHEN by_cik.y IS NOT NULL THEN 'cik'
            WHEN by_url.y IS NOT NULL THEN 'url' END AS filled_by
FROM customer LEFT JOIN by_cik ON o_custkey = c_custkey
LEFT JOIN by_url ON s_suppkey = CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 150 END""")
def enrich_coalesce(spark, sf):
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.when(key % 3 == 0, 1950).alias("founded_year"), key.cast("double").alias("cik"),
        F.when(key % 7 != 0, F.concat(F.lit("www.s"), (key % 150).cast("string"), F.lit(".com/"))).alias("website"),
    )
    by_cik = table(spark, sf, "orders").filter("o_custkey % 4 <> 0").select(
        F.col("o_custkey").cast("string").alias("key"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/a").alias("year"),
    )
    by_url = table(spark, sf, "supplier").select(
        F.concat(F.lit("https://www.s"), F.col("s_suppkey").cast("string"), F.lit(".com")).alias("key"),
        (1990 + F.col("s_suppkey") % 30).alias("year"),
    )
    filled = enrich.fill_years(rows, by_cik, by_url, source="filled_by")
    return filled.select("c_custkey", "founded_year", "filled_by")


_INCLUDED = [("Ring", "Brand#1"), ("small bolt", "Brand#2"), ("no such part", "Brand#3")]
_EXCLUDED = ["Widget, Inc.", "Unobtainium"]
_NAMES = "regexp_replace(lower(p_name || ' LLC'), ' llc$', '')"


@query("substring_spot_check", f"""
WITH wanted(category, company, msa, norm) AS (VALUES
  ('expected_included', 'Ring', 'Brand#1', 'ring'), ('expected_included', 'small bolt', 'Brand#2', 'small bolt'),
  ('expected_included', 'no such part', 'Brand#3', 'no such part'),
  ('expected_excluded', 'Widget, Inc.', '', 'widget'), ('expected_excluded', 'Unobtainium', '', 'unobtainium'))
SELECT category, company, msa, count(p_partkey) > 0 AS found_in_output, count(p_partkey) AS match_count,
       CASE WHEN (count(p_partkey) > 0) = (category = 'expected_included') THEN 'PASS' ELSE 'FAIL' END AS result
FROM wanted LEFT JOIN part ON contains({_NAMES}, norm) AND (msa = '' OR msa = p_brand)
GROUP BY category, company, msa""")
def substring_spot_check(spark, sf):
    roster = table(spark, sf, "part").select(
        F.concat("p_name", F.lit(" LLC")).alias("name"), F.col("p_brand").alias("msa")
    )
    return verify.spot_check(roster, _INCLUDED, _EXCLUDED)


@query("spot_check_list", f"""
WITH wanted AS (
  SELECT min(p_partkey) AS pos, p_name AS company, p_brand, CASE WHEN min(p_partkey) % 3 = 0 THEN '' ELSE p_brand END AS msa
  FROM part GROUP BY p_name, p_brand
),
names AS (SELECT {_NAMES} AS norm, p_brand AS area, count(*) AS n FROM part GROUP BY 1, 2),
hits AS (
  SELECT pos, sum(n) AS n FROM wanted JOIN names ON contains(norm, lower(company)) AND (msa = '' OR msa = area)
  GROUP BY pos
)
SELECT pos, CASE WHEN pos % 2 = 0 THEN 'expected_included' ELSE 'expected_excluded' END AS category, company, msa,
       n IS NOT NULL AS found_in_output, CAST(coalesce(n, 0) AS BIGINT) AS match_count,
       CASE WHEN (n IS NOT NULL) = (pos % 2 = 0) THEN 'PASS' ELSE 'FAIL' END AS result
FROM wanted LEFT JOIN hits USING (pos)""")
def spot_check_list(spark, sf):
    """Every different part of a brand, in a list of its own, found among all parts."""
    parts = table(spark, sf, "part")
    wanted = parts.groupBy(F.col("p_name").alias("company"), "p_brand").agg(F.min("p_partkey").alias("pos"))
    wanted = wanted.select(
        "pos", F.when(F.col("pos") % 2 == 0, "expected_included").otherwise("expected_excluded").alias("category"),
        "company", F.when(F.col("pos") % 3 == 0, "").otherwise(F.col("p_brand")).alias("msa"),
    )
    roster = parts.select(F.concat("p_name", F.lit(" LLC")).alias("name"), F.col("p_brand").alias("msa"))
    return verify.spot_check_list(roster, wanted)


@query("reconcile_counts", with_base("""ours AS (
  SELECT area AS msa, count(*) FILTER (c_custkey % 2 = 0) AS form_d, count(*) FILTER (c_custkey % 3 = 0) AS sbir
  FROM customers GROUP BY area
),
theirs AS (
  SELECT area AS msa, CASE WHEN s_suppkey % 2 = 0 THEN 'form_d' ELSE 'sbir' END AS source,
         CAST(sum(s_suppkey) AS BIGINT) AS n
  FROM suppliers WHERE area <> 'asia' OR s_suppkey % 2 = 0 GROUP BY ALL
),
pairs AS (
  SELECT msa, unnest(['form_d', 'sbir']) AS source, unnest([form_d, sbir]) AS our_count FROM ours
)""", select="""
SELECT p.msa, p.source, our_count, coalesce(n, 0) AS external_count,
       round(our_count / nullif(n, 0), 4) AS ratio,
       CASE WHEN nullif(n, 0) IS NULL THEN 'no_external_data'
            WHEN p.source = 'form_d' AND our_count / n BETWEEN 0.001 AND 0.20 THEN 'ok'
            WHEN p.source = 'sbir' AND our_count / n BETWEEN 0.05 AND 0.80 THEN 'ok'
            ELSE 'review' END AS flag_if_out_of_range
FROM pairs p LEFT JOIN theirs t ON p.msa = t.msa AND p.source = t.source"""))
def reconcile_counts(spark, sf):
    roster = customers(spark, sf).select(
        F.col("area").alias("msa"), (F.col("c_custkey") % 2 == 0).alias("source_form_d"),
        (F.col("c_custkey") % 3 == 0).alias("source_sbir"),
    )
    states = areas(spark, sf).groupBy(F.col("area").alias("msa")).agg(
        F.array(F.max("area_state"), F.lit("XX")).alias("state_codes")
    )
    even = F.col("s_suppkey") % 2 == 0
    external = suppliers(spark, sf).filter((F.col("area") != "asia") | even).groupBy(
        F.col("area_state").alias("state"), F.when(even, "form_d").otherwise("sbir").alias("source")
    ).agg(F.sum("s_suppkey").alias("external_count"))
    return verify.reconcile(roster, states, external)


@query("year_check", """
WITH drawn AS (
  SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders
  WHERE o_orderkey % 4 <> 0 ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 200
)
SELECT 'Order ' || o_orderkey AS company, CAST(o_custkey AS VARCHAR) AS cik, y AS our_founded_year,
       CASE WHEN o_custkey % 3 = 1 THEN CAST(1995 + o_custkey % 7 AS VARCHAR) END AS sec_year_of_incorp,
       CASE WHEN o_custkey % 3 = 1 THEN y = 1995 + o_custkey % 7 END AS match,
       CASE WHEN o_custkey % 3 <> 0 THEN 'fetched' ELSE 'skipped' END AS status
FROM drawn""")
def year_check(spark, sf):
    key = F.col("o_orderkey")
    roster = table(spark, sf, "orders").select(
        key.alias("ord"), F.concat(F.lit("Order "), key.cast("string")).alias("name"),
        F.col("o_custkey").cast("double").alias("cik"),
        F.when(key % 4 != 0, F.year("o_orderdate")).alias("founded_year"),
    )
    customer = F.col("c_custkey")
    external = table(spark, sf, "customer").filter(customer % 3 != 0).select(
        customer.alias("cik"), F.when(customer % 3 == 1, 1995 + customer % 7).alias("year")
    )
    return verify.year_check(roster, external, seed=7, n=200)


@query("seed_union", with_base(select="""
SELECT name, msa, source, tagline, location, url FROM (
  SELECT name, msa, 'pages' AS source, '' AS tagline, location, url FROM portfolio
  UNION ALL SELECT n_name, area, 'seed', '', '', '' FROM areas
) WHERE length(name) BETWEEN 2 AND 80
  AND lower(name) NOT IN ('home', 'menu', 'about', 'contact', 'search', 'learn more', 'read more', 'portfolio',
                          'companies', 'next', 'prev')"""))
def seed_union(spark, sf):
    from catalog.aggregates import portfolio_source
    from muster.plans.layers import build_portfolio

    seeds = areas(spark, sf).select(
        F.col("n_name").alias("name"), F.col("area").alias("msa"), F.col("n_nationkey").alias("ord")
    )
    built = build_portfolio([portfolio_source(spark, sf)], tag(seeds, source="seed"))
    return built.select("name", "msa", "source", "tagline", "location", "url")
