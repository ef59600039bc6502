"""Rollups, merges, counts, pivots and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import (
    area_of_page,
    areas,
    award_rows,
    city_allowlist,
    filing_rows,
    grant_rows,
    location_of_page,
    sql_norm,
    suppliers,
    table,
    with_base,
)
from muster.functions.exprs import year_bucket
from muster.operators import report, rollup, verify
from muster.operators.filters import split_rejects
from muster.plans import geo
from muster.plans.layers import flatten_grants, scope_awards, scope_filings
from muster.sources import config


def filing_part(spark, sf):
    dim = config.city_dimension(city_allowlist(spark, sf))
    return rollup.rollup_filings(scope_filings(filing_rows(spark, sf), dim))


def award_part(spark, sf):
    dim = config.city_dimension(city_allowlist(spark, sf))
    return rollup.rollup_awards(scope_awards(award_rows(spark, sf), dim))


def grant_part(spark, sf):
    return rollup.rollup_grants(flatten_grants(grant_rows(spark, sf)))


@query("filing_rollup", with_base(select="""
SELECT msa, name, cik, city, state, zip, year_incorp, entity_type, industry, form_d_filings,
       true AS source_form_d
FROM filing_part"""))
def filing_rollup(spark, sf):
    return filing_part(spark, sf)


@query("award_rollup", with_base(select="""
SELECT msa, name, uei, duns, city, state, zip, website, employees, sbir_awards,
       round(sbir_total_usd, 2) AS sbir_total_usd, sbir_first_year, sbir_last_year, true AS source_sbir
FROM award_part"""))
def award_rollup(spark, sf):
    return award_part(spark, sf).withColumn("sbir_total_usd", F.round("sbir_total_usd", 2))


@query("grant_rollup", with_base(select="""
SELECT msa, name, city, state, zip, nih_grants, round(nih_total_usd, 2) AS nih_total_usd,
       true AS source_nih
FROM grant_part"""))
def grant_rollup(spark, sf):
    return grant_part(spark, sf).withColumn("nih_total_usd", F.round("nih_total_usd", 2))


MERGED_SQL = f"""stacked AS (
  SELECT 0 AS rank, * FROM filing_part
  UNION ALL BY NAME SELECT 1 AS rank, * FROM award_part
  UNION ALL BY NAME SELECT 2 AS rank, * FROM grant_part
),
keyed AS (
  SELECT *, {sql_norm('name')} AS name_norm,
         row_number() OVER (ORDER BY rank, name) AS o FROM stacked
),
merged AS (
  SELECT msa, name_norm, arg_min(name, o) AS name,
         arg_min(cik, o) FILTER (cik IS NOT NULL) AS cik, arg_min(uei, o) FILTER (uei IS NOT NULL) AS uei,
         arg_min(duns, o) FILTER (duns IS NOT NULL) AS duns,
         arg_min(city, o) FILTER (city IS NOT NULL) AS city,
         arg_min(state, o) FILTER (state IS NOT NULL) AS state,
         arg_min(zip, o) FILTER (zip IS NOT NULL) AS zip,
         arg_min(year_incorp, o) FILTER (year_incorp IS NOT NULL) AS year_incorp,
         arg_min(entity_type, o) FILTER (entity_type IS NOT NULL) AS entity_type,
         arg_min(industry, o) FILTER (industry IS NOT NULL) AS industry,
         arg_min(website, o) FILTER (website IS NOT NULL) AS website,
         arg_min(employees, o) FILTER (employees IS NOT NULL) AS employees,
         bool_or(rank = 0) AS source_form_d, bool_or(rank = 1) AS source_sbir,
         bool_or(rank = 2) AS source_nih,
         CAST(coalesce(sum(form_d_filings), 0) AS BIGINT) AS form_d_filings,
         CAST(coalesce(sum(sbir_awards), 0) AS BIGINT) AS sbir_awards,
         round(coalesce(sum(sbir_total_usd), 0), 2) AS sbir_total_usd,
         CAST(coalesce(sum(nih_grants), 0) AS BIGINT) AS nih_grants,
         round(coalesce(sum(nih_total_usd), 0), 2) AS nih_total_usd,
         arg_min(sbir_first_year, o) FILTER (sbir_first_year IS NOT NULL) AS sbir_first_year,
         arg_min(sbir_last_year, o) FILTER (sbir_last_year IS NOT NULL) AS sbir_last_year
  FROM keyed WHERE name_norm <> '' GROUP BY msa, name_norm
)"""


@query("roster_merge", with_base(MERGED_SQL, select="SELECT * FROM merged"))
def roster_merge(spark, sf):
    stacked = rollup.stack_sources({
        "filings": filing_part(spark, sf), "awards": award_part(spark, sf), "grants": grant_part(spark, sf),
    })
    merged = rollup.merge_sources(stacked).withColumns({
        "sbir_total_usd": F.round("sbir_total_usd", 2), "nih_total_usd": F.round("nih_total_usd", 2),
        **{c: F.coalesce(F.col(c), F.lit(False)) for c in ("source_form_d", "source_sbir", "source_nih")},
    })
    return merged.drop("ord")


@query("cluster_collapse", """
SELECT c_nationkey AS cluster, CAST(min(c_custkey) AS BIGINT) AS ord,
       bool_or(c_custkey % 90 = 0) AS source_form_d,
       CAST(coalesce(sum(CASE WHEN c_nationkey % 3 <> 0 THEN c_custkey END), 0) AS BIGINT) AS nih_grants,
       arg_min(CASE WHEN c_custkey % 4 = 0 THEN c_name END, c_custkey)
         FILTER (CASE WHEN c_custkey % 4 = 0 THEN c_name END IS NOT NULL) AS name,
       CAST(NULL AS VARCHAR) AS city
FROM customer GROUP BY c_nationkey""")
def cluster_collapse(spark, sf):
    """Nulls inside clusters: flags, a sum of nothing, and a first value that comes late or never."""
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("cluster"), key.alias("ord"),
        F.when(key % 2 == 0, key % 90 == 0).alias("source_form_d"),
        F.when(F.col("c_nationkey") % 3 != 0, key).alias("nih_grants"),
        F.when(key % 4 == 0, F.col("c_name")).alias("name"),
        F.lit(None).cast("string").alias("city"),
    )
    flags, sums, firsts = rollup.classes_of(rows.columns, ["cluster", "ord"])
    return rollup.canonical_agg(rows, ["cluster"], "ord", flags, sums, firsts)


@query("interim_counts", """
SELECT CAST(c_nationkey AS VARCHAR) AS msa, count(*) AS total,
       count(*) FILTER (c_custkey % 2 = 0) AS funded_form_d, count(*) FILTER (c_custkey % 3 = 0) AS sbir_recipients,
       count(*) FILTER (c_custkey % 5 = 0) AS nih_recipients, count(*) FILTER (c_mktsegment = 'MACHINERY') AS confirmed_strong
FROM customer GROUP BY c_nationkey""")
def interim_counts(spark, sf):
    key = F.col("c_custkey")
    return report.interim_counts(table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("msa"), (key % 2 == 0).alias("source_form_d"),
        (key % 3 == 0).alias("source_sbir"), (key % 5 == 0).alias("source_nih"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "confirmed_strong").alias("tier"),
    ))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "ABSENT"]


@query("pivot_tier", f"""
SELECT n_name AS msa, {", ".join(f"count(*) FILTER (c_mktsegment = '{s}') AS {s}" for s in _SEGMENTS)},
       count(CASE WHEN c_mktsegment IN ({", ".join(f"'{s}'" for s in _SEGMENTS)}) THEN 1 END) AS "TOTAL"
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def pivot_tier(spark, sf):
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).withColumnsRenamed({"n_name": "msa", "c_mktsegment": "tier"})
    return report.tier_pivot(rows, _SEGMENTS)


@query("pivot_subcategory", """
SELECT p_brand AS msa, count(*) FILTER (p_type = 'SMALL') AS "SMALL", count(*) FILTER (p_type = 'LARGE') AS "LARGE",
       count(*) FILTER (p_type IN ('SMALL', 'LARGE')) AS "TOTAL_STARTUPS"
FROM part GROUP BY p_brand""")
def pivot_subcategory(spark, sf):
    rows = table(spark, sf, "part").withColumnsRenamed({"p_brand": "msa", "p_type": "ls_subcategory"})
    return report.subcategory_pivot(rows, ["SMALL", "LARGE"])


_BUCKETS = ["2015-2019", "2020", "2021", "2022", "2023", "2024", "2025-2026", "Unknown"]


@query("pivot_bucket", f"""
WITH b AS (
  SELECT o_orderpriority AS msa, CASE WHEN y IS NULL THEN 'Unknown' WHEN y <= 2019 THEN '2015-2019'
    WHEN y >= 2025 THEN '2025-2026' ELSE CAST(y AS VARCHAR) END AS bucket
  FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 9 <> 0 THEN year(o_orderdate) + 22 END AS y FROM orders)
)
SELECT msa, {", ".join(f"count(*) FILTER (bucket = '{b}') AS " + chr(34) + b + chr(34) for b in _BUCKETS)}
FROM b GROUP BY msa""")
def pivot_bucket(spark, sf):
    return report.founded_pivot(table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("msa"),
        F.when(F.col("o_orderkey") % 9 != 0, F.year("o_orderdate") + 22).alias("founded_year"),
    ))


@query("year_buckets", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) + 22 <= 2019 THEN '2015-2019'
  WHEN year(o_orderdate) + 22 >= 2025 THEN '2025-2026' ELSE CAST(year(o_orderdate) + 22 AS VARCHAR) END AS bucket
FROM orders""")
def year_buckets(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", year_bucket(F.year("o_orderdate") + 22).alias("bucket")
    )


@query("group_counts", """
SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source""")
def group_counts(spark, sf):
    return rollup.group_counts(table(spark, sf, "documents"), "lang", "source")


@query("slice_summary", """
SELECT year(o_orderdate) || 'q' || quarter(o_orderdate) AS _quarter, count(*) AS total_rows,
       count(*) FILTER (o_totalprice > 200000) AS kept
FROM orders GROUP BY 1""")
def slice_summary(spark, sf):
    from muster.functions.exprs import quarter_tag

    tagged = table(spark, sf, "orders").withColumn("_quarter", quarter_tag(F.col("o_orderdate")))
    return rollup.slice_summary(tagged, "_quarter", F.col("o_totalprice") > 200000)


@query("filled_counts", """
SELECT count(*) AS rows, count(CASE WHEN c_custkey % 3 = 0 THEN c_name END) AS name,
       count(c_acctbal) AS balance FROM customer""")
def filled_counts(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("name"), F.col("c_acctbal").alias("balance")
    )
    return rollup.filled_counts(rows, "name", "balance")


@query("distinct_firms", """
SELECT p_brand, count(DISTINCT lower(trim(p_name))) AS firms FROM part GROUP BY p_brand""")
def distinct_firms(spark, sf):
    name = F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.concat(F.lit(" "), "p_name"))
    return verify.distinct_firms(table(spark, sf, "part"), ["p_brand"], name)


@query("check_tallies", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS passed, count(*) AS checks
FROM orders GROUP BY o_orderpriority""")
def check_tallies(spark, sf):
    return verify.tally(table(spark, sf, "orders"), "o_orderstatus", "F", "o_orderpriority")


# -- geography dimensions --------------------------------------------------------------------

_CROSSWALK_SQL = """crosswalk AS (
  SELECT CAST(l_partkey AS VARCHAR) AS zip, n_name AS county, ' ' || n_name || ' ' AS city,
         lower(area_state) AS state, l_discount AS res_ratio, area AS msa,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS ord
  FROM lineitem JOIN suppliers ON l_suppkey = s_suppkey
)"""


def crosswalk(spark, sf):
    """Order lines as crosswalk rows: part = ZIP code, supplier's nation = county."""
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount")
        .join(suppliers(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_partkey").cast("string").alias("geoid"), F.col("n_name").alias("county"),
            F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("city"),
            F.lower("area_state").alias("state"), F.col("l_discount").alias("res_ratio"),
            (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("ord"),
        )
    )


def area_config(spark, sf):
    """Areas with their nations as counties, in key order, and curated cities."""
    ordered = areas(spark, sf).groupBy(F.col("area").alias("msa")).agg(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n"),
        F.array(F.max("area_state"), F.lit("XX")).alias("state_codes"),
    )
    return ordered.select(
        "msa", "state_codes", F.col("n.n_name").alias("county_fips"),
        F.array(F.lit("Springfield"), F.get("n.n_name", F.lit(0))).alias("notable_cities"),
    )


@query("max_ratio_dedup", with_base(_CROSSWALK_SQL, select="""
SELECT msa, zip, county_fips, state, res_ratio FROM (
  SELECT msa, zip, county AS county_fips, upper(state) AS state, res_ratio, row_number() OVER (
    PARTITION BY msa, zip ORDER BY res_ratio DESC, n_nationkey, ord) AS r
  FROM crosswalk JOIN nation ON county = n_name WHERE res_ratio > 0
) WHERE r = 1"""))
def max_ratio_dedup(spark, sf):
    return geo.zip_dim(geo.area_crosswalk(crosswalk(spark, sf), area_config(spark, sf)))


@query("city_counts", with_base(_CROSSWALK_SQL, select="""
SELECT msa, lower(trim(city)) AS city_normalized, upper(state) AS state, CAST(count(*) AS INTEGER) AS zip_count
FROM crosswalk WHERE res_ratio > 0 GROUP BY ALL"""))
def city_counts(spark, sf):
    return geo.city_counts(geo.area_crosswalk(crosswalk(spark, sf), area_config(spark, sf)))


_CURATED_SQL = """curated AS (
  SELECT area AS msa, unnest(['springfield', lower(arg_min(n_name, n_nationkey))]) AS city_normalized,
         max(area_state) AS s FROM areas GROUP BY area
),
curated_states AS (SELECT msa, city_normalized, unnest([s, 'XX']) AS state FROM curated)"""


@query("curated_cross", with_base(_CURATED_SQL, select="""
SELECT msa, city_normalized, state, 0 AS zip_count FROM curated_states"""))
def curated_cross(spark, sf):
    return geo.curated_cities(area_config(spark, sf))


@query("geo_dims", with_base(_CROSSWALK_SQL, _CURATED_SQL, select="""
SELECT msa, city_normalized, state, CAST(max(zip_count) AS INTEGER) AS zip_count FROM (
  SELECT msa, lower(trim(city)) AS city_normalized, upper(state) AS state, count(*) AS zip_count
  FROM crosswalk WHERE res_ratio > 0 GROUP BY ALL
  UNION ALL SELECT msa, city_normalized, state, 0 FROM curated_states
) GROUP BY ALL"""))
def geo_dims(spark, sf):
    return geo.build_geo_dims(crosswalk(spark, sf), area_config(spark, sf))[1]


# -- set operations --------------------------------------------------------------------------


@query("union_by_name", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def union_by_name(spark, sf):
    one = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    two = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return rollup.stack_sources({"customers": one, "none": None, "suppliers": two}).drop("ord")


@query("complement", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_totalprice > 100000 THEN 'large' END AS drop_reason
FROM orders""")
def complement(spark, sf):
    """A predicate that is null for many rows: these are kept, and no row is lost."""
    drop = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") > 100000)
    kept, rejected = split_rejects(table(spark, sf, "orders"), drop, "large")
    return kept.unionByName(rejected, allowMissingColumns=True).select("o_orderkey", "drop_reason")


def portfolio_source(spark, sf):
    from catalog.enrichment import list_items

    return list_items(spark, sf).select(
        "page_id", "item_pos", "name", "source", "tagline", "url",
        area_of_page().alias("msa"), location_of_page().alias("location"),
        (F.col("page_id") * 1000 + F.col("item_pos")).alias("ord"),
    )

