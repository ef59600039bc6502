"""Sorts, top-k, first per key, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.rules import SCORE_SQL, _SCORED_SQL, scored_customers
from catalog.tables import customers, table, with_base
from muster import defaults
from muster.operators import report, rules
from muster.sources import config


@query("sorted_capped", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50""")
def sorted_capped(spark, sf):
    rows = table(spark, sf, "customer").withColumn("ord", F.struct(-F.col("c_acctbal"), "c_custkey"))
    return report.capped(rows, "ord", 50).select("c_custkey", "c_name", "c_acctbal")


@query("distinct_values", """
SELECT DISTINCT lang FROM documents""")
def distinct_values(spark, sf):
    return report.distinct_values(table(spark, sf, "documents"), "lang")


@query("top_k_per_group", with_base(select="""
SELECT area AS msa, c_custkey AS ord, ename AS name, c_acctbal AS priority_score FROM customers
QUALIFY row_number() OVER (PARTITION BY area ORDER BY c_acctbal DESC, ename, c_custkey) <= 25"""))
def top_k_per_group(spark, sf):
    return report.top_prospects(customers(spark, sf).select(
        F.col("area").alias("msa"), F.col("c_custkey").alias("ord"), F.col("ename").alias("name"),
        F.col("c_acctbal").alias("priority_score"),
    ))


@query("first_per_key", """
SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice
FROM orders GROUP BY o_custkey""")
def first_per_key(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return report.first_per_key(rows, ["o_custkey"], "o_orderkey")


_SEEDED = "md5('42|' || c_custkey)"


@query("stratified_sample", with_base(_SCORED_SQL, f"""banded AS (
  SELECT *, {SCORE_SQL} AS score FROM scored),
drawn AS (
  SELECT *, CASE WHEN score >= 7 THEN 'high (>=7)' WHEN score >= 4 THEN 'mid (4-6)' WHEN score >= 1 THEN 'low (1-3)' END
    AS band FROM banded)""", select=f"""
SELECT c_custkey, band AS sample_band, score AS priority_score FROM drawn WHERE band IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY band ORDER BY {_SEEDED}, c_custkey) <= 10"""))
def stratified_sample(spark, sf):
    scored = scored_customers(spark, sf)
    return report.sample_per_stratum(
        scored, rules.sample_band(F.col("priority_score")), F.col("c_custkey"), 42, 10
    ).select("c_custkey", "sample_band", "priority_score")


@query("seeded_sample", f"""
SELECT c_custkey, c_name FROM customer ORDER BY {_SEEDED}, c_custkey LIMIT 10""")
def seeded_sample(spark, sf):
    return report.sample_rows(table(spark, sf, "customer"), F.col("c_custkey"), 42, 10).select("c_custkey", "c_name")


@query("sample_projection", with_base(_SCORED_SQL, f"""banded AS (
  SELECT *, {SCORE_SQL} AS score FROM scored)""", select=f"""
SELECT ename AS company_name, area AS msa, score AS priority_score,
  CASE WHEN score >= 7 THEN 'high (>=7)' WHEN score >= 4 THEN 'mid (4-6)' WHEN score >= 1 THEN 'low (1-3)' END AS sample_band,
  filed AS source_form_d, CAST(NULL AS BOOLEAN) AS source_sbir, listed AS source_tto,
  CAST(NULL AS INTEGER) AS founded_year, CAST(c_custkey AS VARCHAR) AS cik, CAST(NULL AS VARCHAR) AS uei,
  '{defaults.FILING_SEARCH_URL[0]}' || replace(url_encode(ename), '%20', '+') || '{defaults.FILING_SEARCH_URL[1]}'
    AS sec_edgar_search_url,
  '{defaults.AWARD_SEARCH_URL[0]}' || replace(url_encode(ename), '%20', '+') AS sbir_search_url,
  CAST(NULL AS VARCHAR) AS company_website, '' AS verification_notes
FROM banded"""))
def sample_projection(spark, sf):
    scored = scored_customers(spark, sf).withColumnsRenamed(
        {"ename": "name", "area": "msa", "filed": "source_form_d", "listed": "source_tto"}
    ).withColumns({
        "cik": F.col("c_custkey").cast("string"), "sample_band": rules.sample_band(F.col("priority_score")),
    })
    return report.review_sheet(scored)


def order_allowlist(spark, sf):
    """Orders as an allowlist with very many collisions: customer = city, priority = state."""
    return table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("msa"), F.concat(F.lit(" C"), F.col("o_custkey").cast("string")).alias("city_normalized"),
        F.lower(F.left("o_orderpriority", F.lit(1))).alias("state"),
        F.col("o_custkey").cast("string").alias("zip"), F.col("o_orderkey").alias("ord"),
    )


@query("allowlist_first_wins", """
SELECT 'c' || o_custkey AS _city_norm, left(o_orderpriority, 1) AS _state_norm,
       arg_min(o_orderstatus, o_orderkey) AS _msa
FROM orders GROUP BY 1, 2""")
def allowlist_first_wins(spark, sf):
    return config.city_dimension(order_allowlist(spark, sf))


@query("allowlist_last_wins", """
SELECT CAST(o_custkey AS VARCHAR) AS zip, arg_max(o_orderstatus, o_orderkey) AS msa FROM orders GROUP BY 1""")
def allowlist_last_wins(spark, sf):
    return config.zip_dimension(order_allowlist(spark, sf))


@query("allowlist_grouped", """
SELECT o_orderstatus AS msa, left(o_orderpriority, 1) AS state,
       array_to_string(list_sort(list(DISTINCT ' C' || o_custkey)), ',') AS cities
FROM orders GROUP BY 1, 2""")
def allowlist_grouped(spark, sf):
    grouped = config.cities_by_state(order_allowlist(spark, sf))
    return grouped.withColumn("cities", F.array_join("cities", ","))


@query("allowlist_pages", """
WITH listed AS (SELECT DISTINCT o_orderstatus AS msa, left(o_orderpriority, 1) AS state, ' C' || o_custkey AS city FROM orders),
placed AS (SELECT *, (row_number() OVER (PARTITION BY msa, state ORDER BY city) - 1) // 50 AS page FROM listed)
SELECT msa, state, page, string_agg(city, ',' ORDER BY city) AS cities FROM placed GROUP BY msa, state, page""")
def allowlist_pages(spark, sf):
    """Lists of fifty names a row."""
    pages = config.city_pages(order_allowlist(spark, sf), 50)
    return pages.withColumn("cities", F.array_join("cities", ","))
