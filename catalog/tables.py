"""The driver tables seen as source layers, in Spark and as common table expressions in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster import defaults

INDUSTRY_OF_SEGMENT = {
    "HOUSEHOLD": "Other Health Care", "MACHINERY": "Biotechnology", "FURNITURE": "Pharmaceuticals",
}
LOCATIONS = ["Boston, MA", "Lagos, NG", "", "Lima,PE"]
PLACES = {"africa": ["boston", "st. louis"], "asia": ["boston", "lima"], "europe": ["lagos"]}


# Declared, so that no job has to read the schema from the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# -- names -----------------------------------------------------------------------------------


def _part_name() -> Column:
    return F.concat("p_name", F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit(" ")))


def parts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", _part_name().alias("pname"))


def areas(spark, sf_dir) -> DataFrame:
    """Nations with the area, city and state they stand for."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name",
        F.lower("r_name").alias("area"),
        F.upper(F.left("r_name", F.lit(2))).alias("area_state"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("area_zip"),
    )


def city_allowlist(spark, sf_dir) -> DataFrame:
    return areas(spark, sf_dir).select(
        F.col("area").alias("msa"),
        F.lower("n_name").alias("city_normalized"),
        F.col("area_state").alias("state"),
        F.col("n_nationkey").cast("bigint").alias("ord"),
    )


def customers(spark, sf_dir) -> DataFrame:
    """Customers as named entities."""
    key = F.col("c_custkey")
    ending = (
        F.when(key % 3 == 0, ", Inc.").when(key % 3 == 1, " LLC").otherwise(" Holdings Co.")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(parts(spark, sf_dir), key == F.col("p_partkey"))
        .join(areas(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey", "n_name", "area",
            "area_state", "area_zip",
            F.concat("pname", ending).alias("ename"),
        )
    )


def suppliers(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .join(parts(spark, sf_dir), F.col("s_suppkey") == F.col("p_partkey"))
        .join(areas(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "s_suppkey", "s_name", "s_acctbal", "s_nationkey", "n_name", "area", "area_state",
            "area_zip", F.concat(F.upper("pname"), F.lit(" LIMITED")).alias("ename"),
        )
    )


# -- layers ----------------------------------------------------------------------------------


def filing_rows(spark, sf_dir) -> DataFrame:
    """Orders as filings of their customers, before any scoping."""
    key = F.col("c_custkey")
    industry = F.lit("Other")
    for segment, name in INDUSTRY_OF_SEGMENT.items():
        industry = F.when(F.col("c_mktsegment") == segment, name).otherwise(industry)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(customers(spark, sf_dir), F.col("o_custkey") == key).select(
        F.col("o_orderkey").cast("string").alias("ACCESSIONNUMBER"),
        (key + 1).cast("string").alias("CIK"),
        F.col("ename").alias("ENTITYNAME"),
        F.concat(F.lit(" "), "n_name").alias("CITY"),
        F.lower("area_state").alias("STATEORCOUNTRY"),
        F.col("area_zip").alias("ZIPCODE"),
        F.when(key % 50 == 0, "Non-Profit Corporation").otherwise("Corporation").alias("ENTITYTYPE"),
        F.when(key % 5 != 0, (1990 + key % 35).cast("string")).alias("YEAROFINC_VALUE_ENTERED"),
        industry.alias("INDUSTRYGROUPTYPE"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("FILING_DATE"),
        F.col("o_orderkey").alias("ord"),
    )


def award_rows(spark, sf_dir) -> DataFrame:
    """Order lines as awards to their suppliers, before any scoping."""
    key = F.col("s_suppkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    amount = F.regexp_replace(F.col("l_extendedprice").cast("string"), r"(\d)(\d{3}\.)", "$1,$2")
    return lines.join(suppliers(spark, sf_dir), F.col("l_suppkey") == key).select(
        F.col("ename").alias("Company"),
        F.concat(F.lit("U"), key.cast("string")).alias("UEI"),
        F.when(key % 4 != 0, (key * 7).cast("string")).alias("Duns"),
        F.col("n_name").alias("City"),
        F.col("area_state").alias("State"),
        F.col("area_zip").alias("Zip"),
        F.when(key % 3 != 0, F.concat(F.lit("www.s"), key.cast("string"), F.lit(".example.com/")))
        .alias("Company Website"),
        (key % 100).cast("string").alias("Number Employees"),
        F.col("l_orderkey").cast("string").alias("Contract"),
        F.concat(F.lit("$"), amount).alias("Award Amount"),
        F.year("l_shipdate").cast("string").alias("Award Year"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("ord"),
    )


def grant_rows(spark, sf_dir) -> DataFrame:
    """Events as nested grant records tagged with area and fiscal year."""
    user = F.col("user_id")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    ending = F.when(user % 10 == 0, " University").otherwise(" Corp")
    return (
        events.join(parts(spark, sf_dir), user == F.col("p_partkey"))
        .join(areas(spark, sf_dir), (user % 25).cast("int") == F.col("n_nationkey"))
        .select(
            F.struct(
                F.concat("pname", ending).alias("org_name"),
                F.col("n_name").alias("org_city"),
                F.col("area_state").alias("org_state"),
                F.when(user % 3 != 0, F.col("area_zip")).alias("org_zipcode"),
            ).alias("organization"),
            F.col("value").alias("award_amount"),
            F.col("area").alias("_msa"),
            F.year("ts").alias("_fy"),
            F.col("event_id").alias("ord"),
        )
    )


def area_of_page() -> Column:
    names = ["africa", "america", "asia", "europe", "middle east"]
    return F.get(F.array(*[F.lit(n) for n in names]), (F.col("page_id") % 5).cast("int"))


def location_of_page() -> Column:
    return F.get(F.array(*[F.lit(n) for n in LOCATIONS]), (F.col("page_id") % 4).cast("int"))


# -- the same in SQL ---------------------------------------------------------------------------


def quote_list(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_norm(column: str, suffixes: Sequence[str] = defaults.MERGE_SUFFIXES) -> str:
    """Normal form of a name, for texts of any script."""
    return (
        f"array_to_string(list_filter(string_split_regex(lower(coalesce({column}, '')), "
        f"'[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '' AND w NOT IN ({quote_list(suffixes)})), ' ')"
    )


def sql_resolve(column: str) -> str:
    return sql_norm(column, defaults.RESOLVE_SUFFIXES)


_INDUSTRY = " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in INDUSTRY_OF_SEGMENT.items())

BASE = f"""
WITH RECURSIVE parts AS (
  SELECT p_partkey, p_name || ' ' || replace(p_brand, '#', ' ') AS pname FROM part
),
areas AS (
  SELECT n_nationkey, n_name, r_name, lower(r_name) AS area, upper(left(r_name, 2)) AS area_state,
         lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS area_zip
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
customers AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey, n_name, area, area_state, area_zip,
         pname || CASE c_custkey % 3 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC' ELSE ' Holdings Co.' END
           AS ename
  FROM customer JOIN parts ON c_custkey = p_partkey JOIN areas ON c_nationkey = n_nationkey
),
suppliers AS (
  SELECT s_suppkey, s_name, s_acctbal, s_nationkey, n_name, area, area_state, area_zip,
         upper(pname) || ' LIMITED' AS ename
  FROM supplier JOIN parts ON s_suppkey = p_partkey JOIN areas ON s_nationkey = n_nationkey
),
filings AS (
  SELECT o_orderkey AS ord, c_custkey + 1 AS cik, ename AS name, ' ' || n_name AS city,
         lower(area_state) AS state, area_zip AS zip, area AS msa, o_orderdate,
         CASE WHEN c_custkey % 50 = 0 THEN 'Non-Profit Corporation' ELSE 'Corporation' END
           AS entity_type,
         CASE WHEN c_custkey % 5 <> 0 THEN CAST(1990 + c_custkey % 35 AS VARCHAR) END AS year_incorp,
         CASE c_mktsegment {_INDUSTRY} ELSE 'Other' END AS industry
  FROM orders JOIN customers ON o_custkey = c_custkey
),
scoped_filings AS (
  SELECT * FROM filings WHERE industry IN ({quote_list(defaults.FILING_INDUSTRIES)})
),
filing_part AS (
  SELECT msa, name, CAST(arg_min(cik, ord) AS VARCHAR) AS cik, arg_min(city, ord) AS city,
         arg_min(state, ord) AS state, arg_min(zip, ord) AS zip,
         arg_min(year_incorp, ord) FILTER (year_incorp IS NOT NULL) AS year_incorp,
         arg_min(entity_type, ord) AS entity_type, arg_min(industry, ord) AS industry,
         count(DISTINCT ord) AS form_d_filings
  FROM scoped_filings GROUP BY msa, name
),
awards AS (
  SELECT l_orderkey * 16 + l_linenumber AS ord, area AS msa, ename AS name,
         'U' || s_suppkey AS uei,
         CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey * 7 AS VARCHAR) END AS duns,
         n_name AS city, area_state AS state, area_zip AS zip,
         CASE WHEN s_suppkey % 3 <> 0 THEN 'www.s' || s_suppkey || '.example.com/' END AS website,
         CAST(s_suppkey % 100 AS VARCHAR) AS employees, l_orderkey AS contract,
         l_extendedprice AS amount, CAST(year(l_shipdate) AS VARCHAR) AS award_year
  FROM lineitem JOIN suppliers ON l_suppkey = s_suppkey
),
award_part AS (
  SELECT msa, name, arg_min(uei, ord) AS uei, arg_min(duns, ord) FILTER (duns IS NOT NULL) AS duns,
         arg_min(city, ord) AS city, arg_min(state, ord) AS state, arg_min(zip, ord) AS zip,
         arg_min(website, ord) FILTER (website IS NOT NULL) AS website,
         arg_min(employees, ord) AS employees, count(DISTINCT contract) AS sbir_awards,
         sum(amount) AS sbir_total_usd, min(award_year) AS sbir_first_year,
         max(award_year) AS sbir_last_year
  FROM awards GROUP BY msa, name
),
grants AS (
  SELECT event_id AS ord, area AS msa, year(ts) AS fy, value AS amount,
         pname || CASE WHEN user_id % 10 = 0 THEN ' University' ELSE ' Corp' END AS name,
         n_name AS city, area_state AS state, CASE WHEN user_id % 3 <> 0 THEN area_zip END AS zip
  FROM events JOIN parts ON user_id = p_partkey JOIN areas ON user_id % 25 = n_nationkey
),
grant_part AS (
  SELECT msa, name, arg_min(city, ord) AS city, arg_min(state, ord) AS state,
         arg_min(zip, ord) FILTER (zip IS NOT NULL) AS zip, count(*) AS nih_grants,
         sum(coalesce(amount, 0)) AS nih_total_usd
  FROM grants GROUP BY msa, name
),
page_items AS (
  SELECT page_id, (['africa', 'america', 'asia', 'europe', 'middle east'])[page_id % 5 + 1] AS msa,
         ([{quote_list(LOCATIONS)}])[page_id % 4 + 1] AS location,
         unnest(regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1)) AS item,
         generate_subscripts(regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li\\s*>', 1), 1) - 1
           AS item_pos
  FROM pages
),
portfolio AS (
  SELECT * FROM (SELECT page_id, item_pos, msa, location, page_id * 1000 + item_pos AS ord,
         trim(regexp_replace(regexp_replace(item, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS name,
         regexp_extract(item, '(?is)<a\\b[^>]*?\\shref\\s*=\\s*"([^"]*)"', 1) AS url
  FROM page_items) WHERE name <> ''
)"""


def with_base(*ctes: str, select: str) -> str:
    """A query over the base expressions and further ones."""
    return ",\n".join([BASE, *ctes]) + "\n" + select
