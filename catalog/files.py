"""Readers and sinks: tables written to the shared folder in a landed form and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import query
from catalog.tables import award_rows, customers, filing_rows, grant_rows, suppliers, table, with_base
from muster.functions.exprs import money
from muster.operators import columns, joins, rollup, sinks
from muster.plans import layers
from muster.session import materialize, session_folder
from muster.sources import config, files


def landing(spark, label: str) -> str:
    return f"{session_folder(spark)}/landing-{label}-{uuid.uuid4().hex}"


def write_lines(df, header: str, path: str, compression: str = "none") -> None:
    """A text column as the lines of files that begin with the given header line."""
    df.select(df[df.columns[0]].alias(header)).write.options(
        header=True, quote="", escape="", sep="\x01", encoding="ISO-8859-1", compression=compression
    ).csv(path)


@query("parquet_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def parquet_roundtrip(spark, sf):
    path = landing(spark, "parquet")
    sinks.write_layer(table(spark, sf, "orders"), path)
    schema = table(spark, sf, "orders").schema
    return files.read_optional(spark, path, schema).filter("o_totalprice > 100000").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("optional_source", """
SELECT c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS tagline FROM customer""")
def optional_source(spark, sf):
    """A layer that is not there adds its columns and no rows."""
    absent = files.read_optional(spark, landing(spark, "absent"), _PORTFOLIO)
    present = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    return rollup.stack_sources({"customers": present, "portfolio": absent}).select("name", "balance", "tagline")


_PORTFOLIO = "name string, balance double, tagline string"

_ROSTER_TYPES = {"ord": "bigint", "name": "string", "source_tto": "boolean", "sbir_total_usd": "double",
                 "zip": "string", "url": "string"}


@query("csv_roundtrip", with_base(select="""
SELECT c_custkey AS ord, ename || ' "A"' || chr(10) || 'x, y' AS name, c_custkey % 3 = 0 AS source_tto,
       c_acctbal AS sbir_total_usd, area_zip AS zip, CAST(NULL AS VARCHAR) AS url
FROM customers"""))
def csv_roundtrip(spark, sf):
    """Quotes, line breaks, leading zeros, null flags and a missing column survive the way."""
    path = landing(spark, "csv")
    key = F.col("c_custkey")
    sinks.write_csv(customers(spark, sf).select(
        F.concat("ename", F.lit(' "A"\nx, y')).alias("name"), key.cast("double").alias("ord"),
        F.when(key % 3 == 0, True).alias("source_tto"), F.col("c_acctbal").alias("sbir_total_usd"),
        F.col("area_zip").alias("zip"),
    ), path)
    return files.read_roster(spark, path, _ROSTER_TYPES, multi_line=True)


@query("partitioned_sink", with_base(select="SELECT area AS msa, c_custkey, c_name FROM customers"))
def partitioned_sink(spark, sf):
    path = landing(spark, "areas")
    sinks.write_csv(customers(spark, sf).select(F.col("area").alias("msa"), "c_custkey", "c_name"), path, per="msa")
    back = spark.read.schema("c_custkey bigint, c_name string, msa string").option("header", True).csv(path)
    return back.select("msa", "c_custkey", "c_name")


@query("tsv_scan", """
SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER", 'Société "' || o_custkey || '"' || chr(9) || 'x' AS "NAME",
       CASE WHEN o_orderkey % 5 <> 1 THEN o_orderstatus END AS "STATUS"
FROM orders WHERE o_orderkey % 5 <> 0""")
def tsv_scan(spark, sf):
    """A fifth of the lines has a field too many and is dropped, a fifth one too few and is kept.

    Names are quoted, with quotes and a tab inside.
    """
    path = landing(spark, "tsv")
    key = F.col("o_orderkey")
    fields = [key.cast("string"), F.concat(F.lit('"Société ""'), F.col("o_custkey").cast("string"), F.lit('""\tx"'))]
    line = (
        F.when(key % 5 == 0, F.concat_ws("\t", *fields, "o_orderstatus", F.lit("extra")))
        .when(key % 5 == 1, F.concat_ws("\t", *fields))
        .otherwise(F.concat_ws("\t", *fields, "o_orderstatus"))
    )
    write_lines(table(spark, sf, "orders").select(line.alias("line")), "order\tname\tstatus", path)
    return columns.upper_columns(files.read_tsv(spark, path).drop("_file"))


@query("csv_scan", with_base(select="""
SELECT name AS "Company", CAST(contract AS VARCHAR) AS "Contract", round(amount, 2) AS amount FROM awards"""))
def csv_scan(spark, sf):
    """Quoted amounts with commas, firm names with quotes and line breaks, columns in two orders."""
    path = landing(spark, "bulk")
    awards = award_rows(spark, sf).select("Company", "Contract", "Award Amount")
    awards = awards.withColumn("Company", F.concat("Company", F.lit(' "Q",\nx')))
    even = F.col("Contract").cast("bigint") % 2 == 0
    sinks.write_csv(awards.filter(even), f"{path}/one")
    sinks.write_csv(awards.filter(~even).select("Award Amount", "Contract", "Company"), f"{path}/other")
    back = files.read_bulk_csv(spark, path, multi_line=True)
    return back.select(
        F.replace("Company", F.lit(' "Q",\nx'), F.lit("")).alias("Company"), "Contract",
        F.round(money(F.col("Award Amount")), 2).alias("amount"),
    )


@query("flatten_json", with_base(select="""
SELECT name AS org_name, city AS org_city, zip AS org_zipcode, amount AS award_amount, msa AS _msa,
       CAST(fy AS INTEGER) AS _fy FROM grants"""))
def flatten_json(spark, sf):
    """Nested records written as JSON lines and flattened to dotted columns."""
    path = landing(spark, "json")
    grants = grant_rows(spark, sf)
    grants.write.json(path)
    flat = layers.flatten_grants(spark.read.schema(grants.schema).json(path))
    return flat.select(
        F.col("`organization.org_name`").alias("org_name"), F.col("`organization.org_city`").alias("org_city"),
        F.col("`organization.org_zipcode`").alias("org_zipcode"), "award_amount", "_msa", "_fy",
    )


@query("event_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k" FROM events""")
def event_props(spark, sf):
    parsed = table(spark, sf, "events").select("event_id", F.from_json("props", "struct<k:bigint>").alias("props"))
    return columns.flatten_struct(parsed)


@query("flatten_grants", with_base(select="""
SELECT msa, name, count(*) AS nih_grants FROM grants GROUP BY msa, name"""))
def flatten_grants(spark, sf):
    return rollup.rollup_grants(layers.flatten_grants(grant_rows(spark, sf))).select("msa", "name", "nih_grants")


@query("json_config", """
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 3 <> 0""")
def json_config(spark, sf):
    """An exclusion list written as one JSON document, applied to all customers."""
    path = landing(spark, "config")
    listed = table(spark, sf, "nation").filter("n_nationkey % 3 = 0")
    doc = listed.agg(F.to_json(F.struct(F.collect_list("n_name").alias("excluded_names"))).alias("value"))
    doc.coalesce(1).write.text(path)
    names = config.read_excluded_names(spark, path)
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joins.exclude_names(rows, names, "n_name").select("c_custkey", "n_name")


@query("ticker_map", """
SELECT CAST(s_suppkey // 2 AS VARCHAR) AS cik, 'T' || max(s_suppkey) AS ticker FROM supplier GROUP BY s_suppkey // 2""")
def ticker_map(spark, sf):
    """One JSON object per supplier; two of them share each number and the later one counts."""
    key = F.col("s_suppkey")
    record = F.struct(
        F.floor(key / 2).alias("cik_str"), F.concat(F.lit("T"), key.cast("string")).alias("ticker"),
        F.col("s_name").alias("title"),
    )
    docs = table(spark, sf, "supplier").select(F.to_json(F.create_map(key.cast("string"), record)).alias("value"))
    return config.ticker_table(docs)


@query("backfill_log", """
SELECT s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 'city' ELSE 'zip' END AS field, CAST(s_suppkey AS VARCHAR) AS value,
       row_number() OVER (ORDER BY s_suppkey) AS ord
FROM supplier WHERE s_suppkey % 3 <> 2""")
def backfill_log(spark, sf):
    path = landing(spark, "log")
    key = F.col("s_suppkey")
    # Two files of the log, the larger one later, and each in order.
    rows = table(spark, sf, "supplier").repartitionByRange(1, "s_suppkey").sortWithinPartitions("s_suppkey")
    logged = rows.select(
        key.alias("key"), F.col("s_name").alias("name"),
        F.when(key % 3 == 0, "city").when(key % 3 == 1, "zip").otherwise("skipped").alias("field"),
        key.cast("string").alias("value"), F.lit("a, b").alias("notes"),
    )
    sinks.write_csv(logged.filter("key <= 20").drop("key"), f"{path}/log-1")
    sinks.write_csv(logged.filter("key > 20").drop("key"), f"{path}/log-2")
    log = config.read_backfill_log(spark, [f"{path}/log-1", f"{path}/log-2"])
    return log.select("name", "field", "value", F.row_number().over(Window.orderBy("ord")).cast("bigint").alias("ord"))


_TABLES = {
    "issuers": ["ACCESSIONNUMBER", "CIK", "ENTITYNAME", "CITY", "STATEORCOUNTRY", "ZIPCODE", "ENTITYTYPE"],
    "offerings": ["ACCESSIONNUMBER", "INDUSTRYGROUPTYPE", "ENTITYTYPE"],
    "submissions": ["ACCESSIONNUMBER", "FILING_DATE"],
}


_OLD_NAMES = {"ISSUER_CITY": "CITY", "ISSUER_STATEORCOUNTRY": "STATEORCOUNTRY"}
_TABLES_RENAMED = {
    "issuers": ["CIK", "ACCESSIONNUMBER", "ENTITYNAME", "ISSUER_STATEORCOUNTRY", "ISSUER_CITY", "ZIPCODE", "ENTITYTYPE"],
    "offerings": ["INDUSTRYGROUPTYPE", "ENTITYTYPE", "ACCESSIONNUMBER"],
    "submissions": ["FILING_DATE", "ACCESSIONNUMBER"],
}
_FILE_NAMES = {"issuers": "ISSUERS", "offerings": "Offering", "submissions": "formdsubmission"}


def merge_files(spark, source: str, prefix: str) -> None:
    """Move the files of a folder to names that start with a prefix."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(prefix).getParent())
    for i, status in enumerate(system.globStatus(path(f"{source}/part-*"))):
        ending = ".tsv.gz" if status.getPath().getName().endswith(".gz") else ".tsv"
        system.rename(status.getPath(), path(f"{prefix}_{i}{ending}"))


def landed_filings(spark, sf):
    """The filings, joined once and spread over tasks by size, as the tables of all quarters are written from them."""
    return materialize(filing_rows(spark, sf).drop("ord", "YEAROFINC_VALUE_ENTERED").hint("rebalance"), "filings")


@query("load_filings", with_base(select="""
SELECT ord AS accession, name, msa, industry, strftime(o_orderdate, '%Y-%m-%d') AS filed,
       entity_type AS other_type
FROM scoped_filings"""))
def load_filings(spark, sf):
    """Three tab-separated tables written, read, joined and scoped."""
    from catalog.tables import city_allowlist

    rows, tables = landed_filings(spark, sf), {}
    for name, fields in _TABLES.items():
        path = landing(spark, name)
        line = F.concat_ws("\t", *fields)
        write_lines(rows.select(line.alias("line")), "\t".join(fields), path)
        tables[name] = columns.upper_columns(files.read_tsv(spark, path).drop("_file"))
    joined = joins.join_filing_tables(*tables.values())
    scoped = layers.scope_filings(joined, config.city_dimension(city_allowlist(spark, sf)))
    return scoped.select(
        F.col("ACCESSIONNUMBER").cast("bigint").alias("accession"), F.col("ENTITYNAME").alias("name"),
        F.col("_msa").alias("msa"), F.col("_industry_norm").alias("industry"),
        F.col("FILING_DATE").alias("filed"), F.col("ENTITYTYPE_o").alias("other_type"),
    )


@query("quarter_filings", with_base(select="""
SELECT q.quarter AS _quarter, ord AS accession, name, msa, strftime(o_orderdate, '%Y-%m-%d') AS filed,
       CASE WHEN q.quarter = '2020q1' THEN entity_type ELSE 'Other' END AS other_type
FROM scoped_filings, (VALUES ('2020q1'), ('2020q2'), ('2020q4')) q(quarter)"""))
def quarter_filings(spark, sf):
    """Quarters with the same numbers, in two header layouts, one compressed, and one that lacks a table."""
    from catalog.tables import city_allowlist

    root = landing(spark, "quarters")
    rows = landed_filings(spark, sf)
    for quarter, layout in (("2020q1", _TABLES), ("2020q2", _TABLES_RENAMED), ("2020q3", _TABLES), ("2020q4", _TABLES)):
        for name, fields in layout.items():
            if (quarter, name) == ("2020q3", "offerings"):
                continue
            shaped = rows if quarter == "2020q1" or name != "offerings" else rows.withColumn("ENTITYTYPE", F.lit("Other"))
            named = [F.col(_OLD_NAMES.get(f, f)) for f in fields]
            write_lines(shaped.select(F.concat_ws("\t", *named).alias("line")), "\t".join(fields), f"{root}/parts/{quarter}/{name}", "gzip" if quarter == "2020q4" else "none")
            merge_files(spark, f"{root}/parts/{quarter}/{name}", f"{root}/{quarter}/{_FILE_NAMES[name]}")
    scoped = layers.load_filings(spark, f"{root}/20*", config.city_dimension(city_allowlist(spark, sf)))
    return scoped.select(
        "_quarter", F.col("ACCESSIONNUMBER").cast("bigint").alias("accession"), F.col("ENTITYNAME").alias("name"),
        F.col("_msa").alias("msa"), F.col("FILING_DATE").alias("filed"), F.col("ENTITYTYPE_o").alias("other_type"),
    )


@query("scope_awards", with_base(select="""
SELECT CAST(contract AS VARCHAR) AS "Contract", name AS "Company", msa, state AS _state_norm FROM awards"""))
def scope_awards(spark, sf):
    """Bulk CSV with other header names, scoped by city and state."""
    from catalog.tables import city_allowlist

    path = landing(spark, "awards")
    renamed = award_rows(spark, sf).select(
        "Company", "Contract", F.col("City").alias("Firm City"), F.col("State").alias(" firm state")
    )
    sinks.write_csv(renamed, path)
    scoped = layers.scope_awards(files.read_bulk_csv(spark, path), config.city_dimension(city_allowlist(spark, sf)))
    return scoped.select("Contract", "Company", F.col("_msa").alias("msa"), "_state_norm")


@query("build_portfolio", with_base(select="""
SELECT msa, source, count(*) AS n FROM (
  SELECT msa, 'pages' AS source, name FROM portfolio UNION ALL SELECT area, 'supplier', s_name FROM suppliers
) WHERE length(name) BETWEEN 2 AND 80 AND lower(name) NOT IN ('home', 'menu', 'about', 'contact', 'search',
  'learn more', 'read more', 'portfolio', 'companies', 'next', 'prev')
GROUP BY ALL"""))
def build_portfolio(spark, sf):
    from catalog.aggregates import portfolio_source

    seeds = suppliers(spark, sf).select(
        F.col("s_name").alias("name"), F.col("area").alias("msa"), F.lit("supplier").alias("source"),
        F.col("s_suppkey").alias("ord"),
    )
    built = layers.build_portfolio([portfolio_source(spark, sf)], seeds)
    return rollup.group_counts(built, "msa", "source")

