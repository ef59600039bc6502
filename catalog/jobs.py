"""Whole jobs: rosters, the funnel with its audit, report, verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.aggregates import MERGED_SQL, award_part, filing_part, grant_part, portfolio_source
from catalog.clusters import sql_components, sql_hubs
from catalog.enrichment import _LOG_SQL
from catalog.filters import _VEHICLES, _place_sql
from catalog.rules import _SCORED_SQL, _SUBCATEGORY_SQL, SCORE_SQL, _words_sql, scored_customers
from catalog.tables import PLACES, areas, customers, parts, quote_list, sql_norm, sql_resolve, suppliers, table, with_base
from muster import defaults
from muster.operators import report, rules, verify
from muster.operators.filters import recent
from muster.plans import funnel, layers, reports, roster
from muster.schemas import ROSTER_TYPES, SUM_COLUMNS

MONEY = ["sbir_total_usd", "nih_total_usd"]


def rounded(df):
    return df.withColumns({c: F.round(c, 2) for c in MONEY})


def roster_parts(spark, sf):
    portfolio = layers.build_portfolio([portfolio_source(spark, sf)], None).select(
        "name", "msa", "source", "tagline", "location", "url", F.col("pos").alias("ord")
    )
    return {
        "filings": filing_part(spark, sf), "awards": award_part(spark, sf), "grants": grant_part(spark, sf),
        "portfolio": layers.portfolio_part(portfolio),
    }


_INTERIM_COLUMNS = [c for c in defaults.INTERIM_FRONT if c != "tier"]


@query("interim_roster", with_base(MERGED_SQL, select=f"""
SELECT {", ".join(_INTERIM_COLUMNS)}, CASE WHEN source_form_d AND (source_sbir OR source_nih) THEN 'confirmed_strong'
  WHEN source_form_d THEN 'confirmed_funded' WHEN source_sbir THEN 'confirmed_grant' ELSE 'research_org' END AS tier
FROM merged"""))
def interim_roster(spark, sf):
    three = {k: v for k, v in roster_parts(spark, sf).items() if k != "portfolio"}
    return rounded(roster.interim_roster(three)).select(*_INTERIM_COLUMNS, "tier")


# -- classified roster -----------------------------------------------------------------------

_FLAGS = {"source_form_d": 0, "source_sbir": 1, "source_nih": 2, "source_tto": 3}
_FIRSTS = ["name", "city", "state", "zip", "year_incorp", "filer_type", "industry", "tagline", "tto_source_name", "cik",
           "uei", "duns", "website", "employees", "sbir_first_year", "sbir_last_year", "tto_location", "url"]


def _firsts(columns, order: str) -> str:
    return ", ".join(f"arg_min({c}, {order}) FILTER ({c} IS NOT NULL) AS {c}" for c in columns)


def _sums() -> str:
    return ", ".join(
        f"CAST(coalesce(sum({c}), 0) AS {'DOUBLE' if c in MONEY else 'BIGINT'}) AS {c}" for c in SUM_COLUMNS
    )


_NAV = quote_list(defaults.NAVIGATION_WORDS)
CLASSIFIED_SQL = f"""stacked4 AS (
  SELECT 0 AS rank, * RENAME (entity_type AS filer_type) FROM filing_part
  UNION ALL BY NAME SELECT 1 AS rank, * FROM award_part
  UNION ALL BY NAME SELECT 2 AS rank, * FROM grant_part
  UNION ALL BY NAME SELECT 3 AS rank, msa, name, '' AS tagline, 'pages' AS tto_source_name,
    location AS tto_location, url, ord AS pos
  FROM portfolio WHERE length(name) BETWEEN 2 AND 80 AND lower(name) NOT IN ({_NAV})
),
keyed4 AS (
  SELECT *, {sql_norm('name')} AS name_norm,
         row_number() OVER (ORDER BY rank, CASE WHEN rank < 3 THEN name END, pos) AS o
  FROM stacked4
),
merged4 AS (
  SELECT msa, name_norm, {_firsts(_FIRSTS, 'o')}, {_sums()},
         {", ".join(f"bool_or(rank = {r}) AS {f}" for f, r in _FLAGS.items())}
  FROM keyed4 WHERE name_norm <> '' AND msa IS NOT NULL GROUP BY msa, name_norm
),
typed4 AS (
  SELECT *, CASE WHEN {_words_sql("(name || ' ' || name_norm)", defaults.UNIVERSITY_WORDS)} THEN 'university'
    WHEN {_words_sql("(name || ' ' || name_norm)", defaults.HOSPITAL_WORDS)} THEN 'hospital'
    WHEN {_words_sql("(name || ' ' || name_norm)", defaults.GOVERNMENT_WORDS)} THEN 'govt_lab'
    WHEN {_words_sql("(name || ' ' || name_norm)", defaults.NONPROFIT_WORDS)} AND NOT source_form_d THEN 'nonprofit'
    WHEN source_nih AND NOT source_form_d AND NOT source_sbir THEN 'research_inst'
    WHEN lower(filer_type) LIKE '%non-profit%' THEN 'nonprofit' ELSE 'startup' END AS entity_type,
    lower(name || ' ' || coalesce(industry, 'nan') || ' ' || coalesce(tagline, 'nan')) AS blob
  FROM merged4
),
classified AS (
  SELECT * EXCLUDE (blob, filer_type), CASE {_SUBCATEGORY_SQL} WHEN contains(lower(industry), 'pharm') THEN 'pharma'
      WHEN contains(lower(industry), 'biotech') THEN 'biotech' WHEN contains(lower(industry), 'health') THEN 'medtech'
      ELSE 'unknown' END AS ls_subcategory,
    CASE WHEN entity_type <> 'startup' THEN 'research_inst' WHEN source_form_d THEN 'operating_company'
      WHEN source_sbir THEN 'grant_only_company' WHEN source_tto THEN 'tto_spinout' ELSE 'research_inst' END AS tier
  FROM typed4
)"""


def _rounded_sql(columns) -> str:
    return ", ".join(f"round({c}, 2) AS {c}" if c in MONEY else c for c in columns)


@query("classified_roster", with_base(CLASSIFIED_SQL, select=f"""
SELECT {_rounded_sql(ROSTER_TYPES)} FROM classified"""))
def classified_roster(spark, sf):
    return rounded(roster.classified_roster(roster_parts(spark, sf)))


def flagship(spark, sf):
    """Startups with a recent signal, scored; the best 25 of every area."""
    startups = roster.startups(roster.classified_roster(roster_parts(spark, sf)))
    c = F.col
    scored = startups.filter(
        recent(c("source_form_d"), c("source_tto"), c("sbir_last_year"), since=2001)
    ).select(
        "msa", "name", "tier", "form_d_filings", "sbir_awards", F.round("sbir_total_usd", 2).alias("sbir_total_usd"),
        rules.priority_score(c("source_form_d"), c("source_tto"), c("sbir_last_year"), c("ls_subcategory"),
                             c("year_incorp")).alias("priority_score"),
        c("name_norm").alias("ord"),
    )
    return report.top_prospects(scored).drop("ord")


def _score_sql() -> str:
    return """CAST(CASE WHEN source_form_d THEN 3 ELSE 0 END
  + CASE WHEN CAST(sbir_last_year AS INTEGER) >= 2024 THEN 3 WHEN CAST(sbir_last_year AS INTEGER) >= 2022 THEN 2
         WHEN CAST(sbir_last_year AS INTEGER) >= 2020 THEN 1 ELSE 0 END
  + CASE WHEN source_tto THEN 2 ELSE 0 END
  + CASE WHEN ls_subcategory IN ('biotech', 'pharma', 'diagnostics', 'chemistry') THEN 2 ELSE 0 END
  + CASE WHEN CAST(year_incorp AS INTEGER) >= 2015 THEN 1 ELSE 0 END AS INTEGER)"""


query("flagship", with_base(CLASSIFIED_SQL, f"""ranked AS (
  SELECT *, {_score_sql()} AS priority_score FROM classified
  WHERE tier <> 'research_inst' AND (source_form_d OR source_tto OR CAST(sbir_last_year AS INTEGER) >= 2001)
)""", select="""
SELECT msa, name, tier, form_d_filings, sbir_awards, round(sbir_total_usd, 2) AS sbir_total_usd, priority_score
FROM ranked QUALIFY row_number() OVER (
  PARTITION BY msa ORDER BY priority_score DESC, name, name_norm) <= 25"""))(flagship)


# -- funnel ----------------------------------------------------------------------------------

_NAME_WORDS = "ring|bolt|the|le"


def funnel_config(spark, sf) -> funnel.FunnelConfig:
    listed = suppliers(spark, sf).select("s_suppkey", "area", F.col("ename").alias("name"))
    following = listed.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("name").alias("other"))
    own = listed.select(F.col("s_suppkey").alias("group_id"), F.col("area").alias("msa"), "name")
    next_name = listed.join(following, "s_suppkey").select(
        F.col("s_suppkey").alias("group_id"), F.col("area").alias("msa"), F.col("other").alias("name")
    )
    sized = table(spark, sf, "part").select("p_partkey", "p_size").join(parts(spark, sf), "p_partkey")
    key = F.col("s_suppkey")
    fields = F.array(*[F.lit(f) for f in ("city", "founded_year", "skipped", "absent")])
    customer = F.col("c_custkey")
    return funnel.FunnelConfig(
        merge_groups=own.unionByName(next_name),
        vehicle_names=sized.filter("p_size = 7").select(F.col("pname").alias("name")),
        tickers=table(spark, sf, "supplier").select(
            (key * 5).cast("string").alias("cik"), F.concat(F.lit("T"), key.cast("string")).alias("ticker")
        ),
        excluded_names=sized.filter("p_size = 9").select(F.concat("pname", F.lit(" Inc")).alias("name")),
        years_by_cik=table(spark, sf, "orders").filter("o_custkey % 4 = 0").select(
            F.col("o_custkey").cast("string").alias("key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("year")
        ),
        years_by_url=table(spark, sf, "supplier").select(
            F.concat(F.lit("https://www.s"), key.cast("string"), F.lit(".example.com")).alias("key"),
            (1990 + key % 30).alias("year"),
        ),
        backfill=customers(spark, sf).select(
            F.col("ename").alias("name"), customer.alias("ord"),
            F.get(fields, (customer % 4).cast("int")).alias("field"),
            F.when((customer % 4 == 1) & (customer % 3 == 0), "unknown")
            .when(customer % 4 == 1, (1990 + customer % 30).cast("string"))
            .otherwise(F.concat(F.lit("City "), customer.cast("string"))).alias("value"),
        ),
        places=PLACES, kept_categories=["biotech", "pharma"], kept_name_words=_NAME_WORDS,
        vehicle_rules=_VEHICLES, recent_since=2001, mature_span=5, mature_total=15_000_000,
    )


def run_funnel(spark, sf) -> funnel.FunnelResult:
    numbered = roster.number_rows(roster.startups(roster.classified_roster(roster_parts(spark, sf))))
    return funnel.run_funnel(numbered, funnel_config(spark, sf))


_ROSTER_FIRSTS = [c for c in ROSTER_TYPES if c not in SUM_COLUMNS and c not in _FLAGS]


def _collapse(rows: str, comp: str) -> str:
    flags = ", ".join(f"bool_or({f}) AS {f}" for f in _FLAGS)
    return (
        f"SELECT min(ord) AS ord, {flags}, {_sums()}, {_firsts(_ROSTER_FIRSTS, 'ord')} "
        f"FROM {rows} JOIN {comp} ON ord = node GROUP BY component"
    )


_CONFLICT = " OR ".join(
    f"(a.{c} IS NOT NULL AND b.{c} IS NOT NULL AND a.{c} <> b.{c})" for c in ("cik", "uei", "duns")
)
_GENERIC = quote_list(defaults.GENERIC_TOKENS)
FUNNEL_SQL = f"""numbered AS (
  SELECT *, row_number() OVER (ORDER BY msa, tier, entity_type, name, name_norm) AS ord
  FROM classified WHERE tier <> 'research_inst'
),
named1 AS (SELECT *, {sql_resolve('name')} AS norm FROM numbered),
links1 AS (
  {sql_hubs('named1', 'msa', 'norm', where="norm <> ''")}
  UNION ALL {sql_hubs('named1', 'cik', where="cik <> '0'")}
  UNION ALL {sql_hubs('named1', 'uei', where="uei IS NOT NULL")}
  UNION ALL {sql_hubs('named1', 'duns', where="duns <> '0'")}
),
{sql_components('named1', 'links1', 'comp1')},
step1 AS ({_collapse('numbered', 'comp1')}),
named2 AS (
  SELECT *, coalesce(list_filter(words, lambda w: w NOT IN ({_GENERIC}))[1], words[1]) AS block, len(words) AS tokens
  FROM (SELECT *, {sql_resolve('name')} AS norm, string_split({sql_resolve('name')}, ' ') AS words FROM step1)
),
links2 AS (
  SELECT a.ord AS src, b.ord AS dst FROM named2 a JOIN named2 b USING (msa, block)
  WHERE a.ord < b.ord AND a.norm <> '' AND b.norm <> '' AND NOT coalesce({_CONFLICT}, false)
    AND jaro_winkler_similarity(a.norm, b.norm)
      >= CASE WHEN greatest(a.tokens, b.tokens) <= 2 THEN 0.95 ELSE 0.92 END
),
{sql_components('named2', 'links2', 'comp2')},
step2 AS ({_collapse('step1', 'comp2')}),
groups AS (
  SELECT s_suppkey AS group_id, area AS msa, {sql_resolve('ename')} AS norm FROM suppliers
  UNION SELECT s.s_suppkey, s.area, {sql_resolve('t.ename')}
  FROM suppliers s JOIN suppliers t ON t.s_suppkey = s.s_suppkey + 1
),
hits AS (
  SELECT group_id, ord FROM (SELECT ord, msa, {sql_resolve('name')} AS norm FROM step2) JOIN groups USING (msa, norm)
),
links3 AS ({sql_hubs('hits', 'group_id')}),
{sql_components('step2', 'links3', 'comp3')},
step3 AS ({_collapse('step2', 'comp3')}),
looked_up AS (
  SELECT s.*, ticker, {sql_resolve('name')} AS norm, lower(tto_location) AS place
  FROM step3 s LEFT JOIN (SELECT CAST(s_suppkey * 5 AS VARCHAR) AS listed, 'T' || s_suppkey AS ticker FROM supplier)
    ON cik = listed
),
tagged AS (
  SELECT * EXCLUDE (norm, place), CASE
    WHEN source_tto AND place <> '' AND ({_place_sql()}) THEN 'Step3_geo_cleanup'
    WHEN NOT (ls_subcategory IN ('biotech', 'pharma')
              OR (ls_subcategory = 'unknown' AND regexp_matches(name, '(?i){_NAME_WORDS}'))) THEN 'Step4_wetlab_subcat'
    WHEN NOT (source_form_d OR source_tto OR coalesce(CAST(sbir_last_year AS INTEGER) >= 2001, false)) THEN 'Step5_recency'
    WHEN coalesce(CAST(sbir_last_year AS INTEGER) - CAST(sbir_first_year AS INTEGER), 0) > 5
         AND sbir_total_usd > 15000000 THEN 'Step6_stage'
    WHEN regexp_matches(name, '(?i)\\bBrand\\s+1\\b|\\bring\\b.*\\bInc\\b|Holdings\\s+Co\\.?$')
         OR norm IN (SELECT {sql_resolve('pname')} FROM parts JOIN part USING (p_partkey) WHERE p_size = 7)
      THEN 'Step7_spv_vehicles'
    WHEN ticker IS NOT NULL THEN 'Step8_public_cos'
    WHEN norm IN (SELECT {sql_resolve('pname')} FROM parts JOIN part USING (p_partkey) WHERE p_size = 9)
      THEN 'Step9_nonwetlab_excl' END AS drop_step
  FROM looked_up
),
{_LOG_SQL},
by_cik AS (
  SELECT CAST(o_custkey AS VARCHAR) AS k, min(year(o_orderdate)) AS y FROM orders WHERE o_custkey % 4 = 0 GROUP BY 1
),
by_url AS (SELECT 'www.s' || s_suppkey || '.example.com/' AS k, 1990 + s_suppkey % 30 AS y FROM supplier),
dated AS (
  SELECT t.* EXCLUDE (year_incorp, drop_step, ticker), {_score_sql()} AS priority_score,
         CASE WHEN CAST(year_incorp AS INTEGER) BETWEEN 1900 AND 2030 THEN CAST(year_incorp AS INTEGER) END AS own_year,
         by_cik.y AS cik_year, by_url.y AS url_year
  FROM tagged t LEFT JOIN by_cik ON by_cik.k = cik LEFT JOIN by_url ON by_url.k = website
  WHERE drop_step IS NULL
),
placed AS (
  SELECT * REPLACE (
      CASE WHEN city IS NULL AND tto_location LIKE '%,%' THEN trim(split_part(tto_location, ',', 1)) ELSE city END AS city,
      CASE WHEN city IS NULL AND tto_location LIKE '%,%' THEN upper(trim(split_part(tto_location, ',', 2))) ELSE state END AS state,
      coalesce(industry, CASE ls_subcategory WHEN 'biotech' THEN 'Biotechnology' WHEN 'pharma' THEN 'Pharmaceuticals'
        ELSE 'Other Health Care' END) AS industry),
    coalesce(own_year, cik_year, url_year) AS year0
  FROM dated
),
final AS (
  SELECT p.* EXCLUDE (own_year, cik_year, url_year, year0) REPLACE (coalesce(nullif(trim(p.city), ''), w.city) AS city0),
         CASE WHEN own_year IS NOT NULL THEN 'known' WHEN cik_year IS NOT NULL THEN 'cik' WHEN url_year IS NOT NULL THEN 'url' END AS year_source,
         CAST(coalesce(year0, w.founded_year) AS INTEGER) AS founded_year
  FROM (SELECT *, city AS city0 FROM placed) p LEFT JOIN wide w ON w.name = p.name
)"""

_KEPT_COLUMNS = [c for c in ROSTER_TYPES if c not in ("year_incorp", "city")] + ["priority_score", "founded_year"]
FUNNEL_BASE = (CLASSIFIED_SQL, FUNNEL_SQL)


@query("funnel_kept", with_base(*FUNNEL_BASE, select=f"""
SELECT {_rounded_sql(_KEPT_COLUMNS)}, trim(city0) AS city FROM final"""))
def funnel_kept(spark, sf):
    kept = rounded(run_funnel(spark, sf).kept)
    return kept.select(*_KEPT_COLUMNS, F.trim("city").alias("city"))


@query("funnel_rejects", with_base(*FUNNEL_BASE, select="""
SELECT msa, name, drop_step, ticker FROM tagged WHERE drop_step IS NOT NULL"""))
def funnel_rejects(spark, sf):
    return run_funnel(spark, sf).rejects.select("msa", "name", "drop_step", "ticker")


_STEPS = [n for n, _ in funnel.RESOLVE_STEPS + funnel.FILTER_STEPS]
AUDIT_SQL = f"""sizes AS (
  SELECT 0 AS pos, (SELECT count(*) FROM numbered) - (SELECT count(*) FROM step1) AS removed
  UNION ALL SELECT 1, (SELECT count(*) FROM step1) - (SELECT count(*) FROM step2)
  UNION ALL SELECT 2, (SELECT count(*) FROM step2) - (SELECT count(*) FROM step3)
  UNION ALL SELECT list_position([{quote_list(_STEPS)}], drop_step) - 1, count(*) FROM tagged
  WHERE drop_step IS NOT NULL GROUP BY 1
),
steps AS (SELECT unnest([{quote_list(_STEPS)}]) AS step_name, unnest(range({len(_STEPS)})) AS pos),
filled AS (SELECT (SELECT count(*) FROM final WHERE year_source = 'cik') AS c, (SELECT count(*) FROM final WHERE year_source = 'url') AS u),
all_steps AS (
  SELECT pos, step_name, coalesce(removed, 0) AS removed, NULL AS reason FROM steps LEFT JOIN sizes USING (pos)
  UNION ALL SELECT 10, 'Step11b_sec_yearofincorp', 0, 'filled +' || c || ' founded_year cells' FROM filled
  UNION ALL SELECT 11, 'Step11c_website_scrape', 0, 'filled +' || u || ' founded_year cells' FROM filled
),
audit AS (
  SELECT pos, step_name, CAST((SELECT count(*) FROM numbered) - sum(removed) OVER (ORDER BY pos) + removed AS BIGINT) AS rows_in,
         CAST((SELECT count(*) FROM numbered) - sum(removed) OVER (ORDER BY pos) AS BIGINT) AS rows_out,
         CAST(removed AS BIGINT) AS rows_removed, reason FROM all_steps
)"""


@query("funnel_audit", with_base(*FUNNEL_BASE, AUDIT_SQL, select="""
SELECT step_name, rows_in, rows_out, rows_removed, reason FROM audit"""))
def funnel_audit(spark, sf):
    audit = run_funnel(spark, sf).audit
    return audit.withColumn("reason", F.when(F.col("step_name").startswith("Step11"), F.col("reason")))


@query("drift_check", with_base(*FUNNEL_BASE, AUDIT_SQL, """snapshot(step_name, expected_rows_removed) AS (
  VALUES ('Step1_rededup', 0), ('Step5_recency', 3), ('Step0_gone', 1))""", select="""
SELECT step_name, rows_removed, CAST(expected_rows_removed AS BIGINT) AS expected_rows_removed,
       rows_removed IS DISTINCT FROM expected_rows_removed AS drift
FROM audit FULL JOIN snapshot USING (step_name)"""))
def drift_check(spark, sf):
    snapshot = spark.createDataFrame(
        [("Step1_rededup", 0), ("Step5_recency", 3), ("Step0_gone", 1)], "step_name string, rows_removed bigint"
    )
    return verify.drift_check(run_funnel(spark, sf).audit, snapshot, columns=["rows_removed"])


def _long(df, name: str, columns):
    cells = F.array(*[F.struct(F.lit(c).alias("item"), F.col(f"`{c}`").cast("bigint").alias("n")) for c in columns])
    return df.select(F.lit(name).alias("report"), "msa", F.explode(cells).alias("cell")).select(
        "report", "msa", "cell.item", "cell.n"
    )


_FOUNDED = quote_list(defaults.FOUNDED_BUCKETS)


@query("report_tables", with_base(*FUNNEL_BASE, f"""
kept_rows AS (
  SELECT *, CASE WHEN founded_year IS NULL THEN 'Unknown' WHEN founded_year <= 2019 THEN '2015-2019'
    WHEN founded_year >= 2025 THEN '2025-2026' ELSE CAST(founded_year AS VARCHAR) END AS bucket FROM final
),
items AS (
  SELECT DISTINCT 'area_counts' AS report, msa, 'prospects' AS item FROM kept_rows
  UNION ALL SELECT DISTINCT 'subcategory_by_area', msa, unnest([{quote_list(defaults.SUBCATEGORIES)}]) FROM kept_rows
  UNION ALL SELECT DISTINCT 'founded_by_area', msa, unnest([{_FOUNDED}]) FROM kept_rows
  UNION ALL SELECT DISTINCT 'top_prospects', msa, 'points' FROM kept_rows
),
cells AS (
  SELECT 'area_counts' AS report, msa, 'prospects' AS item, count(*) AS n FROM kept_rows GROUP BY ALL
  UNION ALL SELECT 'subcategory_by_area', msa, ls_subcategory, count(*) FROM kept_rows GROUP BY ALL
  UNION ALL SELECT 'founded_by_area', msa, bucket, count(*) FROM kept_rows GROUP BY ALL
  UNION ALL SELECT 'top_prospects', msa, 'points', sum(priority_score) FROM (
    SELECT * FROM kept_rows QUALIFY row_number() OVER (PARTITION BY msa ORDER BY priority_score DESC, name, ord) <= 25
  ) GROUP BY ALL
)""", select="""
SELECT report, msa, item, CAST(coalesce(n, 0) AS BIGINT) AS n FROM items LEFT JOIN cells USING (report, msa, item)"""))
def report_tables(spark, sf):
    """All report tables of one funnel run in long form."""
    tables = reports.report_tables(run_funnel(spark, sf))
    points = tables["top_prospects"].groupBy("msa").agg(F.sum("priority_score").alias("points"))
    return (
        _long(tables["area_counts"], "area_counts", ["prospects"])
        .unionByName(_long(tables["subcategory_by_area"], "subcategory_by_area", defaults.SUBCATEGORIES))
        .unionByName(_long(tables["founded_by_area"], "founded_by_area", defaults.FOUNDED_BUCKETS))
        .unionByName(_long(points, "top_prospects", ["points"]))
    )


# -- verification ----------------------------------------------------------------------------


@query("verify_pack", with_base(_SCORED_SQL, f"""banded AS (
  SELECT *, {SCORE_SQL} AS score FROM scored
),
drawn AS (
  SELECT CASE WHEN score >= 7 THEN 'high (>=7)' WHEN score >= 4 THEN 'mid (4-6)' WHEN score >= 1 THEN 'low (1-3)' END AS band,
         c_custkey, ename FROM banded
),
sampled AS (
  SELECT * FROM drawn WHERE band IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY band ORDER BY md5('42|' || c_custkey), c_custkey) <= 10
),
years AS (
  SELECT c_custkey, CASE WHEN CAST(year_incorp AS INTEGER) BETWEEN 1900 AND 2030 THEN CAST(year_incorp AS INTEGER) END AS y FROM scored
),
checked AS (SELECT * FROM years WHERE y IS NOT NULL ORDER BY md5('43|' || c_custkey), c_custkey LIMIT 10),
latest AS (SELECT o_custkey, min(year(o_orderdate)) AS y FROM orders GROUP BY o_custkey)""", select="""
SELECT 'sample' AS section, band AS item, CAST(count(*) AS VARCHAR) AS value FROM sampled GROUP BY band
UNION ALL SELECT 'sample_names', ename, CAST(count(*) AS VARCHAR) FROM sampled GROUP BY ename
UNION ALL SELECT 'source_counts', area || ' form_d', CAST(count(*) FILTER (filed) AS VARCHAR) FROM scored GROUP BY area
UNION ALL SELECT 'source_counts', area || ' sbir', '0' FROM scored GROUP BY area
UNION ALL SELECT 'spot_check', 'ring', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END
  FROM scored WHERE area = 'asia' AND contains(lower(ename), 'ring')
UNION ALL SELECT 'spot_check', 'bolt', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END
  FROM scored WHERE contains(lower(ename), 'bolt')
UNION ALL SELECT 'year_check', CAST(c.c_custkey AS VARCHAR), CASE WHEN l.y = c.y THEN 'true' WHEN l.y <> c.y THEN 'false' END
  FROM checked c LEFT JOIN latest l ON o_custkey = c_custkey"""))
def verify_pack(spark, sf):
    """Sample, reconciliation, spot check and year check of one roster in long form."""
    people = scored_customers(spark, sf).select(
        F.col("c_custkey").alias("ord"), F.col("area").alias("msa"), F.col("ename").alias("name"), "priority_score",
        F.col("filed").alias("source_form_d"), F.lit(False).alias("source_sbir"), F.col("listed").alias("source_tto"),
        F.col("c_custkey").cast("string").alias("cik"), rules.founded_year(F.col("year_incorp")).alias("founded_year"),
    )
    states = areas(spark, sf).groupBy(F.col("area").alias("msa")).agg(
        F.array(F.max("area_state")).alias("state_codes")
    )
    counts = suppliers(spark, sf).groupBy(F.col("area_state").alias("state"), F.lit("form_d").alias("source")).agg(
        F.count(F.lit(1)).alias("external_count")
    )
    years = table(spark, sf, "orders").select(F.col("o_custkey").alias("cik"), F.year("o_orderdate").alias("year"))
    pack = reports.verification_pack(people, states, counts, years, [("ring", "asia")], ["bolt"])

    def section(name, df, item, value):
        return df.select(F.lit(name).alias("section"), item.alias("item"), value.cast("string").alias("value"))

    sample = pack["sample"]
    one = F.count(F.lit(1)).alias("n")
    return (
        section("sample", sample.groupBy("sample_band").agg(one), F.col("sample_band"), F.col("n"))
        .unionByName(section("sample_names", sample.groupBy("company_name").agg(one), F.col("company_name"), F.col("n")))
        .unionByName(section("source_counts", pack["source_counts"], F.concat_ws(" ", "msa", "source"), F.col("our_count")))
        .unionByName(section("spot_check", pack["spot_check"], F.col("company"), F.col("result")))
        .unionByName(section("year_check", pack["year_check"], F.col("cik"), F.col("match")))
    )
