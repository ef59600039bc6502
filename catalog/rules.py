"""Rule classification and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import customers, table, with_base
from muster import defaults
from muster.functions.exprs import text_blob
from muster.operators import rules


def _words_sql(text: str, words: str) -> str:
    """Whole-word search; the word boundary of RE2 knows ASCII letters only."""
    return f"regexp_matches({text}, '(?i)(^|[^\\p{{L}}\\p{{N}}_])({words})($|[^\\p{{L}}\\p{{N}}_])')"


def _any_sql(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


_TITLES = ["University of ", "Memorial Hospital ", "NASA ", "The Trust ", "Society ", ""]
_TITLED = "([" + ", ".join(f"'{t}'" for t in _TITLES) + "])[doc_id % 6 + 1] || text"
_ENTITY_SQL = f"""
WITH titled AS (
  SELECT doc_id, {_TITLED} || ' ' || source AS t, doc_id % 5 = 0 AS filed, doc_id % 7 = 0 AS awarded,
         doc_id % 2 = 0 AS granted, CASE doc_id % 3 WHEN 0 THEN 'Non-Profit Corp' WHEN 1 THEN 'Corp' END AS ft
  FROM documents
),
typed AS (
  SELECT doc_id, filed, awarded, granted, CASE
    WHEN {_words_sql('t', defaults.UNIVERSITY_WORDS)} THEN 'university'
    WHEN {_words_sql('t', defaults.HOSPITAL_WORDS)} THEN 'hospital'
    WHEN {_words_sql('t', defaults.GOVERNMENT_WORDS)} THEN 'govt_lab'
    WHEN {_words_sql('t', defaults.NONPROFIT_WORDS)} AND NOT filed THEN 'nonprofit'
    WHEN granted AND NOT filed AND NOT awarded THEN 'research_inst'
    WHEN lower(ft) LIKE '%non-profit%' OR lower(ft) LIKE '%nonprofit%' THEN 'nonprofit'
    ELSE 'startup' END AS entity_type
  FROM titled
)"""


def _typed_documents(spark, sf):
    key = F.col("doc_id")
    title = F.get(F.array(*[F.lit(t) for t in _TITLES]), (key % 6).cast("int"))
    filer = F.when(key % 3 == 0, "Non-Profit Corp").when(key % 3 == 1, "Corp")
    flagged = table(spark, sf, "documents").withColumns({
        "filed": key % 5 == 0, "awarded": key % 7 == 0, "granted": key % 2 == 0,
    })
    return flagged.withColumn("entity_type", rules.entity_type(
        F.concat(title, "text"), F.col("source"), filer, F.col("filed"), F.col("awarded"), F.col("granted")
    ))


@query("classify_entity", _ENTITY_SQL + "SELECT doc_id, entity_type FROM typed")
def classify_entity(spark, sf):
    return _typed_documents(spark, sf).select("doc_id", "entity_type")


@query("assign_tier", _ENTITY_SQL + """
SELECT doc_id, CASE WHEN entity_type <> 'startup' THEN 'research_inst' WHEN filed THEN 'operating_company'
  WHEN awarded THEN 'grant_only_company' WHEN doc_id % 3 = 0 THEN 'tto_spinout'
  ELSE 'research_inst' END AS tier
FROM typed""")
def assign_tier(spark, sf):
    listed = F.when(F.col("doc_id") % 3 == 0, True)
    return _typed_documents(spark, sf).select("doc_id", rules.tier(
        F.col("entity_type"), F.col("filed"), F.col("awarded"), listed
    ).alias("tier"))


@query("interim_tier", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)
  THEN 'confirmed_strong' WHEN o_orderstatus = 'F' THEN 'confirmed_funded'
  WHEN o_orderkey % 2 = 0 THEN 'confirmed_grant' ELSE 'research_org' END AS tier
FROM orders""")
def interim_tier(spark, sf):
    awarded = F.when(F.col("o_orderkey") % 2 == 0, True)
    return table(spark, sf, "orders").select("o_orderkey", rules.interim_tier(
        F.col("o_orderstatus") == "F", awarded, F.col("o_orderkey") % 3 == 0
    ).alias("tier"))


_SUBCATEGORY_SQL = " ".join(
    f"WHEN {_any_sql('blob', words)} THEN '{label}'" for label, words in defaults.SUBCATEGORY_KEYWORDS
)


@query("classify_subcategory", f"""
WITH told AS (
  SELECT doc_id, lower(text || ' ' || coalesce(industry, 'nan') || ' ') AS blob, lower(industry) AS industry
  FROM (SELECT doc_id, text,
               (['Pharmaceuticals', 'Biotechnology', 'Other Health Care'])[doc_id % 4 + 1] AS industry
        FROM documents)
)
SELECT doc_id, CASE {_SUBCATEGORY_SQL} WHEN contains(industry, 'pharm') THEN 'pharma'
  WHEN contains(industry, 'biotech') THEN 'biotech' WHEN contains(industry, 'health') THEN 'medtech'
  ELSE 'unknown' END AS subcategory
FROM told""")
def classify_subcategory(spark, sf):
    key = F.col("doc_id")
    kinds = F.array(*[F.lit(i) for i in ("Pharmaceuticals", "Biotechnology", "Other Health Care")])
    told = table(spark, sf, "documents").select(
        "doc_id",
        "text",
        F.get(kinds, (key % 4).cast("int")).alias("industry"),
    )
    read = told.withColumn("blob", text_blob(F.col("text"), F.col("industry"), F.lit("")))
    return read.select("doc_id", rules.subcategory(F.col("blob"), F.col("industry")).alias("subcategory"))


_SCORED_SQL = """scored AS (
  SELECT c_custkey, ename, area, c_acctbal, c_custkey % 4 = 0 AS filed, c_custkey % 9 = 0 AS listed,
         CASE WHEN c_custkey % 3 <> 0 THEN CAST(2000 + c_custkey % 27 AS VARCHAR) END AS last_year,
         c_mktsegment AS category, CAST(1840 + c_custkey % 200 AS VARCHAR) AS year_incorp
  FROM customers)"""
SCORE_SQL = """CAST(CASE WHEN filed THEN 3 ELSE 0 END
  + CASE WHEN CAST(last_year AS INTEGER) >= 2024 THEN 3 WHEN CAST(last_year AS INTEGER) >= 2022 THEN 2
         WHEN CAST(last_year AS INTEGER) >= 2020 THEN 1 ELSE 0 END
  + CASE WHEN listed THEN 2 ELSE 0 END
  + CASE WHEN category IN ('MACHINERY', 'FURNITURE') THEN 2 ELSE 0 END
  + CASE WHEN CAST(year_incorp AS INTEGER) >= 2015 THEN 1 ELSE 0 END AS INTEGER)"""


def scored_customers(spark, sf):
    key = F.col("c_custkey")
    shaped = customers(spark, sf).withColumns({
        "filed": key % 4 == 0, "listed": key % 9 == 0,
        "last_year": F.when(key % 3 != 0, (2000 + key % 27).cast("string")),
        "year_incorp": (1840 + key % 200).cast("string"),
    })
    score = rules.priority_score(
        F.col("filed"), F.col("listed"), F.col("last_year"), F.col("c_mktsegment"),
        F.col("year_incorp"), high=["MACHINERY", "FURNITURE"],
    )
    return shaped.withColumn("priority_score", score)


@query("priority_score", with_base(_SCORED_SQL, select=f"""
SELECT c_custkey, {SCORE_SQL} AS priority_score,
       CASE WHEN CAST(year_incorp AS INTEGER) BETWEEN 1900 AND 2030 THEN CAST(year_incorp AS INTEGER) END
         AS founded_year
FROM scored"""))
def priority_score(spark, sf):
    return scored_customers(spark, sf).select(
        "c_custkey", "priority_score", rules.founded_year(F.col("year_incorp")).alias("founded_year")
    )


@query("ratio_flags", """
WITH r AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'form_d' ELSE 'sbir' END AS source,
         l_discount / nullif(l_linenumber - 1, 0) AS q FROM lineitem
)
SELECT l_orderkey, l_linenumber, CASE WHEN q IS NULL THEN 'no_external_data'
  WHEN source = 'form_d' AND q BETWEEN 0.001 AND 0.20 THEN 'ok'
  WHEN source = 'sbir' AND q BETWEEN 0.05 AND 0.80 THEN 'ok' ELSE 'review' END AS flag
FROM r""")
def ratio_flags(spark, sf):
    line = F.col("l_linenumber")
    source = F.when(line % 2 == 0, "form_d").otherwise("sbir")
    quotient = F.col("l_discount") / F.nullif((line - 1).cast("double"), F.lit(0.0))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", rules.ratio_flag(source, quotient).alias("flag")
    )
