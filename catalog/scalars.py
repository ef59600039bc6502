"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import customers, location_of_page, quote_list, sql_norm, sql_resolve, table, with_base
from muster import defaults
from muster.functions import exprs, names, pages, similarity
from muster.operators.verify import spot_norm

_RE_SUFFIX = "|".join(defaults.MERGE_SUFFIXES)


@query("normalize_name", with_base(select=f"""
SELECT c_custkey,
       trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(ename)), '[^\\w\\s]+', ' ', 'g'),
            '\\b({_RE_SUFFIX})\\b\\.?', ' ', 'g'), '\\s+', ' ', 'g')) AS name_norm,
       lower(trim(coalesce(n_name, ''))) AS city_norm
FROM customers"""))
def normalize_name(spark, sf):
    return customers(spark, sf).select(
        "c_custkey",
        names.normalize_name(F.col("ename")).alias("name_norm"),
        exprs.lower_key(F.col("n_name")).alias("city_norm"),
    )


@query("normalize_variants", f"""
SELECT doc_id, {sql_resolve('text')} AS resolve_norm,
       trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'),
            '\\b({"|".join(defaults.SPOT_CHECK_SUFFIXES)})\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS spot_norm
FROM documents""")
def normalize_variants(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        names.resolve_name(F.col("text")).alias("resolve_norm"),
        spot_norm(F.col("text")).alias("spot_norm"),
    )


@query("money_parse", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 3 THEN 0.0 ELSE round(l_extendedprice, 2) END AS amount
FROM lineitem""")
def money_parse(spark, sf):
    price = F.regexp_replace(F.col("l_extendedprice").cast("string"), r"(\d)(\d{3}\.)", "$1,$2")
    text = F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.concat(F.lit("$"), price))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(exprs.money(text), 2).alias("amount")
    )


_BAD_NUMBERS = "CASE o_orderkey % 6 WHEN 0 THEN o_orderkey || 'd' WHEN 1 THEN 'nan' WHEN 2 THEN ' ' || o_orderkey || ' ' WHEN 3 THEN '' WHEN 4 THEN CAST(o_totalprice AS VARCHAR) END"


def _bad_number():
    key, text = F.col("o_orderkey") % 6, F.col("o_orderkey").cast("string")
    return (
        F.when(key == 0, F.concat(text, F.lit("d")))
        .when(key == 1, "nan")
        .when(key == 2, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(key == 3, "")
        .when(key == 4, F.col("o_totalprice").cast("string"))
    )


@query("safe_cast", f"""
SELECT o_orderkey,
       CASE WHEN regexp_full_match(trim({_BAD_NUMBERS}), '[0-9.]+')
            THEN CAST(trim({_BAD_NUMBERS}) AS DOUBLE) END AS number
FROM orders""")
def safe_cast(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", exprs.safe_double(_bad_number()).alias("number")
    )


@query("valid_year", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) + (o_orderkey % 5) * 20 - 40 BETWEEN 1900 AND 2030
       THEN CAST(year(o_orderdate) + (o_orderkey % 5) * 20 - 40 AS INTEGER) END AS founded_year
FROM orders""")
def valid_year(spark, sf):
    year = F.year("o_orderdate") + (F.col("o_orderkey") % 5) * 20 - 40
    return table(spark, sf, "orders").select("o_orderkey", exprs.valid_year(year).alias("founded_year"))


_STATES = [" Georgia", "new york ", "TX", "District of Columbia", "zz"]


@query("state_map", f"""
SELECT c_custkey, (['GA', 'NY', 'TX', 'DC', 'ZZ'])[c_nationkey % 5 + 1] AS state FROM customer""")
def state_map(spark, sf):
    text = F.get(F.array(*[F.lit(s) for s in _STATES]), F.col("c_nationkey") % 5)
    return table(spark, sf, "customer").select(
        "c_custkey", exprs.state_abbreviation(text).alias("state")
    )


@query("industry_fill", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus
            WHEN o_orderpriority = '1-URGENT' THEN 'Biotechnology'
            WHEN o_orderpriority = '2-HIGH' THEN 'Pharmaceuticals'
            WHEN o_orderpriority = '3-MEDIUM' THEN NULL
            ELSE 'Other Health Care' END AS industry
FROM orders""")
def industry_fill(spark, sf):
    priority = F.col("o_orderpriority")
    category = (
        F.when(priority == "1-URGENT", "biotech")
        .when(priority == "2-HIGH", "pharma")
        .when(priority != "3-MEDIUM", priority)
    )
    given = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus"))
    # The third priority has no category, so that nothing is filled in.
    return table(spark, sf, "orders").select(
        "o_orderkey", exprs.fill_industry(given, category).alias("industry")
    )


@query("is_missing_id", """
SELECT o_orderkey, o_orderkey % 7 IN (0, 1, 2, 3) OR o_custkey = 0 AS missing,
       CASE WHEN o_orderkey % 7 NOT IN (0, 1, 2, 3) AND o_custkey <> 0 THEN CAST(o_custkey AS VARCHAR) END AS id,
       CAST(o_custkey AS VARCHAR) AS cik
FROM orders""")
def is_missing_id(spark, sf):
    key = F.col("o_orderkey") % 7
    raw = (
        F.when(key == 1, "").when(key == 2, " nan").when(key == 3, "0")
        .when(key > 3, F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        names.is_missing(raw).alias("missing"),
        names.present_id(raw).alias("id"),
        names.cik_text(F.col("o_custkey").cast("double")).alias("cik"),
    )


_GENERIC = ["red", "blue", "ring"]


@query("block_token", f"""
WITH words AS (
  SELECT p_partkey, string_split({sql_norm("p_name || ' Group ' || p_brand")}, ' ') AS w FROM part
)
SELECT p_partkey,
       coalesce(list_filter(w, lambda x: x NOT IN ({quote_list(_GENERIC)}))[1], w[1], '') AS token
FROM words""")
def block_token(spark, sf):
    norm = names.normalize_name(F.concat("p_name", F.lit(" Group "), "p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey", names.block_token(norm, _GENERIC).alias("token")
    )


@query("sim_threshold", f"""
WITH counted AS (
  SELECT doc_id, len(string_split({sql_norm("text")}, ' ')) AS a,
         len(string_split({sql_norm('source')}, ' ')) AS b
  FROM documents
)
SELECT doc_id, CASE WHEN greatest(a, b) <= 2 THEN 0.95 ELSE 0.92 END::DOUBLE AS threshold
FROM counted""")
def sim_threshold(spark, sf):
    whole = names.normalize_name(F.col("text"))
    source = names.normalize_name(F.col("source"))
    return table(spark, sf, "documents").select(
        "doc_id",
        names.similarity_threshold(names.token_count(whole), names.token_count(source)).alias("threshold"),
    )


@query("jaro_winkler", """
SELECT l_orderkey, l_linenumber,
       round(jaro_winkler_similarity(a.p_name || ' ' || a.p_brand, s_name || ' ' || b.p_name), 9) AS sim
FROM lineitem JOIN part a ON l_partkey = a.p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN part b ON l_suppkey = b.p_partkey""")
def jaro_winkler(spark, sf):
    part = table(spark, sf, "part")
    one = part.select(F.col("p_partkey").alias("l_partkey"),
                      F.concat_ws(" ", "p_name", "p_brand").alias("one"))
    other = part.select(F.col("p_partkey").alias("l_suppkey"), F.col("p_name").alias("other"))
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return (
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .join(one, "l_partkey").join(supplier, "l_suppkey").join(other, "l_suppkey")
        .select("l_orderkey", "l_linenumber", F.round(similarity.jaro_winkler(
            F.col("one"), F.concat_ws(" ", "s_name", "other")), 9).alias("sim"))
    )


@query("location_parse", """
WITH located AS (
  SELECT page_id, (['Boston, MA', 'Lagos, NG', '', 'Lima,PE'])[page_id % 4 + 1] AS place FROM pages
)
SELECT page_id, CASE WHEN place <> '' THEN trim(split_part(place, ',', 1)) END AS city,
       CASE WHEN place <> '' THEN upper(trim(split_part(place, ',', 2))) END AS state
FROM located""")
def location_parse(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        exprs.located_city(location_of_page()).alias("city"),
        exprs.located_state(location_of_page()).alias("state"),
    )


@query("text_blob", """
SELECT p_partkey, lower(p_name || ' ' || CASE WHEN p_size % 2 = 0 THEN 'nan' ELSE p_type END || ' ')
       AS blob
FROM part""")
def text_blob(spark, sf):
    kind = F.when(F.col("p_size") % 2 != 0, F.col("p_type"))
    return table(spark, sf, "part").select(
        "p_partkey", exprs.text_blob(F.col("p_name"), kind, F.lit("")).alias("blob")
    )


@query("url_normalize", """
WITH shaped AS (
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN ' NaN '
         WHEN 2 THEN regexp_replace(url, '^https?://', '') || '//' ELSE url END AS u FROM pages
)
SELECT page_id, CASE WHEN u IS NULL OR lower(trim(u)) IN ('', 'nan') THEN NULL
       ELSE rtrim(CASE WHEN starts_with(u, 'http://') OR starts_with(u, 'https://') THEN u
                       ELSE 'https://' || u END, '/') END AS url
FROM shaped""")
def url_normalize(spark, sf):
    key = F.col("page_id") % 5
    shaped = (
        F.when(key == 1, " NaN ")
        .when(key == 2, F.concat(F.regexp_replace("url", "^https?://", ""), F.lit("//")))
        .when(key > 2, F.col("url"))
    )
    return table(spark, sf, "pages").select("page_id", exprs.normalize_url(shaped).alias("url"))


@query("search_url", f"""
SELECT c_custkey,
       '{defaults.FILING_SEARCH_URL[0]}' || replace(url_encode(c_name || ' & Co*~'), '%20', '+')
         || '{defaults.FILING_SEARCH_URL[1]}' AS filing_url,
       '{defaults.AWARD_SEARCH_URL[0]}' || replace(url_encode(c_name || ' & Co*~'), '%20', '+') AS award_url
FROM customer""")
def search_url(spark, sf):
    name = F.concat("c_name", F.lit(" & Co*~"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        exprs.filing_search_url(name).alias("filing_url"),
        exprs.award_search_url(name).alias("award_url"),
    )


@query("control_chars", """
SELECT doc_id, text AS clean FROM documents""")
def control_chars(spark, sf):
    """Control characters are put in front of every line break and must all go again."""
    marked = F.replace("text", F.lit("\n"), F.lit("\x00\x08\x0b\x0c\x0e\x1f\n"))
    return table(spark, sf, "documents").select("doc_id", exprs.strip_control(marked).alias("clean"))


@query("title_case", """
SELECT doc_id, array_to_string(list_transform(
         regexp_extract_all(text, '(\\p{L}+|\\P{L}+)', 1),
         lambda r: replace(upper(r[1]), 'ẞ', 'Ss') || lower(r[2:])), '') AS title
FROM documents""")
def title_case(spark, sf):
    return table(spark, sf, "documents").select("doc_id", exprs.title_case(F.col("text")).alias("title"))


@query("quarter_sequence", """
SELECT o_orderkey, year(q) || 'q' || quarter(q) AS quarter
FROM (SELECT o_orderkey, unnest(generate_series(TIMESTAMP '2015-01-01',
        date_trunc('quarter', o_orderdate + INTERVAL 18 YEAR - INTERVAL 60 DAY), INTERVAL 3 MONTH)) AS q
      FROM orders)""")
def quarter_sequence(spark, sf):
    """Published quarters as of each order's date, moved into the time of the archive."""
    today = F.add_months(F.col("o_orderdate").cast("date"), 18 * 12)
    tags = exprs.quarter_tags(exprs.last_published_quarter(today))
    return table(spark, sf, "orders").select("o_orderkey", F.explode(tags).alias("quarter"))


@query("ratio", """
SELECT l_orderkey, l_linenumber,
       round(l_quantity / nullif(l_linenumber - 1, 0), 4) AS ratio
FROM lineitem""")
def ratio(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        exprs.ratio(F.col("l_quantity"), F.col("l_linenumber") - 1).alias("ratio"),
    )


_PAGE_HTML = "replace(html, '</article>', '<p>&copy; 2019 Founded in ' || (1880 + page_id % 170) || ', since 2010</p><script>founded 1950</script></article>')"


@query("html_text_year", f"""
WITH read AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_PAGE_HTML},
           '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'),
           '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g') AS t
  FROM pages
),
found AS (
  SELECT page_id, t, list_concat({", ".join(f"regexp_extract_all(t, '(?i){p}', 1)" for p in defaults.FOUNDING_PHRASES)}) AS ys
  FROM read
)
SELECT page_id, t AS page_text, CAST(list_min(list_filter(list_transform(ys, lambda y: CAST(y AS INTEGER)),
       lambda y: y BETWEEN 1900 AND 2030)) AS INTEGER) AS founded_year
FROM found""")
def html_text_year(spark, sf):
    phrase = F.concat(
        F.lit("<p>&copy; 2019 Founded in "), (1880 + F.col("page_id") % 170).cast("string"),
        F.lit(", since 2010</p><script>founded 1950</script></article>"),
    )
    shaped = table(spark, sf, "pages").select(
        "page_id", F.replace("html", F.lit("</article>"), phrase).alias("html")
    )
    return shaped.select(
        "page_id",
        pages.page_text(F.col("html")).alias("page_text"),
        pages.founding_year(F.col("html")).alias("founded_year"),
    )


def _sql_title(words: str, separator: str) -> str:
    return (f"array_to_string(list_transform(string_split({words}, '{separator}'), "
            "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


@query("image_names", f"SELECT p_partkey, {_sql_title('p_name', ' ')} AS name FROM part")
def image_names(spark, sf):
    """Part names spelled by the files of their logos."""
    endings = F.array(*[F.lit(e) for e in ("-logo.png", "-white-e12.png", "-20200131123456.jpg", ".svg")])
    stem = F.replace(F.lower("p_name"), F.lit(" "), F.lit("-"))
    path = F.concat(F.lit("/u/2020/"), stem, F.get(endings, (F.col("p_partkey") % 4).cast("int")))
    return table(spark, sf, "part").select("p_partkey", pages.name_from_image_file(path).alias("name"))


@query("host_names", f"""
SELECT page_id, {_sql_title("string_split(host, '.')[1]", '-')} AS name
FROM (SELECT page_id, CASE WHEN starts_with(h, 'www.') THEN h[5:] ELSE h END AS host
      FROM (SELECT page_id, string_split(string_split(url, '//')[2], '/')[1] AS h FROM pages))""")
def host_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", pages.name_from_host(F.col("url")).alias("name"))


@query("card_names", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment WHEN 2 THEN 'Lead ' || c_name ELSE '' END AS name
FROM customer""")
def card_names(spark, sf):
    """Headings, links where the heading is a mere status, and text leads where there is neither."""
    key = F.col("c_custkey")
    heading = F.when(key % 4 == 0, F.col("c_name")).when(key % 4 == 1, "Acquired").otherwise("")
    link = F.when(key % 4 == 1, F.col("c_mktsegment")).otherwise("")
    text = F.when(key % 4 == 2, F.concat(F.lit("Lead "), "c_name", F.lit(" Institution: U"))).otherwise("no lead")
    return table(spark, sf, "customer").select("c_custkey", pages.card_name(heading, link, text).alias("name"))
