"""Similar names, components, duplicate resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import customers, sql_resolve, suppliers, table, with_base
from muster.functions.names import block_token, resolve_name
from muster.operators import components, resolve


def sql_components(rows: str, edges: str, name: str = "comp") -> str:
    """Expressions that give ``node, component`` of all ``ord`` of ``rows``."""
    return f"""{name}_both AS (SELECT src, dst FROM {edges} UNION SELECT dst, src FROM {edges}),
{name}_reach AS (
  SELECT ord AS node, ord AS label FROM {rows}
  UNION SELECT e.dst, r.label FROM {name}_reach r JOIN {name}_both e ON e.src = r.node AND e.dst > r.label
),
{name} AS (SELECT node, min(label) AS component FROM {name}_reach GROUP BY node)"""


def sql_hubs(rows: str, *keys: str, where: str = "true") -> str:
    by = ", ".join(keys)
    return (
        f"SELECT ord AS src, min(ord) OVER (PARTITION BY {by}) AS dst FROM {rows} WHERE {where}"
    )


_LINKS_SQL = """links AS (
  SELECT a.o_custkey AS src, b.o_custkey AS dst FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
  WHERE a.o_custkey % 40 = b.o_custkey % 40 AND a.o_custkey <> b.o_custkey
),
nodes AS (SELECT c_custkey AS ord FROM customer)"""


@query("connected_components", f"""WITH RECURSIVE {_LINKS_SQL}, {sql_components('nodes', 'links')}
SELECT node, component FROM comp""")
def connected_components(spark, sf):
    """Customers of consecutive orders are linked if their numbers fall into one bucket."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    following = orders.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("dst"))
    links = orders.join(following, "o_orderkey").select(F.col("o_custkey").alias("src"), "dst").filter(
        F.col("src") % 40 == F.col("dst") % 40
    )
    return components.connected_components(table(spark, sf, "customer").select("c_custkey"), links)


# Part names with slips of the pen, so that some are alike and some are equal.
_SLIPS_SQL = """slips AS (
  SELECT p_partkey AS ord, p_brand AS msa, CASE p_partkey % 5 WHEN 0 THEN p_name || ', Inc.' WHEN 1 THEN p_name || 's'
           WHEN 2 THEN replace(p_name, 'i', 'ii') WHEN 3 THEN upper(p_name) ELSE p_name || ' Medical' END AS name,
         CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size % 3 + 1 AS VARCHAR) END AS cik,
         CASE WHEN p_partkey % 7 = 0 THEN 'U' || (p_size % 2) END AS uei,
         p_partkey % 3 = 0 AS source_tto, p_partkey AS nih_grants
  FROM part
),
shaped AS (
  SELECT *, norm, string_split(norm, ' ')[1] AS block, len(string_split(norm, ' ')) AS tokens
  FROM (SELECT *, {} AS norm FROM slips)
)"""


def slips(spark, sf):
    key, name = F.col("p_partkey"), F.col("p_name")
    shaped = (
        F.when(key % 5 == 0, F.concat(name, F.lit(", Inc."))).when(key % 5 == 1, F.concat(name, F.lit("s")))
        .when(key % 5 == 2, F.replace(name, F.lit("i"), F.lit("ii"))).when(key % 5 == 3, F.upper(name))
        .otherwise(F.concat(name, F.lit(" Medical")))
    )
    return table(spark, sf, "part").select(
        key.alias("ord"), F.col("p_brand").alias("msa"), shaped.alias("name"),
        F.when(key % 4 == 0, (F.col("p_size") % 3 + 1).cast("string")).alias("cik"),
        F.when(key % 7 == 0, F.concat(F.lit("U"), (F.col("p_size") % 2).cast("string"))).alias("uei"),
        (key % 3 == 0).alias("source_tto"), key.alias("nih_grants"),
    )


_SHAPED = _SLIPS_SQL.replace("{}", sql_resolve("name"))
_THRESHOLD = "CASE WHEN greatest(a.tokens, b.tokens) <= 2 THEN 0.95 ELSE 0.92 END"


@query("jaro_winkler_pairs", f"""WITH RECURSIVE {_SHAPED},
named AS (SELECT msa, block, norm, min(ord) AS ord, min(tokens) AS tokens FROM shaped GROUP BY msa, block, norm)
SELECT msa, a.norm AS norm_a, b.norm AS norm_b, round(jaro_winkler_similarity(a.norm, b.norm), 9) AS sim
FROM named a JOIN named b USING (msa, block)
WHERE a.ord < b.ord AND jaro_winkler_similarity(a.norm, b.norm) >= {_THRESHOLD}""")
def jaro_winkler_pairs(spark, sf):
    norm = resolve_name(F.col("name"))
    names = slips(spark, sf).select("msa", "ord", norm.alias("norm"), block_token(norm).alias("block"))
    distinct = names.groupBy("msa", "block", "norm").agg(F.min("ord").alias("ord"))
    return resolve.similar_names(distinct, ["msa", "block"]).select(
        "msa", "norm_a", "norm_b", F.round("sim", 9).alias("sim")
    )


_VETO = "(a.cik IS NOT NULL AND b.cik IS NOT NULL AND a.cik <> b.cik) OR (a.uei IS NOT NULL AND b.uei IS NOT NULL AND a.uei <> b.uei)"
_COLLAPSED = """
SELECT CAST(min(ord) AS BIGINT) AS ord, arg_min(msa, ord) AS msa, arg_min(name, ord) AS name,
       arg_min(cik, ord) FILTER (cik IS NOT NULL) AS cik, arg_min(uei, ord) FILTER (uei IS NOT NULL) AS uei,
       bool_or(source_tto) AS source_tto, CAST(sum(nih_grants) AS BIGINT) AS nih_grants"""


@query("fuzzy_dedup", f"""WITH RECURSIVE {_SHAPED},
links AS (
  SELECT a.ord AS src, b.ord AS dst FROM shaped a JOIN shaped b USING (msa, block)
  WHERE a.ord < b.ord AND NOT coalesce({_VETO}, false)
    AND jaro_winkler_similarity(a.norm, b.norm) >= {_THRESHOLD}
),
{sql_components('shaped', 'links')}
{_COLLAPSED} FROM shaped JOIN comp ON ord = node GROUP BY component""")
def fuzzy_dedup(spark, sf):
    return resolve.merge_by_similarity(slips(spark, sf))


_IDENTITY_SQL = f"""entities AS (
  SELECT c_custkey AS ord, area AS msa, ename AS name, {sql_resolve('ename')} AS norm,
         CASE WHEN c_custkey % 6 = 0 THEN CAST(c_custkey // 18 AS VARCHAR) END AS cik,
         CASE WHEN c_custkey % 11 = 0 THEN 'U' || (c_custkey // 33) END AS uei,
         c_custkey % 3 = 0 AS source_tto, c_custkey AS nih_grants
  FROM customers
),
links AS (
  {sql_hubs('entities', 'msa', 'norm', where="norm <> ''")}
  UNION ALL {sql_hubs('entities', 'cik', where="cik <> '0'")}
  UNION ALL {sql_hubs('entities', 'uei', where="uei IS NOT NULL")}
)"""


def identity_entities(spark, sf):
    key = F.col("c_custkey")
    return customers(spark, sf).select(
        key.alias("ord"), F.col("area").alias("msa"), F.col("ename").alias("name"),
        F.when(key % 6 == 0, F.floor(key / 18).cast("string")).alias("cik"),
        F.when(key % 11 == 0, F.concat(F.lit("U"), F.floor(key / 33).cast("string"))).alias("uei"),
        (key % 3 == 0).alias("source_tto"), key.alias("nih_grants"),
    )


@query("id_dedup", with_base(_IDENTITY_SQL, sql_components("entities", "links"),
                             select=f"{_COLLAPSED} FROM entities JOIN comp ON ord = node GROUP BY component"))
def id_dedup(spark, sf):
    return resolve.merge_by_identity(identity_entities(spark, sf))


@query("id_links", with_base(_IDENTITY_SQL, select="SELECT DISTINCT src, dst FROM links WHERE src <> dst"))
def id_links(spark, sf):
    return resolve.identity_edges(identity_entities(spark, sf)).distinct()


@query("manual_merge", with_base(_IDENTITY_SQL.split("links AS")[0].rstrip().rstrip(","), f"""groups AS (
  SELECT s_suppkey AS group_id, area AS msa, {sql_resolve('ename')} AS norm FROM suppliers
  UNION SELECT s.s_suppkey, s.area, {sql_resolve('t.ename')}
  FROM suppliers s JOIN suppliers t ON t.s_suppkey = s.s_suppkey + 1
),
hits AS (SELECT group_id, ord FROM entities JOIN groups USING (msa, norm)),
links AS ({sql_hubs('hits', 'group_id')})""", sql_components("entities", "links"),
                                 select=f"{_COLLAPSED} FROM entities JOIN comp ON ord = node GROUP BY component"))
def manual_merge(spark, sf):
    """Every supplier lists its own and the next supplier's name as one entity of its area."""
    listed = suppliers(spark, sf).select("s_suppkey", "area", F.col("ename").alias("name"))
    following = listed.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("name").alias("other"))
    own = listed.select(F.col("s_suppkey").alias("group_id"), F.col("area").alias("msa"), "name")
    next_name = listed.join(following, "s_suppkey").select(
        F.col("s_suppkey").alias("group_id"), F.col("area").alias("msa"), F.col("other").alias("name")
    )
    return resolve.merge_by_groups(identity_entities(spark, sf), own.unionByName(next_name))
