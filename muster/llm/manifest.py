"""A Merkle manifest of a table of documents: digests of rows, folded into one tree per language and one root.

Nodes of a level are rows with their number in their tree.  Each level is built by self-joins on computed
sibling numbers: the first node of a run meets its siblings, whose numbers differ from its own by their slot
(in a binary tree by the last bit), and emits the parent.  The way back down joins every run to the run above it,
so that each leaf gets its siblings level by level, with as many rows per level as there are runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.session import materialize

FANOUT = 8
_PLACE = (1 << 33) - 1  # the part of an increasing row number that counts within a partition
_PATH = "array<struct<l:string,r:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value after its number of UTF-8 bytes, so that no two rows of values read alike; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, order: list[str], fanout: int = FANOUT) -> DataFrame:
    """``rows`` with ``idx``, their number in their ``tree`` by the given order, ``n``, the size of the tree, and ``slot``.

    Rows are dealt by ranges of the order; a row's number is its place in its range after the rows of its tree in the
    ranges before.  Rows that are equal throughout are dealt apart, so that no value needs to fit one range.
    """
    number, keys = F.monotonically_increasing_id(), [F.col("tree").asc(), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.withColumn("copy", number).repartitionByRange(*keys, F.col("copy")).drop("copy").sortWithinPartitions(*keys)
    dealt = dealt.withColumn("place", number).select(
        *rows.columns, F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND(F.lit(_PLACE)).alias("place"))
    dealt = materialize(dealt, "dealt")
    # One row per range and tree; a range that holds several trees holds all but the first and last as a whole.
    sizes = dealt.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("own"))
    tree = Window.partitionBy("tree")
    before = F.sum("own").over(tree.orderBy("part")) - F.col("own")
    sizes = materialize(sizes.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("own").over(tree).alias("n")), "sizes")
    idx = F.col("place") + F.col("shift")
    placed = dealt.join(sizes, ["tree", "part"]).select(*rows.columns, idx.alias("idx"), "n", F.pmod(idx, F.lit(fanout)).cast("int").alias("slot"))
    return materialize(placed, "level", split_by="slot")


def _runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """``tree, idx, n, kids, h`` of every parent: its number, how many nodes its level below has, these in order, its digest."""
    kept = [c for c in nodes.columns if c not in ("tree", "idx", "n", "slot")]
    several = nodes.filter("n > 1")
    runs = several.filter("slot = 0").select("tree", "idx", "n", F.struct(*kept).alias("kid0"))
    for k in range(1, fanout):
        first = F.col("idx").bitwiseXOR(F.lit(1)) if fanout == 2 else F.col("idx") - F.lit(k)
        runs = runs.join(several.filter(f"slot = {k}").select("tree", first.alias("idx"), F.struct(*kept).alias(f"kid{k}")), ["tree", "idx"], "left")
    kids = F.array_compact(F.array(*[f"kid{k}" for k in range(fanout)]))
    runs = runs.select("tree", F.expr(f"idx div {fanout}").alias("idx"), "n", kids.alias("kids"))
    return materialize(runs.withColumn("h", F.sha2(F.array_join("kids.h", ""), 256)), "runs")


def _levels(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level from the leaves up, and ``tree, h`` of every tree's top."""
    most, levels = nodes.agg(F.max("n")).first()[0] or 0, []
    tops = nodes.filter("n = 1").select("tree", "h")
    while most > 1:
        runs = _runs(nodes, fanout)
        levels.append(runs)
        above = F.ceil(F.col("n") / F.lit(fanout)).cast("long")
        nodes = runs.select("tree", "h", "idx", above.alias("n"), F.pmod("idx", F.lit(fanout)).cast("int").alias("slot"))
        tops = tops.unionByName(nodes.filter("n = 1").select("tree", "h"))
        most = -(-most // fanout)
        if most > fanout ** 3:
            nodes = materialize(nodes, "level", split_by="slot")
    return levels, materialize(tops, "tops")


def _siblings(kids: str, slot: Column) -> Column:
    """The digests left and right of a slot, each concatenated."""
    return F.struct(
        F.array_join(F.slice(F.col(kids), F.lit(1), slot), "").alias("l"),
        F.array_join(F.slice(F.col(kids), slot + F.lit(2), F.size(kids)), "").alias("r"))


def _paths(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame | None:
    """The runs of the leaves with ``path``, the siblings of their parents on every level from there up.

    ``tops`` has ``tree, path`` and more columns, which go along.
    """
    along, below = [c for c in tops.columns if c not in ("tree", "path")], None
    for level, runs in reversed(list(enumerate(levels))):
        under = runs.filter(F.col("n") <= fanout).join(tops, "tree")
        if below is not None:
            up = below.select("tree", F.col("idx").alias("up"), F.col("kids.h").alias("others"), F.col("path").alias("rest"), *along)
            high = runs.filter(F.col("n") > fanout).withColumn("up", F.expr(f"idx div {fanout}")).join(up, ["tree", "up"])
            slot = F.pmod("idx", F.lit(fanout)).cast("int")
            path = F.concat(F.array(_siblings("others", slot)), "rest")
            under = under.unionByName(high.withColumn("path", path).drop("up", "others", "rest"))
        below = materialize(under.drop("h"), "paths") if level else under.drop("h")
    return below


def manifest(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), fanout: int = FANOUT, tamper_every: int = 3) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    A leaf is the digest of a row's ``fields``, each ``-`` if null, else its length in bytes, a colon and its value.  The
    leaves of a language ascend by id, null first and rows of one id by digest; runs of ``fanout`` nodes become the digest
    of their digests while a level has several, and the tops, by language with null first, likewise the root.  A proof
    is what is beside a row's way to the root.  To show that it tells rows apart, every row of which the crc32 of the id is divisible by
    ``tamper_every`` is folded as if its A-Z were lower-cased; a row without id or text, or without such letters, stays
    as it is.  A row alone in its language and the only language has the digest of nothing as proof.  No rows, no rows;
    columns not in ``fields`` are not looked at.
    """
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    tampered = digest(*[field(lower if f == text_col else F.col(f)) for f in fields])
    leaves = materialize(docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col(tree_col).cast("string")), F.lit("")).alias("tree"), F.col(id_col).alias("doc_id"),
        digest(*[field(F.col(f)) for f in fields]).alias("h"), F.when(crc % tamper_every == 0, tampered).alias("tampered")), "leaves")
    nodes = numbered(leaves, ["doc_id", "h"], fanout)
    levels, subroots = _levels(nodes, fanout)

    # The tree of the subroots, in which a leaf's name is its language.
    upper = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h"), ["name"], fanout)
    upper_levels, root = _levels(upper, fanout)
    top = root.select("tree", F.col("h").alias("root"), F.array().cast(_PATH).alias("path"))
    ends = upper.filter("n = 1").join(top, "tree").select("name", F.col("h").alias("subroot"), "path", "root")
    if upper_levels:
        runs = _paths(upper_levels, top, fanout)
        each = runs.select("root", "path", F.col("kids.h").alias("own"), F.posexplode("kids").alias("slot", "kid"))
        ends = ends.unionByName(each.select(
            F.col("kid.name").alias("name"), F.col("kid.h").alias("subroot"), F.concat(F.array(_siblings("own", F.col("slot"))), "path").alias("path"), "root"))
    ends = materialize(ends.withColumnRenamed("name", "tree"), "ends")

    # Every leaf with its siblings from its own run up; a leaf that is its tree's top has those of the tops alone.
    found = nodes.filter("n = 1").select("tree", "doc_id", "h", "tampered").join(ends, "tree")
    found = found.select("doc_id", "h", "tampered", "subroot", "root", "path")
    if levels:
        runs = _paths(levels, ends, fanout)
        each = runs.select("subroot", "root", "path", F.col("kids.h").alias("own"), F.posexplode("kids").alias("slot", "kid"))
        found = found.unionByName(each.select(
            "kid.doc_id", "kid.h", "kid.tampered", "subroot", "root", F.concat(F.array(_siblings("own", F.col("slot"))), "path").alias("path")))
    beside = F.array_join(F.transform("path", lambda p: F.concat(p["l"], p["r"])), "")
    folded = F.aggregate("path", F.coalesce("tampered", "h"), lambda h, p: digest(p["l"], h, p["r"]))
    found = found.withColumns({"proof_sha256": F.sha2(beside, 256), "folded_root": folded})
    return found.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
