"""Duplicate resolution: links between rows, clusters of linked rows, one row per cluster."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions.names import (
    block_token,
    present_id,
    resolve_name,
    token_count,
)
from muster.functions.similarity import forest, similar_pairs
from muster.operators.components import linked_components
from muster.operators.joins import HOT_ROWS, join_counted
from muster.operators.rollup import canonical_agg, classes_of
from muster.schemas import ID_COLUMNS
from muster.session import materialize

# Names of one block that meet in one task as one side; a larger block is split into tiles.
TILE_NAMES = 2000


def hub_edges(
    df: DataFrame, ord_col: str, key_cols: Sequence[str], valid: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``src, dst`` from every row to the least ``ord`` of the rows with its key.

    The number of links is linear in the rows even where one key has a large share of them.
    """
    rows = df if valid is None else df.filter(valid)
    hubs = (
        rows.groupBy(*key_cols)
        .agg(F.min(ord_col).alias("dst"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
    )
    keyed = rows.select(F.col(ord_col).alias("src"), *key_cols)
    linked = join_counted(keyed, hubs, key_cols, "_rows", hot_rows)
    return linked.filter(F.col("src") != F.col("dst")).select("src", "dst")


def collapse_clusters(df: DataFrame, components: DataFrame, ord_col: str = "ord") -> DataFrame:
    """One row per cluster of ``components`` (``node, component``).

    Only rows with a partner are shuffled and aggregated; the others pass straight through.
    """
    flags, sums, firsts = classes_of(df.columns, [ord_col])
    alone = df.join(components, df[ord_col] == components["node"], "left_anti").withColumns(
        {c: F.coalesce(F.col(c), F.lit(False)) for c in flags}
        | {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in sums}
    )
    merged = canonical_agg(
        df.join(components, df[ord_col] == components["node"]).drop("node"),
        ["component"], ord_col, flags, sums, firsts,
    )
    return alone.unionByName(merged.drop("component"))


def _with_ids(df: DataFrame, hard_ids: Sequence[str]) -> dict[str, Column]:
    return {c: present_id(F.col(c)) for c in hard_ids if c in df.columns}


def identity_edges(
    df: DataFrame, ord_col: str = "ord", name: str = "name", area: str = "msa",
    hard_ids: Sequence[str] = ID_COLUMNS,
) -> DataFrame:
    """Links between rows with the same name in the same area, or the same identifier anywhere."""
    norm = resolve_name(F.col(name))
    keys = [("name", F.col(area), F.when(norm != "", norm))]
    keys += [(c, F.lit(""), value) for c, value in _with_ids(df, hard_ids).items()]
    entries = F.array(
        *[F.struct(F.lit(k).alias("kind"), a.alias("area"), v.alias("value")) for k, a, v in keys]
    )
    keyed = df.select(F.col(ord_col).alias("ord"), F.explode(entries).alias("key")).select(
        "ord", "key.kind", "key.area", "key.value"
    )
    # Read several times below; narrow, so written once.
    keyed = materialize(keyed.filter("value IS NOT NULL"), "keyed")
    return hub_edges(keyed, "ord", ["kind", "area", "value"])


def merge_by_identity(df: DataFrame, ord_col: str = "ord", **columns) -> DataFrame:
    return collapse_clusters(df, linked_components(identity_edges(df, ord_col, **columns)), ord_col)


# -- similar names ---------------------------------------------------------------------------


def _compared(
    names: DataFrame, block: Sequence[str], tile: int, short: float, long: float,
    hard_ids: Sequence[str], carry: Sequence[str], tied: str | None,
) -> DataFrame:
    """``ord_a, ord_b, norm_a, norm_b, sim`` of similar names, and the columns to ``carry`` of either.

    Every pair of tiles of a block meets in one task, which holds two tiles' names.  Of the pairs in which ``tied``
    is true on both sides only a spanning forest leaves a task.
    """
    extra = list(dict.fromkeys([*hard_ids, *carry, *([tied] if tied else [])]))
    names = names.filter("norm <> ''").select(*block, "norm", "ord", (token_count(F.col("norm")) <= 2).alias("few"), *extra)
    names = materialize(names, "names")
    tiles = names.groupBy(*block).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = tiles.select(*block, F.ceil(F.col("n") / F.lit(tile)).cast("int").alias("tiles"))
    dealt = names.join(tiles, block).withColumn("own", F.pmod(F.xxhash64("norm"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pair = [F.least("own", "met").alias("one"), F.greatest("own", "met").alias("other")]
    dealt = dealt.select(*block, *pair, "own", "norm", "ord", "few", *extra)
    sides = [f"{c}_{s}" for c in ("ord", "norm", *carry) for s in ("a", "b")]
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    result = [f"`{c}` {kinds[c]}" for c in block] + [f"`{c}` {kinds[c.rpartition('_')[0]]}" for c in sides] + ["sim double"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(group: pa.Table) -> pa.RecordBatch:
            texts, own = group.column("norm").to_pylist(), group.column("own").to_numpy()
            # A tile met by another shows its pairs with that one only; its own pairs are the tile met by itself.
            ids = [np.unique(np.array(group.column(c).to_pylist(), dtype=object), return_inverse=True)[1] for c in hard_ids]
            known = [np.array([v != "" for v in group.column(c).to_pylist()]) for c in hard_ids]

            def agree(i, j):
                chosen = np.ones(len(i), dtype=bool)
                for number, there in zip(ids, known):
                    chosen &= ~(there[i] & there[j]) | (number[i] == number[j])
                return chosen

            i, j, sim = similar_pairs(texts, group.column("few").to_numpy(), own, short, long, agree if hard_ids else None)
            if tied and len(i):
                sure = np.array(group.column(tied).to_pylist(), dtype=bool)
                both = sure[i] & sure[j]
                kept = ~both
                kept[both] = forest(i[both], j[both])
                i, j, sim = i[kept], j[kept], sim[kept]
            first = np.array(group.column("ord").to_pylist(), dtype=object)
            swap = first[i] > first[j] if len(i) else np.zeros(0, dtype=bool)
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            at = {"a": pa.array(i, pa.int64()), "b": pa.array(j, pa.int64())}
            columns = [group.column(c).take(at["a"]) for c in block]
            columns += [group.column(c.rpartition("_")[0]).take(at[c[-1]]) for c in sides] + [pa.array(sim, pa.float64())]
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            return pa.RecordBatch.from_arrays(columns, [*block, *sides, "sim"])

        keys, waiting, last = [*block, "one", "other"], [], None
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            edges = [0] + [n for n in range(1, len(rows)) if rows[n] != rows[n - 1]] + [len(rows)]
            for start, stop in zip(edges, edges[1:]):
                if start == stop:
                    continue
                if waiting and rows[start] != last:
                    yield settle(pa.Table.from_batches(waiting))
                    waiting = []
                waiting.append(batch.slice(start, stop - start))
                last = rows[start]
        if waiting:
            yield settle(pa.Table.from_batches(waiting))

    keys = [*block, "one", "other"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, ", ".join(result))


def similar_names(
    names: DataFrame,
    block_cols: Sequence[str],
    norm: str = "norm",
    ord_col: str = "ord",
    short: float = 0.95,
    long: float = 0.92,
    tile: int = TILE_NAMES,
    hard_ids: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Pairs of different names of one block with at least the threshold similarity.

    ``names`` has one row per block and name.  The result has the block columns and
    ``ord_a, ord_b, norm_a, norm_b, sim`` with ``ord_a < ord_b``, and the columns to ``carry`` of
    either name.  Names that contradict each other in a known one of the ``hard_ids`` ('' is unknown)
    are passed over before their similarity is computed.

    Names are numbered characters (the first e, the second e, ...), and no pair matches on more than it has in
    common.  Products of blocks of such rows give that number for all pairs of two tiles at once, and with lengths and
    common prefix an upper bound of the similarity; it loses no pair.  Only pairs within the bound are compared.
    """
    named = names.withColumnsRenamed({norm: "norm", ord_col: "ord"})
    return _compared(named, list(block_cols), tile, short, long, hard_ids, carry, None).select(
        *block_cols, "ord_a", "ord_b", "norm_a", "norm_b", "sim", *[f"{c}_{s}" for c in carry for s in ("a", "b")])


def _compatible_edges(pairs: DataFrame, profiles: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Links between the rows of paired names whose known identifiers do not contradict.

    For two given sets of known identifiers, rows agree exactly if they are equal on the common
    ones.  Rows of either kind that are equal there all agree across, so one hub links them.
    """
    kinds = 1 << len(ids)
    known = F.lit(0)
    for i, c in enumerate(ids):
        known = known + F.when(F.col(c) != "", 1 << i).otherwise(0)

    def side(which):
        own, other = ("kind_a", "kind_b") if which == "a" else ("kind_b", "kind_a")
        met = pairs.join(
            profiles.withColumnRenamed("name_id", f"name_{which}"), f"name_{which}"
        ).select("name_a", "name_b", "rep", *ids, known.alias(own))
        met = met.withColumn(other, F.explode(F.array(*[F.lit(k) for k in range(kinds)])))
        both = F.col("kind_a").bitwiseAND(F.col("kind_b"))
        common = [
            F.when(both.bitwiseAND(F.lit(1 << i)) != 0, F.col(c)).otherwise("").alias(c)
            for i, c in enumerate(ids)
        ]
        return met.select(
            "name_a", "name_b", "kind_a", "kind_b", *common, "rep", F.lit(which).alias("side")
        )

    met = side("a").unionByName(side("b"))
    keys = ["name_a", "name_b", "kind_a", "kind_b", *ids]
    hubs = (
        met.groupBy(*keys)
        .agg(
            F.min("rep").alias("dst"), F.min("side").alias("_low"), F.max("side").alias("_high"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .filter("_low <> _high")
        .drop("_low", "_high")
    )
    linked = join_counted(met, hubs, keys, "_rows")
    return linked.filter("rep <> dst").select(F.col("rep").alias("src"), "dst").distinct()


def similarity_edges(
    df: DataFrame, ord_col: str = "ord", name: str = "name", area: str = "msa",
    hard_ids: Sequence[str] = ID_COLUMNS, block: Column | None = None,
    short: float = 0.95, long: float = 0.92, tile: int = TILE_NAMES,
) -> DataFrame:
    """Links between rows of one area and block whose names are alike and whose ids agree.

    Rows that share name and identifiers count as one, and so do the rows of one name while names
    are compared.
    """
    ids = list(_with_ids(df, hard_ids))
    norm = resolve_name(F.col(name))
    rows = df.select(
        F.col(ord_col).alias("ord"),
        F.coalesce(F.col(area), F.lit("")).alias("area"),
        norm.alias("norm"),
        *[F.coalesce(v, F.lit("")).alias(c) for c, v in _with_ids(df, hard_ids).items()],
        *([] if block is None else [block.alias("block")]),
    ).filter("norm <> ''")
    if block is None:
        rows = rows.withColumn("block", block_token(F.col("norm")))
    same = ["area", "block", "norm", *ids]
    rows = materialize(rows, "rows")
    copies = hub_edges(rows, "ord", same)
    profiles = materialize(rows.groupBy(*same).agg(F.min("ord").alias("rep")), "profiles")
    single = F.count(F.lit(1)) == 1
    # Only a name with one set of identifiers has them compared as a name.
    names = profiles.groupBy("area", "block", "norm").agg(
        F.min("rep").alias("ord"), single.alias("single"),
        *[F.when(single, F.min(c)).otherwise("").alias(c) for c in ids],
    )
    names = materialize(names, "names")
    # Links between names of one set of identifiers each are final: a forest of them leaves each task.
    pairs = materialize(
        _compared(names, ["area", "block"], tile, short, long, ids, ["single"], "single").select(
            F.col("ord_a").alias("name_a"), F.col("ord_b").alias("name_b"),
            (F.col("single_a") & F.col("single_b")).alias("settled"),
        ),
        "pairs",
    )
    settled = pairs.filter("settled").select(F.col("name_a").alias("src"), F.col("name_b").alias("dst"))
    homonyms = names.filter("NOT single").select(
        F.col("ord").alias("name_a"), F.col("ord").alias("name_b")
    )
    open_pairs = pairs.filter("NOT settled").drop("settled").unionByName(homonyms)
    keyed = profiles.join(
        names.select("area", "block", "norm", F.col("ord").alias("name_id")),
        ["area", "block", "norm"],
    ).select("name_id", "rep", *ids)
    return copies.unionByName(settled).unionByName(_compatible_edges(open_pairs, keyed, ids))


def merge_by_similarity(df: DataFrame, ord_col: str = "ord", **options) -> DataFrame:
    edges = similarity_edges(df, ord_col, **options)
    return collapse_clusters(df, linked_components(edges), ord_col)


# -- merge groups ----------------------------------------------------------------------------


def group_edges(
    df: DataFrame, groups: DataFrame, ord_col: str = "ord", name: str = "name", area: str = "msa"
) -> DataFrame:
    """Links between the rows of one listed group (columns ``group_id, msa, name``)."""
    members = groups.select(
        "group_id",
        F.lower(F.trim("msa")).alias(area),
        resolve_name(F.col("name")).alias("_norm"),
    ).distinct()
    rows = df.select(
        F.col(ord_col).alias("ord"), F.col(area), resolve_name(F.col(name)).alias("_norm")
    )
    hits = rows.join(members, [area, "_norm"]).select("group_id", "ord")
    return hub_edges(hits, "ord", ["group_id"])


def merge_by_groups(df: DataFrame, groups: DataFrame, ord_col: str = "ord", **columns) -> DataFrame:
    edges = group_edges(df, groups, ord_col, **columns)
    return collapse_clusters(df, linked_components(edges), ord_col)
