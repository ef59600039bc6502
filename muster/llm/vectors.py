"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Vectors of one label are compared.  A bounded sample gives the cells' centres; every vector lives in the cell
of its nearest centre and visits each cell that may hold a partner.  By the triangle inequality of angles these
are the cells whose centre is no farther than the cell's radius plus the angle of the least cosine, so no link
is lost.  Cells are cut into blocks, and blocks meet in products of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.language import hash_limit
from muster.operators.components import linked_components
from muster.session import materialize

LEAST_COSINE = 0.93
CELL_ROWS = 1500  # vectors a cell is meant to hold
SAMPLE = 20_000  # vectors the centres are fitted to
MOST_CELLS = 4096
BLOCK = 2048
ROUNDS = 12
_SLACK = 1e-9


def units(arrays: list) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision; scaled first, so that none overflows."""
    rows = np.array(arrays, dtype=np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_centres(rows: np.ndarray, count: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Centres of unit rows: each the direction of the sum of the rows nearest to it by cosine."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.permutation(len(rows))[:count]]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 1e-12, sums / np.maximum(norms, 1e-12)[:, None], centres)
    return centres


def _angles(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ centres.T, -1.0, 1.0))


def _columns(batch, name: str) -> list:
    return batch.column(name).to_pylist()


def _groups(batch) -> dict[str, np.ndarray]:
    """Rows of a batch by their label and length."""
    keys = np.array(_columns(batch, "space"))
    return {k: np.flatnonzero(keys == k) for k in np.unique(keys)} if len(keys) else {}


def _spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the visitors and homes of a product, the least row of the home side each is connected to within it.

    Row ``i`` of ``linked`` is a visitor, column ``j`` a home; least labels are passed on until none changes.
    """
    size = linked.shape[1]
    home = np.arange(size)
    while True:
        visitor = np.where(linked, home[None, :], size).min(axis=1, initial=size)
        following = np.minimum(home, np.where(linked, visitor[:, None], size).min(axis=0, initial=size))
        if (following == home).all():
            return visitor, home
        home = following


def link_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    least: float = LEAST_COSINE, cell_rows: int = CELL_ROWS, sample: int = SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector row.

    Vectors link if their labels are equal and known, their lengths are equal, and their cosine is at least
    ``least``.  Null and zero vectors, and those with null or non-finite components, link with nothing.  Equal
    vectors are compared once and counted as often as they occur.  ``component_id`` is the least id connected;
    a row without id has that of its links, and is never kept.  Other columns are not looked at.
    """
    # Strings and vectors keep the type they have; ids may be null or repeat.
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    # Fused copies: -0.0 and 0.0 are one value to Spark's grouping, and to a cosine.
    number = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.col("v").isNotNull() & F.col("label").isNotNull() & F.coalesce(number, F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    space = F.concat_ws(":", F.size("v").cast("string"), F.col("label").cast("string"))
    same = F.sha2(F.concat_ws(",", space, F.concat_ws(",", F.transform("v", lambda x: F.hex((x + F.lit(0.0)).cast("string"))))), 256)
    keyed = rows.withColumn("ok", whole).withColumn("key", F.when(F.col("ok"), same))
    distinct = keyed.filter("ok").withColumn("space", space).groupBy("key", "space").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    distinct = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    total = distinct.count()
    alone = keyed.filter("NOT ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if not total:
        return alone

    # Large spaces, of which there are at most as many as cells, get a share of the sample, and cells by their size;
    # any other is one cell.
    large = materialize(distinct.groupBy("space").count().filter(F.col("count") > max(cell_rows, total // MOST_CELLS)), "spaces")
    sizes = {r["space"]: r["count"] for r in large.toLocalIterator()}
    part = distinct.join(F.broadcast(large.select("space")), "space", "left_semi")
    part = part.filter(F.xxhash64("key") <= hash_limit(min(1.0, sample / total))).select("space", "v").orderBy("space", "key").toPandas()
    centres: dict[str, np.ndarray] = {}
    for name, own in part.groupby("space", sort=True)["v"]:
        wanted = max(1, min(math.ceil(sizes[name] / cell_rows), math.ceil(MOST_CELLS * sizes[name] / total), len(own)))
        centres[name] = spherical_centres(units(own.tolist()), wanted)
    context = vectors.sparkSession.sparkContext
    shared = context.broadcast(centres)

    def home(batches):
        for batch in batches:
            cell, angle = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            vectors_of = _columns(batch, "v")
            for name, own in _groups(batch).items():
                if name in shared.value:
                    angles = _angles(units([vectors_of[i] for i in own]), shared.value[name])
                    cell[own], angle[own] = angles.argmin(axis=1), angles.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("node", "space", "v", "copies")), pa.array(cell), pa.array(angle)],
                ["node", "space", "v", "copies", "cell", "angle"])

    homes = materialize(
        distinct.select("node", "space", "v", "copies").mapInArrow(home, "node long, space string, v array<double>, copies long, cell long, angle double"),
        "homes")
    cells = homes.join(F.broadcast(large.select("space")), "space", "left_semi").groupBy("space", "cell").agg(F.max("angle").alias("radius"))
    limits: dict[str, dict[int, float]] = {}
    for r in cells.toLocalIterator():
        limits.setdefault(r["space"], {})[r["cell"]] = r["radius"]
    limit = context.broadcast(limits)
    reach = math.acos(least)

    def visit(batches):
        """Cells that each vector visits, its own among them."""
        for batch in batches:
            owners, cell, angle = [], [], []
            vectors_of = _columns(batch, "v")
            for name, own in _groups(batch).items():
                known = limit.value.get(name, {0: 0.0})
                order = sorted(known)
                radius = np.array([known[c] for c in order])
                if name in shared.value:
                    angles = _angles(units([vectors_of[i] for i in own]), shared.value[name])[:, order]
                    row, col = np.nonzero(angles <= radius[None, :] + reach + _SLACK)
                else:
                    row, col = np.arange(len(own)), np.zeros(len(own), np.int64)
                owners.append(own[row])
                cell.append(np.array(order)[col])
            take = pa.array(np.concatenate(owners) if owners else np.zeros(0, np.int64))
            where = np.concatenate(cell) if cell else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(take) for n in ("node", "space", "v", "copies")), pa.array(where.astype(np.int64))],
                ["node", "space", "v", "copies", "cell"])

    visits = homes.select("node", "space", "v", "copies").mapInArrow(visit, "node long, space string, v array<double>, copies long, cell long")
    visitors = materialize(visits.groupBy("space", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("vb")), "visits")
    residents = homes.groupBy("space", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("hb"))
    plan = visitors.join(residents, ["space", "cell"])
    salt = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    columns = ["node", "space", "v", "copies", "cell"]
    left = homes.join(plan, ["space", "cell"]).select(*columns, salt("hb").alias("i"), "vb").select(*columns, "i", every("vb").alias("j"), F.lit(True).alias("home"))
    right = visits.join(plan, ["space", "cell"]).select(*columns, salt("vb").alias("j"), "hb").select(*columns, every("hb").alias("i"), "j", F.lit(False).alias("home"))

    def meet(group: pa.Table) -> pa.Table:
        home_side = np.array(_columns(group, "home"))
        nodes, copies = (group.column(n).to_numpy() for n in ("node", "copies"))
        of_home, of_visitor = np.flatnonzero(home_side), np.flatnonzero(~home_side)
        out = {"node": [], "n": [], "to": []}
        if len(of_home) and len(of_visitor):
            every_v = _columns(group, "v")
            unit = units(every_v)
            linked = unit[of_visitor] @ unit[of_home].T >= least
            itself = nodes[of_visitor][:, None] == nodes[of_home][None, :]
            linked &= ~itself
            met = np.flatnonzero(linked.any(axis=1))
            linked = linked[met]
            of_met, of_tied = _spanning(linked)
            # Homes pass their tie on too: their own visits may be in other products, where the tie is unknown.
            tied = np.flatnonzero(of_tied != np.arange(len(of_home)))
            out = {
                "node": np.concatenate([nodes[of_visitor][met], nodes[of_home][tied]]),
                "n": np.concatenate([linked @ copies[of_home], np.zeros(len(tied), np.int64)]),
                "to": nodes[of_home][np.concatenate([of_met, of_tied[tied]])],
            }
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    met = left.unionByName(right).groupBy("space", "cell", "i", "j").applyInArrow(meet, "node long, n long, to long")
    met = materialize(met, "met")
    counts = met.groupBy("node").agg(F.sum("n").alias("n"))
    components = linked_components(met.select(F.col("node").alias("src"), F.col("to").alias("dst")))
    placed = distinct.select("key", "node", "copies", "least_id").join(counts, "node", "left").join(components, "node", "left")
    placed = materialize(placed.select("key", "copies", "least_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component")), "placed")
    named = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = placed.join(named, "component").select("key", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = keyed.filter("ok").select("vec_id", "key").join(named, "key").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return linked.unionByName(alone).select(F.col("vec_id").cast(kinds["vec_id"]), "n_links", "component_id", "kept")
