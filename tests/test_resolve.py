"""Duplicate resolution against brute force on small fixtures, with skew."""

import random

import numpy as np
import pytest

from muster.functions import similarity
from muster.functions.similarity import jaro_winkler_batch
from muster.operators import components, joins, resolve

SCHEMA = "ord bigint, msa string, name string, cik string, uei string, source_tto boolean, sbir_awards bigint"


def groups_of(n, edges):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {i: root(i) for i in range(n)}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(30)],
    [(0, i) for i in range(1, 200)],
    [(199, i) for i in range(0, 199)],
    [],
    [(3, 3)],
])
def test_components_shapes(spark, edges):
    nodes = spark.range(200).toDF("id")
    found = components.connected_components(nodes, spark.createDataFrame(edges, "src bigint, dst bigint"))
    assert {r.node: r.component for r in found.collect()} == groups_of(200, edges)


def test_components_random(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)]
    found = components.connected_components(
        spark.range(400).toDF("id"), spark.createDataFrame(edges, "src bigint, dst bigint")
    )
    assert {r.node: r.component for r in found.collect()} == groups_of(400, edges)


def test_components_with_hot_hubs(spark):
    edges = [(i, i % 3) for i in range(300)] + [(299, i) for i in range(100, 200)] + [(250, 251)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    expected = groups_of(300, edges)
    found = components.linked_components(df, hot_rows=20)
    assert {r.node: r.component for r in found.collect()} == expected


def test_hub_edges_with_hot_keys(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 12}") for i in range(300)], "ord bigint, k string")
    plain = sorted(map(tuple, resolve.hub_edges(rows, "ord", ["k"]).collect()))
    hot = resolve.hub_edges(rows, "ord", ["k"], hot_rows=50)
    assert sorted(map(tuple, hot.collect())) == plain and len(plain) == 300 - 5


def test_lookup_with_hot_and_missing_keys(spark):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else i % 4) for i in range(200)], "ord bigint, k bigint")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (9, "z")], "k bigint, v string").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for how in ("left", "left_anti"):
        found = joins.lookup(rows, dim, "k", how)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1  # the rows are read once
        assert sorted(map(str, found.select("ord", "k").collect())) == sorted(
            map(str, rows.join(dim, "k", how).select("ord", "k").collect()))
    values = {r.ord: r.v for r in joins.lookup(rows, dim, "k").collect()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert values == {i: None if i % 5 == 0 else {0: "a", 1: "b"}.get(i % 4) for i in range(200)}


def test_components_report_too_few_rounds(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)], "src bigint, dst bigint")
    with pytest.raises(RuntimeError):
        components.linked_components(edges, max_rounds=1)


def entities(seed, n):
    """Names with slips; a third of all rows are copies of one name, and one block is hot."""
    rng = random.Random(seed)
    words = ["alpha", "alpine", "beta", "gamma", "gamut", "delta"]
    rows = []
    for i in range(n):
        if rng.random() < 0.33:
            name = "Hot Name Inc"
        else:
            name = f"{rng.choice(['hot', 'hot', 'cold'])} {rng.choice(words)} {rng.choice(words)}"
            if rng.random() < 0.4:
                at = rng.randrange(len(name))
                name = name[:at] + rng.choice("abcdxyz") + name[at + 1 :]
        cik = rng.choice([None, None, "0", "1", "2", "3"])
        uei = rng.choice([None, "", "u", "v"])
        rows.append((i, rng.choice(["x", "y"]), name, cik, uei, rng.random() < 0.5, i))
    return rows


def norm(name):
    return " ".join(w for w in name.lower().replace(",", " ").split() if w != "inc")


def known(v):
    return v if v not in (None, "", "0") else None


def brute_links(rows):
    links = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = rows[i], rows[j]
            na, nb = norm(a[2]), norm(b[2])
            if a[1] != b[1] or not na or not nb or na.split()[0] != nb.split()[0]:
                continue
            if any(known(a[k]) and known(b[k]) and a[k] != b[k] for k in (3, 4)):
                continue
            tokens = max(len(na.split()), len(nb.split()))
            if jaro_winkler_batch([na], [nb])[0] >= (0.95 if tokens <= 2 else 0.92):
                links.append((i, j))
    return links


@pytest.mark.parametrize("seed, tile", [(1, 2000), (2, 3)])
def test_similarity_against_all_pairs(spark, seed, tile):
    rows = entities(seed, 220)
    df = spark.createDataFrame(rows, SCHEMA)
    edges = resolve.similarity_edges(df, tile=tile)
    found = components.connected_components(df.select("ord"), edges)
    assert {r.node: r.component for r in found.collect()} == groups_of(len(rows), brute_links(rows))


def test_similarity_links_stay_linear_in_copies(spark):
    rows = [(i, "x", "Hot Name Inc", None, None, False, 1) for i in range(3000)]
    edges = resolve.similarity_edges(spark.createDataFrame(rows, SCHEMA))
    assert edges.count() < 2 * len(rows)
    merged = resolve.merge_by_similarity(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(merged) == 1 and merged[0].sbir_awards == 3000


def test_copies_with_contradicting_ids_stay_apart(spark):
    rows = [(i, "x", "Hot Name Inc", str(1 + i % 50), None, False, 1) for i in range(500)]
    merged = resolve.merge_by_similarity(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(merged) == 50 and all(r.sbir_awards == 10 for r in merged)


def test_chain_joins_despite_veto(spark):
    rows = [
        (0, "x", "northwind analytics", "1", None, False, 0),
        (1, "x", "northwind analytic", None, None, False, 0),
        (2, "x", "northwind analytcs", "2", None, False, 0),
    ]
    assert resolve.merge_by_similarity(spark.createDataFrame(rows, SCHEMA)).count() == 1


def test_suffix_only_names_never_link(spark):
    rows = [(0, "x", "Inc", None, None, False, 0), (1, "x", "LLC", None, None, False, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert resolve.merge_by_identity(df).count() == 2
    assert resolve.merge_by_similarity(df).count() == 2


def test_identity_same_name(spark):
    df = spark.createDataFrame(
        [(0, "phila", "Acme Bio, Inc.", True, False, 0, 0.0), (1, "phila", "ACME BIO INC", False, True, 3, 500_000.0)],
        "ord bigint, msa string, name string, source_form_d boolean, source_sbir boolean, "
        "sbir_awards bigint, sbir_total_usd double",
    )
    (row,) = resolve.merge_by_identity(df).collect()
    assert (row.source_form_d, row.source_sbir, row.sbir_total_usd, row.name) == (True, True, 500_000.0, "Acme Bio, Inc.")


def test_identity_keeps_areas_apart_unless_an_id_links(spark):
    rows = [
        (0, "phila", "Acme Bio Inc", None, None, True, 1), (1, "atlanta", "Acme Bio Inc", None, None, True, 1),
        (2, "phila", "Alpha LLC", "12345.0", None, True, 1), (3, "dallas", "Beta", "12345.0", None, False, 1),
        (4, "phila", "Zero one", "0", None, True, 1), (5, "phila", "Zero two", "0", None, True, 1),
    ]
    merged = resolve.merge_by_identity(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.ord, r.msa) for r in merged.collect()) == [
        (0, "phila"), (1, "atlanta"), (2, "phila"), (4, "phila"), (5, "phila")]


def test_collapse_null_rules(spark):
    df = spark.createDataFrame(
        [(0, "x", "same", None, None, None, None), (1, "x", "same", "7", None, None, None)], SCHEMA
    )
    (row,) = resolve.merge_by_identity(df).collect()
    assert (row.cik, row.uei, row.source_tto, row.sbir_awards) == ("7", None, False, 0)


def test_merge_groups(spark):
    rows = [
        (0, "dallas", "Nano Technologies LLC", None, None, True, 1), (1, "dallas", "Nano Therapeutics, Inc.", None, None, False, 2),
        (2, "atlanta", "Nano Technologies", None, None, False, 4), (3, "dallas", "Single", None, None, False, 8),
    ]
    groups = spark.createDataFrame(
        [(0, " Dallas", "NANO TECHNOLOGIES"), (0, " Dallas", "nano therapeutics"), (1, "dallas", "Single")],
        "group_id int, msa string, name string",
    )
    merged = resolve.merge_by_groups(spark.createDataFrame(rows, SCHEMA), groups)
    assert sorted((r.ord, r.sbir_awards) for r in merged.collect()) == [(0, 3), (2, 4), (3, 8)]


def test_result_does_not_depend_on_partitions(spark):
    rows = entities(5, 150)
    seen = set()
    for partitions in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        df = spark.createDataFrame(rows, SCHEMA).repartition(int(partitions))
        merged = resolve.merge_by_similarity(resolve.merge_by_identity(df))
        seen.add(tuple(sorted(map(str, merged.collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(seen) == 1


def words(count, seed=1):
    """Different names of one block, some of them slips of others."""
    rng = random.Random(seed)
    parts = "al be co da en fi ga hy in jo ka lu me no op pra qui ro si ti um vi wa xe yo zen tri gen mat ser".split()
    vocabulary = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(400)]
    made = {}
    while len(made) < count:
        name = f"hot {rng.choice(vocabulary)} {rng.choice(vocabulary)}"
        if rng.random() < 0.3:
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice("abcdxyz") + name[at + 1 :]
        made[name] = None
    return list(made)


@pytest.mark.parametrize("tile", [2000, 37])
def test_similar_names_against_all_pairs(spark, tile):
    names = words(300) + ["hot", "hot a", "é" * 3000, "é" * 2999 + "x", "ab", "ba"]
    rows = [(i, "x" if i % 7 else "y", n) for i, n in enumerate(names)]
    found = resolve.similar_names(spark.createDataFrame(rows, "ord bigint, msa string, norm string"), ["msa"], tile=tile)
    want = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            few = max(len(a[2].split()), len(b[2].split())) <= 2
            sim = jaro_winkler_batch([a[2]], [b[2]])[0] if a[1] == b[1] else 0
            if sim >= (0.95 if few else 0.92):
                want.add((a[1], a[0], b[0], a[2], b[2], round(sim, 9)))
    assert {(r.msa, r.ord_a, r.ord_b, r.norm_a, r.norm_b, round(r.sim, 9)) for r in found.collect()} == want and len(want) > 10


def test_few_pairs_of_a_large_block_are_compared(monkeypatch):
    names, compared = words(4000), []
    computed = similarity.jaro_winkler_batch
    monkeypatch.setattr(similarity, "jaro_winkler_batch", lambda a, b: compared.append(len(a)) or computed(a, b))
    similarity.similar_pairs(names, [False] * len(names), [0] * len(names), 0.95, 0.92)
    assert sum(compared) < len(names) * (len(names) - 1) / 2 / 10


def test_no_join_of_a_block_with_itself(spark):
    names = spark.createDataFrame([(i, "x", n) for i, n in enumerate(words(30))], "ord bigint, msa string, norm string")
    plan = resolve.similar_names(names, ["msa"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_links_of_alike_names_are_a_forest(spark):
    rows = [(i, "x", f"hot entity number {i:05d}", None, None, False, 1) for i in range(1500)]
    edges = resolve.similarity_edges(spark.createDataFrame(rows, SCHEMA), tile=500)
    assert edges.count() <= 6 * 1000  # six pairs of three tiles, less than two tiles' names from each
    assert resolve.merge_by_similarity(spark.createDataFrame(rows, SCHEMA), tile=500).count() == 1


def test_forest():
    rng = random.Random(2)
    links = [(rng.randrange(40), rng.randrange(40)) for _ in range(60)]
    i, j = (np.array(x) for x in zip(*links))
    kept = similarity.forest(i, j)
    assert groups_of(40, links) == groups_of(40, [x for x, k in zip(links, kept) if k])
    assert kept.sum() == 40 - len(set(groups_of(40, links).values()))
