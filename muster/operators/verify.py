"""Checks of a finished roster: expected names, external totals, years, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.defaults import SPOT_CHECK_SUFFIXES
from muster.functions.exprs import ratio
from muster.functions.names import cik_text, normalize_name
from muster.operators.joins import settled
from muster.operators.report import sample_rows
from muster.operators.rules import ratio_flag
from muster.session import materialize


def spot_norm(name: Column) -> Column:
    return normalize_name(name, SPOT_CHECK_SUFFIXES, ascii_only=True)


def spot_check(
    roster: DataFrame, included: Sequence[tuple[str, str]], excluded: Sequence[str]
) -> DataFrame:
    """Hits of names that must be in the roster (of an area) and of names that must not.

    A name counts as found where a roster name contains it, both normalized.  The list is a
    literal of the plan; the roster is read once and needs no join.
    """
    wanted = [("expected_included", n, m) for n, m in included]
    wanted += [("expected_excluded", n, "") for n in excluded]
    schema = "pos int, category string, company string, msa string"
    spark = roster.sparkSession
    table = spark.createDataFrame([(i, *w) for i, w in enumerate(wanted)], schema)
    probes = F.array(*[
        F.struct(F.lit(i).alias("pos"), spot_norm(F.lit(n)).alias("norm"), F.lit(m).alias("area"))
        for i, (_, n, m) in enumerate(wanted)
    ])
    hits = (
        roster.select("msa", spot_norm(F.col("name")).alias("norm"))
        .withColumn("hit", F.explode(F.transform(
            F.filter(
                probes,
                lambda p: F.contains(F.col("norm"), p["norm"])
                & ((p["area"] == "") | (p["area"] == F.coalesce(F.col("msa"), F.lit("")))),
            ),
            lambda p: p["pos"],
        )))
        .groupBy(F.col("hit").alias("pos"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    count = F.coalesce("n", F.lit(0).cast("bigint"))
    passed = (count > 0) == (F.col("category") == "expected_included")
    return table.join(hits, "pos", "left").orderBy("pos").select(
        "category", "company", "msa",
        (count > 0).alias("found_in_output"),
        count.alias("match_count"),
        F.when(passed, "PASS").otherwise("FAIL").alias("result"),
    )


ANCHORS = (8, 3, 2, 1, 0)  # lengths of the strings by which names of a list are found, greatest first


def _pieces(text: Column, length: Column) -> Column:
    """Different substrings of a length; none where the text is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    cut = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, length)))
    return F.when(F.length(text) >= length, cut)


def containing_names(roster: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pos, n``: how many rows of the roster have a name that contains a wanted one, by an index.

    ``roster`` has ``norm, area``, ``wanted`` has ``pos, norm, area``; an empty area stands for all.  A
    name that contains another contains each of its substrings, hence the one of them that is rarest in
    the roster.  Only names that share this anchor meet, each pair once, and are compared in whole.
    Equal names of an area count as one row until the end.
    """
    names = roster.filter("norm IS NOT NULL").groupBy("norm", F.coalesce("area", F.lit("")).alias("area"))
    names = materialize(names.agg(F.count(F.lit(1)).alias("n")), "names")
    sized = F.coalesce(*[F.when(F.length("norm") >= k, F.lit(k)) for k in ANCHORS])
    wanted = settled(wanted.filter("norm IS NOT NULL").withColumn("size", sized))
    choices = wanted.select("pos", "norm", "area", F.explode(_pieces(F.col("norm"), F.col("size"))).alias("anchor"))
    every = F.flatten(F.filter(
        F.array(*[_pieces(F.col("norm"), F.lit(k)) for k in ANCHORS]), lambda found: found.isNotNull()
    ))
    placed = names.select("norm", "area", "n", F.explode(every).alias("anchor"))
    frequent = (
        placed.select("anchor")
        .join(settled(choices.select("anchor").distinct()), "anchor", "left_semi")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    # A name with an anchor that the roster lacks is not there.
    times = F.coalesce("times", F.lit(0).cast("bigint"))
    rarest = choices.join(frequent, "anchor", "left").groupBy("pos").agg(
        F.min_by(F.struct("anchor", "norm", "area"), F.struct(times.alias("times"), "anchor")).alias("least")
    )
    index = settled(rarest.select(
        "pos", F.col("least.anchor").alias("anchor"), F.col("least.norm").alias("part"),
        F.col("least.area").alias("within"),
    ))
    met = placed.join(index, "anchor").filter(
        F.contains(F.col("norm"), F.col("part")) & ((F.col("within") == "") | (F.col("within") == F.col("area")))
    )
    return met.groupBy("pos").agg(F.sum("n").alias("n"))


def spot_check_list(roster: DataFrame, wanted: DataFrame) -> DataFrame:
    """``spot_check`` for a table ``pos, category, company, msa`` of any length; ``pos`` is unique.

    The plan does not grow with the list, and a name of the roster meets only those names of the list
    whose rarest piece it has.  An empty or null area stands for all.
    """
    names = roster.select(spot_norm(F.col("name")).alias("norm"), F.col("msa").alias("area"))
    parts = wanted.select("pos", spot_norm(F.col("company")).alias("norm"), F.coalesce("msa", F.lit("")).alias("area"))
    count = F.coalesce("n", F.lit(0).cast("bigint"))
    passed = (count > 0) == (F.col("category") == "expected_included")
    return wanted.join(containing_names(names, parts), "pos", "left").select(
        "pos", "category", "company", "msa",
        (count > 0).alias("found_in_output"),
        count.alias("match_count"),
        F.when(passed, "PASS").otherwise("FAIL").alias("result"),
    )


def reconcile(roster: DataFrame, areas: DataFrame, external: DataFrame) -> DataFrame:
    """Counts per area and source against external totals of the area's states.

    ``areas`` has ``msa, state_codes``; ``external`` has ``state, source, external_count``.
    """
    ours = roster.groupBy("msa").agg(
        F.count_if("source_form_d").alias("form_d"), F.count_if("source_sbir").alias("sbir")
    )
    totals = (
        areas.select("msa", F.explode("state_codes").alias("state"))
        .join(external, "state")
        .groupBy("msa", "source")
        .agg(F.sum("external_count").alias("external_count"))
    )
    zero = F.lit(0).cast("bigint")
    rows = (
        areas.select("msa")
        .join(ours, "msa", "left")
        .select("msa", F.explode(F.array(*[
            F.struct(F.lit(s).alias("source"), F.coalesce(s, zero).alias("our_count"))
            for s in ("form_d", "sbir")
        ])).alias("row"))
        .select("msa", "row.source", "row.our_count")
        .join(totals, ["msa", "source"], "left")
        .withColumn("external_count", F.coalesce("external_count", zero))
    )
    exact = F.col("our_count") / F.nullif(F.col("external_count"), zero)
    return rows.withColumns({
        "ratio": ratio(F.col("our_count"), F.col("external_count")),
        "flag_if_out_of_range": ratio_flag(F.col("source"), exact),
    })


def year_check(
    roster: DataFrame, external: DataFrame, seed: int, n: int = 10, ord_col: str = "ord"
) -> DataFrame:
    """Years of ``n`` drawn rows against an external table ``cik, year``.

    ``match`` is null where the external table has no year.
    """
    usable = roster.filter(F.col("founded_year").isNotNull() & cik_text(F.col("cik")).isNotNull())
    drawn = sample_rows(usable, F.col(ord_col), seed, n)
    known = external.groupBy(cik_text(F.col("cik")).alias("cik")).agg(
        F.min(F.col("year").cast("string")).alias("sec_year_of_incorp"), F.lit(True).alias("listed")
    )
    theirs = F.col("sec_year_of_incorp")
    return (
        drawn.select(
            F.col("name").alias("company"),
            cik_text(F.col("cik")).alias("cik"),
            F.col("founded_year").cast("int").alias("our_founded_year"),
        )
        .join(known, "cik", "left")
        .select(
            "company", "cik", "our_founded_year", theirs,
            (theirs == F.col("our_founded_year").cast("string")).alias("match"),
            F.when(F.col("listed"), "fetched").otherwise("skipped").alias("status"),
        )
    )


def tally(checks: DataFrame, column: str, good: str, by: str) -> DataFrame:
    """Checks passed and made, per kind."""
    return checks.groupBy(by).agg(
        F.count_if(F.col(column) == good).alias("passed"), F.count(F.lit(1)).alias("checks")
    )


def distinct_firms(df: DataFrame, by: Sequence[str], name: Column) -> DataFrame:
    """Different firm names per group, blank ones left out."""
    key = F.lower(F.trim(name))
    return df.groupBy(*by).agg(F.countDistinct(F.when(key != "", key)).alias("firms"))


def drift_check(
    actual: DataFrame, expected: DataFrame, on: str = "step_name",
    columns: Sequence[str] = ("rows_in", "rows_out", "rows_removed"),
) -> DataFrame:
    """Both counts per step and whether they differ; steps of either side only are listed too."""
    theirs = expected.select(on, *[F.col(c).alias(f"expected_{c}") for c in columns])
    ours = actual.select(on, *columns)
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"expected_{c}"))
    return ours.join(theirs, on, "full_outer").withColumn("drift", ~same)
