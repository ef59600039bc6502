"""Filters, rules, rollups, funnel: expectations per step, and invariants of whole jobs."""

import pytest
from pyspark.sql import functions as F

from muster import defaults
from muster.operators import enrich, filters, joins, report, rollup, rules, verify
from muster.plans import funnel, reports, roster
from muster.schemas import ROSTER_TYPES


def flags(spark, rows, schema, condition):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(condition).collect()]


def test_category(spark):
    rows = [(c, "Acme") for c in defaults.KEPT_CATEGORIES] + [
        ("digital_health", "Acme Bio"), ("services", "Acme Bio"), ("unknown", "Genomics Solutions LLC"),
        ("unknown", "Software Metrics Inc"), (None, "Genomics"), ("unknown", None)]
    kept = flags(spark, rows, "c string, n string", filters.kept_category(F.col("c"), F.col("n")))
    assert kept == [True] * 5 + [False, False, True, False, True, False]


def test_recency(spark):
    rows = [(True, False, "2010.0"), (False, False, "2021"), (False, False, "2015"), (False, False, "2010"), (None, None, None),
            (None, True, None)]
    kept = flags(spark, rows, "f boolean, t boolean, y string", filters.recent(F.col("f"), F.col("t"), F.col("y")))
    assert kept == [True, True, True, False, False, True]


def test_maturity(spark):
    rows = [("1995", "2020", 25e6), ("1995", "2020", 5e6), ("2015", "2020", 25e6), (None, "2020", 25e6)]
    dropped = flags(spark, rows, "a string, b string, t double", filters.mature(F.col("a"), F.col("b"), F.col("t")))
    assert dropped == [True, False, False, False]


@pytest.mark.parametrize("name, rule", [
    ("OXOS Series #6 Holdings, LLC", "numbered_series"), ("NovaDerm Aid Fund Alpha, L.L.C.", "greek_fund"),
    ("PRIME ER FUND I LLC", "roman_fund"), ("Cancer Check SPV LLC", "spv"), ("Spark Therapeutics Inc", None),
    ("Shield Medical, LLC - Series ALPHA", "dash_series"), ("Alpha Acquisitions, LLC", "acquisition_llc"),
    ("Alpha Acquisitions, LLC Co", None), ("Big Investors L.P. ", "investors_lp"), ("Nature’s Care", "natures_care"),
    (None, None),
])
def test_vehicles(value, name, rule):
    assert value(filters.vehicle_rule, name) == rule


def test_out_of_area(spark):
    rows = [(True, "Norman, OK", "atlanta"), (True, "Atlanta, GA", "Atlanta"), (False, "Norman, OK", "atlanta"),
            (True, "", "atlanta"), (True, "nan", "atlanta"), (True, None, "atlanta"), (True, "Boston", "nowhere"),
            (None, "Boston", "atlanta"), (True, "St. Louis", "atlanta"), (True, "Stx Louis", "atlanta"), (True, "Boston", None)]
    dropped = flags(spark, rows, "t boolean, l string, m string", filters.out_of_area(F.col("t"), F.col("l"), F.col("m")))
    assert dropped == [True] + [False] * 7 + [True, False, False]


def test_scores(spark):
    rows = [(True, True, "2025", "biotech", "2022"), (False, False, "2010", "unknown", "2005"), (None, None, None, None, None),
            (False, False, "2022", "medtech", "2015"), (False, False, "2021", "pharma", "nan")]
    score = rules.priority_score(*[F.col(c) for c in "ftycn"])
    assert flags(spark, rows, "f boolean, t boolean, y string, c string, n string", score) == [11, 0, 0, 3, 3]


def test_entity_types(spark):
    rows = [("Emory University", None, False, False, True), ("Grady Hospital", None, True, False, False),
            ("US Army Lab", None, False, True, False), ("Hope Foundation", None, False, False, False),
            ("Hope Foundation", None, True, False, False), ("Acme", None, False, False, True),
            ("Acme", "Non-Profit Corp", True, False, False), ("Acme", None, None, True, None), ("Éarmy", None, True, None, None)]
    kind = rules.entity_type(F.col("n"), F.lower("n"), F.col("e"), F.col("f"), F.col("a"), F.col("g"))
    got = flags(spark, rows, "n string, e string, f boolean, a boolean, g boolean", kind)
    assert got == ["university", "hospital", "govt_lab", "nonprofit", "startup", "research_inst", "nonprofit", "startup", "startup"]


def test_subcategory_precedence_and_substrings(spark):
    rows = [("arborxr nan", None), ("one-day turnaround", None), ("cell", "Pharmaceuticals"), ("cell ", None),
            ("polymer diagnostics", None), ("x", "Other Health Care"), ("x", None)]
    got = flags(spark, rows, "b string, i string", rules.subcategory(F.col("b"), F.col("i")))
    assert got == ["pharma", "biotech", "pharma", "biotech", "chemistry", "medtech", "unknown"]


def test_tiers(spark):
    rows = [("hospital", True, True, True), ("startup", True, True, True), ("startup", False, True, True),
            ("startup", None, None, True), ("startup", None, None, None)]
    tier = rules.tier(*[F.col(c) for c in "kfat"])
    got = flags(spark, rows, "k string, f boolean, a boolean, t boolean", tier)
    assert got == ["research_inst", "operating_company", "grant_only_company", "tto_spinout", "research_inst"]


def test_rejects_are_the_complement(spark):
    df = spark.range(10).withColumn("p", F.when(F.col("id") % 2 == 0, F.col("id") > 4))
    kept, rejected = filters.split_rejects(df, F.col("p"), "why")
    assert sorted(r.id for r in rejected.collect()) == [6, 8] and kept.count() == 8
    assert {r.drop_reason for r in rejected.collect()} == {"why"}


def test_rollup_keeps_null_keys(spark):
    rows = [("x", None, "a", "1", 1), ("x", None, "b", "1", 2), ("x", "N", None, "3", 3), ("x", "N", "c", "4", 4)]
    filings = spark.createDataFrame(rows, "_msa string, ENTITYNAME string, CIK string, ACCESSIONNUMBER string, ord int")
    for c in ("CITY", "STATEORCOUNTRY", "ZIPCODE", "YEAROFINC_VALUE_ENTERED", "ENTITYTYPE", "_industry_norm"):
        filings = filings.withColumn(c, F.lit(None).cast("string"))
    got = {r.name: (r.cik, r.form_d_filings) for r in rollup.rollup_filings(filings).collect()}
    assert got == {None: ("a", 1), "N": ("c", 2)}


def test_backfill(spark):
    df = spark.createDataFrame(
        [("A", None, None, "z"), ("A", "Own", 1999, ""), ("B", " ", None, None)], "name string, city string, founded_year int, zip string"
    )
    log = spark.createDataFrame(
        [("A", "city", None, 1), ("A", "city", "C1", 2), ("A", "city", "C2", 3), ("A", "founded_year", "bad", 4),
         ("A", "founded_year", "2001", 5), ("A", "nothing", "x", 6), ("B", "city", "D", 7), ("A", "name", "Z", 8)],
        "name string, field string, value string, ord int",
    )
    got = sorted((r.name, r.city, r.founded_year, r.zip or "") for r in enrich.fill_from_log(
        df, log, ["city", "founded_year", "zip", "name", "nothing"]).collect())
    assert got == [("A", "C1", 2001, "z"), ("A", "Own", 1999, ""), ("B", "D", None, "")]


def test_location_fill(spark):
    df = spark.createDataFrame(
        [(None, "GA", "Norman , ok"), ("Own", "GA", "Norman, OK"), (None, "GA", "Maryland")], "city string, state string, tto_location string"
    )
    got = [(r.city, r.state) for r in enrich.fill_location(df).collect()]
    assert got == [("Norman", "OK"), ("Own", "GA"), (None, "GA")]


def test_sample_leaves_out_score_zero_and_repeats(spark):
    df = spark.range(200).select(F.col("id").alias("ord"), (F.col("id") % 12).cast("int").alias("priority_score"),
                                 F.col("id").cast("string").alias("name"), F.lit("x").alias("msa"))
    first = report.stratified_sample(df, 42).collect()
    assert sorted(map(str, first)) == sorted(map(str, report.stratified_sample(df.repartition(7), 42).collect()))
    assert len(first) == 30 and all(r.priority_score > 0 for r in first)
    assert sorted(map(str, first)) != sorted(map(str, report.stratified_sample(df, 43).collect()))


def test_spot_check(spark):
    df = spark.createDataFrame([("Acme Bio, Inc.", "x"), ("ACME BIO LABS", "y"), ("Beta", None)], "name string, msa string")
    rows = verify.spot_check(df, [("Acme Bio", "x"), ("Acme Bio", "z")], ["Beta Inc", "Gamma"]).collect()
    assert [(r.match_count, r.result) for r in rows] == [(1, "PASS"), (0, "FAIL"), (1, "FAIL"), (0, "PASS")]


def test_listed_names_are_found_like_literal_ones(spark):
    names = ["Acme Bio, Inc.", "ACME BIO LABS", "Acme Bio, Inc.", "Beta", "", None, "Ab", "xacme biosystems", "grand acme bio north"]
    df = spark.createDataFrame([(n, "xyz"[i % 3] if i % 4 else None) for i, n in enumerate(names)], "name string, msa string")
    included = [("Acme Bio", "x"), ("Acme Bio", ""), ("b", ""), ("", ""), ("Inc", "y"), ("me biosys", ""), ("nowhere to be found", ""), ("AB", "z")]
    excluded = ["Beta Inc", "Gamma", "acme bio"]
    literal = verify.spot_check(df, included, excluded).collect()
    listed = [("expected_included", n, m) for n, m in included] + [("expected_excluded", n, "") for n in excluded]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(listed)], "pos int, category string, company string, msa string")
    assert verify.spot_check_list(df, table).orderBy("pos").drop("pos").collect() == literal
    nothing = verify.spot_check_list(df.filter("false"), table).collect()
    assert len(nothing) == len(listed) and not any(r.match_count for r in nothing)
    assert verify.spot_check_list(df, table.filter("false")).count() == 0


def test_paged_values(spark):
    rows = [(("hot", None, "b")[i % 3], f"v{i % 700:04d}" if i % 11 else None) for i in range(3000)] + [("bare", None), ("one", "x")]
    df = spark.createDataFrame(rows, "g string, v string").repartition(5)
    lists = {}
    for g, v in rows:
        if v is not None:
            lists.setdefault(g, set()).add(v)
    pages = report.paged_values(df, ["g"], "v", "vs", 64).collect()
    expected = {(g, i // 64): sorted(vs)[i:i + 64] for g, vs in lists.items() for i in range(0, len(vs), 64)}
    assert {(r.g, r.page): r.vs for r in pages} == expected and len(pages) == len(expected)
    assert report.paged_values(df.filter("false"), ["g"], "v", "vs").count() == 0


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_without_key_are_no_hot_key(spark, how):
    rows = spark.range(20000).select("id", F.when(F.col("id") % 10 == 0, (F.col("id") % 400).cast("string")).alias("k"))
    dim = spark.range(0, 400, 20).select(F.col("id").cast("string").alias("k"), F.col("id").alias("found"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in off}
    try:
        for name, setting in off.items():
            spark.conf.set(name, setting)
        out = joins.lookup(rows, dim, "k", how)
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        got = sorted(out.collect(), key=lambda r: r.id)
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting)
    listed = [i for i in range(20000) if i % 20 == 0]
    if how == "left":
        assert out.columns == ["k", "id", "found"] and len(got) == 20000
        assert [(r.id, r.found) for r in got if r.found is not None] == [(i, i % 400) for i in listed]
    else:
        assert out.columns == ["k", "id"] and [r.id for r in got] == [i for i in range(20000) if i % 20]
    assert len(tasks) == 8 and max(tasks) < 1.5 * sum(tasks) / 8


def make_roster(spark):
    schema = ", ".join(f"{n} {t}" for n, t in ROSTER_TYPES.items()) + ", ord bigint"
    base = dict.fromkeys(ROSTER_TYPES)
    rows = [
        dict(name="Acme Bio, Inc.", msa="atlanta", source_form_d=True, ls_subcategory="biotech", year_incorp="2019", sbir_awards=1),
        dict(name="ACME BIO", msa="atlanta", source_sbir=True, ls_subcategory="biotech", sbir_awards=2, sbir_last_year="2024"),
        dict(name="Acme Bios", msa="atlanta", source_sbir=True, ls_subcategory="biotech", sbir_awards=4),
        dict(name="Old Pharma", msa="atlanta", source_sbir=True, ls_subcategory="pharma", sbir_last_year="2001"),
        dict(name="Soft", msa="atlanta", source_form_d=True, ls_subcategory="services"),
        dict(name="Far Bio", msa="atlanta", source_tto=True, ls_subcategory="biotech", tto_location="Boston, MA"),
        dict(name="Near Bio", msa="atlanta", source_tto=True, ls_subcategory="biotech", tto_location="Decatur, ga"),
        dict(name="Fund Alpha SPV", msa="atlanta", source_form_d=True, ls_subcategory="biotech"),
        dict(name="Chain Dental", msa="atlanta", source_form_d=True, ls_subcategory="medtech"),
        dict(name="Public Pharma", msa="dallas", source_form_d=True, ls_subcategory="pharma", cik="77.0"),
        dict(name="Robot Bio", msa="dallas", source_form_d=True, ls_subcategory="medtech"),
        dict(name="Big Pharma", msa="dallas", source_form_d=True, ls_subcategory="pharma", sbir_first_year="1990",
             sbir_last_year="2020", sbir_total_usd=3e7),
        dict(name="Years Bio", msa="dallas", source_form_d=True, ls_subcategory="biotech", cik="88"),
        dict(name="Site Bio", msa="dallas", source_form_d=True, ls_subcategory="biotech", website="site.com/"),
    ]
    data = [tuple({**base, **r}.values()) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def make_config(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "name string")

    return funnel.FunnelConfig(
        vehicle_names=names("Chain Dental Holdings"), excluded_names=names("ROBOT BIO INC"),
        tickers=spark.createDataFrame([("77", "PPH")], "cik string, ticker string"),
        years_by_cik=spark.createDataFrame([("88", "2011-05"), ("99", "1800")], "key string, year string"),
        years_by_url=spark.createDataFrame([("https://site.com", 2012)], "key string, year int"),
        backfill=spark.createDataFrame([("Near Bio", "zip", "30030", 1)], "name string, field string, value string, ord int"),
    )


def test_funnel(spark):
    result = funnel.run_funnel(make_roster(spark), make_config(spark))
    kept = {r.name: r for r in result.kept.collect()}
    assert sorted(kept) == ["Acme Bio, Inc.", "Near Bio", "Site Bio", "Years Bio"]
    acme = kept["Acme Bio, Inc."]
    assert (acme.sbir_awards, acme.source_sbir, acme.priority_score, acme.founded_year) == (7, True, 9, 2019)
    assert "year_incorp" not in result.kept.columns
    assert (kept["Near Bio"].city, kept["Near Bio"].state, kept["Near Bio"].zip) == ("Decatur", "GA", "30030")
    assert (kept["Years Bio"].founded_year, kept["Site Bio"].founded_year) == (2011, 2012)
    assert kept["Near Bio"].industry == "Biotechnology"

    dropped = {r.name: r.drop_step for r in result.rejects.collect()}
    assert dropped == {
        "Far Bio": "Step3_geo_cleanup", "Soft": "Step4_wetlab_subcat", "Old Pharma": "Step5_recency",
        "Big Pharma": "Step6_stage", "Fund Alpha SPV": "Step7_spv_vehicles", "Chain Dental": "Step7_spv_vehicles",
        "Public Pharma": "Step8_public_cos", "Robot Bio": "Step9_nonwetlab_excl"}
    assert {r.ticker for r in result.rejects.collect()} == {None, "PPH"}

    assert result.audit.inputFiles() == []  # counted on writing, no table is read for it
    audit = result.audit.collect()
    assert [r.rows_removed for r in audit] == [1, 1, 0, 1, 1, 1, 1, 2, 1, 1, 0, 0]
    assert audit[0].rows_in == 14 and audit[-1].rows_out == len(kept)
    assert all(a.rows_out == b.rows_in for a, b in zip(audit, audit[1:]))
    assert all(a.rows_in - a.rows_out == a.rows_removed for a in audit)
    assert audit[-1].reason == "filled +1 founded_year cells"

    tables = reports.report_tables(result)
    assert {r.msa: r.prospects for r in tables["area_counts"].collect()} == {"atlanta": 2, "dallas": 2}
    founded = {r.msa: r for r in tables["founded_by_area"].collect()}
    assert founded["dallas"]["2015-2019"] == 2 and founded["atlanta"]["Unknown"] == 1
    assert [r.priority_score for r in tables["top_prospects"].filter("msa = 'atlanta'").collect()] == [9, 4]


def test_funnel_without_inputs(spark):
    result = funnel.run_funnel(make_roster(spark))
    assert result.kept.count() + result.rejects.count() == result.audit.collect()[2].rows_out
    assert "Public Pharma" in {r.name for r in result.kept.collect()}


def test_numbering_follows_the_sort(spark):
    numbered = roster.number_rows(make_roster(spark).drop("ord"), ["msa", "name"])
    assert [r.name for r in numbered.orderBy("ord").collect()] == [r.name for r in numbered.orderBy("msa", "name").collect()]
    assert numbered.select("ord").distinct().count() == 14


def test_drift(spark):
    ours = spark.createDataFrame([("a", 1, 1, 0), ("b", 1, 1, 0)], "step_name string, rows_in int, rows_out int, rows_removed int")
    theirs = spark.createDataFrame([("a", 1, 1, 0), ("c", 1, 1, 0)], "step_name string, rows_in int, rows_out int, rows_removed int")
    assert {r.step_name: r.drift for r in verify.drift_check(ours, theirs).collect()} == {"a": False, "b": True, "c": True}


def test_funnel_of_no_rows(spark):
    result = funnel.run_funnel(make_roster(spark).filter("false"), make_config(spark))
    assert {(r.rows_in, r.rows_out, r.rows_removed) for r in result.audit.collect()} == {(0, 0, 0)}
    assert result.kept.count() == result.rejects.count() == 0
