import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from muster.functions import exprs, names, pages, similarity



@pytest.mark.parametrize("text, expected", [
    ("Spark Therapeutics, Inc.", "spark therapeutics"),
    ("A.B. Corp LLC", "a b"),
    ("Foo L.L.C.", "foo l l c"),
    ("Société Générale & Co", "société générale"),
    ("Inc. LLC", ""),
    ("  ", ""),
    ("", ""),
    (None, ""),
])
def test_resolve_name(value, text, expected):
    assert value(names.resolve_name, text) == expected


def test_suffix_lists_differ(value):
    assert value(names.normalize_name, "Acme Partners LP") == "acme partners lp"
    assert value(names.resolve_name, "Acme Partners LP") == "acme partners"


@pytest.mark.parametrize("norm, token", [
    ("bio acme labs", "acme"), ("bio labs", "bio"), ("", ""), ("acme", "acme"),
])
def test_block_token(value, norm, token):
    assert value(names.block_token, norm) == token


@pytest.mark.parametrize("text, missing", [
    (None, True), ("", True), (" nan ", True), ("0", True), ("0.0", False), ("12", False),
])
def test_missing_id(value, text, missing):
    assert value(names.is_missing, text) is missing


@pytest.mark.parametrize("text, number", [
    ("12", 12.0), (" 12 ", 12.0), ("1e3", 1000.0), ("-.5", -0.5), ("12d", None), ("nan", None),
    ("1-2", None), ("e", None), ("", None), (None, None), ("Infinity", None), ("0x1p3", None),
])
def test_safe_double(value, text, number):
    assert value(exprs.safe_double, text) == number


@pytest.mark.parametrize("text, amount", [("$1,234.50", 1234.5), ("n/a", 0.0), (None, 0.0)])
def test_money(value, text, amount):
    assert value(exprs.money, text) == amount


@pytest.mark.parametrize("text, year", [("2019.0", 2019), ("1850", None), ("nan", None), (None, None)])
def test_valid_year(value, text, year):
    assert value(exprs.valid_year, text) == year


def test_cik_text(value):
    assert value(names.cik_text, "12345.0") == "12345"
    assert value(names.cik_text, "unknown") is None


def test_title_case(value):
    assert value(exprs.title_case, "2ulaundry white@300x e") == "2Ulaundry White@300X E"


def test_state(value):
    assert value(exprs.state_abbreviation, " New York ") == "NY"
    assert value(exprs.state_abbreviation, "tx") == "TX"
    assert value(exprs.state_abbreviation, None) == ""


@pytest.mark.parametrize("url, expected", [
    ("www.a.com//", "https://www.a.com"), ("http://a.com/x/", "http://a.com/x"), (" nan", None), ("", None),
    (None, None),
])
def test_normalize_url(value, url, expected):
    assert value(exprs.normalize_url, url) == expected


def test_search_urls(value):
    assert value(exprs.filing_search_url, "Sonavex, Inc.").endswith("q=%22Sonavex%2C+Inc.%22&forms=D")
    assert value(exprs.award_search_url, "a*~b").endswith("firm=a%2A~b")


def test_quarters(spark):
    def tags(day):
        today = F.lit(day).cast("date")
        return spark.range(1).select(exprs.quarter_tags(exprs.last_published_quarter(today))).first()[0]

    assert tags(datetime.date(2015, 8, 31)) == ["2015q1", "2015q2", "2015q3"]
    assert tags(datetime.date(2015, 8, 29)) == ["2015q1", "2015q2"]
    assert tags(datetime.date(2014, 1, 1)) == []


@pytest.mark.parametrize("year, bucket", [
    (None, "Unknown"), (1990, "2015-2019"), (2019, "2015-2019"), (2020, "2020"), (2030, "2025-2026"),
])
def test_year_bucket(spark, year, bucket):
    assert spark.range(1).select(exprs.year_bucket(F.lit(year).cast("int"))).first()[0] == bucket


def test_ratio(spark):
    assert spark.range(1).select(exprs.ratio(F.lit(5), F.lit(800))).first()[0] == 0.0063
    assert spark.range(1).select(exprs.ratio(F.lit(5), F.lit(0))).first()[0] is None


def test_text_blob_reads_null_as_nan(spark):
    row = spark.range(1).select(exprs.text_blob(F.lit("Acme"), F.lit(None).cast("string"), F.lit("")))
    assert row.first()[0] == "acme nan "


def test_industry_fill(spark):
    rows = spark.createDataFrame(
        [("Own", "pharma"), (None, "pharma"), (None, "other"), (None, None)], "i string, c string"
    ).select(exprs.fill_industry(F.col("i"), F.col("c"))).collect()
    assert [r[0] for r in rows] == ["Own", "Pharmaceuticals", "Other Health Care", None]


@pytest.mark.parametrize("html, year", [
    ("<p>&copy; 2019 Founded in 2008, since 2010</p>", 2008),
    ("<script>founded 1950</script><b>Est. 1999</b>", 1999),
    ("founded: 1850 and established 2031", None),
    ("Copyright 2015", None),
    ("FOUNDED - 1987", 1987),
    ("unfounded 1987", None),
    (None, None),
])
def test_founding_year(value, html, year):
    assert value(pages.founding_year, html) == year


@pytest.mark.parametrize("path, name", [
    ("/up/2020/acme-bio-white-e1234.png", "Acme Bio"), ("acme_labs-logo.svg", "Acme Labs"),
    ("/x/acme20200101.jpg", "Acme"), ("", ""),
])
def test_name_from_image_file(value, path, name):
    assert value(pages.name_from_image_file, path) == name


def test_name_from_host(value):
    assert value(pages.name_from_host, "https://www.acme-bio.com/#x") == "Acme Bio"


def test_card_name(spark):
    rows = spark.createDataFrame(
        [("Acme", "l", "t"), ("Acquired", "Link", "t"), ("", "", "Acme Labs Institution: X"), ("", "", "x")],
        "h string, l string, t string",
    ).select(pages.card_name(F.col("h"), F.col("l"), F.col("t"))).collect()
    assert [r[0] for r in rows] == ["Acme", "Link", "Acme Labs", ""]


def test_similarity_known_values():
    got = similarity.jaro_winkler_batch(
        ["martha", "dwayne", "dixon", "abc", "", None, "é" * 3], ["marhta", "duane", "dicksonx", "xyz", "a", "a", "é" * 3]
    )
    assert np.allclose(got[:5], [0.9611111111, 0.84, 0.8133333333, 0.0, 0.0])
    assert np.isnan(got[5]) and got[6] == 1.0


def test_similarity_of_long_and_short_texts_in_one_batch():
    left = ["a" * 30_000, "spark"] * 3
    assert np.allclose(similarity.jaro_winkler_batch(left, left), 1.0)


def test_similarity_in_sql(spark):
    similarity.register(spark)
    row = spark.sql("SELECT jaro_winkler('martha', 'marhta') AS s").first()
    assert round(row.s, 6) == 0.961111
