import gzip
import json

import pytest
from pyspark.sql import functions as F

from muster.functions import pages
from muster.operators import columns, enrich, joins, sinks
from muster.plans import geo, layers
from muster.schemas import MSA_CONFIG_TYPE, ROSTER_TYPES
from muster.sources import config, files


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_tsv_keeps_short_and_drops_long_lines(spark, tmp_path):
    write(tmp_path / "a.tsv", "B\tA\n1\tSociété\n2\n3\tx\textra\n4\t\n", "latin-1")
    rows = files.read_tsv(spark, str(tmp_path)).select("A", "B").collect()
    assert sorted((r.B, r.A) for r in rows) == [("1", "Société"), ("2", None), ("4", None)]
    assert files.read_tsv(spark, str(tmp_path)).count() == 3
    assert files.read_tsv(spark, str(tmp_path)).select("B").count() == 3


def quarter(root, name, header_city="CITY", prefix="ISSUERS", tables=("i", "o", "s")):
    folder = root / name
    if "i" in tables:
        write(folder / f"{prefix}.tsv", f"ACCESSIONNUMBER\tENTITYNAME\t{header_city}\tISSUER_STATEORCOUNTRY\tENTITYTYPE\n"
              f"{name}-1\tAcme\t Boston \tma\tCorp\n{name}-2\tBeta\tNowhere\tma\tLLC\n")
    if "o" in tables:
        write(folder / "Offering.tsv", f"AccessionNumber\tIndustryGroupType\tEntityType\n{name}-1\tBiotechnology\tX\n"
              f"{name}-2\tBiotechnology\tX\n")
    if "s" in tables:
        write(folder / "formdsubmission.tsv", f"ACCESSIONNUMBER\tFILING_DATE\tX\n{name}-1\t2020-01-02\tx\n")


def test_filing_quarters(spark, tmp_path):
    """Folders at any depth, file names in any case, two header layouts, one incomplete quarter."""
    quarter(tmp_path, "2020q1")
    quarter(tmp_path / "2020q2", "2020Q2_d", header_city="ISSUER_CITY", prefix="issuers_x")
    quarter(tmp_path, "2020q3", tables=("i", "o"))
    allowlist = spark.createDataFrame(
        [("x", "boston", "MA", 1), ("y", "Boston ", "ma", 2)], "msa string, city_normalized string, state string, ord int"
    )
    scoped = layers.load_filings(spark, str(tmp_path), config.city_dimension(allowlist))
    rows = {r.ACCESSIONNUMBER: r for r in scoped.collect()}
    assert sorted(rows) == ["2020Q2_d-1", "2020q1-1"]
    assert {r._quarter for r in rows.values()} == {"2020q1", "2020q2"}
    assert {r._msa for r in rows.values()} == {"x"} and rows["2020q1-1"].ENTITYTYPE_o == "X"
    assert rows["2020q1-1"].FILING_DATE == "2020-01-02"


def test_filing_tables_must_exist(spark, tmp_path):
    quarter(tmp_path, "2020q1", tables=("i",))
    with pytest.raises(FileNotFoundError):
        layers.read_filings(spark, str(tmp_path))


def test_bulk_csv(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Company,Award Amount\n"Acme, ""A""\nInc","$1,0"\nBeta\nGamma,1,2\n')
    rows = files.read_bulk_csv(spark, path, multi_line=True).collect()
    assert sorted((r.Company, r["Award Amount"]) for r in rows) == [('Acme, "A"\nInc', "$1,0"), ("Beta", None)]
    assert files.read_bulk_csv(spark, path, multi_line=True).count() == 2


def test_csv_columns_are_found_by_name(spark, tmp_path):
    write(tmp_path / "f" / "a.csv", 'Company,City\nAcme,"Rome, ""A"""\n')
    write(tmp_path / "f" / "b.csv", "City,Company,Extra\nOslo,Beta,1\n")
    rows = files.read_bulk_csv(spark, str(tmp_path / "f")).collect()
    assert sorted((r.Company, r.City, r.Extra) for r in rows) == [("Acme", 'Rome, "A"', None), ("Beta", "Oslo", "1")]
    roster = files.read_roster(spark, str(tmp_path / "f"), {"Company": "string", "Extra": "bigint"}).collect()
    assert sorted((r.Company, r.Extra) for r in roster) == [("Acme", None), ("Beta", 1)]


def test_tsv_quotes(spark, tmp_path):
    write(tmp_path / "q.tsv", 'A\tB\n"Foo ""Bar"" Inc"\t1\n"x\ty"\t2\n')
    rows = files.read_tsv(spark, str(tmp_path)).collect()
    assert sorted((r.A, r.B) for r in rows) == [('Foo "Bar" Inc', "1"), ("x\ty", "2")]
    write(tmp_path / "m" / "q.tsv", 'A\tB\n"x\ny"\t1\n')
    assert [(r.A, r.B) for r in files.read_tsv(spark, str(tmp_path / "m"), multiLine=True).collect()] == [("x\ny", "1")]


def test_filing_tables_join_within_a_quarter(spark, tmp_path):
    for name in ("2020q1", "2020q2"):
        folder = tmp_path / name
        write(folder / "ISSUERS.tsv", "ACCESSIONNUMBER\tENTITYNAME\nx-1\tAcme\n")
        write(folder / "OFFERING.tsv", f"ACCESSIONNUMBER\tINDUSTRYGROUPTYPE\nx-1\t{name}\n")
        write(folder / "FORMDSUBMISSION.tsv", f"ACCESSIONNUMBER\tFILING_DATE\nx-1\tin {name}\n")
    rows = layers.read_filings(spark, str(tmp_path)).collect()
    assert sorted((r._quarter, r.INDUSTRYGROUPTYPE, r.FILING_DATE) for r in rows) == [
        ("2020q1", "2020q1", "in 2020q1"), ("2020q2", "2020q2", "in 2020q2")]


def test_one_ticker_per_number(spark):
    rows = spark.createDataFrame([("7.0",), ("8",), (None,)], "cik string")
    tickers = spark.createDataFrame([("7", "A", 2), ("7", "B", 1)], "cik string, ticker string, ord int")
    found = joins.with_ticker(rows, tickers).collect()
    assert sorted((r.cik or "", r.ticker or "") for r in found) == [("", ""), ("7.0", "A"), ("8", "")]


def test_url_years_are_checked(spark):
    rows = spark.createDataFrame([("http://a.b", None), ("http://c.d/", None), ("http://e.f", None)], "website string, founded_year int")
    years = spark.createDataFrame([("http://a.b", "n/a"), ("http://c.d", "9999"), ("http://e.f", "2010-01-01")], "key string, year string")
    found = {r.website: r.founded_year for r in enrich.fill_years(rows, None, years).collect()}
    assert found == {"http://a.b": None, "http://c.d/": None, "http://e.f": 2010}


def test_log_order_over_files(spark, tmp_path):
    write(tmp_path / "l" / "a.csv", "name,field,value\nAcme,city,first\n")
    write(tmp_path / "l" / "b.csv", "name,field,value\n" + "".join(f"Acme,city,later {i}\n" for i in range(300)))
    log = config.read_backfill_log(spark, str(tmp_path / "l"))
    assert log.orderBy("ord").first().value == "first"


def test_awards_need_location_columns(spark):
    with pytest.raises(ValueError):
        layers.normalized_awards(spark.createDataFrame([("a",)], "Company string"))


def test_city_allowlist_file(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'msa,city_normalized,state,zip_count\nx,"winston, salem",NC,2\n')
    assert [(r.city_normalized, r.state) for r in config.read_city_allowlist(spark, path).collect()] == [("winston, salem", "NC")]
    path = write(tmp_path / "c.csv", "msa,city_normalized,state,zip_count\nx,chester,MD,2\ny,chester,MD,1\ny,acme,PA,3\n")
    allowlist = config.read_city_allowlist(spark, path)
    dim = {(r._city_norm, r._state_norm): r._msa for r in config.city_dimension(allowlist).collect()}
    assert dim == {("chester", "MD"): "x", ("acme", "PA"): "y"}
    assert {r.zip_count for r in allowlist.collect()} == {1, 2, 3}


def test_zip_last_wins(spark):
    rows = spark.createDataFrame([("1", "x", 1), ("1", "y", 2)], "zip string, msa string, ord int")
    assert [r.msa for r in config.zip_dimension(rows).collect()] == ["y"]


AREAS = {"msas": {"x": {
    "state_codes": ["PA", "NJ"], "county_fips": ["1", "2"], "county_names": {"1": "A"}, "notable_cities": ["Acme", "Rome"],
    "metropolitan_divisions": {"d": {"name": "D", "county_fips": ["1"]}},
}}}


def test_geo_dimensions(spark, tmp_path):
    path = write(tmp_path / "m.json", json.dumps(AREAS, indent=1))
    areas = config.read_area_config(spark, path)
    assert "map" in MSA_CONFIG_TYPE
    crosswalk = spark.createDataFrame(
        [("001", "1", "Acme", "pa", 0.5, 1), ("001", "2", "Acme", "pa", 0.5, 2), ("002", "2", "", "pa", 0.9, 3),
         ("003", "1", "Gone", "pa", 0.0, 4), ("004", "9", "Far", "pa", 1.0, 5), (None, "1", "Acme", "pa", 1.0, 6)],
        "geoid string, county string, city string, state string, res_ratio double, ord int",
    )
    zips, cities = geo.build_geo_dims(crosswalk, areas)
    assert sorted((r.zip, r.county_fips) for r in zips.collect()) == [("001", "1"), ("002", "2")]
    assert sorted((r.city_normalized, r.state, r.zip_count) for r in cities.collect()) == [
        ("acme", "NJ", 0), ("acme", "PA", 2), ("rome", "NJ", 0), ("rome", "PA", 0)]


def test_name_lists(spark, tmp_path):
    path = write(tmp_path / "e.json", json.dumps({"_comment": "c", "excluded_names": ["A Inc", "B"]}))
    assert sorted(r.name for r in config.read_excluded_names(spark, path).collect()) == ["A Inc", "B"]
    merges = {"merges": [{"msa": "x", "names": ["A", "", "B"], "reason": "r"}, {"msa": " ", "names": ["C"]}]}
    path = write(tmp_path / "m.json", json.dumps(merges))
    assert sorted((r.msa, r.name) for r in config.read_merge_groups(spark, path).collect()) == [("x", "A"), ("x", "B")]


def test_tickers_last_wins(spark, tmp_path):
    doc = {str(i): {"cik_str": 7, "ticker": f"T{i}", "title": "x"} for i in range(12)}
    path = write(tmp_path / "t.json", json.dumps(doc))
    assert [tuple(r) for r in config.read_tickers(spark, path).collect()] == [("7", "T11")]


def test_backfill_log_order(spark, tmp_path):
    lines = "\n".join(f'Acme,city,"City {i}",u,high,"a, b"' for i in range(50))
    path = write(tmp_path / "b.csv", "name,field,value,source_url,confidence,notes\nX,skipped,,,,\n" + lines + "\n")
    log = config.read_backfill_log(spark, path)
    assert [r.value for r in log.orderBy("ord").collect()] == [f"City {i}" for i in range(50)]


def test_optional_and_roster_files(spark, tmp_path):
    assert files.read_optional(spark, str(tmp_path / "none"), "a string").count() == 0
    roster = spark.createDataFrame([("x", None, "00501", 3.0)], "msa string, source_tto boolean, zip string, sbir_awards double")
    sinks.write_csv(roster, str(tmp_path / "r"))
    row = files.read_roster(spark, str(tmp_path / "r"), ROSTER_TYPES).first()
    assert (row.zip, row.source_tto, row.sbir_awards, row.url) == ("00501", False, 3, None)


def test_flatten_two_levels(spark):
    df = spark.createDataFrame([((((1,),), [2]),)], "a: struct<b:struct<c:struct<d:int>>, e:array<int>>")
    assert columns.flatten_struct(df).columns == ["a.b.c", "a.e"]


def test_grants_without_names_give_nothing(spark):
    from muster.operators import rollup

    assert rollup.rollup_grants(spark.createDataFrame([("x", 1)], "_msa string, award_amount int")) is None


ENGAGE = """<ul class="portfolio_list"><li><a href="https://www.acme-bio.com/#t"><img class="big logo" src="/u/acme-bio-white-e12.png">
</a><p class="tagline">We <b>make</b> things</p><span class="ticker">Austin, TX</span></li>
<li><a href="https://www.beta-labs.io/"><img class="icon" src="/u/zzz.png"></a></li></ul>"""
CARDS = """<div class="company"><h3>Acquired</h3><a href="/x">Gamma Inc</a></div>
<div class="company x"><strong>Delta</strong></div><div class="company"><p>Epsilon Labs Institution: U</p></div>"""
BIOS = """<div class="portfolio-company"><h2 class="company-title">Zeta</h2><p class="company-bio">Bio text</p></div>"""
ALTS = """<img src="a" alt="Theta Bio"><img alt="our logo"><img alt="x.PNG"><img alt="Io"><img alt="theta bio">"""


def entities(spark, html, rule):
    pages = spark.createDataFrame([(1, "http://p", html)], "page_id int, url string, html string")
    return enrich.extract_page_entities(pages, rule).orderBy("item_pos").collect()


def test_logo_list(spark):
    rule = enrich.PageRule("engage", enrich.LIST_ITEM, "logo", tagline_class="tagline", location_class="ticker", logo_class="logo")
    one, two = entities(spark, ENGAGE, rule)
    assert (one.name, one.tagline, one.location, one.url) == (
        "Acme Bio", "We make things", "Austin, TX", "https://www.acme-bio.com/#t")
    assert (two.name, two.tagline, two.location) == ("Beta Labs", "", "")


def test_cards(spark):
    rows = entities(spark, CARDS, enrich.PageRule("cards", enrich.card_item("company"), "card", location="Maryland"))
    assert [r.name for r in rows] == ["Gamma Inc", "Delta", "Epsilon Labs"] and rows[0].location == "Maryland"
    rule = enrich.PageRule("bios", enrich.card_item("portfolio-company"), "card", title_class="company-title", tagline_class="company-bio")
    (row,) = entities(spark, BIOS, rule)
    assert (row.name, row.tagline) == ("Zeta", "Bio text")


def test_image_texts(spark):
    rows = entities(spark, ALTS, enrich.PageRule("alts", enrich.IMAGE, "alt", location="Dallas, TX"))
    assert [r.name for r in rows] == ["Theta Bio"]


def test_references_quotes_and_nested_items(spark):
    items = "<ul><li>Johnson &amp; Sons<li>A &#233;&#xE9; &lt;b&gt; &amp;lt; &#0; &#x110000;<ul><li>Inner</li></ul> tail</li></ul>"
    rows = entities(spark, items, enrich.PageRule("list", enrich.LIST_ITEM, "text"))
    assert [r.name for r in rows] == ["Johnson & Sons", "A éé <b> &lt; \ufffd \ufffd", "Inner"]
    images = "<img alt='Eta &amp; Co'><img alt=Iota><img alt = \"Kappa's\">"
    assert [r.name for r in entities(spark, images, enrich.PageRule("alts", enrich.IMAGE, "alt"))] == ["Eta & Co", "Iota", "Kappa's"]
    cards = "<div class='company x'><h3>One &amp; Two</h3></div><div class=company><h3>Three</h3></div>"
    assert [r.name for r in entities(spark, cards, enrich.PageRule("cards", enrich.card_item("company"), "card"))] == ["One & Two", "Three"]


def test_headers_are_read_by_executors(spark, tmp_path):
    """Compressed files, names with blanks and signs, layouts of their own, empty files, long files."""
    root = tmp_path / "layer"
    (root / "2020Q1 x%41").mkdir(parents=True)
    (root / "2020q2").mkdir()
    (root / "2020Q1 x%41" / "Issuers.tsv").write_bytes("A\tNamé\n1\tSociété\n".encode("latin-1") + b"2\tx\n" * 50_000)
    with gzip.open(root / "2020q2" / "ISSUERS.tsv.gz", "wb") as file:
        file.write("NAMÉ\tB\r\nDrei\tzwei\r\n".encode("latin-1"))
    (root / "2020q2" / "issuers_empty.tsv").write_bytes(b"")
    settings = {k: spark.conf.get(k, None) for k in files._FIRST_LINES}
    lines = files._by_header(spark, str(root), "issuers")
    assert sorted(lines) == ["A\tNamé", "NAMÉ\tB"] and [len(p) for p in lines.values()] == [1, 1]
    assert settings == {k: spark.conf.get(k, None) for k in files._FIRST_LINES}
    table = files.read_table_files(spark, str(root), "issuers")
    assert table.columns == ["A", "NAMÉ", "_quarter", "B"] and table.count() == 50_002
    rows = table.filter("A = '1' OR B IS NOT NULL").select("A", "NAMÉ", "B", "_quarter").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "Société", None, "2020q1"), (None, "Drei", "zwei", "2020q2")]
    assert files.read_table_files(spark, str(root), "nothing") is None
    with gzip.open(tmp_path / "bulk.csv.gz", "wt") as file:
        file.write('City,Name\nRome,"A, B"\n')
    assert [tuple(r) for r in files.read_bulk_csv(spark, str(tmp_path / "bulk.csv.gz")).select("Name", "City").collect()] == [("A, B", "Rome")]


def test_elements_are_balanced(spark):
    """Inner elements of the same tag, tails, containers, elements without end tag, comments and scripts."""
    def found(html, **of):
        return spark.createDataFrame([(html,)], "h string").select(pages.elements(F.col("h"), **of)).first()[0]

    nested = '<ul class="x"><li>A<ul><li>B<br>b</li><LI>C</li></ul> tail</li><li id=d>D</ul>after'
    assert found(nested, tag="li") == [
        "<li>A<ul><li>B<br>b</li><LI>C</li></ul> tail</li>", "<li>B<br>b</li>", "<LI>C</li>", "<li id=d>D</ul>after"]
    assert found(nested, tag="li", outermost=True) == ["<li>A<ul><li>B<br>b</li><LI>C</li></ul> tail</li>", "<li id=d>D</ul>after"]
    marked = '<p class="card">1</p><div class="a card b"><div>2<div></div></div></div><div class="cardx">3</div><span class=card>4</span>'
    assert found(marked, css_class="card") == ['<p class="card">1</p>', '<div class="a card b"><div>2<div></div></div></div>', "<span class=card>4</span>"]
    assert found(marked, tag="div", css_class="card") == ['<div class="a card b"><div>2<div></div></div></div>']
    hidden = "<!-- <b>no</b> --><script>var x = '<b>no</b>'</script></b><b>yes</b><br><img src=x><hr>"
    assert found(hidden, tag="b") == ["<b>yes</b>"] and found(hidden, tag="img") == ["<img src=x>"]
    assert found("", tag="b") == [] and found(None, tag="b") is None and found("<b", tag="b") == [] and found("no tags", tag="b") == []


def test_container_of_items(spark):
    html = "<nav><li>Menu</li></nav><div class='list'><ul><li>One<ul><li>In</li></ul> more</li></ul></div><li>Footer</li>"
    rule = enrich.PageRule("list", enrich.Element("li"), "text", container=enrich.Element(css_class="list"))
    assert [r.name for r in entities(spark, html, rule)] == ["One In more", "In"]
    inner = "<div class='list'><div class='company'><div><h3>Eta</h3></div><div>x</div></div><div class='list'><div class='company'><strong>Iota</strong></div></div></div>"
    rule = enrich.PageRule("cards", enrich.Element("div", "company"), "card", container=enrich.Element("div", "list"))
    assert [r.name for r in entities(spark, inner, rule)] == ["Eta", "Iota"]


def test_portfolio_noise_and_order(spark):
    found = spark.createDataFrame([("Menu", "x", 1), ("A", "x", 2), ("Acme", "x", 3)], "name string, msa string, ord int")
    built = layers.build_portfolio([columns.tag(found, source="s")], columns.tag(found, source="seed"))
    assert [(r.name, r.source) for r in built.orderBy("input", "pos").collect()] == [("Acme", "s"), ("Acme", "seed")]
    assert built.select(F.max("location")).first()[0] == ""


def test_headers_take_one_row_of_each_file(spark, tmp_path):
    """No Python function is fed the files: it would be sent every row, even if it stopped after the first."""
    for i in range(3):
        write(tmp_path / f"{i}.tsv", f"A{i}\tB\n" + "1\t2\n" * 20_000)
    lines = files.header_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan and "Arrow" not in plan and "Python" not in plan
    layouts = files._by_header(spark, str(tmp_path))
    assert {k: [p[-5:] for p in v] for k, v in layouts.items()} == {f"A{i}\tB": [f"{i}.tsv"] for i in range(3)}


@pytest.mark.parametrize("name", ["load_filings", "quarter_filings"])
def test_filings_are_made_once(spark, monkeypatch, name):
    """However many tables of however many quarters are written from them."""
    from catalog import files as queries
    from catalog import tables

    made = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: (made.add(1), x)[1]).asNondeterministic()
    fields = ["ACCESSIONNUMBER", "CIK", "ENTITYNAME", "CITY", "STATEORCOUNTRY", "ZIPCODE", "ENTITYTYPE",
              "YEAROFINC_VALUE_ENTERED", "INDUSTRYGROUPTYPE", "FILING_DATE"]
    rows = [(str(i), "1", f"Firm {i}", " Boston", "ma", "02101", "Corp", None, "Biotechnology", "2020-01-02", i) for i in range(7)]
    filings = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fields) + ", ord long")
    filings = filings.withColumn("ACCESSIONNUMBER", count("ACCESSIONNUMBER"))
    cities = spark.createDataFrame([("x", "boston", "MA", 1)], "msa string, city_normalized string, state string, ord int")
    monkeypatch.setattr(queries, "filing_rows", lambda *_: filings)
    monkeypatch.setattr(tables, "city_allowlist", lambda *_: cities)
    found = getattr(queries, name)(spark, "none").collect()
    assert sorted(r.accession for r in found) == sorted([*range(7)] * (3 if name == "quarter_filings" else 1))
    assert made.value == 7
