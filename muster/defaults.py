"""Default rule tables and word lists.  Every one is a parameter of the operator that uses it."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values.  They decide the results, so they are stated here as plain text.
# ---------------------------------------------------------------------------

# Legal-form words dropped from names when sources are merged.
MERGE_SUFFIXES = (
    "inc incorporated llc ltd limited corp corporation co company plc pbc pc holdings group the gmbh ag"
).split()

# Legal-form words dropped when duplicates are resolved and lists are matched.
RESOLVE_SUFFIXES = MERGE_SUFFIXES + "lp llp lllp pllc sa nv bv".split()

# Legal-form words dropped by the spot check.
SPOT_CHECK_SUFFIXES = "inc llc ltd corp co plc pbc holdings group gmbh ag the".split()

# Words too common to block on.
GENERIC_TOKENS = (
    "medical health pharma bio therapeutics labs sciences technologies "
    "group holdings therapy systems solutions partners services care"
).split()

# Named character references in entity names; the ampersand comes last, so that nothing is decoded twice.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "\u00a9", "reg": "\u00ae", "trade": "\u2122",
    "ndash": "\u2013", "mdash": "\u2014", "lsquo": "\u2018", "rsquo": "\u2019", "ldquo": "\u201c", "rdquo": "\u201d",
    "hellip": "\u2026", "middot": "\u00b7", "bull": "\u2022", "eacute": "\u00e9", "egrave": "\u00e8", "auml": "\u00e4",
    "ouml": "\u00f6", "uuml": "\u00fc", "szlig": "\u00df", "ccedil": "\u00e7", "ntilde": "\u00f1", "amp": "&",
}

# Texts that stand for a missing identifier.
MISSING_ID_TEXTS = ["", "nan", "0"]

# Industries in scope for filings.
FILING_INDUSTRIES = ["Pharmaceuticals", "Biotechnology", "Other Health Care"]

# First quarter of the filing archive, and the days after which a quarter counts as published.
FIRST_QUARTER = "2015-01-01"
PUBLICATION_LAG_DAYS = 60

STATE_ABBREVIATIONS = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA",
    "colorado": "CO", "connecticut": "CT", "delaware": "DE", "district of columbia": "DC",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL",
    "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA",
    "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN",
    "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV",
    "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR",
    "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD",
    "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA",
    "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}

# Words of an institution's name, by entity type, as regular expressions between word boundaries.
UNIVERSITY_WORDS = (
    r"university|universities|college|colleges|institute of technology|polytechnic|"
    r"school of medicine|school of public health|school of nursing|medical school|"
    r"graduate school|seminary"
)
HOSPITAL_WORDS = (
    r"hospital|hospitals|medical center|health system|clinic|health network|healthcare system|"
    r"childrens|cancer center|heart institute|eye institute|orthopaed?ic institute|rehabilitation"
)
GOVERNMENT_WORDS = (
    r"department of (?:defense|energy|agriculture|veterans)|naval|army|air force|"
    r"national institutes? of|national laboratory|national lab|federal|u\.?s\.? department|usda|"
    r"noaa|nasa|cdc|fda|epa|veterans affairs|public health (?:dept|department)"
)
NONPROFIT_WORDS = (
    r"foundation|trust|coalition|society|association|consortium|institute for|research institute|"
    r"chari?table|nonprofit"
)
NONPROFIT_FILER_TYPES = ["non-profit", "nonprofit"]

# Subcategory keywords in order of precedence; matched as substrings, trailing blanks included.
SUBCATEGORY_KEYWORDS = [
    ("chemistry", ["chemic", "chemistry", "polymer", "material science", "specialty chem",
                   "petrochem", "catalys", "coating", "fluorochem", "nanotech", "nanomater"]),
    ("diagnostics", ["diagnost", "molecular dx", "screening", "biomarker", "assay",
                     "liquid biopsy", "pathology"]),
    ("medtech", ["medical device", "medtech", "biomed", "robotics", "imaging", "surgical",
                 "implant", "wearable", "monitor", "sensor", "orthopedic", "orthopaedic",
                 "dental", "cardio", "cardiac", "catheter", "stent", "prosthe", "infusion"]),
    ("pharma", ["pharma", "therapeutic", "biopharm", "drug", "rx", "medicine"]),
    ("biotech", ["bio ", "bioscience", "biotech", "biolog", "biophys", "bioengineer", "microbi",
                 "protein", "enzyme", "genomics", "genetic", "cell ", "cellular", "gene ", "rna",
                 "dna", "crispr", "vaccine", "immuno", "oncology", "cancer", "neuro", "stem cell",
                 "antibod", "peptide"]),
    ("digital_health", ["software", "platform", "ai-powered", "ai for", "digital health",
                        "telehealth", "telemedicine", "saas", "data platform", "machine learning",
                        "ml ", "ehr"]),
    ("services", ["consulting", "services", "cro ", "contract research", "cdmo",
                  "manufacturing services", "supply chain"]),
]
# Subcategory by words of the industry field, when no keyword fits.
SUBCATEGORY_BY_INDUSTRY = [("pharma", "pharm"), ("biotech", "biotech"), ("medtech", "health")]

RESEARCH_TYPES = ["university", "hospital", "govt_lab", "research_inst", "nonprofit"]
STARTUP_TIERS = ["operating_company", "grant_only_company", "tto_spinout"]
TIERS = ["grant_only_company", "operating_company", "research_inst", "tto_spinout"]
SUBCATEGORIES = ["biotech", "chemistry", "diagnostics", "digital_health", "medtech", "pharma",
                 "services", "unknown"]

# Categories kept by the funnel, and the name words that keep a row of unknown category.
KEPT_CATEGORIES = ["biotech", "pharma", "diagnostics", "chemistry", "medtech"]
KEPT_NAME_WORDS = (
    r"bio|genom|genet|therap|pharma|cell|rna|dna|protein|chem|catalys|polymer|molecul|assay|"
    r"diagnos|vaccine|immun|onco|neuro|antibody|peptide|enzyme|fermen|culture|tissue|stem|crispr|"
    r"gene|drug|formul|synthe|reagent|crystal|nano|bioprocess|mab|adc"
)
HIGH_CATEGORIES = ["biotech", "pharma", "diagnostics", "chemistry"]

RECENT_SINCE = 2015
MATURE_SPAN_YEARS = 20
MATURE_TOTAL_USD = 20_000_000
YEAR_RANGE = (1900, 2030)

# Place names that put a location outside the area a row was assigned to.
OUT_OF_AREA_PLACES = {
    "atlanta": [
        "san francisco", "sf, ca", "austin", "boston", "new york", "nyc", "seattle", "chicago",
        "los angeles", "l.a.", "denver", "portland", "miami", "charlotte", "raleigh", "durham",
        "nashville", "houston", "san diego", "minneapolis", "st. louis", "detroit", "phoenix",
        "salt lake", "las vegas", "oklahoma", "tallahassee", "fort lauderdale", "auburn, al",
        "norman, ok", "alameda"],
    "philadelphia": [
        "san francisco", "austin", "boston", "new york", "nyc", "seattle", "chicago",
        "los angeles", "denver", "portland", "miami", "atlanta", "dallas", "pittsburgh",
        "baltimore", "houston", "san diego"],
    "pittsburgh": [
        "san francisco", "austin", "boston", "new york", "nyc", "seattle", "chicago",
        "los angeles", "denver", "portland", "miami", "atlanta", "dallas", "philadelphia",
        "baltimore", "houston", "san diego"],
    "baltimore": [
        "san francisco", "austin", "boston", "new york", "nyc", "seattle", "chicago",
        "los angeles", "denver", "portland", "miami", "atlanta", "dallas", "pittsburgh",
        "philadelphia", "houston", "san diego"],
    "dallas": [
        "san francisco", "austin", "boston", "new york", "nyc", "seattle", "chicago",
        "los angeles", "denver", "portland", "miami", "atlanta", "pittsburgh", "philadelphia",
        "baltimore", "san diego", "houston"],
}

# Names of paper vehicles and operating chains: (rule name, case-insensitive expression).
VEHICLE_RULES = [
    ("numbered_series", r"\bSeries\s*#?\s*\d+\b"),
    ("greek_fund",
     r"\bFund\s+(Alpha|Beta|Gamma|Delta|Epsilon|Zeta|Eta|Theta|Iota|Kappa|Lambda|Lamda|Mu|Mi|Nu|"
     r"Ni|Xi|Ksi|Omicron|Pi|Rho|Sigma|Tau|Upsilon|Phi|Chi|Psi|Omega)\b"),
    ("roman_fund", r"\bFund\s+(I{1,3}|IV|VI{0,3}|IX|XI{0,3}|XIV|XV)\b"),
    ("qp_investors", r"\bQP\s+Investors\b"),
    ("investors_llc", r"\bInvestors\s+LLC\b"),
    ("aid_fund", r"\bAid\s+Fund\b"),
    ("spv", r"\bSPV\b"),
    ("master_fund", r"\bMaster\s+Fund\b"),
    ("feeder_fund", r"\bFeeder\s+Fund\b"),
    ("re_holdings", r"\bRE\s+Holdings\b"),
    ("acquisition_corp", r"\bAcquisition\s+Corp\b"),
    ("acquisition_llc", r"\bAcquisitions?,?\s*LLC$"),
    ("distressed_fund", r"\bDistressed\s+Fund\b"),
    ("alternative_finance", r"\bAlternative\s+Finance\b"),
    ("investment_holdings", r"\bInvestment\s+Holdings\b"),
    ("holdco_management", r"\bHoldco\s+Management\b"),
    ("usrc", r"^USRC\b"),
    ("north_texas_renal", r"^North\s+Texas\s+Renal\b"),
    ("texas_surgery_center", r"^Texas\s+Health\s+Surgery\s+Center\b"),
    ("pgc", r"^PGC['s]?\s"),
    ("pgcs_pc", r"^PGCS\s+PC\s"),
    ("responseco", r"^ResponseCO\b"),
    ("acuity_eyecare", r"^Acuity\s+Eyecare\b"),
    ("neuron_shield", r"^Neuron\s+Shield\b"),
    ("natures_care", r"^Nature['’]s\s+Care\b"),
    ("teresas_house", r"^Teresa['’]s\s+House\b"),
    ("herbal_pharm", r"^Herbal\s+Pharm\b"),
    ("irazu_oncology", r"^Irazu\s+Oncology\b"),
    ("dash_series",
     r"\s-\s*Series\s+(ALPHA|BETA|GAMMA|DELTA|EPSILON|ZETA|ETA|THETA|IOTA|KAPPA|LAMBDA|MU|NU|XI|"
     r"OMICRON|PI|RHO|SIGMA|TAU|UPSILON|PHI|CHI|PSI|OMEGA)\b"),
    ("investors_lp", r"\bInvestors\s+L\.?P\.?\s*$"),
]

# Industry given to rows without one, by subcategory.
INDUSTRY_BY_SUBCATEGORY = {
    "biotech": "Biotechnology", "pharma": "Pharmaceuticals", "medtech": "Other Health Care",
    "diagnostics": "Other Health Care", "chemistry": "Other Health Care",
    "digital_health": "Other Health Care", "services": "Other Health Care",
    "unknown": "Other Health Care",
}
DEFAULT_INDUSTRY = "Other Health Care"

# Phrases that state a founding year on a web page.
FOUNDING_PHRASES = [
    r"\bfounded\s+(?:in\s+)?(\d{4})\b",
    r"\bestablished\s+(?:in\s+)?(\d{4})\b",
    r"\bsince\s+(\d{4})\b",
    r"\bincorporated\s+(?:in\s+)?(\d{4})\b",
    r"\best\.?\s+(\d{4})\b",
    r"\bfounded[:\s\-]+(\d{4})\b",
]

FOUNDED_BUCKETS = ["2015-2019", "2020", "2021", "2022", "2023", "2024", "2025-2026", "Unknown"]

# Words of page navigation that are no entity names; words and endings that rule out image texts.
NAVIGATION_WORDS = ["home", "menu", "about", "contact", "search", "learn more", "read more",
                    "portfolio", "companies", "next", "prev"]
IMAGE_STOP_WORDS = ["logo", "icon", "image", "photo", "background"]
IMAGE_FILE_ENDINGS = [".png", ".jpg", ".jpeg"]
CARD_STATUS_WORDS = ["acquired", "active", "exited", ""]

# Columns of the long backfill log that carry no value to fill in.
BACKFILL_SKIPPED_FIELDS = ["skipped", "all"]

# Accepted header names, lower case, in order of preference.
CITY_ALIASES = ["city", "company city", "firm city", "addressline_2_city"]
STATE_ALIASES = ["state", "company state", "firm state"]
ORG_ALIASES = {
    "name": ["organization.org_name", "organization_org_name", "org_name"],
    "city": ["organization.org_city", "organization_org_city", "org_city"],
    "state": ["organization.org_state", "organization_org_state", "org_state"],
    "zip": ["organization.org_zipcode", "organization_org_zipcode", "org_zipcode"],
}
AMOUNT_ALIASES = ["award_amount", "total_cost"]

# Priority score: points per signal.
SCORE_FILING = 3
SCORE_LAST_YEAR = [(2024, None, 3), (2022, 2023, 2), (2020, 2021, 1)]
SCORE_PORTFOLIO = 2
SCORE_HIGH_CATEGORY = 2
SCORE_INCORPORATED = (2015, 1)

SAMPLE_BANDS = [("high (>=7)", 7, None), ("mid (4-6)", 4, 6), ("low (1-3)", 1, 3)]
RATIO_BANDS = {"form_d": (0.001, 0.20), "sbir": (0.05, 0.80)}

FILING_SEARCH_URL = ("https://efts.sec.gov/LATEST/search-index?q=%22", "%22&forms=D")
AWARD_SEARCH_URL = ("https://www.sbir.gov/sbirsearch/award/all?firm=", "")

# Column order of the interim and the classified roster.
INTERIM_FRONT = [
    "msa", "name", "name_norm", "tier", "city", "state", "zip", "source_form_d", "source_sbir",
    "source_nih", "form_d_filings", "sbir_awards", "sbir_total_usd", "nih_grants",
    "nih_total_usd", "year_incorp", "entity_type", "industry", "cik", "uei", "duns", "website",
    "employees", "sbir_first_year", "sbir_last_year"]
ROSTER_FRONT = [
    "msa", "name", "name_norm", "tier", "entity_type", "ls_subcategory", "city", "state", "zip",
    "source_form_d", "source_sbir", "source_nih", "source_tto", "form_d_filings", "sbir_awards",
    "sbir_total_usd", "nih_grants", "nih_total_usd", "year_incorp", "industry", "tagline",
    "tto_source_name", "cik", "uei", "duns", "website", "employees", "sbir_first_year",
    "sbir_last_year"]

# Tags of elements that have no end tag.
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
