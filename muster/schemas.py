"""Schemas of the landed layers and of the roster."""

from __future__ import annotations


SUM_COLUMNS = ["form_d_filings", "sbir_awards", "sbir_total_usd", "nih_grants", "nih_total_usd"]
ID_COLUMNS = ["cik", "uei", "duns"]

ROSTER_TYPES = {
    "msa": "string", "source_form_d": "boolean", "source_sbir": "boolean",
    "source_nih": "boolean", "source_tto": "boolean", "form_d_filings": "bigint",
    "sbir_awards": "bigint", "sbir_total_usd": "double", "nih_grants": "bigint",
    "nih_total_usd": "double", "name": "string", "name_norm": "string", "tier": "string",
    "entity_type": "string", "ls_subcategory": "string", "city": "string", "state": "string",
    "zip": "string", "year_incorp": "string", "industry": "string", "tagline": "string",
    "tto_source_name": "string", "cik": "string", "uei": "string", "duns": "string",
    "website": "string", "employees": "string", "sbir_first_year": "string",
    "sbir_last_year": "string", "tto_location": "string", "url": "string",
}

PORTFOLIO_COLUMNS = ["name", "msa", "source", "tagline", "location", "url"]
CITY_DIM_COLUMNS = ["msa", "city_normalized", "state", "zip_count"]

MSA_CONFIG_TYPE = (
    "struct<msas:map<string,struct<cbsa_code:string,name:string,state_codes:array<string>,"
    "county_fips:array<string>,county_names:map<string,string>,"
    "metropolitan_divisions:map<string,struct<name:string,county_fips:array<string>>>,"
    "principal_cities:array<string>,notable_cities:array<string>>>>"
)
EXCLUSIONS_TYPE = "struct<excluded_names:array<string>>"
MERGES_TYPE = "struct<merges:array<struct<msa:string,names:array<string>,reason:string>>>"
TICKERS_TYPE = "map<string,struct<cik_str:bigint,ticker:string,title:string>>"
