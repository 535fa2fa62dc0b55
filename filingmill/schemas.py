"""Table contracts: what is selected from raw records, and the declared shape of each table."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: raw field -> Spark type (the cleaned name is the lower-cased field) -----------

FINANCIALS_FIELDS = {
    "CERT": "bigint",
    "REPDTE": "string",
    "NAME": "string",
    "STALP": "string",
    "STNAME": "string",
    "BKCLASS": "string",
    "ASSET": "double",
    "DEP": "double",
    "EQ": "double",
    "NETINC": "double",
    "ROA": "double",
    "ROE": "double",
}

BRANCH_FIELDS = {
    "CERT": "bigint",
    "UNINUMBR": "bigint",
    "NAMEFULL": "string",
    "CITYBR": "string",
    "STALPBR": "string",
    "STNAMEBR": "string",
    "DEPSUMBR": "double",
    "ASSET": "double",
    "YEAR": "bigint",
}

# Tracked institution attributes: raw field -> column, in the order they are hashed.
TRACKED_FIELDS = {
    "NAME": "name",
    "CITY": "city",
    "STALP": "state",
    "BKCLASS": "bkclass",
    "REGAGNT": "regagnt",
    "NAMEHCR": "holding_company",
}

PROVENANCE = ("_ingested_at", "_batch_id")

FINANCIALS_KEY = ("cert", "repdte")
BRANCH_KEY = ("uninumbr", "cert", "repdte")  # the most selective first: sorts compare it first

# ---- fixed values: ends of a history, the member for what is unknown, what a refresh needs ------

LOW_WATER_MARK = "1900-01-01"
OPEN_END = "9999-12-31"
UNKNOWN_SK = "unknown"
UNKNOWN_NAME = "Unknown Institution"

REQUIRED_RAW = ("institutions", "financials", "sod")

# ---- fixed values: accepted codes ----------------------------------------------------------------

BANK_CLASSES = ("NM", "SM", "N", "SI", "SB", "NC", "SL", "OI")

STATE_CODES = (
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "FM", "GA",
    "GU", "HI", "IA", "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME",
    "MI", "MN", "MO", "MS", "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV",
    "NY", "OH", "OK", "OR", "PA", "PR", "RI", "SC", "SD", "TN", "TX", "UT",
    "VA", "VI", "VT", "WA", "WI", "WV", "WY",
)

# ---- fixed values: fields the branch survey is known to carry, by kind ---------------------------

BRANCH_DICTIONARY = {
    "ADDRESBR": "string",
    "ADDRESS": "string",
    "ASSET": "number",
    "BKCLASS": "string",
    "BKMO": "number",
    "BRCENM": "string",
    "BRNUM": "number",
    "BRSERTYP": "number",
    "CALL": "string",
    "CB": "number",
    "CBSA_DIV_NAMB": "string",
    "CERT": "number",
    "CHARTER": "string",
    "CHRTAGNN": "string",
    "CHRTAGNT": "string",
    "CITY": "string",
    "CITY2BR": "string",
    "CITYBR": "string",
    "CITYHCR": "string",
    "CLCODE": "number",
    "CNTRYNA": "string",
    "CNTRYNAB": "string",
    "CNTYNAMB": "string",
    "CNTYNUMB": "number",
    "CONSOLD": "number",
    "CSABR": "number",
    "CSANAMBR": "string",
    "DENOVO": "number",
    "DEPDOM": "number",
    "DEPSUM": "number",
    "DEPSUMBR": "number",
    "DIVISIONB": "number",
    "DOCKET": "number",
    "ESCROW": "number",
    "FDICDBS": "number",
    "FDICNAME": "string",
    "FED": "number",
    "FEDNAME": "string",
    "HCTMULT": "string",
    "INSAGNT1": "string",
    "INSBRDD": "number",
    "INSBRTS": "number",
    "INSURED": "string",
    "METROBR": "number",
    "MICROBR": "number",
    "MSABR": "number",
    "MSANAMB": "string",
    "NAMEBR": "string",
    "NAMEFULL": "string",
    "NAMEHCR": "string",
    "NECNAMB": "string",
    "NECTABR": "string",
    "OCCDIST": "number",
    "OCCNAME": "string",
    "PLACENUM": "number",
    "REGAGNT": "string",
    "RSSDHCR": "number",
    "RSSDID": "number",
    "SIMS_ACQUIRED_DATE": "string",
    "SIMS_DESCRIPTION": "string",
    "SIMS_ESTABLISHED_DATE": "string",
    "SIMS_LATITUDE": "number",
    "SIMS_LONGITUDE": "number",
    "SIMS_PROJECTION": "string",
    "SPECDESC": "string",
    "SPECGRP": "number",
    "STALP": "string",
    "STALPBR": "string",
    "STALPHCR": "string",
    "STCNTY": "number",
    "STCNTYBR": "number",
    "STNAME": "string",
    "STNAMEBR": "string",
    "STNUMBR": "number",
    "UNINUMBR": "number",
    "UNIT": "number",
    "USA": "number",
    "YEAR": "number",
    "ZIP": "string",
    "ZIPBR": "string",
    "ZIPBR_RAW": "string",
    "ZIP_RAW": "string",
}

# ---- fixed values: rankable metric -> (mart, column) ---------------------------------------------

METRICS = {
    "roa": ("mart_profitability_trends", "roa"),
    "roe": ("mart_profitability_trends", "roe"),
    "roa_qoq_change": ("mart_profitability_trends", "roa_qoq_change"),
    "roe_qoq_change": ("mart_profitability_trends", "roe_qoq_change"),
    "asset": ("mart_asset_growth", "asset"),
    "asset_growth_qoq": ("mart_asset_growth", "asset_growth_qoq"),
    "asset_growth_yoy": ("mart_asset_growth", "asset_growth_yoy"),
}

# ---- declared tables -----------------------------------------------------------------------------


TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def columns_of(text: str) -> T.StructType:
    """A schema from "name type, name type"; unlike DDL it needs no running session."""
    pairs = (column.split() for column in text.split(", "))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


HISTORY = columns_of(
    "cert bigint, name string, city string, state string, bkclass string, regagnt string, "
    "holding_company string, valid_from date, valid_to date, is_current boolean, _hash string"
)
FINANCIALS = columns_of(
    "cert bigint, repdte date, name string, stalp string, stname string, bkclass string, "
    "asset double, dep double, eq double, netinc double, roa double, roe double, "
    "_ingested_at string, _batch_id string"
)
BRANCHES = columns_of(
    "cert bigint, uninumbr bigint, namefull string, citybr string, stalpbr string, "
    "stnamebr string, depsumbr double, asset double, year bigint, repdte date, "
    "_ingested_at string, _batch_id string"
)
FRESHNESS = columns_of("published_at timestamp, max_repdte date, financials_row_count bigint")

# ---- response shapes of the serving reads --------------------------------------------------------

INSTITUTION = columns_of(
    "cert bigint, name string, city string, state string, bkclass string, regagnt string, "
    "holding_company string, valid_from date, latest_asset double, latest_repdte date"
)
FINANCIAL_PERIOD = columns_of(
    "cert bigint, repdte date, state string, bkclass string, asset double, dep double, "
    "eq double, netinc double, roa double, roe double"
)
RANKING_ENTRY = columns_of(
    "rank bigint, cert bigint, name string, state string, repdte date, metric string, value double"
)
HEALTH = columns_of(
    "status string, published_at timestamp, max_repdte date, financials_row_count bigint, "
    "detail string"
)

# ---- the message topic: columns as the Kafka source names them -----------------------------------

# Fixed values, too.
TOPIC = "filing.received"
DT_MARKER = "_repdte_partition"
MESSAGE = columns_of("key string, value string, partition int, offset bigint")
