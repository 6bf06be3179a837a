"""Table schemas, keys, column lengths and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the source system's values for the results
# to match.  Listed plainly, in their natural order.
# ---------------------------------------------------------------------------

# Tracked series: (series_id, name, category), in seed order.
SERIES_SEED = [
    ("DGS1MO", "1-Month Treasury", "treasury"),
    ("DGS3MO", "3-Month Treasury", "treasury"),
    ("DGS6MO", "6-Month Treasury", "treasury"),
    ("DGS1", "1-Year Treasury", "treasury"),
    ("DGS2", "2-Year Treasury", "treasury"),
    ("DGS5", "5-Year Treasury", "treasury"),
    ("DGS7", "7-Year Treasury", "treasury"),
    ("DGS10", "10-Year Treasury", "treasury"),
    ("DGS20", "20-Year Treasury", "treasury"),
    ("DGS30", "30-Year Treasury", "treasury"),
    ("BAMLC0A0CM", "ICE BofA US Corporate Index OAS", "credit_spread"),
    ("BAMLC0A4CBBB", "ICE BofA BBB US Corporate Index OAS", "credit_spread"),
    ("BAMLH0A0HYM2", "ICE BofA US High Yield Index OAS", "credit_spread"),
    ("FEDFUNDS", "Federal Funds Effective Rate", "policy"),
    ("SOFR", "Secured Overnight Financing Rate", "policy"),
    ("VIXCLS", "CBOE Volatility Index", "risk"),
    ("TEDRATE", "TED Spread", "risk"),
    ("T10YIE", "10-Year Breakeven Inflation Rate", "inflation"),
]
SERIES_IDS = [s[0] for s in SERIES_SEED]

# Yield-curve tenors (output column -> series id).
YIELD_CURVE_TENORS = {"yield_2y": "DGS2", "yield_10y": "DGS10", "yield_30y": "DGS30"}
FULL_CURVE_TENORS = {
    "yield_1m": "DGS1MO",
    "yield_3m": "DGS3MO",
    "yield_6m": "DGS6MO",
    "yield_1y": "DGS1",
    "yield_2y": "DGS2",
    "yield_5y": "DGS5",
    "yield_7y": "DGS7",
    "yield_10y": "DGS10",
    "yield_20y": "DGS20",
    "yield_30y": "DGS30",
}
TREASURY_PREFIX = "DGS"
# Credit-stress legs (output column -> series id).
STRESS_LEGS = {
    "hy_spread": "BAMLH0A0HYM2",
    "vix": "VIXCLS",
    "ted_spread": "TEDRATE",
    "fed_funds": "FEDFUNDS",
}
# stress_score = round(hy_spread / 10 + vix / 40, 2), missing legs count as 0.
STRESS_HY_DIVISOR = 10
STRESS_VIX_DIVISOR = 40
# Label thresholds; every comparison is strict.
CURVE_INVERTED_BELOW = 0      # spread_2s10s < 0     -> INVERTED
CURVE_FLAT_BELOW = 0.25       # spread_2s10s < 0.25  -> FLAT, else NORMAL
STRESS_HIGH_ABOVE = 1.5       # stress_score > 1.5   -> HIGH
STRESS_ELEVATED_ABOVE = 0.8   # stress_score > 0.8   -> ELEVATED, else LOW
# Filing form -> summary column.
FORM_ANNUAL, FORM_QUARTERLY, FORM_CURRENT = "10-K", "10-Q", "8-K"
# Bronze observation value that means "no value".
MISSING_MARKER = "."
# Quality rule: series ids are upper-case alphanumerics.
SERIES_ID_REGEX = r"^[A-Z0-9]+$"
# SEC central index keys are zero-padded to this width.
CIK_WIDTH = 10

# ---------------------------------------------------------------------------
# Types and tables
# ---------------------------------------------------------------------------

VALUE_TYPE = T.DecimalType(10, 4)

OBSERVATIONS = T.StructType([
    T.StructField("observation_date", T.DateType(), False),
    T.StructField("series_id", T.StringType(), False),
    T.StructField("value", VALUE_TYPE, True),
])
OBSERVATIONS_KEY = ["observation_date", "series_id"]

FILINGS = T.StructType([
    T.StructField("accession_number", T.StringType(), False),
    T.StructField("cik", T.StringType(), False),
    T.StructField("company_name", T.StringType(), True),
    T.StructField("filing_type", T.StringType(), True),
    T.StructField("filing_date", T.DateType(), True),
])
FILINGS_KEY = ["accession_number"]

SERIES = T.StructType([
    T.StructField("series_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("is_active", T.BooleanType(), True),
])
#: stored config tables also say when a row was created
CREATED_AT = T.StructField("created_at", T.TimestampType(), True)
SERIES_KEY = ["series_id"]

COMPANIES = T.StructType([
    T.StructField("cik", T.StringType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("is_active", T.BooleanType(), True),
])
COMPANIES_KEY = ["cik"]

# Declared VARCHAR lengths; see operators.constraints for how they are kept.
MAX_LENGTHS = {
    "observations": {"series_id": 20},
    "filings": {"accession_number": 25, "cik": 10, "company_name": 255, "filing_type": 20},
    "series": {"series_id": 20, "name": 100, "category": 50},
    "companies": {"cik": 10, "ticker": 10, "name": 255},
}

#: table -> (columns, key): what operators.constraints compiles
TABLES = {
    "observations": (OBSERVATIONS, OBSERVATIONS_KEY),
    "filings": (FILINGS, FILINGS_KEY),
    "series": (SERIES, SERIES_KEY),
    "companies": (COMPANIES, COMPANIES_KEY),
}

# --- bronze documents -------------------------------------------------------

OBSERVATION_DOC = T.StructType([
    T.StructField("observations", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])

FILING_DOC = T.StructType([
    T.StructField("cik", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("filings", T.StructType([
        T.StructField("recent", T.StructType([
            T.StructField("accessionNumber", T.ArrayType(T.StringType())),
            T.StructField("form", T.ArrayType(T.StringType())),
            T.StructField("filingDate", T.ArrayType(T.StringType())),
        ])),
    ])),
])

# Company directory: {"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple Inc."}, ...}
TICKER_ENTRY = T.StructType([
    T.StructField("cik_str", T.LongType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("title", T.StringType()),
])
TICKER_DIRECTORY = T.MapType(T.StringType(), TICKER_ENTRY)
