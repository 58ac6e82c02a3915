"""Declared schemas, keys and rename maps of the star tables.

One registry replaces DDL plus catalog lookups: every published table has a
StructType and an ordered key list, and both the merges and the checks read
their keys from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed pipeline for identical results:
# raw column names, their published names, and the code-list epoch.
# ---------------------------------------------------------------------------

# Raw arrival columns kept by the fact projection, in published order.
RAW_FACT_COLUMNS = [
    "cicid", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr",
    "depdate", "i94bir", "i94visa", "dtadfile", "visapost", "biryear",
    "dtaddto", "gender", "airline", "admnum", "fltno",
]

# Raw name -> published name, in published order (gender keeps its name).
FACT_RENAMES = {
    "cicid": "immigration_id",
    "i94cit": "country_of_birth",
    "i94res": "country_of_residence",
    "i94port": "arrival_port",
    "arrdate": "arrival_date",
    "i94mode": "arrival_mode",
    "i94addr": "address_state_code",
    "depdate": "departure_date",
    "i94bir": "respondent_age",
    "i94visa": "visa_category",
    "dtadfile": "date_file",
    "visapost": "visa_issue_authority",
    "biryear": "year_of_birth",
    "dtaddto": "permitted_to_stay_until",
    "gender": "gender",
    "airline": "arrival_airline",
    "admnum": "admission_number",
    "fltno": "flight_number",
}

# Raw numeric columns narrowed to int and to bigint.
INT_COLUMNS = ["i94cit", "i94res", "i94mode", "i94bir", "i94visa", "biryear"]
BIGINT_COLUMNS = ["cicid", "admnum"]

# Day numbers in the raw file count from this date.
SAS_EPOCH = "1960-01-01"

# Text date patterns of the raw file.
FILE_DATE_PATTERN = "yyyyMMdd"
STAY_DATE_PATTERN = "MMddyyyy"

# English month names, January to December (what the MMMM pattern accepts).
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# Header renames of the states list.
STATES_RENAMES = {"State": "state_name", "Abbreviation": "abbreviation"}

# Name of the country block in the code-list file.
COUNTRY_BLOCK = "i94cntyl"

# ---------------------------------------------------------------------------

RAW_FACT_SCHEMA = StructType(
    [
        StructField("cicid", DoubleType()),
        StructField("i94cit", DoubleType()),
        StructField("i94res", DoubleType()),
        StructField("i94port", StringType()),
        StructField("arrdate", DoubleType()),
        StructField("i94mode", DoubleType()),
        StructField("i94addr", StringType()),
        StructField("depdate", DoubleType()),
        StructField("i94bir", DoubleType()),
        StructField("i94visa", DoubleType()),
        StructField("dtadfile", StringType()),
        StructField("visapost", StringType()),
        StructField("biryear", DoubleType()),
        StructField("dtaddto", StringType()),
        StructField("gender", StringType()),
        StructField("airline", StringType()),
        StructField("admnum", DoubleType()),
        StructField("fltno", StringType()),
    ]
)

FACT_SCHEMA = StructType(
    [
        StructField("immigration_id", LongType()),
        StructField("country_of_birth", IntegerType()),
        StructField("country_of_residence", IntegerType()),
        StructField("arrival_port", StringType()),
        StructField("arrival_date", DateType()),
        StructField("arrival_mode", IntegerType()),
        StructField("address_state_code", StringType()),
        StructField("departure_date", DateType()),
        StructField("respondent_age", IntegerType()),
        StructField("visa_category", IntegerType()),
        StructField("date_file", DateType()),
        StructField("visa_issue_authority", StringType()),
        StructField("year_of_birth", IntegerType()),
        StructField("permitted_to_stay_until", DateType()),
        StructField("gender", StringType()),
        StructField("arrival_airline", StringType()),
        StructField("admission_number", LongType()),
        StructField("flight_number", StringType()),
    ]
)

ORIGIN_SCHEMA = StructType(
    [StructField("country_code", IntegerType()), StructField("country_name", StringType())]
)

STATES_SCHEMA = StructType(
    [StructField("state_name", StringType()), StructField("abbreviation", StringType())]
)

UNEMPLOYMENT_SCHEMA = StructType(
    [
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
        StructField("state", StringType()),
        StructField("avg_rate", DoubleType()),
    ]
)

# Raw CSV files are read as text and typed afterwards.
STATES_CSV_SCHEMA = StructType(
    [StructField("State", StringType()), StructField("Abbreviation", StringType())]
)

UNEMPLOYMENT_CSV_SCHEMA = StructType(
    [
        StructField("Year", StringType()),
        StructField("Month", StringType()),
        StructField("State", StringType()),
        StructField("County", StringType()),
        StructField("Rate", StringType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """Schema, key and storage layout of one published table."""

    name: str
    schema: StructType
    keys: tuple[str, ...]
    insert_only: bool = False
    partition_by: tuple[str, ...] = ()


FACT = TableSpec(
    "fact_immigration",
    FACT_SCHEMA,
    ("immigration_id",),
    insert_only=True,
    partition_by=("arrival_year", "arrival_month"),
)
ORIGIN = TableSpec("dimension_origin", ORIGIN_SCHEMA, ("country_code",))
STATES = TableSpec("dimension_states", STATES_SCHEMA, ("state_name",))
UNEMPLOYMENT = TableSpec(
    "dimension_unemployment", UNEMPLOYMENT_SCHEMA, ("year", "month", "state")
)

# Monthly arrivals per state code, kept beside the fact. ``cell`` names year, month and code
# (any of them may be null, a key column may not).
ARRIVALS = TableSpec(
    "mart_arrivals",
    StructType(
        [
            StructField("cell", StringType()),
            StructField("year", IntegerType()),
            StructField("month", IntegerType()),
            StructField("abbreviation", StringType()),
            StructField("arrivals", LongType()),
        ]
    ),
    ("cell",),
)

# Load order of the merge step: fact, states, origin, unemployment.
REGISTRY: dict[str, TableSpec] = {
    t.name: t for t in (FACT, STATES, ORIGIN, UNEMPLOYMENT)
}


def keys_of(table: str) -> list[str]:
    return list(REGISTRY[table].keys)
