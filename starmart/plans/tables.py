"""Builders of the fact and the three dimensions (stage 1).

Each builder is a pure DataFrame -> DataFrame (or paths -> DataFrame) plan.
The fact is one projection over the raw scan: conversions, casts and renames
collapse into a single Project inside one whole-stage-codegen span, and only
the 18 used columns are read from Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.casts import integral, rename_columns
from starmart.functions.dates import compact_date, epoch_day_to_date, month_name_to_number
from starmart.operators.dedup import distinct_rows
from starmart.operators.exact import average_of, average_state, merge_states
from starmart.schemas import (
    BIGINT_COLUMNS,
    COUNTRY_BLOCK,
    FACT_RENAMES,
    FILE_DATE_PATTERN,
    INT_COLUMNS,
    RAW_FACT_COLUMNS,
    STATES_CSV_SCHEMA,
    STATES_RENAMES,
    STAY_DATE_PATTERN,
    UNEMPLOYMENT,
    UNEMPLOYMENT_CSV_SCHEMA,
)
from starmart.sources.labels import code_list
from starmart.sources.readers import read_csv


def _conversions() -> dict[str, Column]:
    conv: dict[str, Column] = {
        "arrdate": epoch_day_to_date("arrdate"),
        "depdate": epoch_day_to_date("depdate"),
        "dtadfile": compact_date("dtadfile", FILE_DATE_PATTERN),
        # The stay limit is parsed from its own text, month first.
        "dtaddto": compact_date("dtaddto", STAY_DATE_PATTERN),
    }
    # Raw numbers may arrive as double, integer or text; ids keep all digits.
    conv.update({c: integral(c, "int") for c in INT_COLUMNS})
    conv.update({c: integral(c, "bigint") for c in BIGINT_COLUMNS})
    return conv


def fact_columns() -> list[Column]:
    """The 18 published fact columns as expressions over the raw columns."""
    conv = _conversions()
    return [conv.get(c, F.col(c)).alias(FACT_RENAMES[c]) for c in RAW_FACT_COLUMNS]


def require_raw_columns(raw: DataFrame) -> DataFrame:
    """Fail early, naming them, when raw fact columns are missing."""
    have = {c.lower() for c in raw.columns}
    missing = [c for c in RAW_FACT_COLUMNS if c.lower() not in have]
    if missing:
        raise ValueError(f"raw fact files lack columns {missing}")
    return raw


def build_fact(raw: DataFrame) -> DataFrame:
    """Raw arrival rows -> ``fact_immigration`` (18 typed, renamed columns)."""
    return raw.select(*fact_columns())


REJECT_FLAGS = "_rejects"


def fact_reject_flags() -> Column:
    """One int per raw row: bit i is set when conversion i turned a value into null.

    Carried through the clustering shuffle (4 bytes a row) so the counts can
    be observed on the writing job itself; observing the raw side would also
    count the rows the range sampler reads.
    """
    conv = _conversions()
    flags = F.lit(0)
    for i, c in enumerate(conv):
        flags = flags + F.when(F.col(c).isNotNull() & conv[c].isNull(), F.lit(1 << i)).otherwise(0)
    return flags.alias(REJECT_FLAGS)


def fact_reject_metrics() -> list[Column]:
    """Aggregates over ``fact_reject_flags``: rows each conversion turned into null."""
    return [
        F.sum(F.shiftright(F.col(REJECT_FLAGS), i).bitwiseAND(1)).cast("bigint").alias(f"rejected_{c}")
        for i, c in enumerate(_conversions())
    ]


def build_fact_with_rejects(raw: DataFrame) -> DataFrame:
    """``build_fact`` plus the reject bitmask column."""
    return raw.select(*fact_columns(), fact_reject_flags())


def with_arrival_partition(fact: DataFrame) -> DataFrame:
    """Add the storage partition columns arrival_year and arrival_month."""
    return fact.withColumns(
        {
            "arrival_year": F.year("arrival_date"),
            "arrival_month": F.month("arrival_date"),
        }
    )


def cluster_by_arrival_month(fact: DataFrame) -> DataFrame:
    """Shuffle fact rows so each task writes few, full month directories.

    ``rebalance`` on (arrival_year, arrival_month) is one hash shuffle after
    which AQE splits oversized partitions and merges small ones to the
    advisory size. A month holding a third of all rows (or one id repeated
    that often) is therefore cut into many tasks, and small months share one.
    Unlike range partitioning it needs no sampling pass, which would compute
    the whole input a second time. The local sort by id makes every file's
    row groups id-ordered, so min/max statistics let later key scans skip them.
    """
    return fact.hint("rebalance", "arrival_year", "arrival_month").sortWithinPartitions(
        "arrival_year", "arrival_month", "immigration_id"
    )


def build_origin_from_codes(codes: DataFrame) -> DataFrame:
    """(code, label) text pairs -> ``dimension_origin`` (country_code int, country_name)."""
    return distinct_rows(
        codes.select(
            F.col("code").try_cast("int").alias("country_code"),
            F.col("label").alias("country_name"),
        )
    )


def build_origin(spark: SparkSession, label_paths: str | list[str]) -> DataFrame:
    """Code-list file(s) -> ``dimension_origin`` from the country block."""
    return build_origin_from_codes(code_list(spark, label_paths, COUNTRY_BLOCK))


def build_states_from_raw(raw: DataFrame) -> DataFrame:
    """Raw states list (State, Abbreviation) -> ``dimension_states``.

    Whole rows are de-duplicated before the projection, as in the surveyed job.
    """
    return distinct_rows(rename_columns(raw, STATES_RENAMES)).select("state_name", "abbreviation")


def build_states(spark: SparkSession, csv_paths: str | list[str]) -> DataFrame:
    return build_states_from_raw(read_csv(spark, csv_paths, STATES_CSV_SCHEMA))


def type_rates(raw: DataFrame) -> DataFrame:
    """Raw rate sheet -> typed rows (year int, month int, state, county, rate double),
    other sheet columns kept as they are."""
    typed = {"Year", "Month", "State", "County", "Rate"}
    return raw.select(
        F.col("Year").try_cast("int").alias("year"),
        month_name_to_number("Month").alias("month"),
        F.col("State").alias("state"),
        F.col("County").alias("county"),
        F.col("Rate").try_cast("double").alias("rate"),
        *[F.col(f"`{c}`") for c in raw.columns if c not in typed],
    )


def rate_state(raw: DataFrame) -> DataFrame:
    """State of the averages of a rate sheet's typed, de-duplicated county rows. States of
    sheets that share no row can be merged (``merge_rate_states``) without a reread."""
    return average_state(distinct_rows(type_rates(raw)), UNEMPLOYMENT.keys, "rate")


def merge_rate_states(states: list[DataFrame]) -> DataFrame:
    return merge_states(states, UNEMPLOYMENT.keys)


def rates_of(state: DataFrame) -> DataFrame:
    """``dimension_unemployment`` of a state: the same bits whatever the order of rows."""
    return average_of(state, UNEMPLOYMENT.keys, "avg_rate")


def build_unemployment_from_raw(raw: DataFrame) -> DataFrame:
    """Typed, de-duplicated county rows averaged per (year, month, state)."""
    return rates_of(rate_state(raw))


def build_unemployment(spark: SparkSession, csv_paths: str | list[str]) -> DataFrame:
    return build_unemployment_from_raw(read_csv(spark, csv_paths, UNEMPLOYMENT_CSV_SCHEMA))
