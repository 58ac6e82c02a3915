"""Analyst queries over the published star tables.

Dimensions are joined through ``lookup_join`` (broadcast only after a bounded
size probe). A filter on a looked-up label is applied to the dimension before
the join, which is what Catalyst would infer anyway, and makes the join inner
exactly as a WHERE on the right side of a left join does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import lookup_join
from starmart.plans.publish import StagedWrite, TableStore
from starmart.schemas import ARRIVALS


def arrivals_lookup(
    fact: DataFrame,
    origin: DataFrame,
    states: DataFrame,
    birth_country: str | None = None,
) -> DataFrame:
    """Arrivals with country and state names; origin plays two roles.

    Columns: immigration_id, country_of_birth, country_of_residence,
    state_name, arrival_date, date_file, permitted_to_stay_until.
    """
    birth = origin.select(
        F.col("country_code").alias("_birth_code"), F.col("country_name").alias("_birth_name")
    )
    residence = origin.select(
        F.col("country_code").alias("_res_code"), F.col("country_name").alias("_res_name")
    )
    birth_how = "left"
    if birth_country is not None:
        birth = birth.where(F.col("_birth_name") == birth_country)
        birth_how = "inner"
    state = states.select(
        F.col("abbreviation").alias("_abbr"), F.col("state_name").alias("_state_name")
    )
    f = fact.select(
        "immigration_id",
        "country_of_birth",
        "country_of_residence",
        "address_state_code",
        "arrival_date",
        "date_file",
        "permitted_to_stay_until",
    )
    j = lookup_join(f, birth, F.col("country_of_birth") == F.col("_birth_code"), birth_how)
    j = lookup_join(j, residence, F.col("country_of_residence") == F.col("_res_code"), "left")
    j = lookup_join(j, state, F.col("address_state_code") == F.col("_abbr"), "left")
    return j.select(
        "immigration_id",
        F.col("_birth_name").alias("country_of_birth"),
        F.col("_res_name").alias("country_of_residence"),
        F.col("_state_name").alias("state_name"),
        "arrival_date",
        "date_file",
        "permitted_to_stay_until",
    )


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """First ``n`` rows in a total order (planned as a per-task top-n plus merge)."""
    return df.orderBy(*order).limit(n)


def arrivals_vs_rate(fact: DataFrame, states: DataFrame, unemployment: DataFrame) -> DataFrame:
    """Arrivals per state and month beside that state's average rate.

    The fact is reduced to (year, month, state code) counts first (partial
    aggregation, so hot states collapse map-side); the joins then touch only
    small aggregates and dimensions, so they are plain: a size probe would compute
    the roll-up twice, and AQE picks the strategy from real sizes.
    """
    return counts_vs_rate(monthly_arrivals(fact), states, unemployment)


def monthly_arrivals(fact: DataFrame) -> DataFrame:
    """year, month, abbreviation, arrivals of fact rows (partial counts in the map tasks)."""
    return fact.groupBy(
        F.year("arrival_date").alias("year"),
        F.month("arrival_date").alias("month"),
        F.col("address_state_code").alias("abbreviation"),
    ).agg(F.count(F.lit(1)).alias("arrivals"))


def counts_vs_rate(counts: DataFrame, states: DataFrame, unemployment: DataFrame) -> DataFrame:
    """Monthly arrivals, from the fact or from the maintained mart, beside the rates."""
    named = counts.join(states, "abbreviation", "left")
    rates = unemployment.select(
        "year", "month", F.col("state").alias("state_name"), "avg_rate"
    )
    return named.join(rates, ["year", "month", "state_name"], "left").select(
        "year", "month", "abbreviation", "state_name", "arrivals", "avg_rate"
    )


def stage_arrivals(store: TableStore, fact: StagedWrite) -> StagedWrite:
    """The monthly mart with a staged fact batch added, to be published with the batch.

    Only the batch is read, never the published fact: its counts are added to the rows
    of the mart they fall on, and only key buckets that hold such a row are written. As
    batch and mart become visible in one commit, the mart always equals a recount.
    """
    counts = monthly_arrivals(store.read_units(fact.spec, fact.units))
    key = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("year", "month")), F.coalesce(F.concat(F.lit("="), "abbreviation"), F.lit("")))
    delta = counts.withColumn("cell", key)
    old = store.current(ARRIVALS, state=fact.base).select("cell", F.col("arrivals").alias("_before"))
    total = F.coalesce("_before", F.lit(0).cast("long")) + F.col("arrivals")
    added = delta.join(old, "cell", "left").select("cell", "year", "month", "abbreviation", total.alias("arrivals"))
    return store.stage_upsert(ARRIVALS, added, fact.base)


def published_arrivals(store: TableStore) -> DataFrame:
    """year, month, abbreviation, arrivals of the maintained mart."""
    return store.current(ARRIVALS).drop("cell")
