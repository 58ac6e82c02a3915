"""Merges against a brute-force model on small random inputs (both join plans)."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart.operators.merge import insert_only, upsert

SCHEMA = "k bigint, v string"
ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", "c"])),
    max_size=8,
)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def model_insert_only(target, staging):
    present = {k for k, _ in target if k is not None}
    new = [r for r in dict.fromkeys(staging) if r[0] is None or r[0] not in present]
    return Counter(target) + Counter(new)


def model_upsert(target, staging):
    batch = {k for k, _ in staging if k is not None}
    kept = [r for r in target if r[0] is None or r[0] not in batch]
    return Counter(kept) + Counter(list(dict.fromkeys(staging)))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@SETTINGS
@given(target=ROWS, staging=ROWS, small=st.booleans())
def test_insert_only_matches_model(spark, target, staging, small):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(staging, SCHEMA)
    m = insert_only(t, s, ["k"], max_broadcast_rows=100 if small else 0)
    assert bag(m.result) == model_insert_only(target, staging)
    # existing rows never change
    assert not (Counter(target) - bag(m.result))


@SETTINGS
@given(target=ROWS, staging=ROWS, small=st.booleans())
def test_upsert_matches_model_and_is_idempotent(spark, target, staging, small):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(staging, SCHEMA)
    limit = 100 if small else 0
    once = upsert(t, s, ["k"], max_broadcast_rows=limit).result
    assert bag(once) == model_upsert(target, staging)
    # Re-running a batch changes nothing when its keys are non-null (the
    # staging contract guarantees it; a null key never matches, as in SQL).
    if all(k is not None for k, _ in staging):
        assert bag(upsert(once, s, ["k"], max_broadcast_rows=limit).result) == bag(once)
