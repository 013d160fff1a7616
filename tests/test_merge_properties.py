"""Merge semantics against a brute-force model on random frames (NULL keys, repeated keys)."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.merge import DuplicateSourceKey, merge_insert, merge_upsert

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))
rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, data):
    return spark.createDataFrame(data, "k long, v string")


def model_insert(target, source):
    tkeys = {k for k, _ in target if k is not None}
    return Counter(r for r in source if r[0] is None or r[0] not in tkeys)


def model_upsert(target, source):
    skeys = {k for k, _ in source if k is not None}
    return Counter([r for r in target if r[0] is None or r[0] not in skeys] + list(source))


@SETTINGS
@given(target=rows, source=rows)
def test_insert_matches_model(spark, target, source):
    want = model_insert(target, source)
    for max_rows in (1_000_000, 0):  # broadcast probe and shuffle fallback
        got = Counter(tuple(r) for r in merge_insert(frame(spark, target), frame(spark, source), "k",
                                                     max_rows=max_rows).collect())
        assert got == want


@SETTINGS
@given(target=rows, source=rows)
def test_upsert_matches_model(spark, target, source):
    src_keys = [k for k, _ in source if k is not None]
    if len(src_keys) != len(set(src_keys)):
        with pytest.raises(DuplicateSourceKey):
            merge_upsert(frame(spark, target), frame(spark, source), "k")
        return
    want = model_upsert(target, source)
    for max_rows in (1_000_000, 0):
        got = Counter(tuple(r) for r in merge_upsert(frame(spark, target), frame(spark, source), "k",
                                                     max_rows=max_rows).collect())
        assert got == want
