"""Registered queries against their reference SQL on the smallest tables."""

import numbers
import os

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as driver

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# A cross-section; the whole list is compared by the driver.
CHOSEN = ["scan_text_na", "sink_roundtrip", "mediate_a", "norm_linker", "clean_key17", "block_key_b2",
          "gt_b1", "gt_b2", "gt_capped", "profile_summary", "split_stratified", "sample_negatives",
          "pair_features", "metrics_links", "linker_features", "candidates",
          "block_costs", "one_to_one_round1", "one_to_one", "linker_distances", "describe_nan", "prepared_splits"]


# Operators on models or token ids, tested against brute force in tests/llm.
WITHOUT_SQL = {q for q in driver.queries() if q == "pipeline" or q.startswith("op")} - set(driver.oracle_sql())


def rows(frame):
    def cell(v):
        if pd.isna(v):
            return ""
        number = isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_))
        return repr(float(v)) if number else str(v)
    columns = sorted(frame.columns)
    return columns, sorted(tuple(cell(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


def test_every_reference_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(driver.queries()) - set(driver.oracle_sql()) == WITHOUT_SQL


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_reference(spark, engine, name):
    got = rows(driver.queries()[name](spark, FOLDER).toPandas())
    expected = rows(engine.execute(driver.oracle_sql()[name]).df())
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[1]


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
