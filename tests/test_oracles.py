"""Every oracle against its query on the smallest tables; the driver does so on larger ones."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from tessera import plans

SF = "/root/testdata/sf0.001"
QUICK = ["norm_name_v2", "norm_addr_v1", "postal_v2", "tfidf_index_word", "block_full", "block_sorted_neighborhood", "assign_owner", "threshold_sweep", "recall_ceiling", "gt_overlap", "random_negatives", "rate_scenarios"]


def rows(frame):
    out = []
    for row in frame[sorted(frame.columns)].itertuples(index=False, name=None):
        out.append(tuple(repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v) for v in row))
    return sorted(out)


@pytest.mark.parametrize("name", plans.ORACLES if os.environ.get("ALL_ORACLES") else QUICK)
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got, expected = plans.QUERIES[name](spark, SF).toPandas(), con.execute(plans.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_registry():
    assert set(plans.ORACLES) <= set(plans.QUERIES) and len(plans.QUERIES) > 70
