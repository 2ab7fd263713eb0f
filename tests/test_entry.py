"""The driver's contract: names, SQL for known names only, and a pass over the smallest tables."""

import os

import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"


def test_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_flagship(spark):
    got = __spark_entry__.entry(spark)
    assert got.columns == ["feature_available_time_ms", "symbol", "score", "rank", "target_weight"]
    rows = got.collect()
    assert len(rows) > 1000 and all(1 <= r.rank <= 3 and r.target_weight > 0 for r in rows)
