import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rolefeed.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="rolefeed-tests")
    yield s


def evaluate(spark, rows, schema, **exprs):
    """Evaluate Column expressions over literal rows; returns list of dicts."""
    df = spark.createDataFrame(rows, schema)
    out = df.select(*[e.alias(k) for k, e in exprs.items()]).collect()
    return [r.asDict(recursive=True) for r in out]
