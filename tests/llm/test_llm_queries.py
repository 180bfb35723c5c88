import os

import pytest

from litweave.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    assert df.count() > 0 and df.columns
