import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sluice.session import build_session

    s = build_session("local[4]", app="sluice-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def log_of(spark):
    """Build a message log DataFrame[ord, value] from a list of dicts/strings."""
    import json

    def make(lines):
        rows = [((0, i, 0, 0), line if isinstance(line, str) else json.dumps(line)) for i, line in enumerate(lines)]
        return spark.createDataFrame(rows, "ord struct<seq:bigint,k1:bigint,k2:bigint,k3:bigint>, value string")

    return make
