import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.plans.session import get_spark
    s = get_spark("local[4]", app="ledgerloom-tests",
                  conf={"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4",
                        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerloom-tests-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from ledgerloom.sources.fixture import sample_fixture
    t = sample_fixture(spark)
    for df in t.values():
        df.cache()
    return t
