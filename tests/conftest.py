import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from demandlake import session as S
    spark = S.build("local[8]", app="demandlake-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g"})
    S.checkpoint_dir(spark)  # tests: set a scratch checkpoint folder only if unset
    yield spark


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def tmp_lake():
    return tempfile.mkdtemp(prefix="demandlake-test-")
