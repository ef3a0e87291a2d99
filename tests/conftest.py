import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("VALUORA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from valuora.session import build_session, checkpoint_root

    s = build_session("local[4]", shuffle_partitions=4, extra_conf={"spark.ui.showConsoleProgress": "false"})
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def sales(spark, sf_dir):
    from valuora.sources.tables import sales_table

    return sales_table(spark, sf_dir).cache()
