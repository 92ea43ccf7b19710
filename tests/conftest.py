import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from seqrisk.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4, app="seqrisk-tests",
                    extra={"spark.ui.showConsoleProgress": "false"}, driver_memory="8g")
    yield s


@pytest.fixture
def no_coalescing(spark):
    """Small inputs keep all their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
