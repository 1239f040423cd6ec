import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohortlens.session import local_session

    s = local_session(4, shuffle_partitions=4, app="cohortlens-tests")
    yield s
    s.stop()


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    """Run a test under ANSI mode on and off: results must not depend on it."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)
