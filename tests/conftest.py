import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark import cloudpickle

    import checks
    from zoneloom.session import local_session

    cloudpickle.register_pickle_by_value(checks)
    session = local_session("4", "tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
