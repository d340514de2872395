import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kerbline.session import local_session


@pytest.fixture(scope="session")
def spark():
    # small partitions stay apart, so that order and offsets across partitions are exercised
    session = local_session(
        "8",
        "kerbline-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
