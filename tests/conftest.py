import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphloom import contract as C  # noqa: E402
from graphloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def files_of(spark):
    def make(sources, repository="test/repository"):
        rows = [
            (repository, path, text if isinstance(text, bytes) else text.encode(), None, None)
            for path, text in sources.items()
        ]
        return spark.createDataFrame(rows, C.FILES)
    return make
