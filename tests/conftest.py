import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from paracorpus.session import get_spark

    s = get_spark("local[4]", app="paracorpus-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
