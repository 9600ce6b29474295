import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from assay.session import local_session

    s = local_session(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def samples_dir():
    from fixtures import write_samples

    return write_samples(tempfile.mkdtemp(prefix="assay-samples-"))


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="assay-test-")
