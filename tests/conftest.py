import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from urbanlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4, app="urbanlens-tests")
    yield s


@pytest.fixture()
def tmp_dir(spark):
    from urbanlens.session import shared_dir
    import uuid

    return shared_dir(spark, f"tests/{uuid.uuid4().hex[:10]}")
