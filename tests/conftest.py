import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ndflow.session import get_spark
    from ndflow.session import checkpoint_dir
    s = get_spark("local[4]", app="ndflow-tests", shuffle_partitions=8,
                  extra={"spark.ui.showConsoleProgress": "false"})
    checkpoint_dir(s)  # the configured shared folder, or a temporary one when unset
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ndflow-test-")
