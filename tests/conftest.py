import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from skein.session import clear_scratch, get_spark
    s = get_spark("local[4]", app="skein-tests", shuffle_partitions=4,
                  **{"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("OFF")
    # tests run in local mode: a scratch checkpoint folder is fine here only
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skein-test-ckpt-"))
    yield s
    clear_scratch(s)
    s.stop()
