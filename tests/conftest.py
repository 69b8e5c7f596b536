import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from moodwatch.session import local_session
    s = local_session("*", 8, app="moodwatch-tests")
    # tests own their checkpoint folder (a cluster would set spark.checkpoint.dir)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        d = tempfile.mkdtemp(prefix="moodwatch-test-")
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
