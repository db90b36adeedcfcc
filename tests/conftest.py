import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkstats.session import build_session  # noqa: E402

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="linkstats-tests-")
    s = build_session("local[4]", app="linkstats-tests", shuffle_partitions=4,
                      extra={"spark.local.dir": os.path.join(scratch, "local")})
    if not s.sparkContext.getCheckpointDir():  # only when the environment names none
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s
    s.stop()


@pytest.fixture
def fixtures_dir():
    return FIXTURES


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
