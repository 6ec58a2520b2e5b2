import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txrisk.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests own their session: set a private checkpoint folder only if unset.
    extra = {}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="txrisk-test-ckpt-")
    s = build_session("local[4]", 4, app_name="txrisk-tests", extra=extra)
    yield s
    s.stop()
