import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cityscan.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="cityscan-tests", shuffle_partitions=4)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="cityscan-test-ckpt-"))
    yield s
    s.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
